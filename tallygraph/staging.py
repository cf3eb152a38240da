"""Intermediate tables in the folder that ``spark.checkpoint.dir`` names."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Taken from the session. Only a local master may fall back to a temporary
    folder, as executors on other machines could not read it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallygraph-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a checkpointed table that nothing reads any more.

    Spark keeps them for ever unless told otherwise when the session starts.
    """
    folder = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if folder.isDefined():
        _delete(df.sparkSession, folder.get())


class Staging:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
        """Write ``df`` as Parquet and return the stored table: short lineage, and
        later passes read only the columns they use."""
        df.write.parquet(self.path(name), compression=compression)
        return df.sparkSession.read.schema(df.schema).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        """A stored table again, in the session of the area, whichever wrote it."""
        return self._spark.read.parquet(self.path(name))

    def drop(self) -> None:
        _delete(self._spark, self.root)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """A staging area that is dropped at the end of the block."""
    area = Staging(spark)
    try:
        yield area
    finally:
        area.drop()
