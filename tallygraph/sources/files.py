import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.functions import trim_controls


def split_paths(paths: str | list[str]) -> list[str]:
    """``"a,b"`` or ``["a", "b"]``; a comma inside a ``{x,y}`` glob does not split."""
    if not isinstance(paths, str):
        return list(paths)
    return [path for path in re.split(r",(?![^{]*\})", paths) if path]


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(value)``, one row per line, blank lines included."""
    return spark.read.text(split_paths(paths))


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(doc_id, text)``, one row per line, ``doc_id`` the base name of the file.

    Files stay splittable and no file is held whole. Equal base names in different
    folders are one document.
    """
    lines = read_lines(spark, paths)
    # The metadata name is URL-encoded, but a plus sign in it is literal.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return lines.select(trim_controls(name).alias("doc_id"), F.col("value").alias("text"))


def count_files(spark: SparkSession, paths: str | list[str]) -> int:
    """Files directly in the folders, empty and hidden ones included; a path may be a pattern
    or a single file.

    A listing only. The readers skip empty and hidden files, so this is the corpus
    size when such files are to count as documents. A folder without subfolders is one call,
    whatever the number of its files.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def files_in(file_system, path) -> int:
        summary = file_system.getContentSummary(path)
        if summary.getDirectoryCount() <= 1:
            return summary.getFileCount()
        entries, count = file_system.listStatusIterator(path), 0
        while entries.hasNext():
            count += entries.next().isFile()
        return count

    total = 0
    for name in split_paths(paths):
        pattern = jvm.org.apache.hadoop.fs.Path(name)
        file_system = pattern.getFileSystem(conf)
        matches = file_system.globStatus(pattern)
        if not matches:
            raise FileNotFoundError(name)
        total += sum(files_in(file_system, match.getPath()) for match in matches)
    return total
