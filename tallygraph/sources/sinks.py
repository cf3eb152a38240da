from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.operators.rank import rank_order
from tallygraph.operators.skew import shuffle_partitions

SCORE_SCHEMA = "word string, doc_id {}, tfidf double"

# Text of a named file, at which it goes on in another file of that name.
PIECE_BYTES = 1 << 26


def write_scores(scores: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store a TF-IDF table for search.

    Range partitioned and sorted by word, then document: a term lies in a few neighbouring
    files and a search opens no others, while a frequent word is split over several.
    """
    ranges = scores.repartitionByRange("word", "doc_id").sortWithinPartitions("word", "doc_id")
    ranges.write.mode(mode).parquet(path)


def read_scores(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    return spark.read.schema(SCORE_SCHEMA.format(id_type)).parquet(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Tab-separated text without quoting, one file per partition. A compressed file is read back by one task."""
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    df.select(F.concat_ws("\t", *cells).alias("value")).write.mode(mode).text(path, compression)


def write_ranked(ranks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``id`` tab ``rank``, highest first.

    Range partitioned and written by all tasks; the part files in name order are
    the global order.
    """
    write_tsv(rank_order(ranks).select("id", "rank"), path, mode)


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """``(id, rank)`` of a ranked text output; only the last tab separates."""
    lines = spark.read.text(path)
    rank = F.substring_index("value", "\t", -1)
    identifier = F.substring(F.col("value"), F.lit(1), F.length("value") - F.length(rank) - 1)
    return lines.select(identifier.alias("id"), rank.cast("double").alias("rank"))


def write_betas(betas: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file with one line per coefficient: the table has a row per column only."""
    write_tsv(betas.coalesce(1), path, mode)


def read_betas(spark: SparkSession, path: str) -> DataFrame:
    """``(term, beta)`` as written by ``write_betas``."""
    return read_ranked(spark, path).toDF("term", "beta")


def write_named(rows: DataFrame, path: str, name_col: str, value_col: str, piece_bytes: int = PIECE_BYTES) -> list[str]:
    """Lines of text into files that bear the names, and the folders of these files, all of which are to be read.

    A name of more than ``piece_bytes`` is dealt over several tasks, each of which writes a file of that
    name: one lies in ``path``, the others in folders of their own under it. The names must be few, as the driver
    moves their files. They are kept as they are; a name with a slash is an error.
    """
    spark = rows.sparkSession
    lines = rows.select(F.col(name_col).cast("string").alias("name"), F.col(value_col).alias("value"))
    # One row per name.
    sizes = lines.groupBy("name").agg(F.sum(F.octet_length("value") + 1).alias("bytes")).collect()
    names = {row["name"] or "" for row in sizes}
    if any("/" in name for name in names):
        raise ValueError("a file name cannot have a slash")
    pieces = [(row["name"], -(-(row["bytes"] or 1) // piece_bytes)) for row in sizes]
    large = spark.createDataFrame([(name, n) for name, n in pieces if n > 1], "name string, pieces long")
    # Copies of a line from several tasks part as well, and a recomputed task deals in the same way.
    piece = F.pmod(F.xxhash64("value", F.spark_partition_id()), F.coalesce("pieces", F.lit(1))).alias("piece")
    dealt = lines.join(F.broadcast(large), "name", "left").select("name", "value", piece)
    tasks = max(shuffle_partitions(spark), sum(n for _, n in pieces))
    dealt.repartition(tasks, "name", "piece").drop("piece").write.partitionBy("name").text(path)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = files.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    more = "more"
    while any(name.startswith(more) for name in names):
        more += "-"
    folders = [path]
    for entry in system.listStatus(folder):
        if not entry.isDirectory() or not entry.getPath().getName().startswith("name="):
            continue
        name = unquote(entry.getPath().getName().removeprefix("name="))
        for at, part in enumerate(system.listStatus(entry.getPath())):
            if at == len(folders):
                folders.append(f"{path}/{more}{at}")
                system.mkdirs(files.Path(folders[at]))
            system.rename(part.getPath(), files.Path(files.Path(folders[at]), name))
        system.delete(entry.getPath(), True)
    return folders
