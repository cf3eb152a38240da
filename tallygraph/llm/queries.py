"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.llm.chat import fold_events, read_loss, read_turns, render_chats
from tallygraph.llm.exact_dedup import exact_duplicates
from tallygraph.llm.language import identify_languages
from tallygraph.llm.licenses import scan_licenses
from tallygraph.llm.line_dedup import dedup_lines
from tallygraph.llm.packing import pack_sequences
from tallygraph.llm.pagetext import extract_text
from tallygraph.llm.personal import find_personal_data
from tallygraph.llm.pieces import decoded, encode
from tallygraph.llm.quality import quality_rules
from tallygraph.llm.resampling import importance_resample
from tallygraph.llm.simhash import near_duplicates
from tallygraph.llm.variants import spelling_variants

PLANTED_CHAT = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("clean_text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and the four best segmentations, and a digest of the text that the ids decode to."""
    encoded = encode(_table(spark, sf_dir, "documents"))
    return encoded.withColumn("decoded_sha256", F.sha2(decoded(encoded, F.col("ids")), 256))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sequences of bytes, the tokens of a byte-level model."""
    return pack_sequences(_table(spark, sf_dir, "documents"), F.octet_length("text"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``conversations`` and the planted one as an event log.

    Each row is a message that was written in one of four ways, by a hash of its place: streamed
    in three deltas; edited on the way; generated again after a first try; deleted and put back,
    with another message beside it that was deleted for good. Half of the logs are written backwards.
    Rows of one turn are messages of their own. Nulls are empty texts.
    """
    planted = spark.createDataFrame(
        [(-7, 0, "user", PLANTED_CHAT), (-7, 1, "assistant", PLANTED_CHAT)],
        "conv_id long, turn long, role string, text string",
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    same_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    third = F.ceil(F.length("whole") / 3).cast("int")
    numbered = (
        rows.withColumn("copy", F.row_number().over(same_turn))
        .withColumn("whole", F.coalesce("text", F.lit("")))
        .withColumn("way", F.pmod(F.xxhash64("conv_id", "turn", "copy"), F.lit(8)))
        .withColumn("one", F.substr("whole", F.lit(1), third))
        .withColumn("two", F.substr("whole", third + 1, third))
        .withColumn("three", F.substr("whole", 2 * third + 1))
    )
    one, two, three, nothing = F.col("one"), F.col("two"), F.col("three"), F.lit("")

    def events(*steps: tuple[str, Column], beside: bool = False) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(beside).alias("beside"),
                    F.lit(step).alias("step"),
                    F.lit(kind).alias("kind"),
                    part.alias("part"),
                )
                for step, (kind, part) in enumerate(steps)
            ]
        )

    streamed = events(("start", nothing), ("delta", one), ("delta", two), ("delta", three))
    edited = events(("start", two), ("delta", three), ("edit", F.concat(one, two)), ("delta", three))
    again = events(
        ("start", nothing), ("delta", two), ("regenerate", one), ("delta", two), ("typing", one), ("delta", three)
    )
    put_back = events(("start", one), ("delete", nothing), ("edit", one), ("delta", two), ("delta", three))
    gone = events(("start", one), ("delta", two), ("delete", nothing), beside=True)
    log = (
        F.when(F.col("way") % 4 == 0, streamed)
        .when(F.col("way") % 4 == 1, edited)
        .when(F.col("way") % 4 == 2, again)
        .otherwise(F.concat(put_back, gone))
    )
    event = F.explode(F.when(F.col("way") < 4, log).otherwise(F.reverse(log))).alias("event")
    return numbered.select("conv_id", "turn", "copy", "role", event).select(
        "conv_id",
        F.struct("turn", "copy", "event.beside").alias("message_id"),
        F.struct("turn", "copy", "event.step").alias("seq"),
        "event.kind",
        "role",
        F.col("event.part").alias("text"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = render_chats(fold_events(chat_events(spark, sf_dir))).select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.array_size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))

    def listed(spans: Column) -> Column:
        named = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(named, ",")

    def count(spans: Column, kind: str) -> Column:
        return F.array_size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["by_pattern"])
    return found.select(
        "doc_id",
        *[count(base, kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    return found.withColumns({name: F.array_join(name, ",") for name in ("base_labels", "labels")})


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash": op5_simhash,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_personal_data": op7_personal_data,
    "op8_html_extraction": op8_html_extraction,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_license_scan": op12_license_scan,
    "op13_spelling_variants": op13_spelling_variants,
}
