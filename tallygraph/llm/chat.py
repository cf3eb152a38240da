"""Chats rebuilt from event logs and rendered with a template. DataFrame functions only.

A log has one row per event: a conversation, a message of it, a sequence number, a kind, a
role and a text. Kinds:

* ``start``: the message begins, with this text;
* ``delta``: this text is appended;
* ``edit``: the message so far is replaced by this text;
* ``regenerate``: the message so far is dropped, this text and later deltas form the new one;
* ``delete``: the message goes, unless a later event other than a delta brings it back.

Events of any other kind are ignored. Messages stand in the order of their first event.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END = "### ", ": ", "</turn>"
TRAINED_ROLE = "assistant"
# Each control string of the template, and what stands for it inside a text or a role.
ESCAPES = (("\\", "\\\\"), ("#", "\\h"), (END, "\\t"), (":", "\\c"))


def _escaped(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def escape_text(text: Column) -> Column:
    """No ``#`` and no end mark is left in the text. The colon is no control string there."""
    return _escaped(text, ESCAPES[:3])


def escape_role(role: Column) -> Column:
    return _escaped(role, ESCAPES)


def unescape(text: Column) -> Column:
    """The inverse of both: doubled backslashes are told apart first, from left to right."""

    def plain(part: Column) -> Column:
        for was, code in ESCAPES[1:]:
            part = F.replace(part, F.lit(code), F.lit(was))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def fold_events(
    events: DataFrame,
    conversation: str = "conv_id",
    message: str = "message_id",
    sequence: str = "seq",
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Final messages: ``conv_id, position, message_id, role, text``.

    ``position`` is the sequence number of a message's first event. Events are grouped by
    message, not by conversation, so a conversation with most of all rows is spread here.
    Events with the same sequence number are taken by kind, then text. The role is the last
    one given; a null role counts as not given, and none at all as empty. A null text is empty;
    a null conversation or message is one of its own. Other columns are ignored.
    """
    log = (
        events.select(
            F.col(conversation).alias("conv_id"),
            F.col(message).alias("message_id"),
            F.struct(
                F.col(sequence).alias("seq"),
                F.col(kind).alias("kind"),
                F.coalesce(F.col(text), F.lit("")).alias("text"),
                F.col(role).alias("role"),
            ).alias("event"),
        )
        .where(F.col("event.kind").isin("start", "delta", "edit", "regenerate", "delete"))
        .groupBy("conv_id", "message_id")
        .agg(F.sort_array(F.collect_list("event")).alias("log"))
    )
    # The last event that is not a delta decides where the text begins (0: none did).
    begins = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(0)))
    begun = log.withColumn("begins", begins)
    live = F.expr("slice(log, greatest(begins, 1), size(log))")
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return begun.select(
        "conv_id",
        F.col("log")[0]["seq"].alias("position"),
        "message_id",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
        live[0]["kind"].alias("last_kind"),
    ).where(F.col("last_kind") != "delete").drop("last_kind")


def render_chats(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans``.

    ``messages`` are those of ``fold_events``. A turn is rendered as
    ``### role: text</turn>`` and a line end; control strings in texts and roles are escaped so
    that they can be read back. ``loss_spans`` are the start and length (code points) in
    ``formatted`` of each text of the assistant, the part a model learns to write. A conversation
    ends up in one string, so this step needs its turns in one task; they pass through it in
    order, spilling if need be.
    """
    order = Window.partitionBy("conv_id").orderBy("position", "message_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(CLOSE))
    turns = messages.select(
        "conv_id",
        "position",
        "message_id",
        (F.col("role") == TRAINED_ROLE).alias("trained"),
        head.alias("head"),
        escape_text(F.col("text")).alias("body"),
    ).withColumn("turn", F.concat("head", "body", F.lit(END + "\n")))
    placed = turns.select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        "turn",
        F.when(
            F.col("trained"),
            F.struct(
                (F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head")).alias("start"),
                F.length("body").cast("long").alias("length"),
            ),
        ).alias("span"),
    )
    return (
        placed.groupBy("conv_id")
        .agg(
            F.count("*").alias("n_turns"),
            F.sort_array(F.collect_list(F.struct("n", "turn"))).alias("turns"),
            F.sort_array(F.collect_list("span")).alias("loss_spans"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
            "loss_spans",
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of ``(role, text)``."""
    parts = F.split(formatted, END + "\n")
    return F.transform(
        F.slice(parts, 1, F.array_size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), CLOSE, 1)).alias("role"),
            unescape(F.substr(p, F.locate(CLOSE, p) + len(CLOSE))).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, without escapes: each span once, in order."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )
