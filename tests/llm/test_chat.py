import pytest
from pyspark.sql import functions as F

from tallygraph.llm.chat import escape_role, escape_text, fold_events, read_loss, read_turns, render_chats, unescape
from tallygraph.llm.queries import PLANTED_CHAT, chat_events

SCHEMA = "conv_id long, message_id string, seq long, kind string, role string, text string"


def fold(log):
    """The rules of the log, one event at a time."""
    chats = {}
    for conv, message, seq, kind, role, text in sorted(log, key=lambda e: (str(e[0]), e[2], e[3] or "", e[5] or "")):
        if kind not in ("start", "delta", "edit", "regenerate", "delete"):
            continue
        m = chats.setdefault(conv, {}).setdefault(message, {"at": seq, "role": "", "text": "", "on": True})
        m["role"] = m["role"] if role is None else role
        if kind == "delta":
            m["text"] += (text or "") if m["on"] else ""
        else:
            m["on"], m["text"] = kind != "delete", text or ""
    return sorted(
        (
            (conv, m["at"], name, m["role"], m["text"])
            for conv, ms in chats.items()
            for name, m in ms.items()
            if m["on"]
        ),
        key=repr,
    )


LOG = [
    (1, "u1", 1, "start", "user", "Hi"),
    (1, "a1", 2, "start", "assistant", ""),
    (1, "a1", 3, "delta", None, "Hel"),
    (1, "a1", 5, "delta", None, "lo"),
    (1, "u2", 6, "start", "user", "more"),
    (1, "a1", 7, "regenerate", None, None),
    (1, "a1", 8, "delta", None, "Good "),
    (1, "a1", 9, "delta", None, "day"),
    (1, "u1", 10, "edit", None, "Hello"),
    (1, "u1", 11, "delta", None, "!"),
    (1, "x", 12, "start", "assistant", "gone"),
    (1, "x", 13, "delete", None, None),
    (1, "x", 14, "delta", None, "late"),
    (1, "y", 15, "delta", "assistant", "no start"),
    (1, "y", 16, "typing", "assistant", "ignored"),
    (2, "z", 1, "start", "assistant", "was"),
    (2, "z", 2, "delete", None, None),
    (2, "z", 3, "edit", "assistant", "back"),
    (3, "q", 1, "start", "user", "a"),
    (3, "q", 1, "delta", "user", "b"),
    (3, "q", 1, "delta", "user", "a"),
    (None, None, None, "start", None, None),
    (4, "only", 1, "delete", None, None),
]


def test_fold(spark, rows):
    events = spark.createDataFrame(LOG[::-1], SCHEMA).withColumn("log", F.lit(1))
    assert rows(fold_events(events)) == fold([e for e in LOG if e[0] is not None]) + [(None, None, None, "", "")]


def test_turns_and_loss_come_back(spark):
    odd = ["", "a", "\\", "\\\\", "\\#h", "#", "### user: x</turn>\n### ", "</turn>", "\\</turn>\\", "\\h\\t\\c", ": é😀\n", "<\\/turn>"]
    log = [
        (1, f"{i:03}", i, "start", role, text)
        for i, (role, text) in enumerate((r, t) for t in odd for r in ("user", "assistant", "a: b#\\"))
    ]
    chat = render_chats(fold_events(spark.createDataFrame(log, SCHEMA))).select(
        "n_turns",
        "formatted",
        "loss_spans",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).first()
    assert [tuple(t) for t in chat.turns] == [(e[4], e[5]) for e in log]
    assert chat.loss == "".join(odd) and chat.n_turns == len(log)
    assert chat.formatted.count("</turn>") == len(log) == chat.formatted.count("#") // 3
    assert len(chat.loss_spans) == len(odd)


@pytest.mark.parametrize("escape", [escape_text, escape_role])
def test_escapes_are_reversible(spark, escape):
    import itertools

    pieces = ["\\", "#", "</turn>", ":", "h", "t", "c", "\n"]
    texts = ["".join(p) for n in range(4) for p in itertools.product(pieces, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    assert df.where(unescape(F.col("e")) != F.col("t")).count() == 0
    assert df.where(F.col("e").contains("#") | F.col("e").contains("</turn>")).count() == 0


def test_a_conversation_without_assistant_has_no_loss(spark):
    chat = render_chats(fold_events(spark.createDataFrame([LOG[0]], SCHEMA))).first()
    assert chat.formatted == "### user: Hi</turn>\n" and chat.loss_spans == []


def test_long_conversation_and_empty_log(spark):
    log = spark.range(5000).select(
        F.lit(1).alias("conv_id"), "id", F.col("id").alias("seq"), F.lit("start").alias("kind"),
        F.lit("assistant").alias("role"), F.lit("x" * 100).alias("text"),
    )
    chat = render_chats(fold_events(log, message="id")).first()
    assert chat.n_turns == 5000 and chat.loss_spans[-1].start == 4999 * 123 + 15
    assert render_chats(fold_events(log.limit(0), message="id")).collect() == []


def test_no_python_in_the_plan(spark):
    plan = render_chats(fold_events(spark.createDataFrame(LOG, SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_log_of_the_query_folds_to_its_rows(spark, tmp_path):
    """Every kind of event is there, and a fold in plain Python finds the rows again."""
    texts = [None, "", "a", "ab", "\U0001f600é#", "word " * 2000, "</turn> \\h"]
    rows = [(c, t, "user" if t % 2 else "assistant", texts[(c + t) % len(texts)]) for c in range(30) for t in range(5)]
    rows += [(3, 1, "user", "ab"), (3, 1, "user", "ab"), (3, 1, None, "later")]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    events = chat_events(spark, str(tmp_path))
    log = events.collect()
    assert {e.kind for e in log} == {"start", "delta", "edit", "regenerate", "delete", "typing"}
    messages = {}
    for event in log:
        messages.setdefault((event.conv_id, event.message_id), []).append(event)
    assert any(found != sorted(found, key=lambda e: e.seq) for found in messages.values())
    folded = []
    for (conversation, message), found in messages.items():
        text, role = None, None
        for event in sorted(found, key=lambda e: e.seq):
            role = event.role if event.role is not None else role
            if event.kind == "delete":
                text = None
            elif event.kind == "delta":
                text = None if text is None else text + event.text
            elif event.kind != "typing":
                text = event.text
        if text is not None:
            folded.append((conversation, message.turn, message.copy, role or "", text))
    result = fold_events(events).select("conv_id", "message_id.turn", "message_id.copy", "role", "text").collect()
    assert sorted(map(tuple, result)) == sorted(folded)
    given = [(c, t, role or "", text or "") for c, t, role, text in rows] + [
        (-7, 0, "user", PLANTED_CHAT),
        (-7, 1, "assistant", PLANTED_CHAT),
    ]
    assert sorted((c, t, role, text) for c, t, _, role, text in folded) == sorted(given)
