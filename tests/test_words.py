import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallygraph.functions import plain_words, trim_controls


def brute_words(text):
    """Character by character: what holds a word together, then what is kept."""
    words, current, base = [], "", False
    for char in text + " ":
        category = unicodedata.category(char)
        letter_or_digit = category in {"Lu", "Ll", "Lt", "Lm", "Lo", "Nd"}
        if letter_or_digit or char == "_" or (category == "Mn" and base and current):
            current += char
            base = letter_or_digit or (category == "Mn" and base)
        else:
            words.append(current)
            current, base = "", False
    return sorted(w.lower() for w in words if re.fullmatch("[a-z]+", w.lower()))


def words_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = df.select("id", plain_words(F.col("text")).alias("words")).collect()
    return [row.words for row in sorted(found)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Foo bar's café foo_bar abc1 foo", ["foo", "bar", "s", "foo"]),
        ("don't stop-gap\tEND", ["don", "t", "stop", "gap", "end"]),
        ("", []),
        ("123 _ __x x__ a", ["a"]),
        ("café cafe", ["cafe"]),
        (" ́abc", ["abc"]),
        ("_́abc", ["abc"]),
        ("Kelvin", ["kelvin"]),
        ("İx x", ["x"]),
        ("one\ntwo\r\nthree", ["one", "two", "three"]),
        ("größe Groß gross", ["gross"]),
        ("a\x00b\x1fc", ["a", "b", "c"]),
    ],
)
def test_words(spark, text, expected):
    assert words_of(spark, [text]) == [expected]


def test_very_long_runs_do_not_overflow(spark):
    texts = ["_" * 1_000_000 + " a", "a_" * 500_000 + " b", "é́" * 300_000 + " c", "z" * 1_000_000]
    assert words_of(spark, texts) == [["a"], ["b"], ["c"], ["z" * 1_000_000]]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé_9 '-́̀ſKßΣş\n\t٣中"), max_size=25), min_size=20, max_size=40))
def test_words_match_brute_force(spark, texts):
    assert [sorted(found) for found in words_of(spark, texts)] == [brute_words(text) for text in texts]


def test_trim_strips_controls_only_at_the_ends(spark):
    df = spark.createDataFrame([("\t\x00 a\tb \x1f\r\n",), (" a",), ("",)], "t string")
    trimmed = df.select(trim_controls(F.col("t")).alias("t")).collect()
    assert [row.t for row in trimmed] == ["a\tb", " a", ""]
