import pytest
from pyspark.sql import functions as F

from tallygraph.llm.quality import QualityRules, judge, line_fault, quality_rules, repeated_words

RULES = QualityRules()
PROSE = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(8))


@pytest.mark.parametrize(
    ("line", "fault"),
    [
        ("", ""),
        (" \t\x0b", ""),
        ("A plain sentence.", ""),
        ('He said "no."', ""),
        ("Home | News | Sport | Contact", "navigation"),
        ("Please enable JavaScript to go on.", "boilerplate"),
        ("buy*** now### cheap$$$ pills&&&.", "symbols"),
        ("BUY NOW OR NEVER!", "shouting"),
        ("ÉTÉ À LA MER!", "shouting"),
        ("spam " * 12 + "end.", "repetition"),
        ("no end here", "punctuation"),
        ("One sentence is whole. The next one of this long paragraph of more than twenty words is cut off somewhere in the", ""),
    ],
)
def test_line_faults(line, fault):
    assert line_fault(line, RULES) == fault


def brute_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)})


@pytest.mark.parametrize("text", ["", "a", "a a a", "a a a a", "a b c a b c", "a b c d e f", "a b a b a c a b a", "x y z " * 9])
def test_repeated_words(text):
    assert repeated_words(text.encode().split()) == brute_repeats(text.split())


def test_base_figures():
    got = judge("a# b\x0bc\n\na# b\x0bc\nd\u00a0e <x>", RULES)
    # The no-break space is no white space here, blank lines are no duplicates.
    assert got[:5] == (8, 14, 4, 1, 6)
    assert got[5:7] == (True, False)


def test_verdict(spark):
    menu = "Home | News | Sport | Contact | Help | About us | Jobs\n" * 12
    texts = [PROSE, PROSE + "\n" + menu, menu + PROSE[:40], None, "", "word " * 49 + ".", PROSE * 200]
    docs = spark.createDataFrame(
        [(i, t, "x", True) for i, t in enumerate(texts)], "doc_id long, text string, n_words string, kept boolean"
    )
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert [got[i].kept for i in range(7)] == [True, False, False, False, False, False, False]
    assert got[0].clean_text == PROSE and got[0].kept_share == 1.0
    assert got[1].base_failed and got[1].clean_text == PROSE + "\n"
    assert got[3].n_words == got[4].n_words == 0 and got[3].base_failed
    assert got[6].base_failed and got[6].n_dup_lines > 1000


def test_one_bad_line_does_not_reject(spark):
    docs = spark.createDataFrame([(1, PROSE + "\nHome | News | Sport"), (1, PROSE), (None, PROSE)], "doc_id long, text string")
    rows = quality_rules(docs).collect()
    assert [r.kept for r in rows] == [True] * 3
    assert sorted(r.n_lines_dropped for r in rows) == [0, 0, 1]
    assert {r.clean_text for r in rows} == {PROSE}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules(docs).where(F.col("kept")).count() == 0
