import random
import re

import pytest

from tallygraph.llm.licenses import NOTICES, PHRASES, LicenseParams, needed, notice_words, scan_licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall(text.translate(LOWER))


def brute(text, params):
    """Every block with every notice, every phrase at every place."""
    text = text or ""
    words = words_of(text)
    places, base = [], set()
    for label, phrase in params.phrases.items():
        parts = phrase.split()
        here = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += here
        base |= {label} if here else set()
    lines = [words_of(line) for line in text.split("\n")]
    blocks, run = list(lines), []
    for line in [*lines, []]:
        if line:
            run.append(line)
            continue
        if len(run) > 1:
            blocks.append([w for part in run for w in part])
        run = []
    labels, score = set(base), 0.0
    for label, notice in params.notices:
        own = set(notice_words(notice))
        for block in blocks:
            shared = len(own & set(block))
            if shared * 100 >= params.percent * len(own) and own:
                labels.add(label)
                score = max(score, shared / len(own))
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, sorted(base), sorted(labels), score


def texts(seed, n=80):
    rng = random.Random(seed)
    out = [None, "", "\n\n", "MIT License", "mit\nLICENSE", "mit license " * 3, "KK LicenKe", "x" * 100_000, "the " * 30_000]
    out += ["İ mit license", "the mit license", "a mit license b apache  license-general_public.license"]
    for _ in range(n):
        words = rng.choice(NOTICES)[1].split()
        kept = [w for w in words if rng.random() > rng.choice([0, 0.05, 0.1, 0.2])]
        if rng.random() < 0.3:
            rng.shuffle(kept)
        noise = [rng.choice(["the", "of", "lorem", "Software", "é", "license"]) for _ in range(rng.randint(0, 30))]
        joined = noise + kept
        for _ in range(rng.randint(0, 4)):
            joined.insert(rng.randint(0, len(joined)), rng.choice(["\n", "\n\n", "\n--\n", "\n * "]))
        out.append(" ".join(joined))
    return out


@pytest.mark.parametrize("percent", [85, 100, 50])
def test_against_every_block_and_notice(spark, percent):
    params = LicenseParams(percent=percent)
    rows = [(i, t) for i, t in enumerate(texts(percent))]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, label string, score int").repartition(3)
    found = {r[0]: tuple(r)[1:] for r in scan_licenses(docs, params=params).collect()}
    for i, text in rows:
        assert found[i] == brute(text, params), text


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, "MIT license"), (None, "MIT license"), (1, None), (1, "nothing")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = scan_licenses(docs)
    assert found.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((r["doc_id"] or "", r["n_words"], r["n_base"]) for r in found.collect()) == [("", 2, 1), ("", 2, 1), ("1", 0, 0), ("1", 1, 0)]
    assert scan_licenses(docs.limit(0)).count() == 0


def test_no_notices(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT license")], "doc_id long, text string")
    row = scan_licenses(docs, params=LicenseParams(notices=())).first()
    assert (row["labels"], row["score"]) == (["mit"], 0.0)


def test_thresholds_and_tables():
    assert [needed(n, 85) for n in (1, 5, 7, 10, 20)] == [1, 5, 6, 9, 17]
    assert notice_words("The CC BY-NC 4.0, the") == ["0", "4", "by", "cc", "nc", "the"]
    assert set(PHRASES) <= {label for label, _ in NOTICES}


def test_no_python_in_the_plan(spark, executed_plan):
    docs = spark.createDataFrame([(1, "Released under the MIT license")], "doc_id long, text string")
    plan = executed_plan(scan_licenses(docs))
    assert "Python" not in plan and "Arrow" not in plan
