import itertools
import random
import time
import tracemalloc

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallygraph.llm.pieces import VOCABULARY, WORDS, _Encoder, decoded, encode, lattice_form, load_model, n_best

ODD = ["", "a", " ", "\n", "  a  b ", "a\n\nb  ", "hello  world", "漢字 x", "é😀 ▁x▁▁ y", " \t\x00", "x" * 300, "naïve café\r\n", "$$$ ###"]


@pytest.fixture(scope="module")
def model():
    return load_model()


@pytest.fixture(scope="module")
def library(model):
    """The public library on the same vocabulary, read as a unigram model."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(open(VOCABULARY, "rb").read())
    proto.trainer_spec.model_type = 1
    for k, i in enumerate(model.ids.tolist()):
        proto.pieces[i].score = float(model.scores[k])
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def segmentations(form, model):
    """All ways to cut a word into pieces, with their scores."""
    if not form:
        yield 0.0, ()
        return
    for m in range(1, min(len(form), model.table.max_len) + 1):
        k = model.index.get(form[:m])
        if k is None and m > 1:
            continue
        score = model.unknown if k is None else float(model.scores[k])
        for rest, cut in segmentations(form[m:], model):
            yield score + rest, (m, *cut)


@pytest.mark.parametrize("word", [" the", " others", "\n", "a", " 漢x", " $$$", "   ", " ▁a", "internat"])
def test_word_against_all_segmentations(model, word):
    want = sorted((-s, cut) for s, cut in segmentations(lattice_form(word), model))[:6]
    got = n_best(lattice_form(word), model, 6)
    assert [s for s, _ in got] == pytest.approx([-s for s, _ in want])
    for s, steps in got:
        assert sum(m for _, m in steps) == len(word)


@pytest.mark.parametrize("text", ["a b", "to be", "x\ny", " is it", "en la", "漢 a"])
def test_text_against_all_segmentations(model, text):
    n = 5
    per_word = [list(segmentations(w, model)) for w in WORDS.findall(lattice_form(" " + text))]
    totals = sorted((-sum(s for s, _ in way), sum(len(c) for _, c in way)) for way in itertools.product(*per_word))[:n]
    got = _Encoder(model, n)([text]).nbest[0]
    assert [g[0] for g in got] == pytest.approx([-t for t, _ in totals])


def test_best_scores_of_the_library(model, library):
    score = {int(i): float(s) for i, s in zip(model.ids, model.scores, strict=True)}
    rng = random.Random(5)
    words = ["the", "thing", "été", "schön", "ción", "internationalization", "xyzzy", "a", "$$", "under", "Über"]
    encoder = _Encoder(model, 4)
    for _ in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(1, 6)))
        found = library.nbest_encode(text, nbest_size=4)
        want = [sum(score[i] for i in ids) for ids in found]
        got = encoder([text])
        assert [g[0] for g in got.nbest[0]] == pytest.approx(want, abs=1e-3)
        assert sum(score[i] for i in got.ids.tolist()) == pytest.approx(want[0], abs=1e-3)


def test_round_trip_and_alternatives(spark, model):
    texts = [*ODD, None, "word " * 3000 + "\n" * 50]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = encode(docs)
    rows = {r.doc_id: r for r in coded.withColumn("back", decoded(coded, F.col("ids"))).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert r.back == (text or "") and r.n_pieces == len(r.ids)
        assert r.nbest[0].changes == [] and r.nbest[0].score == pytest.approx(r.score)
        for other in r.nbest[1:]:
            assert other.score <= r.nbest[0].score and other.changes
            for c in other.changes:
                raw = b"".join(model.texts[k] for k in c.ids).decode()
                assert raw == (" " + text)[c.start + 1 if c.start or raw[0] != " " else 0 : c.end + 1] or raw.lstrip(" ") == text[c.start : c.end].lstrip(" ")
    assert rows[0].ids == [] and [b.score for b in rows[0].nbest] == [0.0]


def test_ids_keys_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a"), (2**62 + 1, "a"), (2**62 + 1, "a")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in encode(docs).collect()) == [str(2**62 + 1)] * 2 + ["None"]
    assert encode(docs.limit(0)).collect() == []


def test_decoding_unknown_ids(spark):
    ids = spark.createDataFrame([([99999999, None],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in ids.select(decoded(ids, F.col("ids"))).collect()] == ["��", None, ""]


def test_memory_of_words_does_not_change_results(model):
    texts = ["some words here", "other words there", "some more", "words words"]
    small, large = _Encoder(model, 3), _Encoder(model, 3)
    small.words.numbers._limit = 1  # starts anew all the time
    for t in texts:
        a, b = small([t]), large([t])
        assert a.ids.tolist() == b.ids.tolist() and a.nbest == b.nbest


@pytest.mark.parametrize("word", ["aaaaaaaa", "abababab", "        ", "=========", "a b"])
def test_ties_against_all_segmentations(model, word):
    """Exact scores, each way once, and of equal scores the longest last piece first."""
    ways = [(-s, [-m for m in reversed(cut)]) for s, cut in segmentations(lattice_form(word), model)]
    for n in (1, 4, 9):
        got = n_best(lattice_form(word), model, n)
        assert [s for s, _ in got] == [-s for s, _ in sorted(ways)[:n]]
        assert len({tuple(steps) for _, steps in got}) == len(got)


@pytest.mark.parametrize("word", [" " * 100_000, "a" * 100_000, "ab" * 50_000, "x = 1" + " " * 1_000 + "y", "ƕ" * 50_000])
def test_long_tied_words(model, word):
    started = time.perf_counter()
    got = _Encoder(model, 4)([word])
    seconds = time.perf_counter() - started
    tracemalloc.start()
    n_best(lattice_form(word[:20_000]), model, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got.nbest[0]) == (1 if "ƕ" in word else 4)
    assert b"".join(model.texts[i] for i in got.ids).decode() == " " + word
    # The work and the memory grow with the length alone.
    assert seconds < 8 and peak < 40e6


def test_long_words_as_short_ones(model, monkeypatch):
    texts = ["internationalization of the naïve ▁ 漢字 aaaaaaa        b", "x" * 90]
    want = _Encoder(model, 4)(texts)
    monkeypatch.setattr("tallygraph.llm.pieces.LONG", 3)
    got = _Encoder(model, 4)(texts)
    assert got.scores == want.scores and [[w[0] for w in t] for t in got.nbest] == [[w[0] for w in t] for t in want.nbest]
