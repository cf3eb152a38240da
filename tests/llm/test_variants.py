import itertools
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tallygraph.llm.automaton import Acceptor
from tallygraph.llm.variants import VariantParams, near_words, spelling_variants


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def shared(u, v):
    return next((i for i, (a, b) in enumerate(zip(u, v, strict=False)) if a != b), min(len(u), len(v)))


def some_words(seed, n, low=0, high=6, letters="aabbcd"):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(n)}


@pytest.mark.parametrize("seed", range(30))
def test_composition_accepts_each_near_pair_once(seed):
    words = some_words(seed, seed * 2)
    expected = {p for p in itertools.combinations(sorted(words), 2) if near(*p)}
    for first, end in ((0, None), (1, 3), (0, 2), (3, None)):
        found = [tuple(sorted(p)) for p in Acceptor(words).near_pairs(first, end)]
        assert len(found) == len(set(found))
        assert set(found) == {p for p in expected if shared(*p) >= first and (end is None or shared(*p) < end)}


def accepted(acceptor):
    walk = [(0, "")]
    while walk:
        state, read = walk.pop()
        if acceptor.final[state]:
            yield read
        walk += [(after, read + c) for c, after in acceptor.arcs[state].items()]


@pytest.mark.parametrize("seed", range(10))
def test_acceptor_is_minimal(seed):
    words = some_words(seed, 40)
    acceptor = Acceptor(words)
    assert sorted(accepted(acceptor)) == sorted(words)
    # No two states in use accept the same words.
    used, walk = {0}, [0]
    while walk:
        for after in acceptor.arcs[walk.pop()].values():
            if after not in used:
                used.add(after)
                walk.append(after)

    def language(state):
        return frozenset([""] if acceptor.final[state] else []) | {
            c + rest for c, after in acceptor.arcs[state].items() for rest in language(after)
        }

    assert len({language(s) for s in used}) == len(used)


def test_long_words():
    long = "ab" * 20_000
    found = {tuple(sorted(p, key=len)) for p in Acceptor([long, long + "a", "b" + long, "x"]).near_pairs()}
    assert found == {(long, long + "a"), (long, "b" + long)}


@pytest.mark.parametrize("limit", [20_000, 40, 5, 1])
def test_partitions_of_any_size_find_the_same_pairs(spark, limit):
    words = sorted(some_words(limit, 400, 6, 9, "ab") | some_words(2, 60, 6, 30, "aé") | {"aaaaaa" + "a" * k for k in range(6)})
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    found = [tuple(r) for r in near_words(table, VariantParams(partition_words=limit)).collect()]
    expected = {(u, v, words.index(v) + 1) for u in words for v in words if near(u, v)}
    assert len(found) == len(expected)
    assert set(found) == expected


def brute(docs, params):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if params.typo_modulus and h % params.typo_modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= params.min_chars and c >= params.min_count}
    form, n_near = {}, {}
    for w in n:
        others = sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v))
        n_near[w] = len(others)
        form[w] = others[0] if others and n[others[0]] >= params.ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], n_near[w], n.get(form[w])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("params", [VariantParams(), VariantParams(4, 1, 2, 3, 7), VariantParams(6, 1, 1_000, 0)])
def test_against_all_pairs(spark, rows, params):
    rng = random.Random(params.min_chars)
    vocabulary = sorted(some_words(5, 60, 5, 8, "abÉß÷"))
    docs = [(i % 25, " ".join(rng.choices(vocabulary, weights=[2**-k for k in range(len(vocabulary))], k=60))) for i in range(40)]
    docs += [(None, "Überall überall ÜBERALL"), (None, None), (1, ""), (2, "a" * 50_000), (2, "The " * 9_000), (3, "abcdef-abcdeg_abcde1")]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int")
    found = spelling_variants(table.repartition(4), params=params)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(found) == brute(docs, params)


def test_chain_of_forms_has_one_root(spark):
    counts = {"abcdefgh": 6000, "abcdefg": 1000, "abcdef": 150, "abcdex": 20, "abcdxx": 3}
    docs = spark.createDataFrame([(1, f"{w} " * n) for w, n in counts.items()], "doc_id long, text string")
    found = spelling_variants(docs, params=VariantParams(min_count=1, typo_modulus=0)).collect()
    assert {r["word"]: r["root"] for r in found} == dict.fromkeys(counts, "abcdefgh")


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "short run of it"), (2, None)], "doc_id long, text string")
    assert spelling_variants(docs).count() == 0
    assert spelling_variants(docs.limit(0)).count() == 0
