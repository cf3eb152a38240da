import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallygraph.operators import initial_ranks, out_degree, pagerank, pagerank_step, rank_order, top_pages
from tallygraph.operators import skew
from tallygraph.operators.skew import join_spread
from tallygraph.plans import rank_lines
from tallygraph.staging import checkpoint_root, drop_checkpoint


def brute_pagerank(nodes, links, n, steps, damping=0.85):
    degree = Counter(src for src, _ in links)
    ranks = {node: 1.0 / n for node in nodes}
    for _ in range(steps):
        received = defaultdict(float)
        for src, dst in links:
            if src in ranks:
                received[dst] += ranks[src] / degree[src]
        ranks = {node: (1.0 - damping) + damping * received[node] for node in nodes}
    return ranks


def hub_graph():
    """One page holds more than a third of the links, another receives a third;
    some targets are unknown and some pages have no links."""
    rng = random.Random(7)
    nodes = [f"p{i}" for i in range(60)]
    links = [(f"p{rng.randrange(40)}", f"p{rng.randrange(80)}") for _ in range(300)]
    links += [("p0", f"p{i}") for i in range(80)] * 3
    links += [("p1", f"red{i}") for i in range(150)]
    links += [(f"p{i}", "p2") for i in range(40)] * 4
    return nodes, links + [("p3", "p3")]


def graph_tables(spark, nodes, links):
    edges = [(src, dst, n) for (src, dst), n in Counter(links).items()]
    return (
        spark.createDataFrame([(node,) for node in nodes], "id string"),
        spark.createDataFrame(edges, "src string, dst string, multiplicity bigint").repartition(5),
    )


def ranks_of(df):
    return {row["id"]: row["rank"] for row in df.collect()}


@pytest.fixture(scope="module")
def hub(spark):
    return graph_tables(spark, *hub_graph())


@pytest.mark.parametrize("heavy_rows", [1_000_000, 10, 1])
@pytest.mark.parametrize("steps", [0, 1, 10])
def test_pagerank_matches_brute_force(hub, steps, heavy_rows):
    nodes, links = hub_graph()
    expected = brute_pagerank(nodes, links, len(nodes), steps)
    found = ranks_of(pagerank(*hub, iterations=steps, heavy_rows=heavy_rows))
    assert found == pytest.approx(expected, rel=1e-12)


def test_other_start_and_damping(hub):
    nodes, links = hub_graph()
    found = ranks_of(pagerank(*hub, n=12345, damping=0.5, iterations=3))
    assert found == pytest.approx(brute_pagerank(nodes, links, 12345, 3, 0.5), rel=1e-12)


@pytest.mark.parametrize("heavy_rows", [1, 10, 1_000_000])
def test_single_steps_make_the_loop(hub, heavy_rows):
    nodes, edges = hub
    ranks = initial_ranks(nodes, 60)
    for _ in range(2):
        ranks = pagerank_step(ranks, nodes, edges, heavy_rows=heavy_rows)
    plain_nodes, links = hub_graph()
    assert ranks_of(ranks) == pytest.approx(brute_pagerank(plain_nodes, links, 60, 2), rel=1e-12)


def test_known_value_of_a_self_link(spark):
    """A page whose only incoming link is its own, one of 13, in a dump of 2427 lines."""
    links = [("self", "self")] + [("self", f"missing {i}") for i in range(12)]
    found = ranks_of(pagerank(*graph_tables(spark, ["self"], links), n=2427))
    assert found["self"] == pytest.approx(0.16049382716026525, abs=1e-15)


def test_page_without_incoming_links(spark):
    found = ranks_of(pagerank(*graph_tables(spark, ["a", "b"], [("a", "b")])))
    assert found["a"] == 0.15000000000000002


def test_graph_without_links(spark):
    nodes, edges = graph_tables(spark, ["a", "b"], [("x", "y")])
    assert ranks_of(pagerank(nodes, edges.where("src = 'none'"))) == {"a": 1.0 - 0.85, "b": 1.0 - 0.85}


def test_shares_of_a_page_sum_to_one(hub):
    _, edges = hub
    shares = edges.join(out_degree(edges), "src").groupBy("src")
    sums = shares.agg(F.sum(F.col("multiplicity") / F.col("out_degree")).alias("total")).collect()
    assert [row.total for row in sums] == pytest.approx([1.0] * len(sums))


def test_integer_ids(spark):
    links = [(1, 2), (2, 3), (3, 1), (3, 9), (1, 2)]
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3)], "id int")
    pairs = [(s, d, n) for (s, d), n in Counter(links).items()]
    expected = pytest.approx(brute_pagerank([1, 2, 3], links, 3, 10))
    for ends, heavy_rows in (("int", 1_000_000), ("bigint", 1_000_000), ("int", 1)):
        edges = spark.createDataFrame(pairs, f"src {ends}, dst {ends}, multiplicity int")
        ranks = pagerank(nodes, edges, heavy_rows=heavy_rows)
        assert dict(ranks.dtypes) == {"id": "int", "rank": "double"}
        assert ranks_of(ranks) == expected


def test_rank_lines_counts_every_line(spark):
    lines = [
        "<title>a</title><text>[[b]] [[red]]</text>",
        "<title>a</title><text>[[b]]</text>",
        "<title>b</title><text>[[a]] [[ ]]</text>",
        "",
        "",
        "untitled",
    ]
    dump = spark.createDataFrame([(line,) for line in lines], "value string")
    links = [("a", "b"), ("a", "red"), ("a", "b"), ("b", "a")]
    expected = brute_pagerank(["a", "b", "null"], links, 6, 10)
    assert ranks_of(rank_lines(dump)) == pytest.approx(expected, rel=1e-12)
    assert ranks_of(rank_lines(dump, n=100, iterations=1)) == pytest.approx(
        brute_pagerank(["a", "b", "null"], links, 100, 1)
    )


def test_empty_dump(spark):
    assert rank_lines(spark.createDataFrame([], "value string")).count() == 0


def test_ranking_breaks_ties_by_id(spark):
    ranks = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "id string, rank double")
    assert [r.id for r in rank_order(ranks).collect()] == ["c", "a", "b"]
    assert [r.id for r in top_pages(ranks, 2).collect()] == ["c", "a"]


@pytest.mark.parametrize("heavy_rows", [1_000_000, 1])
def test_join_spread(spark, rows, heavy_rows):
    keys = [0] * 500 + [1] * 300 + list(range(2, 90))
    big = spark.createDataFrame(list(zip(keys, range(len(keys)), strict=True)), "k int, v int").repartition(6)
    members = spark.createDataFrame([(0, "a")] + [(i, "b") for i in range(40, 200)], "k int, tag string")
    expected = sorted(((k, v) for v, k in enumerate(keys) if k == 0 or k >= 40), key=repr)
    assert rows(join_spread(big, members.select("k"), "k", "left_semi", heavy_rows)) == expected
    tagged = sorted(((k, v, "b" if k else "a") for k, v in expected), key=repr)
    assert rows(join_spread(big, members, "k", "inner", heavy_rows)) == tagged


def test_negative_iterations(hub):
    with pytest.raises(ValueError):
        pagerank(*hub, iterations=-1)


@pytest.mark.parametrize("steps", [2, 10])
def test_only_the_result_stays_in_the_checkpoint_folder(spark, hub, steps):
    root = Path(checkpoint_root(spark))
    before = set(root.rglob("rdd-*")) | set(root.glob("staged-*"))
    ranks = pagerank(*hub, iterations=steps)
    left = (set(root.rglob("rdd-*")) | set(root.glob("staged-*"))) - before
    assert len(left) == 1 and ranks.count() == 60
    drop_checkpoint(ranks)
    assert not any(folder.exists() for folder in left)


def test_light_keys_are_not_counted_one_by_one(spark, rows, executed_plan, monkeypatch):
    """Nor are the rows sorted to be joined."""
    counted = []
    monkeypatch.setattr(skew, "heavy_keys", lambda sizes, *rest: counted.append(sizes) or (None, 0))
    big = spark.createDataFrame([(f"k{i}", i) for i in range(3000)], "k string, v int")
    joined = join_spread(big, spark.createDataFrame([("k1",), ("k7",), (None,)], "k string"), "k", "left_semi", 50)
    assert not counted and rows(joined) == [("k1", 1), ("k7", 7)]
    plan = executed_plan(joined)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
