"""What the plans must look like for large tables."""

import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallygraph.operators import (
    document_frequency,
    pagerank_step,
    search,
    search_counts,
    tfidf,
    tfidf_of_rows,
    tokenize,
    top_pages,
    word_count,
    word_count_of_rows,
)
from tallygraph.operators import blocks, rank
from tallygraph.operators.skew import key_salts
from tallygraph.plans import retrieval as plans
from tallygraph.sources import read_scores, write_scores
from tallygraph.staging import staging
from tallygraph.workload.inputs import basket_edges, parts


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def without_cached_subtrees(plan):
    kept, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if skip is not None and depth > skip:
            continue
        skip = depth if "InMemoryRelation" in line else None
        kept.append(line)
    return "\n".join(kept)


def without_initial_plans(plan):
    """A subquery shows its initial plan below its final one."""
    kept, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def exchanges(plan):
    return re.findall(r"\+- Exchange (\w+\([^)]*\))", plan)


@pytest.mark.parametrize("heavy_rows", [1, 1_000_000])
def test_tfidf_tokenizes_once(spark, docs, executed_plan, no_broadcast, heavy_rows, monkeypatch):
    monkeypatch.setattr(plans, "tfidf", partial(tfidf, heavy_rows=heavy_rows))
    one_word = spark.range(9000).selectExpr("id + 1000000 AS doc_id", "'the' AS text")
    hot = docs.select("doc_id", "text").unionByName(one_word)
    scores = plans.score_documents(hot, 9200)
    plan = without_initial_plans(executed_plan(scores))
    assert plan.count("FileScan") == 1
    assert sum("doc_id" in keys for keys in exchanges(plan)) == 1
    # Both sides of the join, of which the words are short.
    assert sum("salt" in keys for keys in exchanges(plan)) == 2
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Only heavy words are set apart.
    assert ("BroadcastHashJoin [word" in plan) == (heavy_rows == 1)


@pytest.mark.parametrize("heavy_rows", [1, 1_000_000])
def test_tfidf_of_rows_moves_postings_once(spark, docs, executed_plan, no_broadcast, heavy_rows, monkeypatch):
    """With a third of all postings under one word, too."""
    monkeypatch.setattr(plans, "tfidf_of_rows", partial(tfidf_of_rows, heavy_rows=heavy_rows))
    one_word = spark.range(9000).selectExpr("id + 1000000 AS doc_id", "'the' AS text")
    hot = docs.select("doc_id", "text").unionByName(one_word)
    scores = plans.score_documents(hot, 9200, one_row_per_doc=True)
    plan = without_initial_plans(executed_plan(scores))
    moves = exchanges(plan)
    assert sum("slot" in keys for keys in moves) == 1
    assert not any("doc_id" in keys or "SinglePartition" in keys for keys in moves)
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Both the counts of the slots and the sums of dealt words read that shuffle.
    assert len(re.findall(r"ReusedExchange \[word#\d+, slot#\d+, posting#\d+\]", plan)) == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = scores.withColumn("task", F.spark_partition_id()).where("word = 'the'").select("task").distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (tasks > 1) == (heavy_rows == 1)
    one_way = plans.tfidf(word_count(tokenize(hot)), 9200)
    assert scores.exceptAll(one_way).isEmpty() and one_way.exceptAll(scores).isEmpty()


def test_only_heavy_keys_get_salts(spark):
    sizes = spark.createDataFrame([("the", 800), ("a", 150), ("b", 50)], "word string, df long")
    salts = {row["word"]: row["salts"] for row in key_salts(sizes, "df", 1).collect()}
    # The average partition of eight holds 125 rows.
    assert salts == {"the": 7, "a": 2, "b": 1}
    assert {row["salts"] for row in key_salts(sizes, "df", 1000).collect()} == {1}
    assert key_salts(sizes.limit(0), "df").count() == 0


def test_counting_single_row_documents_does_not_shuffle(docs, executed_plan):
    assert "Exchange" not in executed_plan(word_count_of_rows(docs))


def test_word_count_combines_before_the_shuffle(docs, executed_plan):
    plan = executed_plan(word_count(tokenize(docs)))
    assert plan.index("ShuffleQueryStage") < plan.index("partial_count")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_one_off_search_filters_below_the_counting(docs, executed_plan):
    plan = executed_plan(search_counts(word_count(tokenize(docs)), ["the", "der"], 200))
    assert plan.count("Generate explode") == 1
    scan_side = plan[plan.index("partial_count(1)") :]
    assert re.search(r"Filter .*word#\d+ IN \(der,the\)", scan_side)


def test_stored_search_pushes_terms_to_the_scan(spark, docs, executed_plan, tmp_path):
    write_scores(tfidf(word_count_of_rows(docs), 200), str(tmp_path / "scores"))
    plan = executed_plan(search(read_scores(spark, str(tmp_path / "scores"), "bigint"), ["the", "der"], top=5))
    assert "PushedFilters: [In(word, [der,the])]" in plan
    assert "TakeOrderedAndProject(limit=5" in plan


def test_document_frequency_needs_no_second_scan(docs, executed_plan, no_broadcast):
    counts = word_count(tokenize(docs))
    plan = executed_plan(counts.join(document_frequency(counts), "word"))
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("heavy_rows", [1, 1_000_000])
def test_pagerank_step_shuffles_the_links_once(spark, executed_plan, no_broadcast, tmp_path, heavy_rows):
    basket_edges(spark, SMALL).write.parquet(str(tmp_path / "edges"))
    edges = spark.read.parquet(str(tmp_path / "edges"))
    nodes = parts(spark, SMALL)
    hub = edges.unionByName(spark.range(9000).selectExpr("1L AS src", "id AS dst", "1L AS multiplicity"))
    hub.write.parquet(str(tmp_path / "hub"))
    edges = spark.read.parquet(str(tmp_path / "hub"))
    step = pagerank_step(nodes.withColumn("rank", F.lit(0.1)), nodes, edges, heavy_rows=heavy_rows)
    plan = without_initial_plans(executed_plan(step))
    # The degrees and the links themselves; only the latter are shuffled row by row.
    assert len(re.findall(r"FileScan[^\n]*ReadSchema: struct<[^>\n]*multiplicity", plan)) == 2
    assert sum("salt" in keys for keys in exchanges(plan)) == 2
    assert "Window" not in plan
    assert ("BroadcastHashJoin [src" in plan) == (heavy_rows == 1)


@pytest.mark.parametrize("tile_links", [1 << 17, 500])
def test_loop_moves_vectors_and_sums_only(spark, executed_plan, monkeypatch, tile_links):
    monkeypatch.setattr(rank, "TILE_LINKS", tile_links)
    edges, nodes = basket_edges(spark, SMALL), parts(spark, SMALL)
    hub = edges.unionByName(nodes.selectExpr("0L AS src", "id AS dst", "1L AS multiplicity"))
    session = rank._loop_session(spark)
    with staging(spark) as area:
        graph = rank._lay_out(nodes, hub, area, 1_000_000, session)
        vector = blocks.constant_vector(session, graph.size, 0.1)
        for _ in range(2):
            vector = blocks.step(graph.tiles, graph.parts, vector, graph.size, 0.85)
        spark.catalog.clearCache()
        plan = executed_plan(vector)
        links = graph.tiles.select(F.sum(F.size("src")), F.max(F.size("src"))).first()
        session.sql(f"DROP TABLE {graph.table}")
    # The tiles are read in their buckets: what is shuffled are the ranks that go to them, and the sums.
    assert plan.count("Bucketed: true") == 2
    assert not re.search(r"Exchange[^\n]*\n[^\n]*Scan parquet", plan)
    assert sum("src_block" in keys for keys in exchanges(plan)) <= 2 and len(exchanges(plan)) <= 4
    assert "InMemoryTableScan" not in plan and "SortMergeJoin" not in plan
    # No tile is larger than the limit, nor is a block's share of links in one part, but for uneven hashes.
    assert links[0] > 1000 and (tile_links > 500 or links[1] <= 1000)


def test_jobs_of_the_loop(spark, tmp_path):
    """A step adds no job, and all ten take few."""
    basket_edges(spark, SMALL).write.parquet(str(tmp_path / "edges"))
    edges, nodes = spark.read.parquet(str(tmp_path / "edges")), parts(spark, SMALL)

    def jobs(steps):
        group = f"steps-{steps}"
        spark.sparkContext.setJobGroup(group, group)
        rank.pagerank(nodes, edges, iterations=steps)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(1), jobs(10)
    assert many <= few + 3 and many < 32


def test_top_pages_does_not_sort_everything(spark, executed_plan):
    ranks = spark.range(1000).selectExpr("id", "rand(1) AS rank")
    assert "TakeOrderedAndProject(limit=100" in executed_plan(top_pages(ranks))


def test_no_python_in_text_and_graph_plans(spark, docs, executed_plan):
    nodes = parts(spark, SMALL)
    plans = [
        executed_plan(tfidf(word_count(tokenize(docs)), 200)),
        executed_plan(pagerank_step(nodes.withColumn("rank", F.lit(0.1)), nodes, basket_edges(spark, SMALL))),
    ]
    assert not any("Python" in plan or "Arrow" in plan for plan in plans)
