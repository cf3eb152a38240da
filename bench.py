"""Time the headline queries on one set of tables and print one line of JSON.

BENCH_SF_DIR names the tables (default the sf0.1 ones), BENCH_CPUS the cores.
"""

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tallygraph.workload import QUERIES

HEADLINE = [
    "doc_word_count",
    "tfidf",
    "conversation_tfidf",
    "search_any",
    "search_top",
    "search_stored_scores",
    "page_links",
    "link_edges",
    "pagerank_one_step",
    "pagerank_10",
    "pagerank_top100",
    "wiki_pagerank",
    "normal_matrix",
    "ols_three_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    # Start the JVM's file and code paths before the clock runs.
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
