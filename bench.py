"""Times the headline queries and prints one line of JSON.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once
to warm up and is then timed; every result is computed in full.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

import linkrank as lr  # noqa: E402
from workloads import queries as Q  # noqa: E402
from workloads.fixtures import succession_graph, wiki_dump  # noqa: E402

ITERATIONS = 10

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("linkrank-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    graph = succession_graph(spark, SF_DIR)
    dump = wiki_dump(spark, SF_DIR)
    records = lr.read_tagged_records(spark, dump)
    ranks = lr.pagerank_log(graph, 1)

    def ranked(variant):
        return lambda: run(variant(graph, ITERATIONS))

    cases = {
        "pagerank_log_10": ranked(lr.pagerank_log),
        "pagerank_basic_10": ranked(lr.pagerank_basic),
        "scan_xml_records": lambda: run(records),
        "classify_pages": lambda: run(lr.classify_pages(records)),
        "parse_and_extract_links": lambda: run(lr.page_edges(lr.parse_pages(records))),
        "parse_counters": lambda: run(lr.parse_counters(lr.parse_pages(records))),
        "build_graph": lambda: succession_graph(spark, SF_DIR),
        "adjacency": lambda: run(lr.adjacency(graph)),
        "topk_100": lambda: run(lr.topk_pages(ranks, 100, "log_rank")),
        "preview_all": lambda: run(lr.preview_graph(graph)),
        "missing_structure": lambda: run(lr.missing_structure(graph)),
        "iteration_counters": lambda: run(lr.iteration_counters(graph)),
        "unescape_entities": lambda: run(Q.unescape_texts(spark, SF_DIR)),
        "html_link_graph": lambda: run(Q.html_link_graph(spark, SF_DIR)),
        "dump_to_topk": lambda: run(lr.dump_to_topk(spark, dump, 3, 10)),
    }
    seconds = {}
    for name, action in cases.items():
        action()
        seconds[name] = round(timed(action), 3)
    seconds["pagerank_log_per_iteration"] = round(seconds["pagerank_log_10"] / ITERATIONS, 3)
    seconds["pagerank_basic_per_iteration"] = round(seconds["pagerank_basic_10"] / ITERATIONS, 3)
    total = sum(value for name, value in seconds.items() if not name.endswith("per_iteration"))
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
