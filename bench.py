"""Headline timings: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from arborflow.operators import tree  # noqa: E402
from arborflow.operators.syntax import extract  # noqa: E402
from arborflow.plans.corpus import load_sources  # noqa: E402
from arborflow.plans.graph import build_graph  # noqa: E402
from arborflow.plans.incremental import incremental_run  # noqa: E402
from arborflow.session import configure, keep  # noqa: E402
from arborflow.sources.state import State, empty_state  # noqa: E402
from oracle import table_cases  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TABLE_QUERIES = [
    "content_fingerprint", "change_detect", "stale_elements", "contract_validate", "json_parse", "latest_by_key",
    "graph_merge", "placeholder_nodes", "detach_delete", "graph_fold_edges", "table_digest", "graph_snapshot",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        configure(SparkSession.builder.master(f"local[{CPUS}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, sizes = {}, {}

    def clock(name: str, work) -> object:
        start = time.time()
        out = work()
        times[name] = round(time.time() - start, 3)
        return out

    sources = load_sources(spark, FOLDER)
    drain(sources)
    clock("ast_nodes", lambda: drain(tree.ast_nodes(extract(sources, stored=False))))

    def graph():
        built = build_graph(sources)
        sizes["nodes"], sizes["edges"] = built.nodes.count(), built.edges.count()

    clock("build_graph_cold", graph)
    clock("build_graph", graph)
    kept = {}

    def first_run():
        run = incremental_run(sources, empty_state(spark))
        drain(run.events)
        kept["state"] = State(keep(run.state.file_state, "state"), keep(run.fresh_elements, "state_elements"), 0)

    clock("first_run", first_run)

    def unchanged():  # files that failed to parse are tried again by every run
        run = incremental_run(sources, kept["state"])
        drain(run.events)

    clock("unchanged_run", unchanged)
    for name in TABLE_QUERIES:
        clock(name, lambda: drain(table_cases.QUERIES[name](spark, FOLDER)))
    files = sources.count()
    total = times["build_graph"]
    print(json.dumps({
        "metric": "bench_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")), "sources": files, "graph_nodes": sizes["nodes"], "graph_edges": sizes["edges"],
        "sources_per_sec": round(files / total, 1), "graph_rows_per_sec": round((sizes["nodes"] + sizes["edges"]) / total, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
