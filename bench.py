"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Graph tables are built
once, as part of ``build_*``; lookups read the stored graph, as a user would.
``prepare_inputs`` derives the manifests, schemas and other operator inputs from the tables.
"""

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from symbolweave.catalog import QUERIES  # noqa: E402
from symbolweave.catalog import inputs  # noqa: E402
from symbolweave.session import local_session  # noqa: E402

HEADLINE = (
    "merge_symbols", "merge_mentions", "merge_ranges", "merge_incremental_mentions", "corpus_union_symbols",
    "resolve_symbols", "resolve_symbols_batch", "find_definitions", "find_definitions_batch", "find_references",
    "find_references_batch", "find_references_uncapped", "find_implementations", "list_symbols", "list_symbols_by_folder",
    "get_imports", "symbols_at", "event_flow_sites", "event_flow_summary", "grep_definition_body",
    "grep_reference_windows", "build_graph_chunks", "build_graph_mentions", "add_missing_symbols", "clear_bad_ranges",
    "k8s_occurrences", "proto_occurrences", "terraform_occurrences", "detect_languages", "render_roots", "plan_rebuild",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY")
    spark = local_session(cores=cores, partitions=cores, driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    names = only.split(",") if only else HEADLINE

    def timed(action):
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    def prepare():
        for derive in (
            inputs.text_lines, inputs.occurrences, inputs.symbol_info, inputs.k8s_objects, inputs.proto_tables,
            inputs.terraform_tables,
        ):
            derive(spark, folder)

    seconds = {
        "build_raw_graph": timed(lambda: inputs.raw_graph(spark, folder)),
        "build_merged_graph": timed(lambda: inputs.merged_graph(spark, folder)),
        "build_text_graph": timed(lambda: inputs.text_graph(spark, folder)),
        "prepare_inputs": timed(prepare),
    }
    for name in names:
        # The noop sink runs the whole plan without collecting rows.
        run = lambda n=name: QUERIES[n](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = timed(run)
    spark.stop()
    return {
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }


if __name__ == "__main__":
    with contextlib.redirect_stdout(sys.stderr):
        result = main()
    print(json.dumps(result))
