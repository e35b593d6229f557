"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row is
computed, nothing is collected), once to warm up and then three times;
the median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["html_to_text", "ledger_accept", "page_links", "annotate_terms", "link_replace",
            "ingest_pages", "ledger_two_batches", "dictionary_upsert", "lexicon_codes", "status_and_empty",
            "annotation_store", "conditions_source", "frontier_walk"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    from quire.plans import QUERIES
    from quire.session import get_session

    spark = get_session(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    out, errors = {}, {}
    for name in names:
        fn = QUERIES[name]
        times = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    times.append(time.perf_counter() - t0)
            out[name] = round(statistics.median(times), 3)
        except Exception as ex:  # noqa: BLE001 - report and keep measuring the rest
            errors[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    line = {"metric": "sum_of_median_query_sec", "value": round(sum(out.values()), 3),
            "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else sf_dir,
            "cpus": cpus, "runs": runs}
    if errors:
        line["errors"] = errors
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
