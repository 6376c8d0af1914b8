"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed with the ``noop`` sink (every row is
produced, nothing is collected), ``BENCH_REPEAT`` times; the median per query
is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "suite_report",
    "clean_rows",
    "quarantine_rows",
    "staging_transactions",
    "dense_ids_bucketed",
    "insert_only_merge",
    "dim_counterparty",
    "fact_lookup",
    "gold_audit",
    "to_euro",
    "emission_report",
    "emission_mean_by_category",
    "star_emission_by_category_country",
)
COMPARED = {"suite_report": "validate_via_pandas", "scan_parquet_glob": "clean_via_pandas",
            "row_number_renumber": "ids_coalesce_one"}


def run_once(spark, query, sf_dir) -> float:
    t0 = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    from ledgerstar.checks.queries import QUERIES
    from ledgerstar.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="ledgerstar-bench",
                          extra={"spark.sql.execution.arrow.pyspark.enabled": "true"})

    # Warm-up: JVM, class loading, parquet footers (not timed).
    run_once(spark, QUERIES["suite_report"], sf_dir)

    medians, spreads = {}, {}
    for name in dict.fromkeys([*names, *COMPARED]):
        times = [run_once(spark, QUERIES[name], sf_dir) for _ in range(repeat)]
        medians[name] = round(statistics.median(times), 3)
        spreads[name] = round(max(times) - min(times), 3)
    baseline = {}
    if os.environ.get("BENCH_BASELINE", "1") == "1":
        sys.path.insert(0, os.path.join(ROOT, "tools"))
        from reference_style_baseline import measure

        baseline = measure(spark, sf_dir, repeat)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(medians[n] for n in names), 3),
        "unit": "sec",
        "queries": medians,
        "spread": spreads,
        "original_style": baseline,
        "compared": {q: {"ours": medians[q], "original_style": baseline.get(b)} for q, b in COMPARED.items()},
        "sf": sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
