"""Command line: run the batch steps on the session the cluster provides.

    python -m ledgerstar validate --bronze PATH --reports DIR [--name FILE]
    python -m ledgerstar silver   --bronze PATH --silver DIR
    python -m ledgerstar stage    --silver DIR --categories CSV
    python -m ledgerstar gold
    python -m ledgerstar audit
    python -m ledgerstar all      --bronze PATH --categories CSV

Tables live below ``--warehouse`` (default: a folder below
``spark.checkpoint.dir``), in databases ``silver`` and ``gold``; every step
prints one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession


def main(argv: list[str] | None = None) -> None:
    from ledgerstar.operators.quality import report_path_for
    from ledgerstar.plans import gold, staging
    from ledgerstar.plans.medallion import bronze_to_silver, read_silver, run_medallion, validate
    from ledgerstar.sinks import Warehouse
    from ledgerstar.sources.reconcile import read_reconciled
    from ledgerstar.sources.reference_data import currency_rates

    parser = argparse.ArgumentParser(prog="ledgerstar")
    parser.add_argument("step", choices=["validate", "silver", "stage", "gold", "audit", "all"])
    parser.add_argument("--bronze")
    parser.add_argument("--silver")
    parser.add_argument("--categories")
    parser.add_argument("--reports")
    parser.add_argument("--report", help="stored validation report that decides how silver is written")
    parser.add_argument("--name", help="input file name used to name the report")
    parser.add_argument("--warehouse", help="root folder of the silver and gold layers "
                                            "(default: <spark.checkpoint.dir>/ledgerstar/warehouse)")
    args = parser.parse_args(argv)

    spark = (SparkSession.builder.appName(f"ledgerstar-{args.step}")
             .config("spark.ui.enabled", "false")  # batch steps: no web UI (use event logs)
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    wh = Warehouse(spark, args.warehouse.rstrip("/")) if args.warehouse else Warehouse.default(spark)
    silver_dir = args.silver or f"{wh.root}/silver/staging_parquet"
    out: dict = {"step": args.step}

    def bronze() -> DataFrame:
        """The landed files, whose columns and types may differ; conflicts show in the step's output."""
        landed = read_reconciled(spark, args.bronze)
        if landed.conflicts:
            out["schema_conflicts"] = landed.conflicts
        return landed.rows

    if args.step == "validate":
        name = args.name or os.path.basename(args.bronze.rstrip("/"))
        path = report_path_for(name, args.reports or f"{wh.root}/reports")
        v = validate(bronze(), result_path=path)
        out.update(success=v.success, result_path=v.result_path)
    elif args.step == "silver":
        out["rows"] = bronze_to_silver(bronze(), silver_dir,
                                       result_path=args.report,
                                       report_path=f"{args.reports or f'{wh.root}/reports'}/silver_validation.json").count()
    elif args.step == "stage":
        names = staging.write_staging(wh, read_silver(spark, silver_dir),
                                      staging.read_category_map(spark, args.categories), currency_rates(spark))
        out["tables"] = names
    elif args.step == "gold":
        names = {t: wh.attach("silver", t) for t in staging.STAGING_TABLES}
        out["inserted"] = gold.load_gold(wh, names)
    elif args.step == "audit":
        gold.ensure_gold(wh)
        out["counts"] = {r["table_name"]: r["row_count"] for r in gold.gold_audit(wh).collect()}
    else:
        out["inserted"] = run_medallion(spark, bronze(),
                                        staging.read_category_map(spark, args.categories),
                                        currency_rates(spark), wh, result_path=args.report)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
