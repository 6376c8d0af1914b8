"""The command line, step by step in separate processes, on a fresh warehouse."""

import json
import subprocess
import sys

from conftest import ROOT, SF001


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "ledgerstar", *args], cwd=ROOT, capture_output=True,
                         text=True, timeout=600, check=True)
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_cli_steps(spark, wh):
    from ledgerstar.checks import queries as QQ
    from ledgerstar.sources import files
    from ledgerstar.sources.reference_data import sample_category_map

    bronze = f"{wh.root}/landing/day1_bronze.parquet"
    QQ.bronze_transactions(spark, SF001).write.parquet(bronze)
    categories = f"{wh.root}/ref/category_map.csv"
    sample_category_map(spark).write.options(**files.CSV_OPTIONS).csv(categories)
    root = ["--warehouse", f"{wh.root}/warehouse"]

    v = _run("validate", "--bronze", bronze, *root)
    assert v["success"] is False and v["result_path"].endswith("day1__validation.json")
    assert spark.read.json(v["result_path"]).count() == 1  # one report document
    assert _run("silver", "--bronze", bronze, *root)["rows"] == QQ.silver(spark, SF001).count()
    assert set(_run("stage", "--categories", categories, *root)["tables"]) == {
        "sta_transactions", "sta_calendar_dim", "sta_counter_party_dim", "sta_category_dim", "sta_currency_dim"}
    assert _run("gold", *root)["inserted"]["currency_dim"] == 5
    counts = _run("audit", *root)["counts"]
    assert counts["transactions"] == QQ.silver(spark, SF001).count() and counts["category_dim"] == 16
