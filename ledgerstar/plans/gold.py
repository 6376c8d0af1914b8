"""Staging to the gold star schema: four dimensions and one fact table.

Order matters and follows the data: dimensions are merged first (insert-only,
dense ids above the current maximum), then fact rows resolve their four
surrogate keys against the committed dimensions and are appended by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar import schemas
from ledgerstar.operators.joins import fits_broadcast, lookup_join, row_spread
from ledgerstar.operators.merge import build_dim, union_dedupe_by_key
from ledgerstar.session import run_concurrently
from ledgerstar.sinks import Warehouse, append_by_name, create_table_if_absent, overwrite_table, store
from ledgerstar.sources.files import table_exists
from ledgerstar.sources.footers import from_footers


@dataclass(frozen=True)
class Dimension:
    table: str
    staging: str
    schema: T.StructType
    key: str
    id_col: str


DIMENSIONS: tuple[Dimension, ...] = (
    Dimension("currency_dim", "sta_currency_dim", schemas.CURRENCY_DIM, "currency", "currency_id"),
    Dimension("calendar_dim", "sta_calendar_dim", schemas.CALENDAR_DIM, "payment_date", "date_id"),
    Dimension("category_dim", "sta_category_dim", schemas.CATEGORY_DIM, "category_code", "category_id"),
    Dimension("counter_party_dim", "sta_counter_party_dim", schemas.COUNTER_PARTY_DIM,
              "counterparty_add", "counterparty_id"),
)
FACT_TABLE = "transactions"
GOLD_TABLES = tuple(d.table for d in DIMENSIONS) + (FACT_TABLE,)


def ensure_gold(wh: Warehouse) -> dict[str, str]:
    """Create the gold database and tables if absent; return table names."""
    wh.ensure_database("gold")
    names = {}
    for table, schema in [(d.table, d.schema) for d in DIMENSIONS] + [(FACT_TABLE, schemas.TRANSACTIONS_FACT)]:
        names[table] = wh.table("gold", table)
        create_table_if_absent(wh.spark, names[table], schema, wh.location("gold", table))
    return names


def load_dimension(wh: Warehouse, dim: Dimension, staging: DataFrame) -> int:
    """Insert-only merge of one dimension; returns the number of new members."""
    columns = [f.name for f in dim.schema.fields if f.name != dim.id_col]
    return build_dim(staging.select(*columns), wh.table("gold", dim.table), [dim.key], dim.id_col)


def resolve_fact_keys(transactions: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows: the amount plus four surrogate keys (left lookups).

    A transaction whose business key has no dimension member (or is NULL)
    keeps a NULL id. Dimensions are unique per key, so no row fans out.
    """
    lookups = {d.table: dims[d.table].select(d.key, d.id_col) for d in DIMENSIONS}
    small = run_concurrently({t: (lambda df=df: fits_broadcast(df)) for t, df in lookups.items()})
    fact = transactions
    if not all(small.values()):  # rows are told apart while they still are those of the stored table
        fact = fact.withColumn("_ls_row", row_spread(fact))
    fact = fact.select("amount_euro", *[d.key for d in DIMENSIONS], *[c for c in fact.columns if c == "_ls_row"])
    # Broadcast lookups first: what a shuffle join reads twice is then only a scan.
    for d in sorted(DIMENSIONS, key=lambda d: not small[d.table]):
        spread = None if small[d.table] else F.col("_ls_row")
        fact = lookup_join(fact, lookups[d.table], d.key, "left", small=small[d.table], spread=spread)
    return fact.select("amount_euro", "currency_id", "date_id", "category_id", "counterparty_id")


def load_fact(wh: Warehouse, transactions: DataFrame) -> None:
    dims = {d.table: wh.spark.table(wh.table("gold", d.table)) for d in DIMENSIONS}
    append_by_name(resolve_fact_keys(transactions, dims), wh.table("gold", FACT_TABLE))


def load_gold(wh: Warehouse, staging_names: dict[str, str]) -> dict[str, int]:
    """Merge the four dimensions, then append the facts; returns inserted counts."""
    ensure_gold(wh)
    spark = wh.spark
    # The four dimensions are independent: their jobs run side by side.
    inserted = run_concurrently({
        d.table: (lambda d=d: load_dimension(wh, d, spark.table(staging_names[d.staging])))
        for d in DIMENSIONS})
    load_fact(wh, spark.table(staging_names["sta_transactions"]))
    return inserted


def rebuild_dimension(wh: Warehouse, dim: Dimension, incoming: DataFrame) -> DataFrame:
    """Renumber a dimension that stored facts refer to, and the facts with it; returns (old id, new id) of every old member.

    Existing members win over incoming rows of the same key, all members get
    dense ids in key order, and the fact table's ids are exchanged by a join
    with the map of old to new ids (size-checked; a hot member's facts are
    spread). Facts keep their business key: an id without a member in the old
    dimension fails the job, NULL stays NULL. Both tables are written in full
    beside the old ones before either is replaced; one writer at a time.
    """
    name, fact_name = wh.table("gold", dim.table), wh.table("gold", FACT_TABLE)
    existing, facts = wh.spark.table(name), wh.spark.table(fact_name)
    columns = [c for c in existing.columns if c != dim.id_col]
    rebuilt = store(union_dedupe_by_key(existing, incoming.select(*columns), [dim.key], dim.id_col), f"rebuilt-{dim.table}")
    old = existing.select(F.col(dim.key).alias("_ls_key"), F.col(dim.id_col).alias("_ls_old"))
    moved = old.join(rebuilt.select(dim.key, dim.id_col), F.col("_ls_key").eqNullSafe(F.col(dim.key)))
    moved = store(moved.select(F.col("_ls_old").alias(dim.id_col), F.col(dim.id_col).alias("_ls_new")), f"moved-{dim.table}")
    lost = F.col(dim.id_col).isNotNull() & F.col("_ls_new").isNull()
    new_id = F.when(lost, F.raise_error(F.lit(f"a fact refers to no member of {dim.table}"))).otherwise(F.col("_ls_new"))
    rekeyed = lookup_join(facts, moved, dim.id_col, "left")
    rekeyed = rekeyed.select(*[new_id.cast(facts.schema[c].dataType).alias(c) if c == dim.id_col else F.col(c) for c in facts.columns])
    rekeyed = store(rekeyed, f"rekeyed-{FACT_TABLE}")
    overwrite_table(rebuilt.select(*existing.columns), name, wh.location("gold", dim.table))
    overwrite_table(rekeyed, fact_name, wh.location("gold", FACT_TABLE))
    return moved.select(dim.id_col, F.col("_ls_new").alias("new_id"))


def gold_audit(wh: Warehouse) -> DataFrame:
    """Row count of every gold table, as one frame ``(table_name, row_count)``, from the files' footers."""
    counts = [
        from_footers(wh.spark, wh.table("gold", t)).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t).alias("table_name"), "row_count")
        for t in ("calendar_dim", "currency_dim", "category_dim", "counter_party_dim", FACT_TABLE)
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def create_or_merge(wh: Warehouse, dim: Dimension, staging: DataFrame) -> int:
    """First load creates the table (ids from 1); later loads merge insert-only.

    A folder that already holds the dimension is never replaced: a catalog that does not know it takes it over.
    """
    name = wh.table("gold", dim.table)
    wh.ensure_database("gold")
    if not table_exists(wh.spark, name):
        create_table_if_absent(wh.spark, name, dim.schema, wh.location("gold", dim.table))
    return load_dimension(wh, dim, staging)
