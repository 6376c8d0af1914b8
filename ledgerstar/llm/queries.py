"""The operators applied to the given tables with production parameters, and DuckDB SQL where it can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.llm import decontaminate, language, lexical, mixing, packing, pages, periodic, quality, secrets, simhash, suffixes, topk, toxicity
from ledgerstar.llm.common import hash_fold

#: Scores from which op7 and op10 predict 1.
TOXIC_FROM, GOOD_FROM = 0.7, 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, at most 4 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links")


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, from the documents that aren't held out."""
    docs, held_out = table(spark, sf_dir, "documents"), hash_fold("doc_id", 5) == 1
    return language.scored_by_rest(docs, held_out)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: what the base patterns find and what the network adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(docs))
    of = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")
    base = span_text(F.filter("__spans", lambda s: s["kind"] != "model"))
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), of("model").alias("n_model"),
        F.sha2(base, 256).alias("base_sha256"), span_text(F.col("__spans")).alias("spans"),
    )


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products for every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents: 0.8 of their five-word shingles."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=5, threshold=0.8)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that aren't held out."""
    docs, held_out = table(spark, sf_dir, "documents").select("doc_id", "text"), hash_fold("doc_id", 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    score = F.col("__score")
    return toxicity.scored(docs, model).select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= TOXIC_FROM).cast("int").alias("predicted"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start earlier, too."""
    found = suffixes.deduplicated(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the rows that aren't held out."""
    docs, held_out = table(spark, sf_dir, "documents").select("doc_id", "text"), hash_fold("doc_id", 5) == 0
    model = quality.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    score = F.col("__score")
    return quality.scored(docs, model).select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= GOOD_FROM).cast("int").alias("predicted"))


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document by crc32 of its id becomes periodic from some word on."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 6 words and 4 periods in every document, and what is left of it without their repeats."""
    found = periodic.find_runs(table(spark, sf_dir, "documents"), min_length=6, min_exponent=4, rewrite=with_planted_period)
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(order)
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of power-of-two length, each a sequence of its own."""
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, most=4096)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_simhash, op2_suffix_tree, op3_secrets, op4_topk, op5_decontaminate, op6_main_text, op7_toxicity, op8_mixing, op9_suffix_dedup, op10_quality, op11_periodic_runs, op12_lexical_search, op13_packing)
}

ORACLE_SQL: dict[str, str] = {
    "op4_topk": r"""
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
  FROM clean q JOIN clean d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
""",
    "op5_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), b AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS i FROM d WHERE len(w) > 0)
), bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 5], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS i FROM b WHERE len(w) > 0)
), total AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id
), found AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM found JOIN total USING (item_id) WHERE n_found >= 0.8 * n_shingles
""",
    "op9_suffix_dedup": r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i AS start, substr(x, 2 * i + 1, 200) AS s FROM (SELECT doc_id, x, unnest(range(0, greatest(n - 99, 0))) AS i FROM d)
), late AS (
  SELECT doc_id, start FROM (SELECT doc_id, start, row_number() OVER (PARTITION BY s ORDER BY doc_id, start) AS r FROM w) WHERE r > 1
), marked AS (
  SELECT doc_id, start, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) <= 100 THEN 0 ELSE 1 END AS fresh FROM late
), numbered AS (
  SELECT doc_id, start, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start) AS k FROM marked
), spans AS (
  SELECT doc_id, k, min(start) AS a, max(start) + 100 AS e FROM numbered GROUP BY doc_id, k
), gaps AS (
  SELECT doc_id, a, e, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next_a FROM spans
), kept AS (
  SELECT d.doc_id, any_value(d.n) AS n, coalesce(sum(e - a), 0) AS n_removed, count(a) AS n_spans,
         CASE WHEN count(a) = 0 THEN any_value(x)
              ELSE substr(any_value(x), 1, 2 * CAST(min(a) AS BIGINT)) || string_agg(substr(x, 2 * e + 1, 2 * (coalesce(next_a, n) - e)), '' ORDER BY a) END AS rest
  FROM d LEFT JOIN gaps USING (doc_id) GROUP BY d.doc_id
)
SELECT doc_id, n AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept
""",
    "op12_lexical_search": r"""
WITH dt AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), it AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark
), total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM dt WHERE len(w) > 0
), postings AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM dt) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, total GROUP BY term, n_docs
), asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(w) AS term FROM it) GROUP BY ALL
), lengths AS (SELECT d, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM dt, total WHERE len(w) > 0
), scored AS (
  SELECT i, d, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (d) GROUP BY ALL
), placed AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS r FROM scored JOIN lengths USING (d) WHERE score > 0
)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM placed JOIN it USING (i) WHERE r <= 10
""",
}
