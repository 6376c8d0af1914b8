"""Independent SQL (DuckDB dialect) for every registered query.

The text is written from the semantics, not from the Spark plans: the bronze
derivation, the cleaning predicates, dense ids as ``row_number() OVER (ORDER
BY key)`` plus the previous maximum, merges as ``UNION ALL ... WHERE NOT
EXISTS``. Sums of doubles are compensated (``fsum``): the plain ``sum`` gives
other last bits in another thread order, which shows at a tie of the twelfth
digit. Views ``lineitem part supplier nation events`` are provided by the
checker. Money products are rounded half-up on the double product's shortest decimal form.
"""

from __future__ import annotations

from ledgerstar.constants import CATEGORY_CODES, CONVERSION_RATES, EXCLUDED_CATEGORY_NAME, VALID_CURRENCIES
from ledgerstar.sources.bronze import LINE_CURRENCY, UNKNOWN_CATEGORY_CODE
from ledgerstar.sources.reference_data import SAMPLE_CATEGORY_MAP


def _text(value: str) -> str:
    parts = value.replace("'", "''").split("\n")
    return " || chr(10) || ".join(f"'{p}'" for p in parts)


def _values_categories() -> str:
    rows = ", ".join(f"({c}, {_text(n)}, CAST({m!r} AS DOUBLE))" for c, n, m in SAMPLE_CATEGORY_MAP)
    return f"SELECT * FROM (VALUES {rows}) AS t(category_code, category_name, co2_multiplier)"


def _values_rates() -> str:
    rows = ", ".join(f"({_text(c)}, CAST({r!r} AS DOUBLE))" for c, r in CONVERSION_RATES)
    return f"SELECT * FROM (VALUES {rows}) AS t(currency, conversion_rate)"


_CURRENCY_BY_LINE = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(LINE_CURRENCY, start=1))
_CODES = ", ".join(str(c) for c in CATEGORY_CODES)
_VALID = ", ".join(f"'{c}'" for c in VALID_CURRENCIES)
_AMOUNT = "CASE WHEN l.l_returnflag = 'R' AND l.l_quantity = 7 THEN -l.l_extendedprice ELSE l.l_extendedprice END"

BASE = f"""
bronze AS (
  SELECT
    l.l_orderkey * 10 + l.l_linenumber AS booking_id,
    CASE l.l_linenumber {_CURRENCY_BY_LINE} END AS acct_ccy,
    {_AMOUNT} AS bookg_amt,
    CAST(round(({_AMOUNT}) * 100) AS BIGINT) AS bookg_amt_nmrc,
    CASE WHEN l.l_quantity = 13 THEN NULL ELSE l.l_shipdate + INTERVAL 13 HOUR END AS bookg_dt_tm_cet,
    CASE WHEN l.l_quantity = 27 THEN NULL ELSE l.l_shipdate + INTERVAL 12 HOUR END AS bookg_dt_tm_gmt,
    CAST(CASE WHEN p.p_size = 50 THEN {UNKNOWN_CATEGORY_CODE}
              ELSE [{_CODES}][p.p_size % {len(CATEGORY_CODES)} + 1] END AS INTEGER) AS dtld_tx_tp,
    s.s_name AS ctpty_nm,
    n.n_name AS ctpty_ctry,
    CASE WHEN s.s_suppkey % 10 = 9 THEN NULL
         ELSE 'ADDR ' || CAST(s.s_suppkey - s.s_suppkey % 2 AS VARCHAR) END AS ctpty_adr_line1
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
flagged AS (
  SELECT *,
    COALESCE(bookg_amt < 0, FALSE) AS v_amount,
    COALESCE(bookg_amt_nmrc < 0, FALSE) AS v_cents,
    COALESCE(acct_ccy NOT IN ({_VALID}), FALSE) AS v_currency,
    bookg_dt_tm_gmt IS NULL AS v_gmt,
    bookg_dt_tm_cet IS NULL AS v_cet,
    COALESCE(dtld_tx_tp NOT IN ({_CODES}), FALSE) AS v_category
  FROM bronze
),
silver AS (
  SELECT booking_id, acct_ccy, bookg_amt, bookg_amt_nmrc, bookg_dt_tm_cet, bookg_dt_tm_gmt,
         dtld_tx_tp, ctpty_nm, ctpty_ctry, ctpty_adr_line1,
         CAST(NULL AS VARCHAR) AS ctpty_adr_line2, CAST(NULL AS VARCHAR) AS rmt_inf_ustrd2,
         CAST(NULL AS VARCHAR) AS tx_tp
  FROM flagged
  WHERE NOT (v_amount OR v_cents OR v_currency OR v_gmt OR v_cet)
),
sta AS (
  SELECT acct_ccy AS currency, bookg_amt AS amount_euro, CAST(bookg_dt_tm_cet AS DATE) AS payment_date,
         ctpty_ctry AS counterparty_country, ctpty_nm AS counterparty_name,
         dtld_tx_tp AS category_code, ctpty_adr_line1 AS counterparty_add
  FROM silver
),
categories AS ({_values_categories()}),
rates AS ({_values_rates()}),
euro AS (
  SELECT CASE WHEN s.currency <> 'EUR' THEN 'EUR' ELSE s.currency END AS currency,
         CASE WHEN s.currency <> 'EUR'
              THEN CAST(round(CAST(CAST(s.amount_euro * r.conversion_rate AS VARCHAR) AS DECIMAL(38,15)), 3)
                        AS DOUBLE)
              ELSE s.amount_euro END AS amount_euro,
         s.payment_date, s.counterparty_country, s.counterparty_name, s.category_code, s.counterparty_add
  FROM sta s LEFT JOIN rates r ON s.currency = r.currency
),
emission AS (
  SELECT e.*, c.category_name, c.co2_multiplier,
         CAST(round(CAST(CAST(e.amount_euro * c.co2_multiplier AS VARCHAR) AS DECIMAL(38,15)), 2)
              AS DOUBLE) AS co2_emission_g
  FROM euro e LEFT JOIN categories c ON e.category_code = c.category_code
),
report AS (
  SELECT co2_emission_g, amount_euro, category_code, category_name, co2_multiplier
  FROM emission
  WHERE category_name <> {_text(EXCLUDED_CATEGORY_NAME)} AND counterparty_country = 'NATION_19'
),
sta_b1 AS (SELECT * FROM sta WHERE payment_date < DATE '1998-01-01'),
cal_all AS (SELECT DISTINCT payment_date FROM sta),
cal_b1 AS (SELECT DISTINCT payment_date FROM sta_b1),
cp_all AS (SELECT DISTINCT counterparty_add, counterparty_country, counterparty_name FROM sta),
cp_b1 AS (SELECT DISTINCT counterparty_add, counterparty_country, counterparty_name FROM sta_b1),
cp_one_all AS (
  SELECT counterparty_add, counterparty_country, counterparty_name FROM cp_all
  QUALIFY row_number() OVER (PARTITION BY counterparty_add
                             ORDER BY counterparty_country NULLS FIRST, counterparty_name NULLS FIRST) = 1
),
cp_one_b1 AS (
  SELECT counterparty_add, counterparty_country, counterparty_name FROM cp_b1
  QUALIFY row_number() OVER (PARTITION BY counterparty_add
                             ORDER BY counterparty_country NULLS FIRST, counterparty_name NULLS FIRST) = 1
),
-- gold dimensions after one load of all rows (ids dense in key order)
g_currency AS (SELECT currency, conversion_rate,
                      CAST(row_number() OVER (ORDER BY currency NULLS FIRST) AS INTEGER) AS currency_id FROM rates),
g_calendar AS (SELECT payment_date,
                      CAST(row_number() OVER (ORDER BY payment_date NULLS FIRST) AS INTEGER) AS date_id FROM cal_all),
g_category AS (SELECT category_code, category_name, co2_multiplier,
                      CAST(row_number() OVER (ORDER BY category_code NULLS FIRST) AS INTEGER) AS category_id
               FROM categories),
g_counterparty AS (SELECT *, CAST(row_number() OVER (ORDER BY counterparty_add NULLS FIRST) AS INTEGER)
                             AS counterparty_id FROM cp_one_all),
g_fact AS (
  SELECT cur.currency_id, cal.date_id, cp.counterparty_id, cat.category_id, s.amount_euro
  FROM sta s
  LEFT JOIN g_currency cur ON s.currency = cur.currency
  LEFT JOIN g_calendar cal ON s.payment_date = cal.payment_date
  LEFT JOIN g_category cat ON s.category_code = cat.category_code
  LEFT JOIN g_counterparty cp ON s.counterparty_add = cp.counterparty_add
)
"""


def _q(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body.strip()}"


_CALENDAR_COLS = ("payment_date, CAST(year(payment_date) AS INTEGER) AS year, "
                  "CAST(month(payment_date) AS INTEGER) AS month, CAST(day(payment_date) AS INTEGER) AS day")


def _rule_report(name: str, column: str, violation: str, missing: str, source: str = "flagged") -> str:
    return f"""
SELECT '{name}' AS rule, '{column}' AS "column",
       count(*) AS element_count,
       count(*) FILTER (WHERE {missing}) AS missing_count,
       count(*) FILTER (WHERE {violation}) AS unexpected_count,
       CASE WHEN count(*) - count(*) FILTER (WHERE {missing}) > 0
            THEN CAST(count(*) FILTER (WHERE {violation}) AS DOUBLE) * 100.0
                 / CAST(count(*) - count(*) FILTER (WHERE {missing}) AS DOUBLE) END AS unexpected_percent,
       count(*) FILTER (WHERE {violation}) = 0 AS success
FROM {source}"""


RULE_SQL = {
    "amount_not_negative": _rule_report("amount_not_negative", "bookg_amt", "v_amount", "bookg_amt IS NULL"),
    "amount_cents_not_negative": _rule_report("amount_cents_not_negative", "bookg_amt_nmrc", "v_cents",
                                              "bookg_amt_nmrc IS NULL"),
    "currency_known": _rule_report("currency_known", "acct_ccy", "v_currency", "acct_ccy IS NULL"),
    "booked_gmt_present": _rule_report("booked_gmt_present", "bookg_dt_tm_gmt", "v_gmt", "FALSE"),
    "booked_cet_present": _rule_report("booked_cet_present", "bookg_dt_tm_cet", "v_cet", "FALSE"),
    "category_known": _rule_report("category_known", "dtld_tx_tp", "v_category", "dtld_tx_tp IS NULL"),
}
_SUITE = " UNION ALL ".join(RULE_SQL[r] for r in (
    "amount_not_negative", "amount_cents_not_negative", "currency_known", "booked_gmt_present",
    "booked_cet_present"))

_FAILED = ("concat_ws(',', CASE WHEN v_amount THEN 'amount_not_negative' END, "
           "CASE WHEN v_cents THEN 'amount_cents_not_negative' END, "
           "CASE WHEN v_currency THEN 'currency_known' END, "
           "CASE WHEN v_gmt THEN 'booked_gmt_present' END, "
           "CASE WHEN v_cet THEN 'booked_cet_present' END)")

# calendar loaded in two runs (payments before 1998, then all)
_CAL_TWO_RUNS = """
, t1 AS (SELECT payment_date, row_number() OVER (ORDER BY payment_date NULLS FIRST) AS date_id FROM cal_b1),
n2 AS (SELECT payment_date FROM cal_all a
       WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.payment_date IS NOT DISTINCT FROM a.payment_date)),
t2 AS (SELECT * FROM t1 UNION ALL
       SELECT payment_date, (SELECT COALESCE(max(date_id), 0) FROM t1)
                            + row_number() OVER (ORDER BY payment_date NULLS FIRST) FROM n2)
"""

_CP_COLS = "counterparty_add, counterparty_country, counterparty_name"


def _cp_two_runs(null_safe: bool) -> str:
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    return f"""
, t1 AS (SELECT {_CP_COLS}, row_number() OVER (ORDER BY counterparty_add NULLS FIRST) AS counterparty_id
         FROM cp_one_b1),
n2 AS (SELECT {_CP_COLS} FROM cp_one_all a
       WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.counterparty_add {eq} a.counterparty_add)),
t2 AS (SELECT * FROM t1 UNION ALL
       SELECT {_CP_COLS}, (SELECT COALESCE(max(counterparty_id), 0) FROM t1)
                          + row_number() OVER (ORDER BY counterparty_add NULLS FIRST) FROM n2)
"""


# Text-typed bronze (H13): malformed amounts (decimal comma) for unknown
# categories and local-format booking times for grocery rows, parsed back
# with TRY_CAST; a present raw value that does not parse is a violation.
_PARSED = [("booking_id", "BIGINT"), ("bookg_amt", "DOUBLE"), ("bookg_amt_nmrc", "BIGINT"),
           ("bookg_dt_tm_cet", "TIMESTAMP"), ("bookg_dt_tm_gmt", "TIMESTAMP"), ("dtld_tx_tp", "INTEGER")]
_TEXT = """
, text_bronze AS (
  SELECT CAST(booking_id AS VARCHAR) AS booking_id, acct_ccy,
         CASE WHEN dtld_tx_tp = 9999 THEN replace(CAST(bookg_amt AS VARCHAR), '.', ',')
              ELSE CAST(bookg_amt AS VARCHAR) END AS bookg_amt,
         CAST(bookg_amt_nmrc AS VARCHAR) AS bookg_amt_nmrc,
         CASE WHEN dtld_tx_tp = 5411 THEN strftime(bookg_dt_tm_cet, '%d.%m.%Y %H:%M')
              ELSE CAST(bookg_dt_tm_cet AS VARCHAR) END AS bookg_dt_tm_cet,
         CAST(bookg_dt_tm_gmt AS VARCHAR) AS bookg_dt_tm_gmt, CAST(dtld_tx_tp AS VARCHAR) AS dtld_tx_tp,
         ctpty_nm, ctpty_ctry, ctpty_adr_line1
  FROM bronze),
parsed AS (
  SELECT """ + ", ".join(f"TRY_CAST({c} AS {t}) AS {c}, {c} AS raw_{c}" for c, t in _PARSED) + """,
         acct_ccy, ctpty_nm, ctpty_ctry, ctpty_adr_line1
  FROM text_bronze),
pflags AS (
  SELECT *, """ + ", ".join(f"COALESCE(raw_{c} IS NOT NULL AND {c} IS NULL, FALSE) AS p_{c}" for c, _ in _PARSED) + """,
    COALESCE(bookg_amt < 0, FALSE) AS v_amount,
    COALESCE(bookg_amt_nmrc < 0, FALSE) AS v_cents,
    COALESCE(acct_ccy NOT IN (""" + _VALID + """), FALSE) AS v_currency,
    bookg_dt_tm_gmt IS NULL AS v_gmt,
    bookg_dt_tm_cet IS NULL AS v_cet
  FROM parsed)
"""
_TEXT_REPORT = " UNION ALL ".join(
    [_rule_report(f"{c}_parses", c, f"p_{c}", f"raw_{c} IS NULL", "pflags") for c, _ in _PARSED]
    + [_rule_report(*args, source="pflags") for args in (
        ("amount_not_negative", "bookg_amt", "v_amount", "bookg_amt IS NULL"),
        ("amount_cents_not_negative", "bookg_amt_nmrc", "v_cents", "bookg_amt_nmrc IS NULL"),
        ("currency_known", "acct_ccy", "v_currency", "acct_ccy IS NULL"),
        ("booked_gmt_present", "bookg_dt_tm_gmt", "v_gmt", "FALSE"),
        ("booked_cet_present", "bookg_dt_tm_cet", "v_cet", "FALSE"))])
_TEXT_CLEAN = """
SELECT booking_id, acct_ccy, bookg_amt, bookg_amt_nmrc, bookg_dt_tm_cet, bookg_dt_tm_gmt, dtld_tx_tp,
       ctpty_nm, ctpty_ctry, ctpty_adr_line1,
       CAST(NULL AS VARCHAR) AS ctpty_adr_line2, CAST(NULL AS VARCHAR) AS rmt_inf_ustrd2,
       CAST(NULL AS VARCHAR) AS tx_tp
FROM pflags
WHERE NOT (""" + " OR ".join(f"p_{c}" for c, _ in _PARSED) + """
           OR v_amount OR v_cents OR v_currency OR v_gmt OR v_cet)"""


# Bronze in other numeric types. t_*: the value as the expected type holds it; p_*: it is not the value that came in.
_TYPED = """
, typed AS (
  SELECT *, 'float' AS kind, CAST(CAST(bookg_amt AS FLOAT) AS DOUBLE) AS t_amount, FALSE AS p_amount,
         bookg_amt_nmrc AS t_cents, dtld_tx_tp = 5411 AS p_cents
  FROM bronze
  UNION ALL
  SELECT *, 'decimal', bookg_amt, dtld_tx_tp = 9999, bookg_amt_nmrc, FALSE FROM bronze
  UNION ALL
  SELECT * EXCLUDE (big), 'bigint', CAST(big AS DOUBLE), CAST(CAST(big AS DOUBLE) AS HUGEINT) <> big, bookg_amt_nmrc, FALSE
  FROM (SELECT *, CASE WHEN dtld_tx_tp = 9999 THEN 9007199254740992 + 2 * booking_id + 1
                       WHEN dtld_tx_tp = 5411 THEN 9007199254740992 + 4 * booking_id ELSE bookg_amt_nmrc END AS big
        FROM bronze) x
)
"""
_TYPED += """
, tflags AS (
  SELECT * EXCLUDE (bookg_amt, bookg_amt_nmrc), t_amount AS bookg_amt, t_cents AS bookg_amt_nmrc,
    COALESCE(t_amount < 0, FALSE) AS v_amount, COALESCE(t_cents < 0, FALSE) AS v_cents,
    COALESCE(acct_ccy NOT IN (""" + _VALID + """), FALSE) AS v_currency,
    bookg_dt_tm_gmt IS NULL AS v_gmt, bookg_dt_tm_cet IS NULL AS v_cet
  FROM typed)
"""
_TYPED_REPORT = " UNION ALL ".join(
    f"SELECT *, '{kind}' AS kind FROM ({rule}) r"
    for kind, casts in (("float", ("amount", "cents")), ("decimal", ("amount",)), ("bigint", ("amount",)))
    for rule in [_rule_report(f"{c}_parses", c, f"p_{n}", f"{c} IS NULL", f"tflags WHERE kind = '{kind}'")
                 for n, c in (("amount", "bookg_amt"), ("cents", "bookg_amt_nmrc")) if n in casts]
    + [_rule_report(*args, source=f"tflags WHERE kind = '{kind}'") for args in (
        ("amount_not_negative", "bookg_amt", "v_amount", "bookg_amt IS NULL"),
        ("amount_cents_not_negative", "bookg_amt_nmrc", "v_cents", "bookg_amt_nmrc IS NULL"),
        ("currency_known", "acct_ccy", "v_currency", "acct_ccy IS NULL"),
        ("booked_gmt_present", "bookg_dt_tm_gmt", "v_gmt", "FALSE"),
        ("booked_cet_present", "bookg_dt_tm_cet", "v_cet", "FALSE"))])
_TYPED_CLEAN = """
SELECT booking_id, bookg_amt, bookg_amt_nmrc, kind FROM tflags
WHERE NOT (p_amount OR p_cents OR v_amount OR v_cents OR v_currency OR v_gmt OR v_cet)"""


def _fact_keys() -> str:
    return "SELECT amount_euro, currency_id, date_id, category_id, counterparty_id FROM g_fact"


ORACLE_SQL: dict[str, str] = {
    "scan_parquet": _q("SELECT * FROM bronze"),
    "scan_parquet_glob": _q("SELECT * FROM silver"),
    "scan_glob_differing_schemas": _q("""
SELECT booking_id, acct_ccy, bookg_amt, dtld_tx_tp,
       CASE booking_id % 3 WHEN 0 THEN bookg_amt WHEN 1 THEN CAST(CAST(bookg_amt AS FLOAT) AS DOUBLE) END AS weight,
       CASE WHEN booking_id % 3 <> 1 THEN ctpty_nm END AS ctpty_nm,
       CASE WHEN booking_id % 3 = 1 THEN 'web' END AS channel
FROM bronze"""),
    "scan_csv_roundtrip": _q("""
SELECT s.currency, s.amount_euro, s.payment_date, s.counterparty_country, s.counterparty_name,
       s.counterparty_add, s.category_code, c.category_name, c.co2_multiplier
FROM sta s LEFT JOIN categories c ON s.category_code = c.category_code"""),
    "scan_catalog_table": _q("SELECT * FROM sta"),
    "scan_temp_view": _q("SELECT currency, amount_euro, payment_date, category_code FROM sta"),
    "report_json_roundtrip": _q(_SUITE),
    "sink_parquet_overwrite": _q("SELECT * FROM silver"),
    "sink_table_overwrite": _q("SELECT * FROM cp_all"),
    "create_if_absent_twice": _q(f"SELECT {_CALENDAR_COLS}, date_id FROM g_calendar"),
    "staging_transactions": _q("SELECT * FROM sta"),
    "reorder_columns": _q("""
SELECT counterparty_add AS column_0, amount_euro AS column_1, currency AS column_2, payment_date AS column_3,
       counterparty_country AS column_4, counterparty_name AS column_5, category_code AS column_6 FROM sta"""),
    "typed_null_columns": _q("""
SELECT *, CAST(NULL AS VARCHAR) AS ctpty_adr_line2, CAST(NULL AS VARCHAR) AS rmt_inf_ustrd2,
       CAST(NULL AS VARCHAR) AS tx_tp FROM bronze"""),
    "payment_day": """
SELECT event_id, CAST(ts AS DATE) AS payment_day, strftime(ts, '%d-%m-%Y') AS day_text,
       CAST(ts AS DATE) AS day_parsed
FROM events""",
    "calendar_dim": _q(f"SELECT {_CALENDAR_COLS}, row_number() OVER (ORDER BY payment_date) AS stored_rank FROM cal_all"),
    "counterparty_distinct": _q("SELECT * FROM cp_all"),
    "counterparty_one_per_key": _q("SELECT * FROM cp_one_all"),
    "max_id_default_zero": _q("""
SELECT 'counter_party_dim' AS table_name, CAST(count(*) AS BIGINT) AS max_id FROM cp_one_all
UNION ALL SELECT 'transactions' AS table_name, CAST(0 AS BIGINT) AS max_id"""),
    "dense_ids_bucketed": _q("""
SELECT booking_id, 1000 + row_number() OVER (ORDER BY booking_id) AS payment_id
FROM (SELECT DISTINCT booking_id FROM silver)"""),
    "dense_ids_from_one": _q(f"""
SELECT {_CP_COLS}, CAST(row_number() OVER (ORDER BY counterparty_add NULLS FIRST) AS INTEGER) AS counterparty_id
FROM cp_one_all"""),
    "row_number_renumber": _q(f"""
SELECT {_CALENDAR_COLS}, CAST(row_number() OVER (ORDER BY payment_date) AS INTEGER) AS date_id FROM cal_all"""),
}


def _with_ctes(extra: str, select: str) -> str:
    """``extra`` starts with ", name AS (...)": CTEs appended to the shared list."""
    return f"WITH {BASE.strip()}\n{extra.strip()}\n{select.strip()}"


_REBUILT = f"""
, existing AS (SELECT {_CP_COLS}, 0 AS prio FROM cp_one_b1),
incoming AS (SELECT {_CP_COLS}, 1 AS prio FROM cp_all),
both_ AS (SELECT * FROM existing UNION ALL SELECT * FROM incoming),
one AS (SELECT {_CP_COLS} FROM both_
        QUALIFY row_number() OVER (PARTITION BY counterparty_add ORDER BY prio,
                counterparty_country NULLS FIRST, counterparty_name NULLS FIRST) = 1)"""
ORACLE_SQL["union_dedupe_by_key"] = _with_ctes(_REBUILT, f"""
SELECT {_CP_COLS}, CAST(row_number() OVER (ORDER BY counterparty_add NULLS FIRST) AS INTEGER) AS counterparty_id
FROM one""")

ORACLE_SQL["rebuild_rekeys_facts"] = _with_ctes(_REBUILT, """
SELECT s.amount_euro, r.counterparty_id, r.counterparty_add
FROM sta_b1 s LEFT JOIN (SELECT counterparty_add, CAST(row_number() OVER (ORDER BY counterparty_add NULLS FIRST) AS INTEGER) AS counterparty_id
                         FROM one) r ON s.counterparty_add = r.counterparty_add""")
ORACLE_SQL["exists_then_create_or_merge"] = _with_ctes(
    _CAL_TWO_RUNS, f"SELECT {_CALENDAR_COLS}, CAST(date_id AS INTEGER) AS date_id FROM t2")
ORACLE_SQL["insert_only_merge"] = ORACLE_SQL["exists_then_create_or_merge"]
ORACLE_SQL["dim_calendar"] = ORACLE_SQL["exists_then_create_or_merge"]
ORACLE_SQL["insert_only_merge_null_keys"] = _with_ctes(
    _cp_two_runs(null_safe=False), f"SELECT {_CP_COLS}, CAST(counterparty_id AS INTEGER) AS counterparty_id FROM t2")
ORACLE_SQL["dim_counterparty"] = _with_ctes(
    _cp_two_runs(null_safe=True), f"SELECT {_CP_COLS}, CAST(counterparty_id AS INTEGER) AS counterparty_id FROM t2")
ORACLE_SQL["insert_only_merge_dup_keys"] = _q(f"""
SELECT {_CP_COLS}, CAST(row_number() OVER (ORDER BY counterparty_add NULLS FIRST,
       counterparty_country NULLS FIRST, counterparty_name NULLS FIRST) AS INTEGER) AS counterparty_id
FROM cp_all""")

_STAR_CTES = """
, star AS (
  SELECT cat.category_name, cp.counterparty_country,
         CASE WHEN cur.currency <> 'EUR'
              THEN CAST(round(CAST(CAST(f.amount_euro * cur.conversion_rate AS VARCHAR) AS DECIMAL(38,15)), 3)
                        AS DOUBLE)
              ELSE f.amount_euro END AS amount_eur,
         cat.co2_multiplier
  FROM g_fact f
  LEFT JOIN g_currency cur ON f.currency_id = cur.currency_id
  JOIN g_category cat ON f.category_id = cat.category_id
  LEFT JOIN g_counterparty cp ON f.counterparty_id = cp.counterparty_id
),
e AS (SELECT *, CAST(round(CAST(CAST(amount_eur * co2_multiplier AS VARCHAR) AS DECIMAL(38,15)), 2)
                     AS DOUBLE) AS co2_emission_g FROM star)
"""
_STAR_SELECT = """
SELECT category_name, counterparty_country,
       CAST(format('{:.11e}', fsum(co2_emission_g) / count(co2_emission_g)) AS DOUBLE) AS mean_co2_emission_g,
       CAST(format('{:.11e}', fsum(co2_emission_g)) AS DOUBLE) AS total_co2_emission_g,
       CAST(format('{:.11e}', fsum(amount_eur)) AS DOUBLE) AS total_amount_eur,
       count(*) AS transactions
FROM e GROUP BY category_name, counterparty_country"""

ORACLE_SQL.update({
    "star_emission_by_category_country": _with_ctes(_STAR_CTES, _STAR_SELECT),
    "text_bronze_report": _with_ctes(_TEXT, _TEXT_REPORT),
    "text_bronze_clean": _with_ctes(_TEXT, _TEXT_CLEAN),
    "typed_bronze_report": _with_ctes(_TYPED, _TYPED_REPORT),
    "typed_bronze_clean": _with_ctes(_TYPED, _TYPED_CLEAN),
    "fact_lookup": _q("SELECT * FROM g_fact"),
    "fact_lookup_using_names": _q(_fact_keys()),
    "fact_append_twice": _q("SELECT * FROM g_fact UNION ALL SELECT * FROM g_fact"),
    "counterparty_lookup_salted": _q("""
SELECT s.counterparty_add, s.amount_euro, g.counterparty_id
FROM sta s LEFT JOIN g_counterparty g ON s.counterparty_add = g.counterparty_add"""),
    "counterparty_lookup_skewed": _q("""
SELECT s.counterparty_add, s.amount_euro, g.counterparty_id
FROM (SELECT amount_euro, CASE WHEN day(payment_date) % 3 = 0 THEN 'ADDR 2' ELSE counterparty_add END AS counterparty_add
      FROM sta) s LEFT JOIN g_counterparty g ON s.counterparty_add = g.counterparty_add"""),
    "gold_audit": _q("""
SELECT 'calendar_dim' AS table_name, count(*) AS row_count FROM g_calendar
UNION ALL SELECT 'currency_dim', count(*) FROM g_currency
UNION ALL SELECT 'category_dim', count(*) FROM g_category
UNION ALL SELECT 'counter_party_dim', count(*) FROM g_counterparty
UNION ALL SELECT 'transactions', count(*) FROM g_fact"""),
    "check_between_amount": _q(RULE_SQL["amount_not_negative"]),
    "check_between_cents": _q(RULE_SQL["amount_cents_not_negative"]),
    "check_in_set_currency": _q(RULE_SQL["currency_known"]),
    "check_not_null_gmt": _q(RULE_SQL["booked_gmt_present"]),
    "check_not_null_cet": _q(RULE_SQL["booked_cet_present"]),
    "check_in_set_category": _q(RULE_SQL["category_known"]),
    "suite_report": _q(_SUITE),
    "suite_success": _q(f"""
SELECT bool_and(success) AS success, count(*) AS rules, count(*) FILTER (WHERE NOT success) AS failed_rules
FROM ({_SUITE}) r"""),
    "silver_pass_report": _q(f"""
SELECT *, CASE WHEN element_count > 0 THEN CAST(missing_count AS DOUBLE) * 100.0 / element_count END AS missing_percent,
       CASE WHEN element_count > 0 THEN CAST(unexpected_count AS DOUBLE) * 100.0 / element_count END AS unexpected_percent_total,
       unexpected_percent AS unexpected_percent_nonmissing
FROM ({_SUITE}) r"""),
    "silver_pass_statistics": _q(f"""
SELECT count(*) AS evaluated_expectations, count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       CAST(count(*) FILTER (WHERE success) AS DOUBLE) * 100.0 / count(*) AS success_percent
FROM ({_SUITE}) r"""),
    "silver_and_quarantine": _q(f"""
SELECT CASE WHEN bad THEN 'quarantine' ELSE 'clean' END AS side, booking_id, acct_ccy, bookg_amt, bookg_dt_tm_cet,
       ctpty_adr_line1, CAST(NULL AS VARCHAR) AS ctpty_adr_line2, CASE WHEN bad THEN failed END AS failed_rules
FROM (SELECT *, {_FAILED} AS failed, v_amount OR v_cents OR v_currency OR v_gmt OR v_cet AS bad FROM flagged) x"""),
    "clean_rows": _q("SELECT * FROM silver"),
    "silver_from_report": _q("SELECT * FROM silver"),
    "silver_passing_unchanged": _q("""
SELECT booking_id, acct_ccy, bookg_amt, bookg_amt_nmrc, ctpty_nm, 'ref ' || booking_id AS rmt_inf_ustrd2,
       'purchase' AS tx_tp, ctpty_adr_line1 AS ctpty_adr_line2
FROM flagged WHERE NOT (v_amount OR v_cents OR v_currency OR v_gmt OR v_cet)"""),
    "money_extremes": """
SELECT l_orderkey, l_linenumber,
       CAST(round(CAST(CAST(l_extendedprice * 1e10 * (l_linenumber * 3.7e-8) AS VARCHAR) AS DECIMAL(38,15)), 3) AS DOUBLE) AS large_times_small,
       CAST(round(CAST(CAST(l_quantity * 1e5 * 4e-7 AS VARCHAR) AS DECIMAL(38,15)), 3) AS DOUBLE) AS small_rate,
       CAST(format('{:.11e}', fsum(l_quantity * 0.0004) OVER (PARTITION BY l_returnflag)) AS DOUBLE) AS fine_sum
FROM lineitem""",
    "exact_sum_cancelling": """
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 8 AS total, CAST(3 * count(*) AS BIGINT) AS n_values
FROM lineitem GROUP BY l_returnflag""",
    "quarantine_rows": _q(f"""
SELECT booking_id, acct_ccy, bookg_amt, bookg_amt_nmrc, bookg_dt_tm_cet, bookg_dt_tm_gmt, dtld_tx_tp,
       ctpty_nm, ctpty_ctry, ctpty_adr_line1, {_FAILED} AS failed_rules
FROM flagged WHERE v_amount OR v_cents OR v_currency OR v_gmt OR v_cet"""),
    "unexpected_values": _q("""
SELECT rule, "column", value, count(*) AS unexpected_n FROM (
  SELECT 'amount_not_negative' AS rule, 'bookg_amt' AS "column",
         CAST(bookg_amt AS VARCHAR) AS value FROM flagged WHERE v_amount
  UNION ALL
  SELECT 'amount_cents_not_negative', 'bookg_amt_nmrc', CAST(bookg_amt_nmrc AS VARCHAR)
  FROM flagged WHERE v_cents
  UNION ALL
  SELECT 'currency_known', 'acct_ccy', acct_ccy FROM flagged WHERE v_currency
  UNION ALL
  SELECT 'category_known', 'dtld_tx_tp', CAST(dtld_tx_tp AS VARCHAR) FROM flagged WHERE v_category
) h GROUP BY rule, "column", value"""),
    "to_euro": _q("SELECT * FROM euro"),
    "emission_per_row": _q("SELECT * FROM emission"),
    "emission_report": _q("SELECT * FROM report"),
    "emission_mean_by_category": _q("""
SELECT category_name,
       CAST(format('{:.11e}', fsum(co2_emission_g) / count(co2_emission_g)) AS DOUBLE) AS mean_co2_emission_g,
       CAST(format('{:.11e}', fsum(co2_emission_g)) AS DOUBLE) AS total_co2_emission_g,
       count(co2_emission_g) AS transactions
FROM report GROUP BY category_name"""),
    "emission_points": _q("SELECT amount_euro, co2_emission_g, category_name FROM report"),
    "stream_bronze_to_silver": _q("SELECT * FROM silver"),
    "first_n_ordered": _q(f"SELECT {_CALENDAR_COLS} FROM cal_all ORDER BY payment_date LIMIT 10"),
})
