"""Fixed values.

Everything in this module is a fixed value that has to stay exactly as it is
for results to agree with the bank-transaction pipeline this package
re-implements: the validation value sets, the currency rates, the raw column
names that staging drops and renames, and the excluded category. They are
listed plainly, in their natural order.
"""

from __future__ import annotations

# --- fixed values: validation value sets -----------------------------------
VALID_CURRENCIES: tuple[str, ...] = ("EUR", "USD", "GBP", "J", "CAD")

CATEGORY_CODES: tuple[int, ...] = (
    2222, 3333, 4111, 4112, 4121, 4131, 4511, 5411, 5420,
    5422, 5462, 5541, 5542, 5912, 6542, 6630, 7512,
)

# --- fixed values: currency conversion rates (currency, rate to euro) -------
CONVERSION_RATES: tuple[tuple[str, float], ...] = (
    ("USD", 0.85),
    ("GBP", 1.10),
    ("EUR", 1.00),
    ("J", 0.0062),
    ("CAD", 0.67),
)

# --- fixed values: emission report parameters -------------------------------
EXCLUDED_CATEGORY_NAME = "Aircarriers airlines not elsewhere classified"

# --- fixed values: raw (bronze) columns dropped by staging ------------------
RAW_DROP_COLUMNS: tuple[str, ...] = (
    "bal_aftr_bookg", "bal_aftr_bookg_nmrc", "bookg_cdt_dbt_ind",
    "bookg_dt_tm_gmt", "acct_id", "card_poi_id", "cdtr_schme_id",
    "ctpty_acct_id_iban", "ctpty_acct_id_bban", "ctpty_acct_ccy",
    "ctpty_adr_line2", "ctpty_agt_bic", "ntry_seq_nb", "rmt_inf_ustrd1",
    "rmt_inf_ustrd2", "tx_acct_svcr_ref", "tx_tp", "year_month",
    "end_to_end_id", "booking_id", "bookg_amt_nmrc",
)

# --- fixed values: raw to staging column names ------------------------------
# The pairs whose source is also in RAW_DROP_COLUMNS (booking_id,
# bookg_amt_nmrc) never apply: those columns are gone before the rename.
RAW_RENAMES: tuple[tuple[str, str], ...] = (
    ("acct_ccy", "currency"),
    ("bookg_amt", "amount_euro"),
    ("bookg_amt_nmrc", "amount_cent"),
    ("bookg_dt_tm_cet", "payment_date"),
    ("booking_id", "payment_id"),
    ("ctpty_ctry", "counterparty_country"),
    ("ctpty_nm", "counterparty_name"),
    ("dtld_tx_tp", "category_code"),
    ("ctpty_adr_line1", "counterparty_add"),
)

# --- fixed values: raw columns blanked (typed NULL strings) when cleaning ---
BLANKED_COLUMNS: tuple[str, ...] = ("ctpty_adr_line2", "rmt_inf_ustrd2", "tx_tp")

# --- fixed values: day format used for the payment-day round trip -----------
DAY_FORMAT = "dd-MM-yyyy"
