"""DuckDB text of the migration, written the brute-force way, for the correctness gate.

The Spark plan derives removal and duplicate flags from per-key statistics; this SQL does what the
definition says instead — window counts over the joined rows and ``bool_or`` over every joined row
of a subscriber row — so agreement between the two is a real check of the decomposition.
Fixture inputs only contain ASCII spaces, so ``\\s`` (RE2) stands in for Python's strip set here.
"""

from __future__ import annotations

from vaultshift import constants as K
from vaultshift.sources import fixtures as FX


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^\\s+', ''), '\\s+$', '')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR lower({strip(x)}) IN ('nan', 'none', 'nat', ''))"


def norm(x: str) -> str:
    return f"(CASE WHEN {blank(x)} THEN '' ELSE {strip(x)} END)"


def empty(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def fm(x: str, pattern: str) -> str:
    return f"coalesce(regexp_full_match({x}, {q(pattern)}), false)"


def inlist(x: str, values) -> str:
    return f"coalesce({x} IN ({', '.join(q(v) for v in values)}), false)"


def na(x: str) -> str:
    return f"(CASE WHEN {x} IN ({', '.join(q(v) for v in K.MAPPING_NA_TOKENS)}) THEN NULL ELSE {x} END)"


def clean(x: str) -> str:
    return f"regexp_replace(CASE WHEN {x} = 'nan' THEN '' ELSE coalesce(CAST({x} AS VARCHAR), '') END, '\\.0$', '')"


_FLOAT = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def qnorm(x: str) -> str:
    s = strip(x)
    d = f"try_cast({s} AS DOUBLE)"
    return (
        f"(CASE WHEN {x} IS NULL THEN {x} "
        f"WHEN lower({s}) IN ('nan', 'none', 'nat', '') THEN {x} "
        f"WHEN regexp_full_match({s}, '[0-9]+') THEN {s} "
        f"WHEN regexp_full_match({s}, {q(_FLOAT)}) AND {d} >= 0 AND {d} = round({d}) "
        f"THEN CAST(CAST({d} AS DECIMAL(38,0)) AS VARCHAR) ELSE {x} END)"
    )


def frac(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN NOT {blank(x)} AND {fm(s, K.ISO_Z_FRACTIONAL_PATTERN)} "
            f"THEN regexp_replace({s}, '\\.[0-9]+Z$', 'Z') ELSE {x} END)")


def parse(x: str) -> str:
    return f"(CASE WHEN {fm(x, K.ISO_Z_PATTERN)} THEN try_strptime({x}, '%Y-%m-%dT%H:%M:%SZ') END)"


AS_OF = "TIMESTAMP '1998-06-15 00:00:00'"

SUB_COLUMNS = [c for c, _ in [("row_id", 0)]] + list(K.REQUIRED_SUBSCRIBER_COLUMNS) + ["price_id_2", "quantity_2"]


def chain(provider: str = "stripe", fill: bool = False, pad: bool = False, frac_fix: bool = False,
          skewed: bool = False) -> str:
    """WITH-clause text ending in ``cr``: post-email joined rows with every flag and roll-up."""
    bs = provider == "bluesnap"
    sub_src = "bsub" if bs else ("ssub" if skewed else "sub")
    fixes = [f"{qnorm('quantity_1')} AS quantity_1", f"{qnorm('quantity_2')} AS quantity_2"]
    if frac_fix:
        fixes += [f"{frac(c)} AS {c}" for c in K.DATE_COLUMNS_WITH_FRACTION_FIX]
    cps, cpe = "current_period_started_at", "current_period_ends_at"
    iso = K.ISO_Z_PATTERN
    if bs:
        m_sel = (
            f"{na(q2('BlueSnap Account Id'))} || right({na(q2('Credit Card Number'))}, 4) AS m_key, "
            f"{na(q2('Credit Card Number'))} AS m_token, "
            f"{strip(na(q2('First Name')))} || ' ' || {strip(na(q2('Last Name')))} AS m_holder, "
            f"{na(q2('Expiration Month'))} AS m_exp_month, {na(q2('Expiration Year'))} AS m_exp_year, "
            f"{na(q2('Network Transaction Id'))} AS m_ntx, {na(q2('Zip Code'))} AS m_zip FROM bmap"
        )
        key = "coalesce(card_token, 'nan')"
        key_filter = ""
        holder = "m_holder"
    else:
        m_sel = (
            f"{na(q2('card.id'))} AS m_key, {na(q2('card.number'))} AS m_token, "
            f"{na(q2('card.name'))} AS m_holder, {na(q2('card.exp_month'))} AS m_exp_month, "
            f"{na(q2('card.exp_year'))} AS m_exp_year, {na(q2('card.transaction_ids'))} AS m_ntx, "
            f"{na(q2('card.address_zip'))} AS m_zip FROM map"
        )
        key = "card_token"
        key_filter = "WHERE card_token IS NOT NULL"
        holder = "coalesce(m_holder, customer_full_name)"
    cleaned = clean("m_zip")
    v0 = strip(cleaned)
    fill_expr = (
        f"CASE WHEN {v0} <> '' THEN (CASE WHEN address_country_code = 'US' THEN "
        f"(CASE WHEN regexp_replace(f_head, '[^0-9]', '', 'g') <> '' THEN regexp_replace(f_head, '[^0-9]', '', 'g') "
        f"ELSE f_head END) ELSE f_v END) END"
    )
    return f"""WITH sub AS ({FX.duck_sub_sql()}),
bsub AS ({FX.duck_bsub_sql()}),
ssub AS ({FX.duck_ssub_sql()}),
map AS ({FX.duck_map_sql()}),
bmap AS ({FX.duck_bmap_sql()}),
s0 AS (SELECT * REPLACE ({', '.join(fixes)}) FROM {sub_src}),
s1 AS (SELECT *,
  NOT (NOT {blank('address_country_code')} AND {fm(strip('address_country_code'), r'^\p{L}{2}$')}) AS f_country,
  ({norm('price_id_1')} = '' OR NOT starts_with({norm('price_id_1')}, 'pri_'))
    OR NOT ({norm('price_id_2')} = '' OR starts_with({norm('price_id_2')}, 'pri_')) AS f_price,
  ({norm('price_id_1')} <> '' AND NOT {fm(norm('quantity_1'), '^[0-9]+$')})
    OR ({norm('price_id_2')} <> '' AND NOT {fm(norm('quantity_2'), '^[0-9]+$')}) AS f_quantity,
  {inlist('address_country_code', K.UNSUPPORTED_COUNTRIES)} AS f_unsupported,
  NOT (NOT {blank(cps)} AND {fm(cps, iso)}) OR NOT (NOT {blank(cpe)} AND {fm(cpe, iso)})
    OR (NOT {blank('started_at')} AND NOT {fm(strip('started_at'), iso)})
    OR (NOT {blank('paused_at')} AND NOT {fm(strip('paused_at'), iso)}) AS f_date_format,
  {parse(cps)} AS t_start, {parse(cpe)} AS t_end
  FROM s0),
s2 AS (SELECT *, (t_start IS NOT NULL AND t_end IS NOT NULL) AS p_period,
  coalesce(t_start IS NOT NULL AND t_end IS NOT NULL AND (t_start > {AS_OF} OR t_end < {AS_OF}), false) AS f_period
  FROM s1),
s AS (SELECT *, f_country OR f_price OR f_quantity OR f_unsupported OR f_date_format OR f_period AS s_failed,
  {key} AS k FROM s2 {key_filter}),
m AS (SELECT * FROM (SELECT {m_sel}) WHERE m_key IS NOT NULL),
j0 AS (SELECT s.*, m.*, count(*) OVER (PARTITION BY s.k) > 1 AS is_duplicate_token,
  {holder} AS holder
  FROM s LEFT JOIN m ON s.k = m.m_key),
j1 AS (SELECT *,
  {inlist('address_country_code', K.POSTAL_REQUIRED_COUNTRIES)} AS p_missing,
  p_missing AND {empty('address_postal_code')} AS f_missing_before,
  f_missing_before AND NOT {empty('m_zip')} AS c_fillable,
  CASE WHEN {v0} LIKE '%.0' THEN regexp_replace({v0}, '\\.0$', '') ELSE {v0} END AS f_v,
  CASE WHEN strpos(f_v, '-') > 0 THEN split_part(f_v, '-', 1) ELSE f_v END AS f_head,
  {fill_expr if fill else 'NULL'} AS fill_value,
  f_missing_before AND fill_value IS NOT NULL AS c_filled,
  CASE WHEN c_filled THEN fill_value ELSE address_postal_code END AS postal_filled,
  p_missing AND {empty('postal_filled')} AS f_missing
  FROM j0),
c0 AS (SELECT *,
  coalesce(upper({strip('address_country_code')}) = 'CA', false) AS ca_rows,
  ca_rows AND NOT {empty('postal_filled')} AS p_ca,
  p_ca AND NOT {fm("regexp_replace(upper(" + strip('postal_filled') + "), '\\s+', ' ', 'g')", '(?i)' + K.CA_POSTAL_PATTERN)} AS f_ca,
  coalesce(address_country_code = 'US', false) AS us_rows,
  coalesce({strip('postal_filled')}, '') AS us_norm0,
  us_rows AND us_norm0 <> '' AND {fm('us_norm0', '^[0-9]{4}$')} AS c_autocorrectable_before,
  {'us_rows AND ' + fm('us_norm0', '^[0-9]{4}$') if pad else 'false'} AS c_autocorrected,
  CASE WHEN c_autocorrected THEN lpad(us_norm0, 5, '0') ELSE postal_filled END AS postal_final,
  coalesce({strip('postal_final')}, '') AS us_norm,
  us_rows AND us_norm <> '' AS p_us,
  p_us AND NOT {fm('us_norm', '^[0-9]{5}$')} AS f_us,
  p_us AND {fm('us_norm', '^[0-9]{4}$')} AS c_autocorrectable,
  m_token IS NULL AS f_no_token
  FROM j1),
c1 AS (SELECT *, s_failed OR f_missing OR f_ca OR f_us OR f_no_token AS j_failed FROM c0),
jall AS (SELECT *, bool_or(j_failed) OVER (PARTITION BY row_id) AS row_failed FROM c1),
cr AS (SELECT *,
  count(*) OVER (PARTITION BY subscription_external_id) > 1 AS dup_sid,
  count(*) OVER (PARTITION BY customer_email) > 1 AS dup_email,
  count(*) OVER (PARTITION BY k) > 1 AS dup_card_id
  FROM jall WHERE customer_email IS NOT NULL)
"""


def q2(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def layout_select(provider: str, stage: str = "final", helpers: bool = True, cleaned: bool = False) -> str:
    """SELECT list of the import layout over ``cr``."""
    bs = provider == "bluesnap"
    head = K.BLUESNAP_LAYOUT_HEAD if bs else K.STRIPE_LAYOUT_HEAD
    cols = list(head) + ["subscription_custom_data_key_1", "subscription_custom_data_value_1",
                         "price_id_1", "quantity_1", "price_id_2", "quantity_2", "vault_provider"]
    src = {
        "card_expiry_month": "m_exp_month", "card_expiry_year": "m_exp_year", "card_holder_name": "holder",
        "card_token": "m_token", "network_transaction_id": "m_ntx",
        "address_postal_code": "postal_final" if stage == "final" else "postal_filled",
        "vault_provider": "'tokenex'" if stage == "final" else "CAST(NULL AS VARCHAR)",
        "enable_checkout": "upper(enable_checkout)" if stage == "final" else "enable_checkout",
    }
    if not bs:
        src["card_id"] = "k"
        src["card.address_zip"] = "m_zip"
        for c in K.STRIPE_MAPPING_PASSTHROUGH:
            src.setdefault(c, "CAST(NULL AS VARCHAR)")
    out = []
    for c in cols:
        e = src.get(c, q2(c))
        e = f"CAST({e} AS VARCHAR)"
        if cleaned:
            e = clean(e)
        out.append(f"{e} AS {q2(c)}")
    if helpers:
        out += ["is_duplicate_token", "row_id AS _temp_row_id"]
    return ", ".join(out)
