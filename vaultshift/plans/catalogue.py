"""Registered queries (Spark) and their DuckDB oracles, over the fixture tables.

Every query reads ``orders`` and ``customer`` (the subscriber export and vault mapping are derived
from them, one subscriber per order) and runs the migration over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T
from vaultshift.operators import postal as P
from vaultshift.plans import oracle as O
from vaultshift.plans import report_queries
from vaultshift.plans.pipeline import ROW_ID, Migration, MigrationOptions, column_check
from vaultshift.plans.summary import validation_messages, validation_summary
from vaultshift.session import checkpoint_dir
from vaultshift.sources import csv_io as IO
from vaultshift.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]


def migration(spark: SparkSession, d: str, provider: str = "stripe", skewed: bool = False, **opts) -> Migration:
    """A run over the fixture tables as one lazy plan: what a query does not ask for is pruned from the
    scans up. Only a run with many sinks materialises (``run_to_directory``)."""
    return plain_migration(spark, d, provider, skewed, **opts)


# Hot-group threshold of the adversarial queries: the 30 % groups exceed it from sf0.01 upwards,
# so those runs take the salted-grid join and the broadcast semi-join.
SKEW_HOT_ROWS = 1000


def plain_migration(spark: SparkSession, d: str, provider: str = "stripe", skewed: bool = False,
                    **opts) -> Migration:
    if skewed:
        sub, mp = FX.skewed_subscribers(spark, d), FX.stripe_mapping(spark, d)
    elif provider == "bluesnap":
        sub, mp = FX.bluesnap_subscribers(spark, d), FX.bluesnap_mapping(spark, d)
    else:
        sub, mp = FX.subscribers(spark, d), FX.stripe_mapping(spark, d)
    sub = sub.withColumnRenamed("row_id", ROW_ID)
    return Migration(sub, mp, MigrationOptions(provider=provider, as_of=FX.FIXTURE_AS_OF, **opts))


def _rid(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(ROW_ID, "row_id")


# ---- scans ----------------------------------------------------------------------------------

def _roundtrip_dir(spark: SparkSession, name: str) -> str:
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/vaultshift-{name}-{uuid.uuid4().hex}"


def _subscriber_csv(spark: SparkSession, d: str) -> str:
    """The fixture export written as a real CSV file (``_`` for null, blanks quoted)."""
    path = _roundtrip_dir(spark, "subscribers")
    sub = FX.subscribers(spark, d).withColumn("row_id", F.col("row_id").cast("string"))
    IO.write_csv(sub, path, clean=False, null_value=K.SUBSCRIBER_NULL_TOKEN)
    return path


def _mapping_csv(spark: SparkSession, d: str) -> str:
    path = _roundtrip_dir(spark, "mapping")
    IO.write_csv(FX.stripe_mapping(spark, d), path, clean=False, null_value="", encoding="ISO-8859-1")
    return path


def q_scan_subscribers(spark, d):
    return IO.scan_subscribers(spark, _subscriber_csv(spark, d)).drop(ROW_ID)


def q_scan_mapping(spark, d):
    return IO.scan_mapping(spark, _mapping_csv(spark, d))


def q_record_counts(spark, d):
    s = IO.record_count(spark, _subscriber_csv(spark, d))
    m = IO.record_count(spark, _mapping_csv(spark, d), "ISO-8859-1")
    long = s.select(F.lit("subscriber_records").alias("k"), "n").unionByName(
        m.select(F.lit("mapping_records").alias("k"), "n"))
    return long.groupBy().pivot("k", ["subscriber_records", "mapping_records"]).agg(F.first("n").cast("long"))


def q_column_check(spark, d):
    sub = FX.subscribers(spark, d)
    info = column_check([c for c in sub.columns if c != "row_id"])
    return sub.agg(F.count(F.lit(1)).cast("long").alias("total_records")).select(
        F.lit(info["valid"]).alias("valid"),
        F.lit(",".join(info["missing_columns"])).alias("missing_columns"),
        F.lit(",".join(info["optional_columns"])).alias("optional_columns"),
        F.lit(info["total_columns"]).cast("long").alias("total_columns"),
        "total_records",
    )


def q_clean_for_csv(spark, d):
    mp = FX.stripe_mapping(spark, d)
    return mp.select(F.col("`card.id`").alias("card_id"),
                     T.clean_for_csv("card.address_zip").alias("zip_clean"),
                     T.clean_for_csv("card.number").alias("number_clean"))


def q_strip_fractional(spark, d):
    m = plain_migration(spark, d, strip_iso_date_fractional_suffix=True)
    return _rid(m.prepared_subscribers.select(ROW_ID, "current_period_started_at", "current_period_ends_at",
                                              "started_at"))


def q_normalize_quantity(spark, d):
    return _rid(plain_migration(spark, d).prepared_subscribers.select(ROW_ID, "quantity_1", "quantity_2"))


def q_layout_stripe(spark, d):
    return migration(spark, d).layout()


def q_layout_bluesnap(spark, d):
    return migration(spark, d, "bluesnap").layout()


def q_anonymise_email(spark, d):
    m = migration(spark, d, is_sandbox=True, anonymise_email=True)
    return m.layout().select(ROW_ID, "customer_email")


# ---- rules ----------------------------------------------------------------------------------

def _sub_rule(flag: str, *cols: str) -> Query:
    def run(spark, d):
        m = plain_migration(spark, d)
        return _rid(m.prepared_subscribers.where(F.col(flag)).select(ROW_ID, *cols))
    return run


q_rule_country_format = _sub_rule("_f_country", "address_country_code")
q_rule_unsupported_country = _sub_rule("_f_unsupported", "address_country_code")
q_rule_price_id = _sub_rule("_f_price", "price_id_1", "price_id_2")
q_rule_quantity = _sub_rule("_f_quantity", "quantity_1", "quantity_2")
q_rule_date_format = _sub_rule("_f_date_format", "current_period_started_at", "current_period_ends_at",
                               "started_at")
q_rule_date_period = _sub_rule("_f_date_period", "current_period_started_at", "current_period_ends_at")


def q_rule_card_token_length(spark, d):
    m = plain_migration(spark, d, "bluesnap", card_token_check=True)
    return _rid(m.prepared_subscribers.where(F.col("_f_card_token")).select(ROW_ID, "card_token"))


def _joined_rule(flag: str, after_email: bool, **opts) -> Query:
    def run(spark, d):
        m = migration(spark, d, **opts)
        df = m.completed if after_email else m.joined_all
        return _rid(df.where(F.col(flag)).select(
            ROW_ID, F.col("_key").alias("card_id"), "address_country_code",
            F.col("_postal_final").alias("address_postal_code"), F.col("_m_zip").alias("mapping_zip")))
    return run


q_rule_missing_postal = _joined_rule("_f_missing", False)
q_missing_postal_fillable = _joined_rule("_c_fillable", False)
q_rule_ca_postal = _joined_rule("_f_ca", True)
q_rule_us_postal = _joined_rule("_f_us", True)


def q_no_token(spark, d):
    m = migration(spark, d)
    return m.no_token.select(ROW_ID, "card_id", "card_token", "customer_email", "is_duplicate_token")


def _audit_scan(spark: SparkSession, d: str) -> DataFrame:
    """The fixture export as files in row order, scanned for the audit."""
    path = _roundtrip_dir(spark, "audit")
    sub = FX.subscribers(spark, d).repartitionByRange("row_id").sortWithinPartitions("row_id")
    IO.write_csv(sub.select("address_country_code", "address_postal_code"), path, clean=False, null_value=K.SUBSCRIBER_NULL_TOKEN)
    return IO.scan_audit(spark, path)


def q_postal_audit_issues(spark, d):
    """C17: whether the file has issues, and how many."""
    n = q_postal_audit(spark, d).agg(F.count(F.lit(1)).cast("long").alias("issues"))
    return n.select((F.col("issues") > 0).alias("has_issues"), "issues")


def q_postal_audit(spark, d):
    lined = _audit_scan(spark, d)
    kind, value, corrected = P.audit_issue(F.col("address_country_code"), F.col("address_postal_code"))
    return lined.select("line", value.alias("postalCode"), corrected.alias("correctedCode"),
                        kind.alias("type")).where(F.col("type").isNotNull())


# ---- join / duplicates ----------------------------------------------------------------------

_JOIN_COLS = ["card_token", "card_holder_name", "card_expiry_month", "card_expiry_year",
              "network_transaction_id", "customer_email", "is_duplicate_token"]


def q_join_stripe(spark, d):
    return migration(spark, d).layout().select(ROW_ID, "card_id", *_JOIN_COLS)


def q_join_bluesnap(spark, d):
    return migration(spark, d, "bluesnap").layout().select(ROW_ID, *_JOIN_COLS)


def q_duplicate_tokens(spark, d):
    return migration(spark, d).duplicate_tokens.select(ROW_ID, "card_id", "card_token")


def q_duplicate_card_ids(spark, d):
    return migration(spark, d).duplicate_card_ids.select(ROW_ID, "card_id", "card_token")


def q_duplicate_subscription_ids(spark, d):
    return migration(spark, d).duplicate_subscription_ids.select(
        ROW_ID, "subscription_external_id", "card_id", "card_token")


def q_duplicate_emails(spark, d):
    return migration(spark, d).duplicate_emails.select(
        ROW_ID, "customer_email", "enable_checkout", "address_postal_code", "vault_provider")


def q_duplicate_emails_surviving(spark, d):
    return migration(spark, d).duplicate_emails_surviving.select(ROW_ID, "customer_email")


# ---- fixes / outputs / summaries ------------------------------------------------------------

def q_fill_postal(spark, d):
    m = migration(spark, d, use_mapping_zip_codes=True)
    return _rid(m.joined_all.where(F.col("_c_filled")).select(
        ROW_ID, F.col("_key").alias("card_id"), "address_country_code", F.col("_m_zip").alias("mapping_zip"),
        F.col("_postal_filled").alias("address_postal_code")))


def q_us_postal_autocorrect(spark, d):
    m = migration(spark, d, autocorrect_us_zip=True)
    return _rid(m.completed.where(F.col("_c_autocorrected")).select(
        ROW_ID, F.col("_key").alias("card_id"), F.col("address_postal_code").alias("postal_before"),
        F.col("_postal_final").alias("postal_after")))


_FIX_NAMES = ["fillable_from_mapping", "pulled_from_mapping", "missing_postal", "available_from_mapping",
              "us_autocorrectable_before", "us_autocorrected", "us_postal", "us_autocorrectable"]


def q_fix_counts(spark, d):
    m = migration(spark, d, use_mapping_zip_codes=True, autocorrect_us_zip=True)
    return m.wide_metrics(_FIX_NAMES)


def q_failed_rows(spark, d):
    m = migration(spark, d)
    return _rid(m.completed.where(F.col("_row_failed") & F.col("_first")).select(ROW_ID))


def _final(provider: str, **opts) -> Query:
    def run(spark, d):
        df = migration(spark, d, provider, **opts).final_import
        return df.select(*[T.clean_for_csv(c).alias(c) for c in df.columns])
    return run


q_final_import_stripe = _final("stripe")
q_final_import_bluesnap = _final("bluesnap")
q_final_import_stripe_fixed = _final("stripe", use_mapping_zip_codes=True, autocorrect_us_zip=True,
                                     strip_iso_date_fractional_suffix=True)
q_final_import_bluesnap_fixed = _final("bluesnap", use_mapping_zip_codes=True, autocorrect_us_zip=True,
                                       strip_iso_date_fractional_suffix=True)


def q_validation_summary(spark, d):
    return validation_summary(migration(spark, d))


def q_validation_summary_bluesnap(spark, d):
    return validation_summary(migration(spark, d, "bluesnap"))


def q_validation_messages(spark, d):
    return validation_messages(migration(spark, d))


def q_run_summary_stripe(spark, d):
    return migration(spark, d).run_summary


def q_run_summary_bluesnap(spark, d):
    return migration(spark, d, "bluesnap").run_summary


def q_run_summary_bluesnap_fixed(spark, d):
    return migration(spark, d, "bluesnap", use_mapping_zip_codes=True, autocorrect_us_zip=True,
                     strip_iso_date_fractional_suffix=True).run_summary


def q_run_summary_stripe_fixed(spark, d):
    return migration(spark, d, use_mapping_zip_codes=True, autocorrect_us_zip=True,
                     strip_iso_date_fractional_suffix=True).run_summary


def q_run_summary_stripe_skewed(spark, d):
    return migration(spark, d, skewed=True, hot_rows=SKEW_HOT_ROWS).run_summary


def q_final_import_stripe_skewed(spark, d):
    df = migration(spark, d, skewed=True, hot_rows=SKEW_HOT_ROWS).final_import
    return df.select(*[T.clean_for_csv(c).alias(c) for c in df.columns])


def q_duplicate_emails_skewed(spark, d):
    return migration(spark, d, skewed=True, hot_rows=SKEW_HOT_ROWS).duplicate_emails.select(ROW_ID, "customer_email")


def q_duplicate_subscription_ids_skewed(spark, d):
    return migration(spark, d, skewed=True, hot_rows=SKEW_HOT_ROWS).duplicate_subscription_ids.select(
        ROW_ID, "subscription_external_id")


def q_no_token_skewed(spark, d):
    m = migration(spark, d, skewed=True, hot_rows=SKEW_HOT_ROWS)
    return m.no_token.select(ROW_ID, "card_id", "card_token", "customer_email", "is_duplicate_token")


def q_report_manifest(spark, d):
    """A whole run writes every non-empty report; the manifest lists them as they lie there."""
    from vaultshift.plans.run import run_to_directory
    out = _roundtrip_dir(spark, "reports")
    run_to_directory(plain_migration(spark, d, seller_name="Fixture Seller"), out, epoch=0)
    return IO.report_manifest(spark, out).drop("size")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in dict(globals()).items() if name.startswith("q_") and callable(fn)
} | report_queries.QUERIES


# ---- oracle SQL -----------------------------------------------------------------------------

def _with(body: str, **kw) -> str:
    return O.chain(**kw) + body


def _narrow_rule(flag: str, after_email: bool, **kw) -> str:
    src = "cr" if after_email else "jall"
    return _with(f"SELECT row_id, k AS card_id, address_country_code, postal_final AS address_postal_code, "
                 f"m_zip AS mapping_zip FROM {src} WHERE {flag}", **kw)


def _sub_rule_sql(flag: str, *cols: str, **kw) -> str:
    return _with(f"SELECT row_id, {', '.join(cols)} FROM s2 WHERE {flag}", **kw)


def _summary_sql(provider: str, **kw) -> str:
    stripe = provider == "stripe"
    body = f"""SELECT {O.q('Sandbox' if kw.pop('sandbox', False) else 'Production')} AS environment,
 (SELECT count(*) FROM {'bsub' if not stripe else 'sub'})::BIGINT AS total_input,
 (SELECT count(*) FROM {'bsub' if not stripe else 'sub'} WHERE card_token IS NULL AND {str(stripe).lower()})::BIGINT AS dropped_null_key,
 (SELECT count(*) FROM jall WHERE customer_email IS NULL)::BIGINT AS dropped_null_email,
 (SELECT count(*) FROM cr)::BIGINT AS joined_rows,
 (SELECT count(*) FROM cr WHERE NOT row_failed)::BIGINT AS success_count,
 (SELECT count(*) FROM cr WHERE f_no_token)::BIGINT AS no_tokens_count,
 (SELECT count(*) FROM cr WHERE is_duplicate_token)::BIGINT AS duplicate_tokens_count,
 {'(SELECT count(*) FROM cr WHERE dup_card_id)::BIGINT' if stripe else 'CAST(NULL AS BIGINT)'} AS duplicate_card_ids_count,
 (SELECT count(*) FROM cr WHERE dup_sid)::BIGINT AS duplicate_external_subscription_ids_count,
 (SELECT count(*) FROM cr WHERE dup_email)::BIGINT AS duplicate_emails_count,
 (SELECT count(*) FROM cr WHERE NOT row_failed)::BIGINT AS total_processed,
 (SELECT count(*) FROM cr WHERE row_failed)::BIGINT AS removed_rows,
 (SELECT count(DISTINCT row_id) FROM cr WHERE row_failed)::BIGINT AS failed_subscriber_rows"""
    return _with(body, provider=provider, **kw)


def _final_sql(provider: str, **kw) -> str:
    return _with(f"SELECT {O.layout_select(provider, helpers=False, cleaned=True)} FROM cr WHERE NOT row_failed",
                 provider=provider, **kw)


def _sub_cols(*cols):
    return ", ".join(O.q2(c) for c in cols)


def _manifest_sql() -> str:
    outputs = {"final_import": "cr WHERE NOT row_failed", "no_token_found": "cr WHERE f_no_token", "duplicate_tokens": "cr WHERE is_duplicate_token",
               "duplicate_external_subscription_ids": "cr WHERE dup_sid", "duplicate_emails": "cr WHERE dup_email", "duplicate_card_ids": "cr WHERE dup_card_id"}
    rules = {"invalid_address_country_codes": "s2 WHERE f_country", "invalid_price_ids": "s2 WHERE f_price OR f_quantity",
             "unsupported_countries": "s2 WHERE f_unsupported", "invalid_date_formats": "s2 WHERE f_date_format", "invalid_date_periods": "s2 WHERE f_period",
             "missing_zip_codes": "jall WHERE f_missing", "invalid_ca_zip_codes": "cr WHERE f_ca", "invalid_us_zip_codes": "cr WHERE f_us"}
    parts = [f"SELECT 'Fixture_Seller_stripe_{r}' AS name, count(*)::BIGINT AS rows FROM {src}" for r, src in outputs.items()]
    parts += [f"SELECT 'Fixture_Seller_{r}_production_0', count(*)::BIGINT FROM {src}" for r, src in rules.items()]
    return _with(f"SELECT name, 1::BIGINT AS files, rows FROM ({' UNION ALL '.join(parts)}) WHERE rows > 0")


def _token_sql(seed: str) -> str:
    """The permuted tokens of row_id in ``r``, one round a subquery."""
    widths = T.TOKEN_WIDTHS
    case = lambda of: "CASE " + " ".join(f"WHEN row_id < {36**w} THEN {of(w)}" for w in widths[:-1]) + f" ELSE {of(widths[-1])} END"
    sql = f"SELECT row_id, w, up, low, (row_id // low) AS hi, (row_id % low) AS lo FROM (SELECT row_id, {case(lambda w: w)} AS w, " \
          f"CAST({case(lambda w: 36 ** (w // 2 + 1))} AS BIGINT) AS up, CAST({case(lambda w: 36 ** (w // 2))} AS BIGINT) AS low FROM cr)"
    for k in range(T.TOKEN_ROUNDS):
        side = "lo" if k % 2 == 0 else "hi"
        drawn = f"CAST('0x' || substr(md5('{seed}:{k}:' || w || ':' || {side}), 1, 12) AS BIGINT)"
        new = f"(hi + {drawn}) % up AS hi, lo" if k % 2 == 0 else f"hi, (lo + {drawn}) % low AS lo"
        sql = f"SELECT row_id, w, up, low, {new} FROM ({sql})"
    return f"SELECT row_id AS _temp_row_id, '{K.ANON_EMAIL_PREFIX}' || lower(to_base(hi, 36, CAST(w // 2 + 1 AS INTEGER)) || to_base(lo, 36, CAST(w // 2 AS INTEGER))) " \
           f"|| '@{K.ANON_EMAIL_DEFAULT_DOMAIN}' AS customer_email FROM ({sql})"


def oracle() -> dict[str, str]:
    from vaultshift.plans.summary import oracle_validation_summary, oracle_validation_messages
    sub_all = ", ".join(
        ("CAST(row_id AS VARCHAR) AS row_id" if c == "row_id" else O.q2(c)) for c in O.SUB_COLUMNS)
    return {
        "scan_subscribers": _with(f"SELECT {sub_all} FROM sub"),
        "scan_mapping": _with("SELECT * FROM map"),
        "record_counts": _with("SELECT (SELECT count(*) FROM sub)::BIGINT AS subscriber_records, "
                               "(SELECT count(*) FROM map)::BIGINT AS mapping_records"),
        "column_check": _with("SELECT true AS valid, '' AS missing_columns, 'price_id_2,quantity_2' AS optional_columns, "
                              f"{len(O.SUB_COLUMNS) - 1}::BIGINT AS total_columns, count(*)::BIGINT AS total_records FROM sub"),
        "clean_for_csv": _with(f'SELECT "card.id" AS card_id, {O.clean(O.q2("card.address_zip"))} AS zip_clean, '
                               f'{O.clean(O.q2("card.number"))} AS number_clean FROM map'),
        "strip_fractional": _with("SELECT row_id, current_period_started_at, current_period_ends_at, started_at FROM s2",
                                  frac_fix=True),
        "normalize_quantity": _with("SELECT row_id, quantity_1, quantity_2 FROM s2"),
        "layout_stripe": _with(f"SELECT {O.layout_select('stripe')} FROM cr"),
        "layout_bluesnap": _with(f"SELECT {O.layout_select('bluesnap')} FROM cr", provider="bluesnap"),
        "report_manifest": _manifest_sql(),
        "anonymise_email": _with(_token_sql(MigrationOptions().anon_seed)),
        "rule_country_format": _sub_rule_sql("f_country", "address_country_code"),
        "rule_unsupported_country": _sub_rule_sql("f_unsupported", "address_country_code"),
        "rule_price_id": _sub_rule_sql("f_price", "price_id_1", "price_id_2"),
        "rule_quantity": _sub_rule_sql("f_quantity", "quantity_1", "quantity_2"),
        "rule_date_format": _sub_rule_sql("f_date_format", "current_period_started_at", "current_period_ends_at",
                                          "started_at"),
        "rule_date_period": _sub_rule_sql("f_period", "current_period_started_at", "current_period_ends_at"),
        "rule_card_token_length": _with(
            f"SELECT row_id, card_token FROM s2 WHERE card_token IS NOT NULL AND card_token <> '' "
            f"AND NOT {O.fm('card_token', '^[0-9]{13}$')}", provider="bluesnap"),
        "rule_missing_postal": _narrow_rule("f_missing", False),
        "missing_postal_fillable": _narrow_rule("c_fillable", False),
        "rule_ca_postal": _narrow_rule("f_ca", True),
        "rule_us_postal": _narrow_rule("f_us", True),
        "no_token": _with("SELECT row_id AS _temp_row_id, k AS card_id, m_token AS card_token, customer_email, "
                          "is_duplicate_token FROM cr WHERE f_no_token"),
        "postal_audit_issues": _with(
            "SELECT count(*) > 0 AS has_issues, count(*)::BIGINT AS issues FROM sub WHERE address_country_code = 'US' "
            f"AND address_postal_code <> '' AND NOT {O.fm(O.strip('address_postal_code'), '^[0-9]{5}$')}"),
        "postal_audit": _with(
            "SELECT line, postalCode, correctedCode, type FROM (SELECT row_number() OVER (ORDER BY row_id)::BIGINT AS line, "
            f"{O.strip('address_postal_code')} AS postalCode, "
            "address_country_code = 'US' AND address_postal_code IS NOT NULL AND address_postal_code <> '' AS audited, "
            f"CASE WHEN audited AND {O.fm(O.strip('address_postal_code'), '^[0-9]{4}$')} THEN 'missing_zero' "
            f"WHEN audited AND NOT {O.fm(O.strip('address_postal_code'), '^[0-9]{5}$')} THEN 'incorrect_format' END AS type, "
            "CASE WHEN type = 'missing_zero' THEN '0' || postalCode END AS correctedCode FROM sub) WHERE type IS NOT NULL"),
        "join_stripe": _with("SELECT row_id AS _temp_row_id, k AS card_id, m_token AS card_token, holder AS card_holder_name, "
                             "m_exp_month AS card_expiry_month, m_exp_year AS card_expiry_year, "
                             "m_ntx AS network_transaction_id, customer_email, is_duplicate_token FROM cr"),
        "join_bluesnap": _with("SELECT row_id AS _temp_row_id, m_token AS card_token, holder AS card_holder_name, "
                               "m_exp_month AS card_expiry_month, m_exp_year AS card_expiry_year, "
                               "m_ntx AS network_transaction_id, customer_email, is_duplicate_token FROM cr",
                               provider="bluesnap"),
        "duplicate_tokens": _with("SELECT row_id AS _temp_row_id, k AS card_id, m_token AS card_token FROM cr "
                                  "WHERE is_duplicate_token"),
        "duplicate_card_ids": _with("SELECT row_id AS _temp_row_id, k AS card_id, m_token AS card_token FROM cr "
                                    "WHERE dup_card_id"),
        "duplicate_subscription_ids": _with("SELECT row_id AS _temp_row_id, subscription_external_id, k AS card_id, "
                                            "m_token AS card_token FROM cr WHERE dup_sid"),
        "duplicate_emails": _with("SELECT row_id AS _temp_row_id, customer_email, enable_checkout, "
                                  "postal_filled AS address_postal_code, CAST(NULL AS VARCHAR) AS vault_provider "
                                  "FROM cr WHERE dup_email"),
        "duplicate_emails_surviving": _with("SELECT row_id AS _temp_row_id, customer_email FROM cr "
                                            "WHERE dup_email AND NOT row_failed"),
        "fill_postal": _with("SELECT row_id, k AS card_id, address_country_code, m_zip AS mapping_zip, "
                             "postal_filled AS address_postal_code FROM jall WHERE c_filled", fill=True),
        "us_postal_autocorrect": _with("SELECT row_id, k AS card_id, address_postal_code AS postal_before, "
                                       "postal_final AS postal_after FROM cr WHERE c_autocorrected", pad=True),
        "fix_counts": _with(
            "SELECT (SELECT count(*) FROM jall WHERE c_fillable)::BIGINT AS fillable_from_mapping, "
            "(SELECT count(*) FROM jall WHERE c_filled)::BIGINT AS pulled_from_mapping, "
            "(SELECT count(*) FROM jall WHERE f_missing)::BIGINT AS missing_postal, "
            f"(SELECT count(*) FROM jall WHERE f_missing AND NOT {O.empty('m_zip')})::BIGINT AS available_from_mapping, "
            "(SELECT count(*) FROM cr WHERE c_autocorrectable_before)::BIGINT AS us_autocorrectable_before, "
            "(SELECT count(*) FROM cr WHERE c_autocorrected)::BIGINT AS us_autocorrected, "
            "(SELECT count(*) FROM cr WHERE f_us)::BIGINT AS us_postal, "
            "(SELECT count(*) FROM cr WHERE c_autocorrectable)::BIGINT AS us_autocorrectable", fill=True, pad=True),
        "failed_rows": _with("SELECT DISTINCT row_id FROM cr WHERE row_failed"),
        "final_import_stripe": _final_sql("stripe"),
        "final_import_bluesnap": _final_sql("bluesnap"),
        "final_import_stripe_fixed": _final_sql("stripe", fill=True, pad=True, frac_fix=True),
        "final_import_bluesnap_fixed": _final_sql("bluesnap", fill=True, pad=True, frac_fix=True),
        "run_summary_bluesnap_fixed": _summary_sql("bluesnap", fill=True, pad=True, frac_fix=True),
        "validation_summary": oracle_validation_summary("stripe"),
        "validation_summary_bluesnap": oracle_validation_summary("bluesnap"),
        "validation_messages": oracle_validation_messages("stripe"),
        "run_summary_stripe": _summary_sql("stripe"),
        "run_summary_bluesnap": _summary_sql("bluesnap"),
        "run_summary_stripe_fixed": _summary_sql("stripe", fill=True, pad=True, frac_fix=True),
        "run_summary_stripe_skewed": _summary_sql("stripe", skewed=True),
        "final_import_stripe_skewed": _final_sql("stripe", skewed=True),
        "duplicate_emails_skewed": _with("SELECT row_id AS _temp_row_id, customer_email FROM cr WHERE dup_email",
                                         skewed=True),
        "duplicate_subscription_ids_skewed": _with("SELECT row_id AS _temp_row_id, subscription_external_id FROM cr "
                                                   "WHERE dup_sid", skewed=True),
        "no_token_skewed": _with("SELECT row_id AS _temp_row_id, k AS card_id, m_token AS card_token, customer_email, "
                                 "is_duplicate_token FROM cr WHERE f_no_token", skewed=True),
        **report_queries.oracle(),
    }
