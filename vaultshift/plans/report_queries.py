"""Queries over written files: scans of exports that differ in shape, and every report and output of a
run as it reads back from its CSV. Their oracles are written by hand over the oracle chain.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T
from vaultshift.operators import postal as P
from vaultshift.operators import rules as R
from vaultshift.plans import oracle as O
from vaultshift.plans import run as RUN
from vaultshift.plans.pipeline import ROW_ID, Migration, MigrationOptions
from vaultshift.plans.summary import validation_envelope, validation_summary, validation_verdict
from vaultshift.session import checkpoint_dir
from vaultshift.sources import csv_io as IO
from vaultshift.sources import fixtures as FX


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/vaultshift-{name}-{uuid.uuid4().hex}"


def _run(spark: SparkSession, d: str, provider: str = "stripe", **opts) -> Migration:
    sub = FX.bluesnap_subscribers(spark, d) if provider == "bluesnap" else FX.subscribers(spark, d)
    mp = FX.bluesnap_mapping(spark, d) if provider == "bluesnap" else FX.stripe_mapping(spark, d)
    return Migration(sub.withColumnRenamed("row_id", ROW_ID), mp, MigrationOptions(provider=provider, as_of=FX.FIXTURE_AS_OF, **opts))


def _read_back(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = _folder(spark, name)
    IO.write_csv(df, path)
    back = IO._scan(spark, path, multi_line=True)
    return back.select(*[F.coalesce(T.col_of(c), F.lit("")).alias(c) for c in back.columns])


# ---- scans ------------------------------------------------------------------------------------

def scan_subscribers_multi_file(spark: SparkSession, d: str) -> DataFrame:
    """One export in two folders whose files order their columns differently."""
    root = _folder(spark, "multi")
    sub = FX.subscribers(spark, d).withColumn("row_id", F.col("row_id").cast("string"))
    cols = [T.col_of(c) for c in sub.columns]
    odd = F.col("row_id").cast("long") % 2 == 1
    for part, columns, name in ((sub.where(odd), cols, "a"), (sub.where(~odd), cols[::-1], "b")):
        IO.write_csv(part.select(*columns), f"{root}/{name}", clean=False, null_value=K.SUBSCRIBER_NULL_TOKEN)
    return IO.scan_subscribers(spark, f"{root}/*").drop(ROW_ID)


_BREAK = "CASE WHEN {0} % 7 = 0 THEN concat({1}, {2}, 'line, \"two\"') ELSE {1} END"


def scan_quoted_newline(spark: SparkSession, d: str) -> DataFrame:
    """Cells with line breaks, commas and quotes survive a written export."""
    sub = FX.subscribers(spark, d)
    sub = sub.withColumn("customer_full_name", F.expr(_BREAK.format("row_id", "customer_full_name", "char(10)")))
    path = _folder(spark, "newline")
    IO.write_csv(sub.withColumn("row_id", F.col("row_id").cast("string")), path, clean=False, null_value=K.SUBSCRIBER_NULL_TOKEN)
    return IO.scan_subscribers(spark, path).select("row_id", "customer_full_name", "customer_email", "address_postal_code")


# ---- edge cells -------------------------------------------------------------------------------

#: Quantity cells and what they normalise to.
QUANTITY_CELLS = (("1e40", "10000000000000000303786028427003666890752"), ("1e23", "99999999999999991611392"), ("1_000", "1000"),
                  ("9223372036854775808.0", "9223372036854775808"), ("1__0", "1__0"), ("+2", "2"), ("1e400", "1e400"), ("-1", "-1"),
                  ("0.0", "0"), ("2d", "2d"), ("2.5", "2.5"), ("123456789012345678901234567890123456789012", "123456789012345678901234567890123456789012"))
#: Tails of a date cell, and whether the cell still has the date shape.
DATE_TAILS = (("", True), ("\n", True), ("\r", False), ("\r\n", False), ("\u0085", False), (" ", False), (" ", False), ("\n\n", False))


def _cell(values, key: str = "o_orderkey"):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def quantity_edges(spark: SparkSession, d: str) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey")
    cells = orders.select("o_orderkey", F.lit("pri_1").alias("price_id_1"), _cell([c for c, _ in QUANTITY_CELLS]).alias("quantity_1"))
    cells = cells.withColumn("quantity_1", T.normalize_quantity("quantity_1"))
    return cells.select(F.col("o_orderkey").alias("row_id"), "quantity_1", R.quantities(set(cells.columns)).fails.alias("fails"))


def date_edges(spark: SparkSession, d: str) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey")
    date = F.concat(F.lit("2025-01-01T00:00:00Z"), _cell([t for t, _ in DATE_TAILS]))
    cells = orders.select("o_orderkey", date.alias("current_period_started_at"), F.lit("2026-01-01T00:00:00Z").alias("current_period_ends_at"))
    return cells.select(F.col("o_orderkey").alias("row_id"), R.date_format(set(cells.columns)).fails.alias("fails"))


# ---- reports and outputs ----------------------------------------------------------------------

def _subscriber_report(report: str, provider: str = "stripe", **opts):
    def run(spark, d):
        return _read_back(spark, RUN.subscriber_report(_run(spark, d, provider, **opts), report), report)
    return run


def _joined_report(report: str, **opts):
    def run(spark, d):
        return _read_back(spark, RUN.joined_report(_run(spark, d, **opts), report), report)
    return run


def _output(report: str, provider: str = "stripe"):
    def run(spark, d):
        return _read_back(spark, getattr(_run(spark, d, provider), RUN.OUTPUTS[report][0]), report)
    return run


def final_import_key_order(spark: SparkSession, d: str) -> DataFrame:
    """H2: the final import written in key order and read back: each record's place over all files, its key and row."""
    path = _folder(spark, "ordered")
    IO.write_csv(_run(spark, d).final_import_in_order(8, helpers=True), path)
    back = IO._scan(spark, path, multi_line=True, numbered=True)
    email = F.coalesce("customer_email", F.lit("")).alias("customer_email")
    return back.select("line", "card_key", F.col(ROW_ID).cast("long").alias("row_id"), email)


def null_key_filter(spark: SparkSession, d: str) -> DataFrame:
    """Subscriber rows without a card key reach no joined row and are counted as dropped."""
    m = _run(spark, d)
    subs = m.subscribers.withColumn("card_token", F.when(F.col(ROW_ID) % 13 != 0, F.col("card_token")))
    m = Migration(subs, m.mapping, m.options)
    kept = m.joined_all.agg(F.count_distinct(ROW_ID).alias("v")).select(F.lit("joined_subscribers").alias("metric"), F.col("v").alias("value"))
    return m.metric_rows(["n_subscribers", "dropped_null_key"]).unionByName(kept)


def step_errors(spark: SparkSession, d: str) -> DataFrame:
    """The steps of an export that lacks a period column, and of one whose dates never parse."""
    m = _run(spark, d)
    cases = {"no_column": m.subscribers.drop("current_period_ends_at"),
             "no_date": m.subscribers.withColumn("current_period_started_at", F.concat(F.lit("on "), "current_period_started_at"))}
    cols = ["step", "valid", "incorrect_count", "total_records", "missing_columns", "report", "error"]
    out = [validation_envelope(Migration(subs, m.mapping, m.options)).where(F.col("step").isin(K.STEP_COLUMNS, K.STEP_DATE_FORMAT, K.STEP_DATE_PERIOD))
           .select(F.lit(case).alias("export"), *cols) for case, subs in cases.items()]
    return out[0].unionByName(out[1])


#: Audit columns by what their cells are inferred to be: all whole numbers, numbers and blanks, and text.
AUDIT_CELLS = {"int": "CASE WHEN row_id % 3 = 0 THEN '02134' WHEN row_id % 3 = 1 THEN ' 90210 ' ELSE '501' END",
               "float": "CASE WHEN row_id % 4 = 0 THEN '02134' WHEN row_id % 4 = 1 THEN '90210' WHEN row_id % 4 = 2 THEN 'NA' ELSE '' END",
               "text": "CASE WHEN row_id % 4 = 0 THEN '02134' WHEN row_id % 4 = 1 THEN '2134' WHEN row_id % 4 = 2 THEN '' ELSE 'A-1' END"}


def postal_audit_inferred(spark: SparkSession, d: str) -> DataFrame:
    """C17 with inferred columns: three files that differ in one kind of cell."""
    parts = []
    for kind, cells in AUDIT_CELLS.items():
        path = _folder(spark, f"audit-{kind}")
        sub = FX.subscribers(spark, d).select("row_id", "address_country_code", F.expr(cells).alias("address_postal_code"))
        sub = sub.repartitionByRange("row_id").sortWithinPartitions("row_id")
        IO.write_csv(sub.select("address_country_code", "address_postal_code"), path, clean=False, null_value=K.SUBSCRIBER_NULL_TOKEN)
        found = P.inferred(IO.scan_audit(spark, path), "address_postal_code")
        issue, value, corrected = P.audit_issue(F.col("address_country_code"), F.col("address_postal_code"))
        parts.append(found.select(F.lit(kind).alias("kind"), "line", value.alias("postalCode"), corrected.alias("correctedCode"), issue.alias("type")).where("type is not null"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def user_rules() -> tuple[R.UserRule, ...]:
    """Rules of each stage, added by a caller: customers whose name ends in an even digit do not migrate, nor do
    subscriptions whose card expires before 2028 (of those with a card); long emails are only reported."""
    return (
        R.UserRule("customer_name", R.SUBSCRIBER, F.col("customer_full_name").rlike("[02468]$")),
        R.UserRule("card_expiry", R.JOINED, F.col("_m_exp_year") < "2028", F.col("_m_token").isNotNull()),
        R.UserRule("long_email", R.SUBSCRIBER, F.length("customer_email") > 18, F.col("customer_email") != "", removes=False),
    )


def _user_run(spark: SparkSession, d: str) -> Migration:
    m = _run(spark, d)
    return Migration(m.subscribers, m.mapping, m.options, user_rules())


def user_rules_summary(spark: SparkSession, d: str) -> DataFrame:
    steps = validation_summary(_user_run(spark, d)).where(F.col("step").isin([r.step for r in user_rules()] + [K.STEP_SUCCESS]))
    return steps.select("step", "valid", "incorrect_count", "total_records", "count")


def user_rules_final_import(spark: SparkSession, d: str) -> DataFrame:
    m = _user_run(spark, d)
    return m.completed.where(~F.col("_row_failed")).select(F.col(ROW_ID).alias("row_id"), F.col("_key").alias("card_id"))


def user_rules_report(spark: SparkSession, d: str) -> DataFrame:
    return _read_back(spark, RUN.joined_report(_user_run(spark, d), "card_expiry"), "card_expiry")


def run_verdict(spark: SparkSession, d: str) -> DataFrame:
    return validation_verdict(_run(spark, d))


def run_envelope(spark: SparkSession, d: str) -> DataFrame:
    return validation_envelope(_run(spark, d, autocorrect_us_zip=True))


QUERIES = {
    "scan_subscribers_multi_file": scan_subscribers_multi_file,
    "scan_quoted_newline": scan_quoted_newline,
    "quantity_edges": quantity_edges,
    "date_edges": date_edges,
    "null_key_filter": null_key_filter,
    "step_errors": step_errors,
    "postal_audit_inferred": postal_audit_inferred,
    "user_rules_summary": user_rules_summary,
    "user_rules_final_import": user_rules_final_import,
    "final_import_key_order": final_import_key_order,
    "report_card_expiry": user_rules_report,
    "validation_verdict": run_verdict,
    "validation_envelope": run_envelope,
    **{f"report_{r}": _subscriber_report(r) for r in RUN.SUBSCRIBER_REPORTS if r != K.REPORT_CARD_TOKEN_LENGTH},
    f"report_{K.REPORT_CARD_TOKEN_LENGTH}": _subscriber_report(K.REPORT_CARD_TOKEN_LENGTH, "bluesnap", card_token_check=True),
    **{f"report_{r}": _joined_report(r) for r in RUN.JOINED_REPORTS},
    **{f"output_{r}": _output(r) for r in RUN.OUTPUTS},
    f"output_{K.REPORT_FINAL_IMPORT}_bluesnap": _output(K.REPORT_FINAL_IMPORT, "bluesnap"),
}


# ---- oracles ----------------------------------------------------------------------------------

def _sub_text(extra: str = "") -> str:
    cols = [f"{O.clean(O.q2(c))} AS {O.q2(c)}" for c in O.SUB_COLUMNS if c != "row_id"]
    return ", ".join(cols) + f", {extra}CAST(row_id AS VARCHAR) AS {ROW_ID}"


_FLAG = ", CASE WHEN is_duplicate_token THEN 'True' ELSE 'False' END AS is_duplicate_token"
_ID = f", CAST(row_id AS VARCHAR) AS {ROW_ID}"


def _layout_text(where: str, stage: str = "final", flag: str = _FLAG, rid: str = _ID, provider: str = "stripe") -> str:
    return O.chain(provider) + f"SELECT {O.layout_select(provider, stage, helpers=False, cleaned=True)}{flag}{rid} FROM cr WHERE {where}"


def _literal(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _cells_sql(rows: list[tuple], names: str, select: str) -> str:
    values = ", ".join("(" + ", ".join(map(_literal, (i, *r))) + ")" for i, r in enumerate(rows))
    return f"SELECT o_orderkey AS row_id, {select} FROM orders JOIN (VALUES {values}) AS v({names}) ON o_orderkey % {len(rows)} = v.i"


def _verdict_sql() -> str:
    from vaultshift.plans.summary import _metrics_cte
    failing = ("country_format > 0", "price_id > 0", "unsupported_country > 0", "date_format > 0", "date_period_population = 0 OR date_period > 0",
               "missing_postal > 0", "ca_postal > 0", "us_postal > 0", "no_token > 0")
    total = " + ".join(f"CAST(({f}) AS INT)" for f in failing)
    return O.chain() + _metrics_cte("stripe") + (
        f"SELECT CAST({total} AS BIGINT) AS failed_count, CASE WHEN {total} > 0 THEN 'Validation failures detected' END AS error FROM w")


def _envelope_sql() -> str:
    from vaultshift.plans.summary import _metrics_cte
    n = "CAST(NULL AS BIGINT)"
    t = "CAST(NULL AS VARCHAR)"
    rows = []

    def row(order, step, valid="true", kind=t, incorrect=n, total=n, count=n, missing=t, optional=t, columns=n, report=t, message=t, when="true"):
        rows.append(f"SELECT {order} AS step_order, '{step}' AS step, {valid} AS valid, {kind} AS type, CAST({incorrect} AS BIGINT) AS incorrect_count, "
                    f"CAST({total} AS BIGINT) AS total_records, CAST({count} AS BIGINT) AS count, {missing} AS missing_columns, {optional} AS optional_columns, "
                    f"CAST({columns} AS BIGINT) AS total_columns, {report} AS report, {message} AS message, {t} AS error FROM w WHERE {when}")

    def rule(order, step, metric, total, report, valid=None):
        ok = valid or f"{metric} = 0"
        row(order, step, f"({ok})", incorrect=metric, total=total, report=f"CASE WHEN NOT ({ok}) THEN {report} END")

    def warning(order, step, metric, text):
        row(order, step, kind="'warning'", count=metric, message=f"'Found ' || {metric} || ' records with {text}.'", when=f"{metric} > 0")

    width = len(O.SUB_COLUMNS) - 1
    row(1, "column_validation", incorrect="0", total=str(width), missing="''", optional="'price_id_2,quantity_2'", columns=str(width))
    rule(2, "address_country_code_validation", "country_format", "n_subscribers", "'invalid_address_country_codes'")
    rule(3, "price_id_validation", "price_id", "n_subscribers", "'invalid_price_ids'")
    rule(4, "unsupported_countries_validation", "unsupported_country", "n_subscribers", "'unsupported_countries'")
    rule(5, "date_format_validation", "date_format", "n_subscribers", "'invalid_date_formats'")
    rule(6, "date_validation", "date_period", "date_period_population", "'invalid_date_periods'", "date_period_population > 0 AND date_period = 0")
    rule(7, "missing_zip_code_validation", "missing_postal", "missing_postal_population", "'missing_zip_codes'")
    rule(8, "ca_zip_code_validation", "ca_postal", "CASE WHEN ca_population > 0 THEN ca_population ELSE ca_rows END", "'invalid_ca_zip_codes'")
    rule(9, "us_zip_code_validation", "us_postal", "CASE WHEN us_population > 0 THEN us_population ELSE us_rows END",
         "'invalid_us_zip_codes' || CASE WHEN us_autocorrected > 0 THEN '_after_autocorrect' ELSE '' END")
    warning(10, "duplicate_tokens", "duplicate_tokens", "duplicate card tokens")
    warning(11, "duplicate_external_subscription_ids", "duplicate_subscription_ids", "duplicate external subscription IDs")
    warning(12, "duplicate_emails", "duplicate_emails", "duplicate customer emails")
    warning(13, "duplicate_card_ids", "duplicate_card_ids", "duplicate card IDs")
    row(14, "no_token_found", "(no_token = 0)", "CASE WHEN no_token > 0 THEN 'error' ELSE 'success' END", count="no_token",
        message="CASE WHEN no_token > 0 THEN 'Found ' || no_token || ' records with no matching token in mapping file.' "
                "ELSE 'All records have matching tokens in mapping file.' END")
    row(15, "successfully_mapped_records", kind="'success'", count="success",
        message="'Successfully mapped ' || success || ' records ready for import.'", when="success > 0")
    return O.chain(pad=True) + _metrics_cte("stripe") + " UNION ALL ".join(rows)


def _step_errors_sql() -> str:
    width = len(O.SUB_COLUMNS) - 1
    n, v = "(SELECT count(*) FROM s2)", "CAST(NULL AS VARCHAR)"
    lost = "'Missing required columns: [''current_period_ends_at'']'"
    rows = [f"SELECT 'no_column' AS export, 'column_validation' AS step, false AS valid, 1::BIGINT AS incorrect_count, {width - 1}::BIGINT AS total_records, "
            f"'current_period_ends_at' AS missing_columns, {v} AS report, 'Missing required columns' AS error",
            f"SELECT 'no_column', 'date_format_validation', false, 0, 0, {v}, {v}, {lost}", f"SELECT 'no_column', 'date_validation', false, 0, 0, {v}, {v}, {lost}",
            f"SELECT 'no_date', 'column_validation', true, 0, {width}, '', {v}, {v}",
            f"SELECT 'no_date', 'date_format_validation', false, {n}, {n}, {v}, 'invalid_date_formats', {v}",
            f"SELECT 'no_date', 'date_validation', false, 0, 0, {v}, {v}, 'No valid date records found'"]
    return O.chain() + " UNION ALL ".join(rows)


def _audit_inferred_sql() -> str:
    line = "SELECT row_number() OVER (ORDER BY row_id)::BIGINT AS line, row_id, address_country_code AS c FROM sub"
    cells = {"int": {0: "2134", 2: "501"}, "float": {0: "2134.0", 1: "90210.0", 2: "nan", 3: "nan"}, "text": {1: "2134", 2: "nan", 3: "A-1"}}
    rows = [f"SELECT '{kind}' AS kind, line, '{cell}' AS \"postalCode\", {repr('0' + cell) if len(cell) == 4 else 'CAST(NULL AS VARCHAR)'} AS \"correctedCode\", "
            f"'{'missing_zero' if len(cell) == 4 else 'incorrect_format'}' AS type FROM ({line}) WHERE c = 'US' AND row_id % {3 if kind == 'int' else 4} = {k}"
            for kind, found in cells.items() for k, cell in found.items()]
    return O.chain() + " UNION ALL ".join(rows)


_EXPIRED = "m_token IS NOT NULL AND coalesce(m_exp_year < '2028', false)"
_EVEN = "coalesce(regexp_matches(customer_full_name, '[02468]$'), false)"
_USER_SUCCESS = f"NOT row_failed AND NOT {_EVEN} AND row_id NOT IN (SELECT row_id FROM jall WHERE {_EXPIRED})"


def _user_summary_sql() -> str:
    long_mail = "customer_email <> '' AND length(customer_email) > 18"
    rows = [("customer_name_validation", f"SELECT count_if({_EVEN}) FROM s2", "SELECT count(*) FROM s2"),
            ("long_email_validation", f"SELECT count_if({long_mail}) FROM s2", "SELECT count_if(coalesce(customer_email <> '', false)) FROM s2"),
            ("card_expiry_validation", f"SELECT count_if({_EXPIRED}) FROM cr", "SELECT count_if(m_token IS NOT NULL) FROM cr")]
    parts = [f"SELECT '{step}' AS step, ({bad}) = 0 AS valid, ({bad})::BIGINT AS incorrect_count, ({of})::BIGINT AS total_records, NULL::BIGINT AS count"
             for step, bad, of in rows]
    parts.append("SELECT 'successfully_mapped_records', true, NULL::BIGINT, NULL::BIGINT, "
                 f"(SELECT count(*) FROM cr WHERE {_USER_SUCCESS})::BIGINT WHERE EXISTS (SELECT 1 FROM cr WHERE {_USER_SUCCESS})")
    return O.chain() + " UNION ALL ".join(parts)


def oracle() -> dict[str, str]:
    sub_all = ", ".join("CAST(row_id AS VARCHAR) AS row_id" if c == "row_id" else O.q2(c) for c in O.SUB_COLUMNS)
    name = _BREAK.format("row_id", "customer_full_name", "chr(10)")
    flags = {"invalid_address_country_codes": "f_country", "invalid_price_ids": "f_price OR f_quantity", "unsupported_countries": "f_unsupported",
             "invalid_date_formats": "f_date_format", "invalid_date_periods": "f_period"}
    missing = _sub_text(f'{O.clean("m_zip")} AS "{K.STRIPE_MAPPING_ZIP}", ')
    return {
        "scan_subscribers_multi_file": O.chain() + f"SELECT {sub_all} FROM sub",
        "scan_quoted_newline": O.chain() + f"SELECT CAST(row_id AS VARCHAR) AS row_id, {name} AS customer_full_name, customer_email, address_postal_code FROM sub",
        "quantity_edges": _cells_sql([(v, not v.isdigit()) for _, v in QUANTITY_CELLS], "i, quantity_1, fails", "quantity_1, fails"),
        "date_edges": _cells_sql([(not ok,) for _, ok in DATE_TAILS], "i, fails", "fails"),
        "null_key_filter": O.chain() + "SELECT 'n_subscribers' AS metric, count(*)::BIGINT AS value FROM sub UNION ALL "
                           "SELECT 'dropped_null_key', count_if(row_id % 13 = 0 OR card_token IS NULL)::BIGINT FROM sub UNION ALL "
                           "SELECT 'joined_subscribers', count_if(row_id % 13 <> 0 AND card_token IS NOT NULL)::BIGINT FROM sub",
        "step_errors": _step_errors_sql(),
        "postal_audit_inferred": _audit_inferred_sql(),
        "user_rules_summary": _user_summary_sql(),
        "user_rules_final_import": O.chain() + f"SELECT row_id, k AS card_id FROM cr WHERE {_USER_SUCCESS}",
        "final_import_key_order": O.chain() + f"SELECT row_number() OVER (ORDER BY k, row_id) AS line, {O.clean('k')} AS card_key, row_id, "
                                  f"{O.clean('customer_email')} AS customer_email FROM cr WHERE NOT row_failed",
        "report_card_expiry": _layout_text(_EXPIRED),
        "validation_verdict": _verdict_sql(),
        "validation_envelope": _envelope_sql(),
        **{f"report_{r}": O.chain() + f"SELECT {_sub_text()} FROM s2 WHERE {f}" for r, f in flags.items()},
        "report_incorrect_card_tokens": O.chain("bluesnap") + f"SELECT {_sub_text()} FROM s2 WHERE card_token <> '' AND NOT {O.fm('card_token', '^[0-9]{13}$')}",
        "report_missing_zip_codes": O.chain() + f"SELECT {missing} FROM jall WHERE f_missing",
        "report_invalid_ca_zip_codes": _layout_text("f_ca"),
        "report_invalid_us_zip_codes": _layout_text("f_us"),
        "output_final_import": _layout_text("NOT row_failed", flag="", rid=""),
        "output_final_import_bluesnap": _layout_text("NOT row_failed", flag="", rid="", provider="bluesnap"),
        "output_no_token_found": _layout_text("f_no_token"),
        "output_duplicate_tokens": _layout_text("is_duplicate_token", flag=""),
        "output_duplicate_external_subscription_ids": _layout_text("dup_sid"),
        "output_duplicate_emails": _layout_text("dup_email", "emails"),
        "output_duplicate_card_ids": _layout_text("dup_card_id"),
    }
