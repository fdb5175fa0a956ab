"""Validation summary (E1, E5) and messages.

Each step is a row of SQL expressions over the run's metrics (``Migration.metrics``). The same
expressions are evaluated by Spark (``stack`` over the one-row metric table) and, in the oracle,
by DuckDB over counts taken the brute-force way.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.plans import oracle as O

METRICS = [
    "n_subscribers", "country_format", "price_id", "unsupported_country", "date_format",
    "date_period_population", "date_period", "missing_postal_population", "missing_postal",
    "available_from_mapping", "pulled_from_mapping", "ca_rows", "ca_population", "ca_postal", "us_rows",
    "us_population", "us_postal", "us_autocorrectable", "us_autocorrected", "duplicate_tokens",
    "duplicate_subscription_ids", "duplicate_emails", "duplicate_card_ids", "no_token", "success",
]

COLUMNS = ["step_order", "step", "valid", "type", "incorrect_count", "total_records", "available_from_mapping",
           "pulled_from_mapping_count", "autocorrectable_count", "autocorrected_count", "count", "shown"]

_NULL_L = "CAST(NULL AS BIGINT)"
_NULL_S = "CAST(NULL AS STRING)"


def _row(order, step, valid, type_=_NULL_S, incorrect=_NULL_L, total=_NULL_L, available=_NULL_L,
         pulled=_NULL_L, autocorrectable=_NULL_L, autocorrected=_NULL_L, count=_NULL_L, shown="true"):
    vals = [f"CAST({order} AS INT)", O.q(step), f"CAST({valid} AS BOOLEAN)", type_,
            f"CAST({incorrect} AS BIGINT)", f"CAST({total} AS BIGINT)", f"CAST({available} AS BIGINT)",
            f"CAST({pulled} AS BIGINT)", f"CAST({autocorrectable} AS BIGINT)", f"CAST({autocorrected} AS BIGINT)",
            f"CAST({count} AS BIGINT)", f"CAST({shown} AS BOOLEAN)"]
    return vals


def missing_dates(columns) -> list[str]:
    """The period columns an export lacks: without one, both date steps fail with an error and check no row."""
    return [c for c in ("current_period_started_at", "current_period_ends_at") if c not in columns]


def step_rows(provider: str, missing_columns: int, total_columns: int, card_token_check: bool = False, dates: bool = True) -> list[list[str]]:
    """Rows of the summary as SQL expressions over metric names."""
    dated = str(dates).lower()
    def warn(order, step, metric, shown_extra="true"):
        return _row(order, step, "true", "'warning'", count=metric, shown=f"({metric} > 0 AND {shown_extra})")

    opted = [_row(16, K.STEP_CARD_TOKEN, "card_token = 0", incorrect="card_token", total="card_token_population")] if card_token_check else []
    return [
        _row(1, K.STEP_COLUMNS, str(missing_columns == 0).lower(), incorrect=missing_columns, total=total_columns),
        _row(2, K.STEP_COUNTRY_FORMAT, "country_format = 0", incorrect="country_format", total="n_subscribers"),
        _row(3, K.STEP_PRICE_ID, "price_id = 0", incorrect="price_id", total="n_subscribers"),
        _row(4, K.STEP_UNSUPPORTED, "unsupported_country = 0", incorrect="unsupported_country",
             total="n_subscribers"),
        _row(5, K.STEP_DATE_FORMAT, f"{dated} AND date_format = 0", incorrect="date_format", total="n_subscribers" if dates else "0"),
        _row(6, K.STEP_DATE_PERIOD, "date_period_population > 0 AND date_period = 0",
             incorrect="date_period", total="date_period_population"),
        _row(7, K.STEP_MISSING_POSTAL, "missing_postal = 0", incorrect="missing_postal",
             total="missing_postal_population", available="available_from_mapping", pulled="pulled_from_mapping"),
        _row(8, K.STEP_CA_POSTAL, "ca_postal = 0", incorrect="ca_postal",
             total="CASE WHEN ca_population > 0 THEN ca_population ELSE ca_rows END"),
        _row(9, K.STEP_US_POSTAL, "us_postal = 0", incorrect="us_postal",
             total="CASE WHEN us_population > 0 THEN us_population ELSE us_rows END",
             autocorrectable="us_autocorrectable", autocorrected="us_autocorrected"),
        warn(10, K.STEP_DUP_TOKENS, "duplicate_tokens"),
        warn(11, K.STEP_DUP_SUBSCRIPTIONS, "duplicate_subscription_ids"),
        warn(12, K.STEP_DUP_EMAILS, "duplicate_emails"),
        warn(13, K.STEP_DUP_CARD_IDS, "duplicate_card_ids", str(provider == "stripe").lower()),
        _row(14, K.STEP_NO_TOKEN, "no_token = 0", "CASE WHEN no_token > 0 THEN 'error' ELSE 'success' END",
             count="no_token"),
        _row(15, K.STEP_SUCCESS, "true", "'success'", count="success", shown="success > 0"),
        *opted,
    ]


def _stack(rows: list[list[str]]) -> str:
    flat = ", ".join(v for r in rows for v in r)
    return f"stack({len(rows)}, {flat}) AS ({', '.join(COLUMNS)})"


def validation_summary(m) -> DataFrame:
    from vaultshift.plans.pipeline import column_check
    info = column_check(m.file_columns)
    check = m.options.card_token_check
    rows = step_rows(m.options.provider, len(info["missing_columns"]), info["total_columns"], check, not missing_dates(m.file_columns))
    rows += [_row(17 + k, r.step, f"{r.flag} = 0", incorrect=r.flag, total=f"{r.flag}_of") for k, r in enumerate(m.rules)]
    names = METRICS + (["card_token", "card_token_population"] if check else []) + [n for r in m.rules for n in r.flags]
    out = m.wide_metrics(names).selectExpr(_stack(rows))
    return out.where("shown").drop("shown")


#: Steps whose failing rows go to a report file of this name.
STEP_REPORTS = {
    K.STEP_COUNTRY_FORMAT: K.REPORT_COUNTRY_FORMAT, K.STEP_PRICE_ID: K.REPORT_PRICE_ID, K.STEP_UNSUPPORTED: K.REPORT_UNSUPPORTED,
    K.STEP_DATE_FORMAT: K.REPORT_DATE_FORMAT, K.STEP_DATE_PERIOD: K.REPORT_DATE_PERIOD, K.STEP_CARD_TOKEN: K.REPORT_CARD_TOKEN_LENGTH,
    K.STEP_MISSING_POSTAL: K.REPORT_MISSING_POSTAL, K.STEP_CA_POSTAL: K.REPORT_CA_POSTAL, K.STEP_US_POSTAL: K.REPORT_US_POSTAL,
}
FAILURES_FOUND = "Validation failures detected"


def step_errors(m) -> dict[str, str]:
    """Errors of steps that the export's header decides."""
    lost = missing_dates(m.file_columns)
    return dict.fromkeys((K.STEP_DATE_FORMAT, K.STEP_DATE_PERIOD), f"Missing required columns: {lost}") if lost else {}


NO_DATES = "No valid date records found"


def with_errors(m, steps: list[dict]) -> list[dict]:
    """The steps of a run with the error of each that has one."""
    errors = step_errors(m)
    for s in steps:
        if s["step"] in errors:
            s["error"] = errors[s["step"]]
        elif s["step"] == K.STEP_DATE_PERIOD and not s["valid"] and not s["total_records"]:
            s["error"] = NO_DATES
    return steps


def validation_envelope(m) -> DataFrame:
    """The validation table with what the result envelope adds to each step: the missing and optional
    columns and the number of columns (column step), the report file of a failed step, its message."""
    from vaultshift.plans.pipeline import column_check
    info = column_check(m.file_columns)
    steps = validation_summary(m)
    is_columns = F.col("step") == K.STEP_COLUMNS
    report = F.lit(None).cast("string")
    for step, name in (STEP_REPORTS | {r.step: r.code for r in m.rules}).items():
        full = f"{name}_after_autocorrect" if step == K.STEP_US_POSTAL else name
        report = F.when((F.col("step") == step) & (F.col("incorrect_count") > 0), F.when(F.coalesce("autocorrected_count", F.lit(0)) > 0, full).otherwise(name)).otherwise(report)
    error = F.when(is_columns & ~F.col("valid"), F.lit("Missing required columns"))
    error = error.when((F.col("step") == K.STEP_DATE_PERIOD) & ~F.col("valid") & (F.col("total_records") == 0), F.lit(NO_DATES))
    for step, text in step_errors(m).items():
        error = F.when(F.col("step") == step, F.lit(text)).otherwise(error)
    message = F.lit(None).cast("string")
    for step, (metric, text) in K.MESSAGES.items():  # a step's count is its metric
        message = F.when(F.col("step") == step, F.expr(re.sub(rf"\b{metric}\b", "`count`", text))).otherwise(message)
    return steps.select(
        "step_order", "step", "valid", "type", "incorrect_count", "total_records", "count",
        F.when(is_columns, F.lit(",".join(info["missing_columns"]))).alias("missing_columns"),
        F.when(is_columns, F.lit(",".join(info["optional_columns"]))).alias("optional_columns"),
        F.when(is_columns, F.lit(info["total_columns"])).cast("long").alias("total_columns"),
        report.alias("report"), message.alias("message"),
        error.alias("error"))


def verdict(steps: list[dict]) -> dict:
    """E5: the number of failed steps, and the error of a run that has any."""
    failed = sum(not s["valid"] for s in steps)
    return {"failed_count": failed, "error": FAILURES_FOUND if failed else None}


def validation_verdict(m) -> DataFrame:
    """E5 as one row: failed_count, error."""
    failed = F.count(F.when(~F.col("valid"), F.lit(1)))
    return validation_summary(m).agg(failed.cast("long").alias("failed_count"),
                                     F.when(failed > 0, F.lit(FAILURES_FOUND)).alias("error"))


def validation_messages(m) -> DataFrame:
    w = m.wide_metrics(METRICS)
    shown = [(step, metric, expr) for step, (metric, expr) in K.MESSAGES.items()
             if step != K.STEP_DUP_CARD_IDS or m.options.provider == "stripe"]
    flat = ", ".join(f"{O.q(step)}, {expr}, CAST({metric} AS BIGINT)" for step, metric, expr in shown)
    out = w.selectExpr(f"stack({len(shown)}, {flat}) AS (step, message, count)")
    keep = "count > 0 OR step = " + O.q(K.STEP_NO_TOKEN)
    return out.where(keep).drop("count")


# ---- oracle ----------------------------------------------------------------------------------

def _metrics_cte(provider: str) -> str:
    stripe = provider == "stripe"
    return f""", w AS (SELECT
 (SELECT count(*) FROM s2) AS n_subscribers,
 (SELECT count_if(f_country) FROM s2) AS country_format,
 (SELECT count_if(f_price OR f_quantity) FROM s2) AS price_id,
 (SELECT count_if(f_unsupported) FROM s2) AS unsupported_country,
 (SELECT count_if(f_date_format) FROM s2) AS date_format,
 (SELECT count_if(p_period) FROM s2) AS date_period_population,
 (SELECT count_if(f_period) FROM s2) AS date_period,
 (SELECT count_if(p_missing) FROM jall) AS missing_postal_population,
 (SELECT count_if(f_missing) FROM jall) AS missing_postal,
 (SELECT count_if(f_missing AND NOT {O.empty('m_zip')}) FROM jall) AS available_from_mapping,
 (SELECT count_if(c_filled) FROM jall) AS pulled_from_mapping,
 (SELECT count_if(ca_rows) FROM cr) AS ca_rows,
 (SELECT count_if(p_ca) FROM cr) AS ca_population,
 (SELECT count_if(f_ca) FROM cr) AS ca_postal,
 (SELECT count_if(us_rows) FROM cr) AS us_rows,
 (SELECT count_if(p_us) FROM cr) AS us_population,
 (SELECT count_if(f_us) FROM cr) AS us_postal,
 (SELECT count_if(c_autocorrectable) FROM cr) AS us_autocorrectable,
 (SELECT count_if(c_autocorrected) FROM cr) AS us_autocorrected,
 (SELECT count_if(is_duplicate_token) FROM cr) AS duplicate_tokens,
 (SELECT count_if(dup_sid) FROM cr) AS duplicate_subscription_ids,
 (SELECT count_if(dup_email) FROM cr) AS duplicate_emails,
 (SELECT {'count_if(dup_card_id)' if stripe else '0'} FROM cr) AS duplicate_card_ids,
 (SELECT count_if(f_no_token) FROM cr) AS no_token,
 (SELECT count_if(NOT row_failed) FROM cr) AS success)
"""


def oracle_validation_summary(provider: str) -> str:
    rows = step_rows(provider, 0, len(O.SUB_COLUMNS) - 1)
    sel = " UNION ALL ".join(
        "SELECT " + ", ".join(f"{v} AS {c}" for v, c in zip(r, COLUMNS)) + " FROM w" for r in rows)
    cols = ", ".join(COLUMNS[:-1])
    return O.chain(provider=provider) + _metrics_cte(provider) + f"SELECT {cols} FROM ({sel}) WHERE shown"


def oracle_validation_messages(provider: str) -> str:
    parts = [f"SELECT {O.q(step)} AS step, {expr} AS message, CAST({metric} AS BIGINT) AS count FROM w"
             for step, (metric, expr) in K.MESSAGES.items()
             if step != K.STEP_DUP_CARD_IDS or provider == "stripe"]
    return (O.chain(provider=provider) + _metrics_cte(provider) +
            f"SELECT step, message FROM ({' UNION ALL '.join(parts)}) WHERE count > 0 OR step = {O.q(K.STEP_NO_TOKEN)}")
