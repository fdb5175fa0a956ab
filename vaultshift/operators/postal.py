"""Postal-code rules and repairs on joined rows.

``add_postal_columns`` turns (country, postal, mapping zip) into every postal outcome of one joined
row. It depends on those three columns only, so it is used twice: per joined row (for reports and
counts) and per vault-mapping row with a fixed country class (for the per-key roll-up that decides
removal without regrouping joined rows, see ``vaultshift.plans.pipeline``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultshift import constants as K
from vaultshift.functions import text as T


# Outcome columns added by ``add_postal_columns`` (names are prefixed by the caller).
OUTCOMES = (
    "_p_missing",                  # C7 population: country is a postal-required code (exact)
    "_f_missing_before",           # C7 before any fill
    "_c_fillable",                 # C15: C7 row whose mapping zip is non-blank
    "_c_filled",                   # G1 applied to this row
    "_postal_filled",
    "_f_missing",                  # C7 after the fill
    "_ca_rows", "_p_ca", "_f_ca",  # C8: CA rows (trim + upper), with a code, failing
    "_us_rows",                    # country exactly US
    "_c_autocorrectable_before",   # C16 before the pad
    "_c_autocorrected",            # G2 applied to this row
    "_postal_final",
    "_p_us", "_c_autocorrectable", "_f_us",  # C9 / C16 after the pad
    "_postal_fails",               # C7 | C8 | C9 of this row
)


def mapping_zip_fill_value(cleaned_stripped: Column, is_us: Column) -> Column:
    """G1 value from the CSV-cleaned, stripped mapping zip: one ``.0`` suffix removed; for US the
    text before the first ``-`` reduced to its digits (kept as is when it has none). Null when
    there is nothing to fill."""
    v = F.when(cleaned_stripped.endswith(".0"), F.regexp_replace(cleaned_stripped, r"\.0$", "")) \
        .otherwise(cleaned_stripped)
    head = F.when(F.instr(v, "-") > 0, F.split_part(v, F.lit("-"), F.lit(1))).otherwise(v)
    digits = F.regexp_replace(head, "[^0-9]", "")
    us_value = F.when(digits != "", digits).otherwise(head)
    return F.when(cleaned_stripped != "", F.when(is_us, us_value).otherwise(v))


def add_postal_columns(df: DataFrame, country: Column, postal: Column, mapping_zip: Column,
                       use_mapping_zip: bool, autocorrect_us: bool, prefix: str = "") -> DataFrame:
    """Every postal outcome of a joined row as columns ``prefix + OUTCOMES``.

    Built in stages (stripped inputs, fill, checks, pad, re-check) so that each regex runs once
    per row: Catalyst keeps the stages as separate projections instead of inlining an expensive
    expression into every place that uses it.
    """
    n = {k: prefix + k for k in OUTCOMES}
    t = {k: f"{prefix}_t_{k}" for k in ("country", "postal", "zip", "cu", "ps", "zs", "zc", "as", "fs")}
    c = lambda k: F.col(t[k])
    o = lambda k: F.col(n[k])
    df = df.withColumns({t["country"]: country, t["postal"]: postal, t["zip"]: mapping_zip})
    df = df.withColumns({
        t["cu"]: F.upper(T.py_strip(c("country"))),
        t["ps"]: T.py_strip(c("postal")),
        t["zs"]: T.py_strip(c("zip")),
        t["zc"]: T.py_strip(T.clean_for_csv(c("zip"))),
    })
    in_required = F.coalesce(c("country").isin(*K.POSTAL_REQUIRED_COUNTRIES), F.lit(False))
    is_us = F.coalesce(c("country") == "US", F.lit(False))
    df = df.withColumns({
        n["_p_missing"]: in_required,
        n["_us_rows"]: is_us,
        n["_ca_rows"]: F.coalesce(c("cu") == "CA", F.lit(False)),
    })
    missing_before = o("_p_missing") & (c("postal").isNull() | (c("ps") == ""))
    df = df.withColumn(n["_f_missing_before"], missing_before)
    fillable = o("_f_missing_before") & ~(c("zip").isNull() | (c("zs") == ""))
    if use_mapping_zip:
        fill_value = mapping_zip_fill_value(c("zc"), o("_us_rows"))
        filled = o("_f_missing_before") & fill_value.isNotNull()
        df = df.withColumns({n["_c_fillable"]: fillable, n["_c_filled"]: filled})
        df = df.withColumn(n["_postal_filled"],
                           F.when(o("_c_filled"), fill_value).otherwise(c("postal")))
    else:
        df = df.withColumns({n["_c_fillable"]: fillable, n["_c_filled"]: F.lit(False),
                             n["_postal_filled"]: c("postal")})
    df = df.withColumn(t["as"], T.py_strip(o("_postal_filled")))
    blank_after = o("_postal_filled").isNull() | (c("as") == "")
    ca_ok = T.full_match(F.regexp_replace(F.upper(c("as")), f"{T._WS}+", " "), "(?i)" + K.CA_POSTAL_PATTERN)
    us_norm = F.coalesce(c("as"), F.lit(""))
    four = T.full_match(us_norm, "^[0-9]{4}$")
    df = df.withColumns({
        n["_f_missing"]: o("_p_missing") & blank_after,
        n["_p_ca"]: o("_ca_rows") & ~blank_after,
        n["_c_autocorrectable_before"]: o("_us_rows") & (us_norm != "") & four,
        n["_c_autocorrected"]: (o("_us_rows") & four) if autocorrect_us else F.lit(False),
    })
    df = df.withColumns({
        n["_f_ca"]: o("_p_ca") & ~ca_ok,
        n["_postal_final"]: F.when(o("_c_autocorrected"), F.lpad(us_norm, 5, "0")).otherwise(o("_postal_filled")),
    })
    df = df.withColumn(t["fs"], F.coalesce(T.py_strip(o("_postal_final")), F.lit("")))
    df = df.withColumn(n["_p_us"], o("_us_rows") & (c("fs") != ""))
    df = df.withColumns({
        n["_c_autocorrectable"]: o("_p_us") & T.full_match(c("fs"), "^[0-9]{4}$"),
        n["_f_us"]: o("_p_us") & ~T.full_match(c("fs"), "^[0-9]{5}$"),
    })
    df = df.withColumn(n["_postal_fails"], o("_f_missing") | o("_f_ca") | o("_f_us"))
    return df.drop(*t.values())


def audit_issue(country: Column, postal: Column) -> tuple[Column, Column, Column]:
    """C17 postal audit of a US row: (type, value, corrected) or a null type when the code is fine.

    4 digits → ``missing_zero`` with a zero-padded correction; anything else that is not 5 digits
    → ``incorrect_format``. Blank codes and non-US rows are not audited.
    """
    v = T.py_strip(postal)
    audited = F.coalesce(country == "US", F.lit(False)) & postal.isNotNull() & (postal != "")
    kind = (
        F.when(audited & T.full_match(v, "^[0-9]{4}$"), F.lit("missing_zero"))
        .when(audited & ~T.full_match(v, "^[0-9]{5}$"), F.lit("incorrect_format"))
    )
    corrected = F.when(kind == "missing_zero", F.concat(F.lit("0"), v))
    return kind, v, corrected


def inferred(df: DataFrame, column: str) -> DataFrame:
    """C17 over a column whose type is inferred: one aggregate decides for the whole column, and its cells are
    rendered as that type. Whole numbers lose leading zeros (``02134`` is ``2134``); with a blank or NA cell, or any
    fraction, all become floats (``2134.0``, blanks ``nan``); one other cell leaves the text as it is, blanks
    ``nan``. Whole numbers beyond 64 bits count as floats."""
    cell = T.mapping_null_normalise(column)
    bare = T.py_strip(cell)
    whole = F.coalesce(T.full_match(bare, r"^[+-]?[0-9]+$") & bare.try_cast("long").isNotNull(), F.lit(False))
    number = F.coalesce(T.full_match(bare, r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), F.lit(False))
    kind = df.agg(F.count_if(cell.isNull()).alias("_blank"), F.count_if(cell.isNotNull() & ~whole).alias("_odd"),
                  F.count_if(cell.isNotNull() & ~number).alias("_text")).withColumn("_one", F.lit(1))
    value = bare.try_cast("double")
    digits = F.when((value == F.rint(value)) & (F.abs(value) < 1e16), F.concat(value.try_cast("decimal(20,0)").cast("string"), F.lit(".0"))).otherwise(
        value.cast("string"))
    text = F.when(F.col("_text") > 0, cell).when((F.col("_odd") > 0) | (F.col("_blank") > 0), digits).otherwise(bare.try_cast("long").cast("string"))
    out = df.withColumn("_one", F.lit(1)).join(F.broadcast(kind), "_one")  # one row
    return out.withColumn(column, F.coalesce(text, F.lit("nan"))).drop("_one", "_blank", "_odd", "_text")
