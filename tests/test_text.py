"""Edge cells per rule and transformation (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from vaultshift.functions import text as T
from vaultshift.operators import postal as P
from vaultshift.operators import rules as R


def _eval(spark, values, fn, col="c"):
    df = spark.createDataFrame([(v,) for v in values], f"{col} string")
    return [r[0] for r in df.select(fn).collect()]


def test_python_strip_set(spark):
    vals = [" a ", " a ", "\x1ca\x85", "　a\t\n"]
    assert _eval(spark, vals, T.py_strip("c")) == ["a", "a", "a", "a"]


def test_clean_for_csv(spark):
    vals = ["v1.0", "2.0.0", "nan", "NaN", None, "8830.0"]
    assert _eval(spark, vals, T.clean_for_csv("c")) == ["v1", "2.0", "", "NaN", "", "8830"]


def test_strip_fractional(spark):
    vals = ["2025-07-06T00:00:00.123Z", "2025-07-06T00:00:00Z", "", "x.1Z", " 2025-07-06T00:00:00.5Z "]
    assert _eval(spark, vals, T.strip_fractional_seconds("c")) == [
        "2025-07-06T00:00:00Z", "2025-07-06T00:00:00Z", "", "x.1Z", "2025-07-06T00:00:00Z"]


def test_normalize_quantity(spark):
    vals = ["1", "0", "2.0", "1e3", "+2", "-0.0", "-1", "2.5", "", "2d", "inf", None, " 7 "]
    assert _eval(spark, vals, T.normalize_quantity("c")) == [
        "1", "0", "2", "1000", "2", "0", "-1", "2.5", "", "2d", "inf", None, "7"]


@pytest.mark.parametrize("value,fails", [
    ("US", False), (" us ", False), ("ÉÉ", False),
    ("", True), (None, True), ("USA", True), ("U1", True), ("1", True), ("nan", True),
])
def test_country_format(spark, value, fails):
    rule = R.country_format({"address_country_code"})
    df = spark.createDataFrame([(value,)], "address_country_code string")
    assert df.select(rule.fails).first()[0] is fails


@pytest.mark.parametrize("value,fails", [("US", False), ("ru", False), (" RU", False), ("RU", True), ("KP", True)])
def test_unsupported_country(spark, value, fails):
    rule = R.unsupported_country({"address_country_code"})
    df = spark.createDataFrame([(value,)], "address_country_code string")
    assert df.select(rule.fails).first()[0] is fails


@pytest.mark.parametrize("p1,p2,q1,q2,price_fails,qty_fails", [
    ("pri_1", "", "1", "", False, False),
    ("", "", "1", "", True, False),
    ("prod_1", "", "1", "", True, False),
    ("PRI_1", "", "1", "", True, False),
    ("pri_1", "bad", "1", "3", True, False),
    ("pri_1", "pri_2", "1", "", False, True),
    ("pri_1", "", "-1", "", False, True),
    ("pri_1", "", "2.5", "", False, True),
    ("pri_1", "", "", "", False, True),
    ("pri_1", "", "0", "", False, False),
])
def test_price_and_quantity(spark, p1, p2, q1, q2, price_fails, qty_fails):
    cols = {"price_id_1", "price_id_2", "quantity_1", "quantity_2"}
    df = spark.createDataFrame([(p1, p2, q1, q2)], "price_id_1 string, price_id_2 string, quantity_1 string, quantity_2 string")
    df = df.withColumns({"quantity_1": T.normalize_quantity("quantity_1"), "quantity_2": T.normalize_quantity("quantity_2")})
    row = df.select(R.price_ids(cols).fails, R.quantities(cols).fails).first()
    assert (row[0], row[1]) == (price_fails, qty_fails)


def test_quantity_column_absent(spark):
    df = spark.createDataFrame([("pri_1", "1", "pri_2")], "price_id_1 string, quantity_1 string, price_id_2 string")
    assert df.select(R.quantities({"price_id_1", "quantity_1", "price_id_2"}).fails).first()[0] is True


@pytest.mark.parametrize("start,end,started,fails", [
    ("2025-07-06T00:00:00Z", "2025-07-06T00:00:00Z", "", False),
    ("2025-13-45T00:00:00Z", "2025-07-06T00:00:00Z", None, False),
    ("", "2025-07-06T00:00:00Z", "", True),
    (None, "2025-07-06T00:00:00Z", "", True),
    ("2025-07-06", "2025-07-06T00:00:00Z", "", True),
    ("2025-07-06T00:00:00.000Z", "2025-07-06T00:00:00Z", "", True),
    (" 2025-07-06T00:00:00Z", "2025-07-06T00:00:00Z", "", True),
    ("2025-07-06T00:00:00Z", "2025-07-06T00:00:00Z", " 2025-07-06T00:00:00Z ", False),
    ("2025-07-06T00:00:00Z", "2025-07-06T00:00:00Z", "yesterday", True),
])
def test_date_format(spark, start, end, started, fails):
    cols = {"current_period_started_at", "current_period_ends_at", "started_at"}
    df = spark.createDataFrame([(start, end, started)],
                               "current_period_started_at string, current_period_ends_at string, started_at string")
    assert df.select(R.date_format(cols).fails).first()[0] is fails


@pytest.mark.parametrize("start,end,pop,fails", [
    ("2025-07-06T00:00:00Z", "2025-07-06T00:00:00Z", True, False),   # start = now, end = now
    ("2025-07-07T00:00:00Z", "2026-07-06T00:00:00Z", True, True),    # start after now
    ("2024-07-06T00:00:00Z", "2025-07-05T00:00:00Z", True, True),    # end before now
    ("bad", "2024-01-01T00:00:00Z", False, False),                   # unparsable: skipped
])
def test_date_period(spark, start, end, pop, fails):
    cols = {"current_period_started_at", "current_period_ends_at"}
    rule = R.date_period(cols, R.as_of_column("2025-07-06T00:00:00Z"))
    df = spark.createDataFrame([(start, end)], "current_period_started_at string, current_period_ends_at string")
    assert tuple(df.select(rule.population, rule.fails).first()) == (pop, fails)


POSTAL_CASES = [
    # country, postal, zip, fill, pad -> (missing, ca, us, final postal)
    ("BR", "", None, False, False, (False, False, False, "")),
    ("us", "", None, False, False, (False, False, False, "")),
    ("US", "  ", None, False, False, (True, False, False, "  ")),
    ("US", None, None, False, False, (True, False, False, None)),
    ("CA", "K1A 0B1", None, False, False, (False, False, False, "K1A 0B1")),
    ("CA", "k1a0b1", None, False, False, (False, False, False, "k1a0b1")),
    ("CA", "K1A  0B1", None, False, False, (False, False, False, "K1A  0B1")),
    (" ca ", "W1A 0B1", None, False, False, (False, True, False, "W1A 0B1")),
    ("CA", "D1A 0B1", None, False, False, (False, True, False, "D1A 0B1")),
    ("CA", "K1A-0B1", None, False, False, (False, True, False, "K1A-0B1")),
    ("US", "90210", None, False, False, (False, False, False, "90210")),
    ("US", " 10001 ", None, False, False, (False, False, False, " 10001 ")),
    ("US", "2134", None, False, False, (False, False, True, "2134")),
    ("US", "10001-1234", None, False, False, (False, False, True, "10001-1234")),
    ("US", "ABCDE", None, False, False, (False, False, True, "ABCDE")),
    ("US", "2134", None, False, True, (False, False, False, "02134")),
    ("US", "501", None, False, True, (False, False, True, "501")),
    ("US", "", "02134-1234", True, False, (False, False, False, "02134")),
    ("US", "", "2134.0", True, False, (False, False, True, "2134")),
    ("US", "", "2134.0", True, True, (False, False, False, "02134")),
    ("US", "", "ABC", True, False, (False, False, True, "ABC")),
    ("US", "", " ", True, False, (True, False, False, "")),
    ("GB", "", "K1A 0B1", True, False, (False, False, False, "K1A 0B1")),
]


@pytest.mark.parametrize("country,postal,zip_,fill,pad,expected", POSTAL_CASES)
def test_postal(spark, country, postal, zip_, fill, pad, expected):
    df = spark.createDataFrame([(country, postal, zip_)], "c string, p string, z string")
    out = P.add_postal_columns(df, F.col("c"), F.col("p"), F.col("z"), fill, pad)
    row = out.select("_f_missing", "_f_ca", "_f_us", "_postal_final").first()
    assert tuple(row) == expected


def test_postal_audit(spark):
    df = spark.createDataFrame([("US", "2134"), ("US", "501"), ("CA", "xx"), ("US", "90210"), ("US", "")],
                               "c string, p string")
    kind, value, corrected = P.audit_issue(F.col("c"), F.col("p"))
    assert [tuple(r) for r in df.select(kind, corrected).collect()] == [
        ("missing_zero", "02134"), ("incorrect_format", None), (None, None), (None, None), (None, None)]


def test_permuted_tokens_never_collide(spark):
    from pyspark.sql import functions as F
    ends = [36**w + d for w in T.TOKEN_WIDTHS[:-1] for d in (-2, -1, 0, 1)] + [2**63 - 1]
    n = spark.range(200_000).unionByName(spark.createDataFrame([(x,) for x in ends], "id long"))
    n = n.select("id", T.permuted_token(F.col("id"), "s").alias("t"), T.permuted_token(F.col("id"), "z").alias("other"))
    assert n.agg(F.count_distinct("t")).first()[0] == n.count() == 200_000 + len(ends)
    assert n.where(~F.col("t").rlike("^[0-9a-z]+$")).count() == 0
    assert {(len(r.t)) for r in n.where("id < 60466176").collect()} == {5} and n.where(f"id = {2**63 - 1}").first().t.__len__() == 13
    assert n.where("t = other").count() < 20


def test_tokens_of_a_small_width_fill_it(spark, monkeypatch):
    """A permutation: with one character a digit pair, the tokens of all numbers of a width are all its tokens."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(T, "TOKEN_WIDTHS", (3, 5))
    t = spark.range(36**3).select(T.permuted_token(F.col("id"), "k").alias("t"))
    assert t.distinct().count() == 36**3 and t.where("length(t) <> 3").count() == 0
