"""Subscriber exports and vault mappings derived from the TPC-H-style test tables.

The migration works on two CSV files the test data does not ship, so the tests derive them from
``orders`` ⋈ ``customer`` with defects injected by key arithmetic (see FIXTURES.md §2). Each column
is one SQL expression; the same text is used by Spark (``selectExpr``) and by the DuckDB oracle, so
both engines see identical inputs. The derivation grows with ``orders``: one subscriber per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultshift import constants as K

# Expressions of the subscriber export (alias, SQL expression over orders ⋈ customer).
SUB_EXPRS: tuple[tuple[str, str], ...] = (
    ("row_id", "o_orderkey"),
    ("customer_email",
     "CASE WHEN o_orderkey % 211 = 5 THEN NULL WHEN o_orderkey % 97 = 0 THEN '' "
     "ELSE concat('user', cast(o_custkey AS string), '@example.com') END"),
    ("customer_full_name", "c_name"),
    ("address_country_code",
     "CASE WHEN o_orderkey % 40 < 14 THEN 'US' WHEN o_orderkey % 40 < 22 THEN 'CA' "
     "WHEN o_orderkey % 40 = 22 THEN ' ca ' WHEN o_orderkey % 40 = 23 THEN 'us' "
     "WHEN o_orderkey % 40 = 24 THEN 'RU' WHEN o_orderkey % 40 = 25 THEN 'USA' "
     "WHEN o_orderkey % 40 = 26 THEN '' WHEN o_orderkey % 40 < 34 THEN 'GB' ELSE 'BR' END"),
    ("address_postal_code",
     "CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 9 = 1 THEN '  ' "
     "WHEN o_orderkey % 40 < 14 THEN CASE o_orderkey % 5 WHEN 0 THEN '2134' WHEN 1 THEN '90210' "
     "WHEN 2 THEN ' 10001 ' WHEN 3 THEN '10001-1234' ELSE '501' END "
     "WHEN o_orderkey % 40 < 23 THEN CASE o_orderkey % 4 WHEN 0 THEN 'K1A 0B1' WHEN 1 THEN 'k1a0b1' "
     "WHEN 2 THEN 'W1A 0B1' ELSE 'K1A-0B1' END ELSE 'SW1A 1AA' END"),
    ("current_period_started_at",
     "CASE WHEN o_orderkey % 53 = 0 THEN '' "
     "WHEN o_orderkey % 59 = 0 THEN cast(cast(o_orderdate AS date) AS string) "
     "WHEN o_orderkey % 23 = 0 THEN concat(cast(cast(o_orderdate AS date) AS string), 'T00:00:00.123Z') "
     "WHEN o_orderkey % 61 = 0 THEN '1997-13-45T00:00:00Z' "
     "ELSE concat(cast(cast(o_orderdate AS date) AS string), 'T00:00:00Z') END"),
    ("current_period_ends_at",
     "concat(cast(cast(o_orderdate AS date) + 365 AS string), 'T00:00:00Z')"),
    ("started_at",
     "CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 67 = 0 THEN 'yesterday' "
     "ELSE concat(cast(cast(o_orderdate AS date) AS string), 'T00:00:00Z') END"),
    ("enable_checkout",
     "CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN '' ELSE NULL END"),
    ("subscription_external_id",
     "CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE concat('sub_', "
     "cast(o_orderkey - CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS string)) END"),
    ("card_token",
     "CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE concat('card_', cast(o_orderkey AS string)) END"),
    ("price_id_1",
     "CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN 'prod_1' "
     "ELSE concat('pri_', cast(o_custkey % 20 AS string)) END"),
    ("quantity_1",
     "CASE o_orderkey % 29 WHEN 0 THEN '2.0' WHEN 1 THEN '-1' WHEN 2 THEN '2.5' WHEN 3 THEN '' "
     "WHEN 4 THEN '1e3' ELSE '1' END"),
    ("price_id_2",
     "CASE WHEN o_orderkey % 7 = 0 THEN 'pri_9' WHEN o_orderkey % 43 = 0 THEN 'bad' ELSE '' END"),
    ("quantity_2", "CASE WHEN o_orderkey % 14 = 0 THEN '3' ELSE '' END"),
)

BSUB_TOKEN_EXPR = (
    "CASE WHEN row_id % 89 = 0 THEN '' WHEN row_id % 83 = 0 THEN '12345' "
    "ELSE concat('9', lpad(cast(row_id AS string), 8, '0'), "
    "lpad(cast(row_id % 10000 AS string), 4, '0')) END"
)

# Adversarial copy: three in ten subscribers share a blank card token, a blank subscription id and
# one email address, so one key of each kind holds 30 % of the rows.
SKEW_EXPRS: tuple[tuple[str, str], ...] = (
    ("card_token", "CASE WHEN row_id % 10 < 3 THEN '' ELSE card_token END"),
    ("subscription_external_id", "CASE WHEN row_id % 10 < 3 THEN '' ELSE subscription_external_id END"),
    ("customer_email", "CASE WHEN row_id % 10 < 3 THEN 'shared@example.com' ELSE customer_email END"),
)

# Stripe vault mapping over orders × {d = 0, 1}; the header is the vault's dotted layout.
MAP_EXPRS: tuple[tuple[str, str], ...] = (
    ("card.id", "concat('card_', cast(o_orderkey AS string))"),
    ("card.number",
     "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('tok', cast(o_orderkey * 10 + d AS string)) END"),
    ("card.name",
     "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('Holder ', cast(o_custkey AS string)) END"),
    ("card.exp_month", "cast(o_orderkey % 12 + 1 AS string)"),
    ("card.exp_year", "cast(2027 + o_orderkey % 6 AS string)"),
    ("card.transaction_ids", "concat('ntx_', cast(o_orderkey AS string))"),
    ("card.address_zip",
     "CASE o_orderkey % 6 WHEN 0 THEN '02134-1234' WHEN 1 THEN '2134.0' WHEN 2 THEN 'K1A 0B1' "
     "WHEN 3 THEN ' ' WHEN 4 THEN 'ABC' ELSE NULL END"),
)
MAP_FILTER = "o_orderkey % 10 <> 3 AND (d = 0 OR o_orderkey % 25 = 0)"
MAP_EXTRA_ROW = ("card_unused", "tokx", "Nobody", "1", "2030", "ntx", None)

BMAP_EXPRS: tuple[tuple[str, str], ...] = (
    (K.BLUESNAP_ACCOUNT, "concat('9', lpad(cast(o_orderkey AS string), 8, '0'))"),
    (K.BLUESNAP_CARD_NUMBER,
     "CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE concat('411111111111', "
     "lpad(cast(o_orderkey % 10000 AS string), 4, '0')) END"),
    (K.BLUESNAP_FIRST_NAME, "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE ' Ada ' END"),
    (K.BLUESNAP_LAST_NAME, "concat('N', cast(o_custkey AS string), ' ')"),
    ("Expiration Month", "cast(o_orderkey % 12 + 1 AS string)"),
    ("Expiration Year", "cast(2027 + o_orderkey % 6 AS string)"),
    ("Network Transaction Id", "concat('ntx_', cast(o_orderkey AS string))"),
    (K.BLUESNAP_MAPPING_ZIP, "CASE o_orderkey % 3 WHEN 0 THEN '2134' WHEN 1 THEN '' ELSE 'K1A 0B1' END"),
)
BMAP_FILTER = "o_orderkey % 10 <> 3"
BMAP_EXTRA_ROW = ("900000007", "4222222222220007", "Eve", "Dup", "1", "2030", "ntx_dup", "90210")

# Fixed clock of the period rule for the fixtures (order dates run from 1995 to 2001).
FIXTURE_AS_OF = "1998-06-15T00:00:00Z"


def _sub_columns() -> list[str]:
    given = {a for a, _ in SUB_EXPRS}
    cols = ["row_id"]
    for name in K.REQUIRED_SUBSCRIBER_COLUMNS:
        cols.append(name)
    cols += ["price_id_2", "quantity_2"]
    assert given <= set(cols)
    return cols


def sub_select_list(quote: str = "`") -> list[str]:
    """SELECT list of the subscriber export; columns the fixture leaves out are constant blanks."""
    exprs = dict(SUB_EXPRS)
    return [f"{exprs.get(c, chr(39) * 2)} AS {quote}{c}{quote}" for c in _sub_columns()]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(orders: DataFrame) -> DataFrame:
    """Spread the orders over every core before deriving files from them.

    A small test table is one unsplittable Parquet row group, i.e. one task; a real export arrives
    as many file splits. The partition count is the larger of the input splits and the cluster's
    cores, so real inputs keep their parallelism; an explicit count is also kept by adaptive
    execution, which would otherwise coalesce the few shuffled bytes into one partition before the
    string-heavy rules.
    """
    n = max(orders.rdd.getNumPartitions(), orders.sparkSession.sparkContext.defaultParallelism)
    return orders.repartition(n, "o_orderkey")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sub``: one subscriber per order (row id = order key)."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = _spread(orders).join(customer, orders.o_custkey == customer.c_custkey)
    return joined.selectExpr(*sub_select_list())


def bluesnap_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bsub``: the same subscribers keyed by Bluesnap account id + last four card digits."""
    sub = subscribers(spark, sf_dir)
    return sub.withColumn("card_token", F.expr(BSUB_TOKEN_EXPR))


def skewed_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ssub``: ``sub`` with 30 % of rows on one blank card token, subscription id and email."""
    return subscribers(spark, sf_dir).withColumns({a: F.expr(e) for a, e in SKEW_EXPRS})


def _extra_row(spark: SparkSession, names: list[str], values: tuple) -> DataFrame:
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([values], schema)


def stripe_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``map``: Stripe vault mapping with the vault's dotted header.

    Orders whose key is a multiple of 25 get a second card row (fan-out duplicates); one in ten
    orders has no card at all; one card row matches no subscriber.
    """
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    doubled = _spread(orders).withColumn("d", F.explode(F.array(F.lit(0), F.lit(1)))).where(MAP_FILTER)
    rows = doubled.selectExpr(*[f"{e} AS `{a}`" for a, e in MAP_EXPRS])
    return rows.unionByName(_extra_row(spark, [a for a, _ in MAP_EXPRS], MAP_EXTRA_ROW))


def bluesnap_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bmap``: Bluesnap vault mapping; the last row repeats the derived key of order 7."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = _spread(orders).where(BMAP_FILTER).selectExpr(*[f"{e} AS `{a}`" for a, e in BMAP_EXPRS])
    return rows.unionByName(_extra_row(spark, [a for a, _ in BMAP_EXPRS], BMAP_EXTRA_ROW))


# ---- DuckDB text of the same views (used by the oracle SQL) ----------------------------------

def duck_sub_sql() -> str:
    return (
        "SELECT " + ", ".join(sub_select_list('"')) +
        " FROM orders JOIN customer ON o_custkey = c_custkey"
    )


def duck_bsub_sql() -> str:
    return f"SELECT * REPLACE ({BSUB_TOKEN_EXPR} AS card_token) FROM sub"


def duck_ssub_sql() -> str:
    return "SELECT * REPLACE (" + ", ".join(f"{e} AS {a}" for a, e in SKEW_EXPRS) + ") FROM sub"


def _duck_literal(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def duck_map_sql() -> str:
    sel = ", ".join(f'{e} AS "{a}"' for a, e in MAP_EXPRS)
    extra = ", ".join(f'{_duck_literal(v)} AS "{a}"' for (a, _), v in zip(MAP_EXPRS, MAP_EXTRA_ROW))
    return (
        f"SELECT {sel} FROM orders, (SELECT unnest([0, 1]) AS d) x WHERE {MAP_FILTER} "
        f"UNION ALL SELECT {extra}"
    )


def duck_bmap_sql() -> str:
    sel = ", ".join(f'{e} AS "{a}"' for a, e in BMAP_EXPRS)
    extra = ", ".join(f'{_duck_literal(v)} AS "{a}"' for (a, _), v in zip(BMAP_EXPRS, BMAP_EXTRA_ROW))
    return f"SELECT {sel} FROM orders WHERE {BMAP_FILTER} UNION ALL SELECT {extra}"
