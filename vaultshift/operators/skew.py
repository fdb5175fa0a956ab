"""Skew-safe join and grouping building blocks.

Any key may hold a large share of the rows (blank card tokens, one shared test email, a blank
subscription id). The join counts rows per key with a partial (map-side) aggregation, which is skew-proof,
and treats *hot* keys apart: keys with at least ``hot_rows`` rows on one side, or with
at least ``PAIRS_PER_ROW * hot_rows`` joined pairs.

* The hot table is part of the plan, no job runs while a query is built. It holds the ``MAX_HOT_KEYS`` keys with
  the most rows or pairs at most, so its broadcast is bounded; a key beyond them has at most a 100 000th of
  a side's rows and is treated as cold. A run that materialises fetches the table instead and plans without
  the grid when it is empty.
* Every key is a grid of cells, and rows are hash-partitioned by key and cell. A cold key is one cell, a group of
  fewer than ``hot_rows`` rows a side and fewer than ``PAIRS_PER_ROW * hot_rows`` pairs.
* Hot keys are split on a salted grid whose cells hold at most about ``PAIRS_PER_ROW * hot_rows`` pairs and
  ``hot_rows`` rows of a side. Left rows of a hot key without partner are spread over its rows.

Group sizes over joined rows (duplicate emails, duplicate subscription ids) come from narrow statistics:
a left row yields as many joined rows as its key has on the right, so sizes are sums of that fan-out over
left rows, and the wide rows are joined once, for the report itself.

Salts are hashes of stable row ids, never random numbers, so a recomputed task after an executor
loss puts every row in the same cell again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
PAIRS_PER_ROW = 100
MAX_HOT_KEYS = 100_000


def _ceil_div(n: Column, d: int) -> Column:
    return F.greatest(F.lit(1), ((n + F.lit(d - 1)) / F.lit(d)).cast("long")).cast("int")


def skew_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_uid: str,
    right_uid: str,
    left_aggs: Sequence[tuple[str, Column]] = (),
    right_aggs: Sequence[tuple[str, Column]] = (),
    hot_rows: int = DEFAULT_HOT_ROWS,
    fetch: bool = False,
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """``left ⟕ right`` on ``key`` with per-key statistics attached to every output row.

    Both inputs must have non-null keys. Output: all left columns, all right columns except the
    key (null when unmatched), ``_ln`` (left rows of the key), ``_rn`` (right rows of the key, 0
    when unmatched) and the named ``left_aggs`` / ``right_aggs`` (aggregate expressions over the
    rows of the key on that side; right ones are null when unmatched). ``fetch``: look at the hot table now
    (one job) and plan without the grid if it is empty. ``left_keys`` / ``right_keys``: the same rows with fewer
    columns (the key, and what ``left_aggs`` reads), from which rows per key are counted.
    """
    left_keys, right_keys = (left if left_keys is None else left_keys), (right if right_keys is None else right_keys)
    lagg = [("_ln", F.count(F.lit(1)))] + list(left_aggs)
    ragg = [("_rn", F.count(F.lit(1)))] + list(right_aggs)
    lnames, rnames = [n for n, _ in lagg], [n for n, _ in ragg]
    ln, rn = F.coalesce(F.col("_ln"), F.lit(0)), F.coalesce(F.col("_rn"), F.lit(0))
    most_pairs = PAIRS_PER_ROW * hot_rows

    def hot_table(rows: DataFrame, aggs: list) -> DataFrame:
        """Hot keys with their statistics as one column; those of the right side from ``rows``."""
        l = left_keys.groupBy(key).agg(*[e.alias(n) for n, e in lagg])
        r = rows.groupBy(key).agg(*[e.alias(n) for n, e in aggs])
        hot = l.join(r, key, "full").where((ln >= hot_rows) | (rn >= hot_rows) | (ln * rn >= most_pairs))
        hot = hot.orderBy(F.desc(F.greatest(ln, rn, ln * rn)), key).limit(MAX_HOT_KEYS)
        return hot.select(key, F.struct(*lnames, *[n for n, _ in aggs]).alias("_h"))

    l_hot = hot_table(right, ragg)
    r_hot = hot_table(right_keys, ragg[:1])  # only sizes
    if fetch:
        found = l_hot.collect()
        l_hot = r_hot = l_hot.sparkSession.createDataFrame(found, l_hot.schema) if found else None

    right_cols = [c for c in right.columns if c != key]
    order = [*left.columns, *lnames, *right_cols, *rnames]
    if l_hot is None:
        # one hash exchange per side; the window statistics reuse that partitioning
        w = Window.partitionBy(key)
        l = left.select("*", *[e.over(w).alias(n) for n, e in lagg])
        r = right.select("*", *[e.over(w).alias(n) for n, e in ragg])
        return l.join(r, key, "left").select(*order).withColumn("_rn", F.coalesce(F.col("_rn"), F.lit(0)))

    # The grid: a left row sits in row ``_gi`` and is copied to every column, a right row in column ``_gj`` and
    # copied to every row, so each pair meets in exactly one cell. A cold key is a grid of one cell, and its
    # statistics are windows over that cell; those of a hot key come with the hot table. A side small enough
    # beside the other is not split.
    side = max(1, int(most_pairs ** 0.5))
    n_l, n_r = (F.coalesce(F.col(f"_h.{n}"), F.lit(0)) for n in ("_ln", "_rn"))
    sl = F.when(n_r < side, _ceil_div(n_l * n_r, most_pairs)).otherwise(_ceil_div(n_l, side))
    sr = F.when(n_l < side, _ceil_div(n_l * n_r, most_pairs)).otherwise(_ceil_div(n_r, side))
    is_hot = F.col("_h").isNotNull()
    rows_, columns = (F.when(is_hot, F.greatest(s, _ceil_div(n, hot_rows))).otherwise(1) for s, n in ((sl, n_l), (sr, n_r)))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    one_of = lambda uid, n: F.pmod(F.xxhash64(F.col(uid)), n.cast("long")).cast("int")
    w = Window.partitionBy(key, "_gi", "_gj")
    l = left.join(F.broadcast(l_hot), key, "left").withColumn("_gi", one_of(left_uid, rows_)).withColumn("_gj", every(columns))
    l = l.select("*", *[F.when(is_hot, F.col(f"_h.{n}")).otherwise(e.over(w)).alias(n) for n, e in lagg])
    r = right.join(F.broadcast(r_hot), key, "left").withColumn("_gj", one_of(right_uid, columns)).withColumn("_gi", every(rows_))
    r = r.select(key, "_gi", "_gj", *right_cols, *[e.over(w).alias(n) for n, e in ragg])
    out = l.join(r, [key, "_gi", "_gj"], "left")
    # a hot key's left row without partner in one cell has them in others
    out = out.where(~(is_hot & (n_r > 0) & F.col(right_uid).isNull()))
    stats = {n: F.when(is_hot, F.col(f"_h.{n}")).otherwise(F.col(n)) for n in rnames}
    return out.select(*left.columns, *lnames, *right_cols, *[c.alias(n) for n, c in stats.items()]).withColumn("_rn", F.coalesce(F.col("_rn"), F.lit(0)))


def fan_out(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(cols, _rows): how many rows of ``left ⟕ right`` on ``key`` carry each combination of left columns, from
    rows per key and combination: both sides are aggregated before they meet."""
    mine = left.groupBy(key, *cols).agg(F.count(F.lit(1)).alias("_l"))
    theirs = right.groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    rows = F.col("_l") * F.greatest(F.coalesce(F.col("_r"), F.lit(0)), F.lit(1))
    return mine.join(theirs, key, "left").select(*cols, rows.alias("_rows"))


def rows_in_groups(df: DataFrame, key: str, fan: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` value more than one row has (nulls form a group of their own), by the
    fan-out (key, _rows) of the join that makes them. One semi-join, the last step of a plan, so that
    AQE splits the rows of a hot group."""
    shared = fan.groupBy(F.col(key).alias("_g")).agg(F.sum("_rows").alias("_n")).where(F.col("_n") > 1).select("_g")
    return df.join(shared, df[key].eqNullSafe(shared["_g"]), "left_semi")


def rows_in_groups_counts(fan: DataFrame, keys: dict[str, str]) -> DataFrame:
    """One row: for each name how many joined rows share their value of a column with another one (name ->
    column). All columns are counted in one pass over the fan-out."""
    values = F.array(*[F.struct(F.lit(name).alias("name"), F.col(col).cast("string").alias("value")) for name, col in keys.items()])
    sizes = fan.select(F.explode(values).alias("g"), "_rows").groupBy("g.name", "g.value").agg(F.sum("_rows").alias("n")).where("n > 1")
    return sizes.agg(*[F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).cast("long").alias(name) for name in keys])
