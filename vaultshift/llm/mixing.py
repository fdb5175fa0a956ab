"""Mixing sources to target weights: Efraimidis-Spirakis sampling under token budgets.

Every source gets a target number of words. The whole epochs that fit come first (every document
``floor(target / source size)`` times); the rest of the target is filled by a weighted sample without
replacement: a document's key is ``-ln(u) / w`` (``u`` uniform from a hash of its id and the seed,
``w`` its quality weight), documents are sorted by key within their source, and those whose midpoint in
the running sum of sizes lies below the rest are taken, which leaves at most half a document of error.

Only the keys near the cut need exact order. Keys are spread over ``buckets`` ranges a source (a
monotone function of the key), sizes are pre-aggregated per range, and only the one range that holds
the cut is sorted; so a source with a third of all rows costs one ``buckets``-th of its rows in a window.
All expressions are DataFrame functions.

Defined cases: null text has size 0; a null source is a source of its own, last in order; a source
without words has target 0; documents of size 0 are taken 0 words; repeated rows and equal keys share
one key and are ordered by id and size, so reruns agree; an empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MAX_EPOCHS = 3
CYCLE = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Weight in (0, 1]: falls with the number of symbols a word."""
    return F.lit(1.0) / (F.lit(1.0) + F.coalesce(F.regexp_count(text, F.lit(SYMBOL)), F.lit(0)) / F.greatest(size, F.lit(1)))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 52 bits of md5(seed:id)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS, cycle: int = CYCLE) -> DataFrame:
    """(source, source_size) -> plus target: shares by weights 1..cycle repeating in source order of the
    sum of sizes, never over ``max_epochs`` times the source; the excess is shared again by weight.

    With sources sorted by cap over weight, the k smallest are at their cap and the others at a common
    level; running sums give the level each source would end the list of capped ones with.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    s = sizes.withColumn("w", ((F.row_number().over(order) - 1) % cycle + 1).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * max_epochs)
    every = Window.partitionBy()
    by = Window.orderBy(F.col("cap") / F.col("w"), "w", "cap").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "capped_before": F.coalesce(F.sum("cap").over(by), F.lit(0)),
        "w_left": F.sum("w").over(every) - F.coalesce(F.sum("w").over(by), F.lit(0)),
        "all": F.sum("source_size").over(every),
    })
    s = s.withColumn("left", F.col("all") - F.col("capped_before"))
    s = s.withColumn("free", F.col("left") * F.col("w") <= F.col("cap") * F.col("w_left"))
    first = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), "w", "cap", "left", "w_left"))).over(every)
    s = s.withColumn("lv", first)
    return s.select("source", "source_size", F.when(
        F.col("lv").isNull() | (F.col("cap") * F.col("lv.w_left") <= F.col("lv.left") * F.col("w")), F.col("cap").cast("double")
    ).otherwise(F.col("lv.left") * F.col("w") / F.col("lv.w_left")).alias("target"))


def mix(docs: DataFrame, scratch: Scratch, buckets: int = 1024, seed: str = SEED) -> DataFrame:
    """(doc_id, source, text) -> doc_id, size, source_size, target, taken."""
    base = docs.select("doc_id", "source", "text").withColumn("size", word_count(F.col("text")))
    base = base.withColumn("key", -F.log(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"), F.col("size")))
    base = base.withColumn("bucket", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * buckets).cast("long"))
    base = scratch.write(base.select("doc_id", "source", "size", "key", "bucket"), "sizes")
    sums = scratch.write(base.groupBy("source", "bucket").agg(F.sum("size").alias("n")), "sums")
    targets = scratch.write(source_targets(sums.groupBy("source").agg(F.sum("n").alias("source_size"))), "targets")

    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
    t = plan.select(F.col("source").alias("t_source"), "source_size", "target", "epochs", "rest")
    cut = sums.join(F.broadcast(t) if t.count() <= 100_000 else t, sums.source.eqNullSafe(t.t_source), "left")
    # the range whose sizes reach the rest; ranges before it are taken whole
    cut = cut.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest")))
    cut = cut.groupBy("t_source").agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("c"))
    plan = scratch.write(
        t.join(cut.withColumnRenamed("t_source", "c_source"), t.t_source.eqNullSafe(F.col("c_source")), "left")
        .select("t_source", "source_size", "target", "epochs", "rest",
                F.col("c.bucket").alias("cut"), F.col("c.before").alias("before")), "plan")
    hinted = F.broadcast(plan) if plan.count() <= 100_000 else plan
    x = base.join(hinted, base.source.eqNullSafe(plan.t_source), "left")
    in_cut = F.col("bucket") == F.col("cut")
    w = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = x.where(in_cut).withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(w), F.lit(0)))
    edge = edge.withColumn("picked", F.col("at") + F.col("size") / 2 < F.col("rest"))
    rest = x.where(F.col("cut").isNull() | ~in_cut).withColumn("at", F.lit(0).cast("long"))
    rest = rest.withColumn("picked", F.col("cut").isNotNull() & (F.col("bucket") < F.col("cut")) & (F.col("rest") > 0))
    out = edge.unionByName(rest)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * (F.col("epochs") + F.col("picked").cast("long"))).cast("long").alias("taken"))


#: The same rows in DuckDB: one window over each whole source instead of ranges.
SQL = r"""
WITH base AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
         (CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
keyed AS (SELECT *, -ln(u) / (1.0 / (1.0 + symbols / greatest(size, 1))) AS k FROM base),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w, 3 * source_size AS cap FROM src),
levels AS (
  SELECT a.source, (SELECT sum(source_size) FROM src) - coalesce(sum(b.cap), 0) AS amount,
         (SELECT sum(w) FROM weighed) - coalesce(sum(b.w), 0) AS w_left, a.cap, a.w
  FROM weighed a LEFT JOIN weighed b ON (b.cap / b.w, b.w, b.cap) < (a.cap / a.w, a.w, a.cap)
  GROUP BY a.source, a.cap, a.w),
lv AS (SELECT amount, w_left FROM levels WHERE amount * w <= cap * w_left ORDER BY cap / w, w, cap LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN (SELECT amount FROM lv) IS NULL OR cap * (SELECT w_left FROM lv) <= (SELECT amount FROM lv) * w
              THEN CAST(cap AS DOUBLE)
              ELSE CAST((SELECT amount FROM lv) * w AS DOUBLE) / CAST((SELECT w_left FROM lv) AS DOUBLE) END AS target
  FROM weighed),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets),
run AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND before + size / 2 < rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
