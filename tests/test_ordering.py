"""Key-ordered output: order over all files, even files under a hot key, ordered final import of a run."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from vaultshift.operators.ordering import key_ordered
from vaultshift.plans import catalogue as C
from vaultshift.plans.run import run_to_directory


def test_a_hot_key_spreads_over_ranges(spark):
    key = F.when(F.col("id") % 10 < 3, F.lit("hot")).when(F.col("id") % 997 == 0, F.lit(None)).otherwise(F.sha1(F.col("id").cast("string")))
    df = spark.range(60_000, numPartitions=7).select(key.alias("k"), F.col("id").alias("row"))
    parts = [[(r.k or "", r.row) for r in p] for p in key_ordered(df, ["k"], ["row"], 12).rdd.glom().collect()]
    sizes = sorted(map(len, parts))
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and sum(1 for p in parts if any(k == "hot" for k, _ in p)) >= 3
    flat = [r for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 60_000


def test_repeated_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", 1), (None, 2)], "k string, row long")
    assert [(r.k, r.row) for r in key_ordered(df, ["k"], ["row"], 3).collect()] == [(None, 2), ("a", 1), ("b", 1), ("b", 1)]
    assert key_ordered(df.limit(0), ["k"], ["row"], 3).count() == 0


def test_a_run_writes_its_final_import_in_key_order(spark, tmp_path):
    runs = {}
    for ordered in (False, True):
        out = str(tmp_path / str(ordered))
        res = run_to_directory(C.plain_migration(spark, SF001, seller_name="S"), out, epoch=1, file_rows=20, key_order=ordered)
        (name,) = [n for n in res["reports"] if n.endswith("final_import")]
        files = sorted(os.listdir(f"{out}/{name}"))
        assert [f for f in files if f.endswith(".csv")] == [f"part-{k:05d}.csv" for k in range(len([f for f in files if f.endswith(".csv")]))]
        bodies = [open(f"{out}/{name}/{f}", encoding="utf-8").read().splitlines() for f in files if f.endswith(".csv")]
        assert len({b[0] for b in bodies}) == 1
        at = bodies[0][0].split(",").index("card_id")
        runs[ordered] = [line for b in bodies for line in b[1:]], [line.split(",")[at] for b in bodies for line in b[1:]], res["reports"]
    assert len(runs[True][0]) > 40 and sorted(runs[True][0]) == sorted(runs[False][0]) and runs[True][2] == runs[False][2]
    assert runs[True][1] == sorted(runs[True][1]) != runs[False][1]
