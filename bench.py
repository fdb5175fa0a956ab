"""Benchmark: headline migration queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: seconds}, "sf", ...}.
Each query is timed from plan construction to the last row (materialisation included), after one
warm-up run of the flagship query; the value is the sum over queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vaultshift.plans import catalogue as C  # noqa: E402
from vaultshift.plans.pipeline import ROW_ID, Migration, MigrationOptions  # noqa: E402
from vaultshift.plans.run import run_to_directory  # noqa: E402
from vaultshift.plans.summary import validation_summary  # noqa: E402
from vaultshift.session import local_session  # noqa: E402
from vaultshift.sources import fixtures as FX  # noqa: E402


def _skewed(spark, d):
    """The fixture with 30 % blank card tokens, subscription ids and one shared email: the
    adversarial case for duplicate detection and the join (one key holds a third of the rows)."""
    sub = FX.subscribers(spark, d).withColumnRenamed("row_id", ROW_ID)
    hot = (F.col(ROW_ID) % 10) < 3
    sub = sub.withColumns({
        "card_token": F.when(hot, F.lit("")).otherwise(F.col("card_token")),
        "subscription_external_id": F.when(hot, F.lit("")).otherwise(F.col("subscription_external_id")),
        "customer_email": F.when(hot, F.lit("shared@example.com")).otherwise(F.col("customer_email")),
    })
    return Migration(sub, FX.stripe_mapping(spark, d), MigrationOptions(as_of=FX.FIXTURE_AS_OF, hot_rows=100_000))


def _replicated(spark, d, copies):
    """The fixture replicated ``copies`` times (distinct row ids, card ids and subscription ids)."""
    sub = FX.subscribers(spark, d).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    sub = sub.withColumns({
        ROW_ID: F.col("row_id") * copies + F.col("_c"),
        "card_token": F.when(F.col("card_token") == "", "").otherwise(F.concat("card_token", F.lit("_"), "_c")),
        "subscription_external_id": F.concat("subscription_external_id", F.lit("_"), "_c"),
    }).drop("row_id", "_c")
    mp = FX.stripe_mapping(spark, d).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    mp = mp.withColumn("card.id", F.concat(F.col("`card.id`"), F.lit("_"), "_c")).drop("_c")
    return Migration(sub, mp, MigrationOptions(as_of=FX.FIXTURE_AS_OF))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    scratch = tempfile.mkdtemp(prefix="vaultshift-bench-")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    def final_import_csv():
        res = run_to_directory(C.plain_migration(spark, sf_dir), os.path.join(scratch, "out", str(time.time_ns())))
        return res["reports"]

    def skew_duplicates():
        m = _skewed(spark, sf_dir).materialize()
        return [m.run_summary.collect(), m.duplicate_emails.count(), m.duplicate_subscription_ids.count()]

    def capacity():
        copies = max(1, -(-1_000_000 // C.FX.subscribers(spark, sf_dir).count()))
        return _replicated(spark, sf_dir, copies).materialize().run_summary.collect()

    plan = {
        "run_summary_stripe": lambda: C.q_run_summary_stripe(spark, sf_dir).collect(),
        "final_import_stripe_csv": final_import_csv,
        "validation_summary": lambda: validation_summary(C.migration(spark, sf_dir)).collect(),
        "duplicate_emails": lambda: C.q_duplicate_emails(spark, sf_dir).count(),
        "duplicate_subscription_ids": lambda: C.q_duplicate_subscription_ids(spark, sf_dir).count(),
        "run_summary_bluesnap": lambda: C.q_run_summary_bluesnap(spark, sf_dir).collect(),
        "final_import_stripe_fixed": lambda: C.q_final_import_stripe_fixed(spark, sf_dir).count(),
        "skew_30pct_blank_keys": skew_duplicates,
        "capacity_1m_subscribers": capacity,
    }
    plan["run_summary_stripe"]()  # warm-up (JVM, codegen caches)
    times = {}
    for name, fn in plan.items():
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "migration_headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
