"""Golden counts (FIXTURES.md §2), skew-path equivalence, invariants and plan shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from vaultshift.plans import catalogue as C

GOLDEN = {
    "country_format": 750, "unsupported_country": 375, "price_id_prefix": 1157, "quantity": 2734,
    "date_format": 1301, "date_period": 11567, "missing_postal": 2516, "fillable_from_mapping": 1730,
    "ca_postal": 1509, "us_postal": 2498, "us_autocorrectable": 1043, "no_token": 2462,
    "duplicate_tokens": 1348, "duplicate_subscription_ids": 1619, "duplicate_emails": 15516,
    "removed": 14711, "success": 807, "joined_rows": 15593, "rows_with_email": 15518,
}


@pytest.fixture(scope="module")
def metrics(spark):
    m = C.plain_migration(spark, SF01).materialize()
    return {r["metric"]: r["value"] for r in m.metrics.collect()}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden(metrics, name):
    assert metrics[name] == GOLDEN[name]


@pytest.mark.parametrize("provider", ["stripe", "bluesnap"])
def test_hot_key_grid_matches_plain_join(spark, provider):
    cols = ["_temp_row_id", "_m_uid", "_row_failed", "is_duplicate_token", "_postal_final", "_m_token"]
    out = []
    for hot in (1_000_000, 2):
        m = C.plain_migration(spark, SF001, provider, hot_rows=hot, use_mapping_zip_codes=True,
                              autocorrect_us_zip=True)
        out.append(sorted(tuple(r) for r in m.joined_all.select(*cols).collect()))
    assert out[0] == out[1]


@pytest.mark.parametrize("opts", [{}, {"use_mapping_zip_codes": True, "autocorrect_us_zip": True}])
def test_removal_matches_bruteforce_rollup(spark, opts):
    """D4 from per-key statistics equals any-failure over every joined row of the subscriber row."""
    m = C.plain_migration(spark, SF001, **opts).materialize()
    j = m.joined_all.withColumn(
        "_any", F.col("_s_failed") | F.col("_f_missing") | F.col("_f_ca") | F.col("_f_us") | F.col("_f_no_token"))
    brute = j.groupBy("_temp_row_id").agg(F.max("_any").alias("b"))
    mism = j.join(brute, "_temp_row_id").where(F.col("b") != F.col("_row_failed")).count()
    assert mism == 0


def test_invariants(spark):
    m = C.migration(spark, SF001)
    success_ids = m.completed.where(~F.col("_row_failed")).select("_temp_row_id").distinct()
    failed_ids = m.completed.where(F.col("_row_failed")).select("_temp_row_id").distinct()
    assert success_ids.join(failed_ids, "_temp_row_id").count() == 0
    assert m.completed.where(~F.col("_row_failed") & F.col("_token").isNull()).count() == 0
    s = m.run_summary.first()
    assert s.success_count + s.removed_rows == s.joined_rows


def test_plan_has_no_python(spark):
    plan = C.plain_migration(spark, SF001).joined_all._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("limit", [0, 100_000])
def test_key_hot_by_pairs_and_hot_set_too_large_to_fetch(spark, monkeypatch, limit):
    """One key with 60 rows on both sides, others with few or no partners; the hot set beyond its
    broadcast limit is joined by shuffle. Same rows either way as a plain join."""
    from vaultshift.operators import skew
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", limit)
    left = spark.createDataFrame([(i, "h" if i < 60 else f"k{i % 40}") for i in range(200)] + [(300 + i, "lonely") for i in range(50)], "u long, k string")
    right = spark.createDataFrame([(i, "h" if i < 60 else f"k{i % 50}") for i in range(150)], "v long, k string")
    got = skew.skew_left_join(left, right, "k", "u", "v", right_aggs=[("_top", F.max("v"))], hot_rows=10)
    stats = right.groupBy("k").agg(F.count("*").alias("_rn"), F.max("v").alias("_top"))
    want = left.join(left.groupBy("k").agg(F.count("*").alias("_ln")), "k").join(right, "k", "left").join(stats, "k", "left").fillna(0, ["_rn"])
    cols = ["u", "k", "v", "_ln", "_rn", "_top"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


def test_building_a_query_writes_nothing(spark, tmp_path):
    """Queries are lazy plans: no intermediate is written for them; counts need no row-id shuffle."""
    import os
    before = set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
    for name in ("layout_stripe", "failed_rows", "fix_counts", "run_summary_stripe", "duplicate_emails_surviving", "final_import_bluesnap", "no_token_skewed"):
        C.QUERIES[name](spark, SF001)
    assert set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))) == before
    m = C.plain_migration(spark, SF001).materialize(str(tmp_path / "copies"))
    plan = m.joined_counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("FileScan") == 1
    wide = m.wide_metrics(["us_postal", "missing_postal"])._jdf.queryExecution().executedPlan().toString()
    assert wide.count("FileScan") == 1


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


@pytest.mark.parametrize("name", ["run_summary_stripe", "duplicate_emails", "duplicate_emails_surviving", "duplicate_subscription_ids",
                                  "validation_summary", "validation_envelope", "no_token_skewed", "output_duplicate_card_ids"])
def test_one_wide_join_and_no_job_while_building(spark, name):
    """The vault's card number is read for the wide join alone: once a query. Building reads file footers
    (one job a table) and, where a query writes files, those files."""
    from vaultshift.plans import report_queries as RQ
    before = _jobs(spark)
    run = {"validation_envelope": lambda: RQ.validation_envelope(RQ._run(spark, SF001)),
           "output_duplicate_card_ids": lambda: RQ._run(spark, SF001).duplicate_card_ids}.get(name, lambda: C.QUERIES[name](spark, SF001))
    df = run()
    assert _jobs(spark) - before <= 4
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # joins of joined rows on the grid (fan-out and hot-key tables are joined on the key alone)
    assert plan.count("Join LeftOuter, (((_key") == 1, plan


def test_join_shuffles_each_side_once(spark):
    """Without hot keys the joined rows need exactly two hash exchanges (one per side, on the card
    key); the duplicate flags and the removal roll-up reuse that partitioning."""
    m = C.plain_migration(spark, SF001)
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m.materialize()  # inputs become Parquet copies; the joined plan below starts from them
        m.__dict__.pop("joined_all", None)
        m.__dict__.pop("keyed_subscribers", None)
        plan = m.joined_all._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning(_key") == 2, plan
    assert plan.count("Exchange") == 2, plan
