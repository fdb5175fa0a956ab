"""Rules added by the caller: steps, counts, reports and removal follow from plain columns."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from vaultshift import Migration, UserRule
from vaultshift.plans import report_queries as RQ
from vaultshift.plans.run import run_to_directory
from vaultshift.plans.summary import validation_envelope, validation_summary


def test_removal_equals_brute_force_and_warnings_remove_nothing(spark):
    m, plain = RQ._user_run(spark, SF001), RQ._run(spark, SF001)
    rows = m.joined_all.select("_temp_row_id", "_row_failed", *[r.flag for r in RQ.user_rules()]).collect()
    before = {r._temp_row_id: r._row_failed for r in plain.joined_all.select("_temp_row_id", "_row_failed").collect()}
    fails = {r._temp_row_id for r in rows if r._u_customer_name or r._u_card_expiry}
    assert fails and any(r._u_long_email for r in rows)
    assert all(r._row_failed == (before[r._temp_row_id] or r._temp_row_id in fails) for r in rows)
    assert len(rows) == plain.joined_all.count()


def test_reports_and_steps_of_a_run(spark, tmp_path):
    m = RQ._user_run(spark, SF001)
    res = run_to_directory(Migration(m.subscribers, m.mapping, m.options.with_(seller_name="S"), RQ.user_rules()), str(tmp_path / "out"))
    steps = {s["step"]: s for s in res["validation_results"]}
    assert steps["customer_name_validation"]["incorrect_count"] > 0 and steps["card_expiry_validation"]["total_records"] > 0
    assert any("_customer_name_" in n for n in res["reports"]) and any("_card_expiry_" in n for n in res["reports"])
    assert all(os.path.exists(str(tmp_path / "out" / n)) for n in res["reports"])
    envelope = {r.step: r for r in validation_envelope(m).collect()}
    assert envelope["card_expiry_validation"].report == "card_expiry"


def test_rules_are_checked(spark):
    with pytest.raises(ValueError, match="stage"):
        UserRule("x", "final", F.lit(True))
    with pytest.raises(ValueError, match="identifier"):
        UserRule("a b", "joined", F.lit(True))
    m = RQ._run(spark, SF001)
    with pytest.raises(ValueError, match="repeat"):
        Migration(m.subscribers, m.mapping, m.options, (UserRule("x", "joined", F.lit(True)), UserRule("x", "subscriber", F.lit(True))))
    nulls = Migration(m.subscribers, m.mapping, m.options, (UserRule("n", "subscriber", F.lit(None).cast("boolean")),))
    step = [s for s in validation_summary(nulls).collect() if s.step == "n_validation"][0]
    assert step.valid and step.incorrect_count == 0 and step.total_records == m.subscribers.count()
