"""Spark queries against their DuckDB oracles (the driver's correctness gate) on sf0.001."""

import pytest

from conftest import SF001

KEY_QUERIES = ["rule_country_format", "rule_date_period", "rule_missing_postal", "no_token", "postal_audit",
               "join_bluesnap", "duplicate_subscription_ids", "final_import_stripe", "final_import_stripe_fixed",
               "validation_summary", "run_summary_stripe", "run_summary_bluesnap", "scan_subscribers",
               "scan_mapping"]


@pytest.fixture(scope="module")
def results(spark):
    from tools.oracle_compare import compare
    return compare(spark, SF001, KEY_QUERIES)


@pytest.mark.parametrize("name", KEY_QUERIES)
def test_oracle(results, name):
    assert results[name][0] == "ok", results[name]


def test_every_query_has_an_oracle_or_is_rows_only():
    import __spark_entry__ as E
    from vaultshift.plans import catalogue as C
    missing = set(C.QUERIES) - set(E.oracle_sql())
    assert missing == set()
