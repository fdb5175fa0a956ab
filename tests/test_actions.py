"""Concurrent submission of independent actions, and a run whose sinks are written together."""

import os

import pytest

from conftest import SF001
from vaultshift.plans import catalogue as C
from vaultshift.plans.actions import run_all
from vaultshift.plans.run import run_to_directory


def test_results_keep_input_order():
    assert run_all([lambda i=i: i * i for i in range(10)], max_parallel=4) == [i * i for i in range(10)]


def test_failure_is_raised_after_every_action_ran():
    ran = []

    def ok(i):
        def f():
            ran.append(i)
            return i
        return f

    def boom():
        raise RuntimeError("sink failed")

    with pytest.raises(RuntimeError, match="sink failed"):
        run_all([ok(0), boom, ok(2), ok(3)], max_parallel=2)
    assert sorted(ran) == [0, 2, 3]


def test_concurrent_jobs(spark):
    dfs = [spark.range(1000 * (i + 1)) for i in range(4)]
    assert run_all([df.count for df in dfs]) == [1000, 2000, 3000, 4000]


def _read_reports(root):
    out = {}
    for name in sorted(os.listdir(root)):
        lines = []
        for part in sorted(os.listdir(os.path.join(root, name))):
            if part.endswith(".csv"):
                with open(os.path.join(root, name, part), encoding="utf-8") as fh:
                    body = fh.read().splitlines()
                header, rows = body[0], body[1:]
                lines += rows
        out[name] = (header, sorted(lines))
    return out


def test_concurrent_sinks_write_the_same_reports(spark, tmp_path):
    results = {}
    for parallel in (1, 8):
        out = str(tmp_path / f"p{parallel}")
        res = run_to_directory(C.plain_migration(spark, SF001, seller_name="Fixture Seller"), out,
                               parallel_sinks=parallel, epoch=7)
        results[parallel] = (res["reports"], res["summary"], _read_reports(out))
    assert results[1][0] == results[8][0]
    assert results[1][1] == results[8][1]
    assert results[1][2] == results[8][2]
    assert all("_7" in n for n in results[1][0] if "production" in n)


def test_one_job_writes_what_single_writes_do(spark, tmp_path):
    """Every published report holds the lines that its own frame writes, over one file or many."""
    from vaultshift.plans import run as RUN
    from vaultshift.sources import csv_io as IO
    m = C.plain_migration(spark, SF001, seller_name="S", use_mapping_zip_codes=True, autocorrect_us_zip=True)
    many = run_to_directory(m, str(tmp_path / "many"), epoch=1, file_rows=200)
    m = C.plain_migration(spark, SF001, seller_name="S", use_mapping_zip_codes=True, autocorrect_us_zip=True)
    one = run_to_directory(m, str(tmp_path / "one"), epoch=1)
    got = _read_reports(str(tmp_path / "one"))
    assert got == _read_reports(str(tmp_path / "many")) and set(got) == set(one["reports"]) == set(many["reports"])
    assert max(len(os.listdir(tmp_path / "many" / n)) for n in many["reports"]) > 3
    m = C.plain_migration(spark, SF001, seller_name="S", use_mapping_zip_codes=True, autocorrect_us_zip=True)
    frames = {f"S_stripe_{r}": getattr(m, f) for r, (f, _) in RUN.OUTPUTS.items()}
    frames |= {IO.rule_report_name("S", r, False, 1): RUN.subscriber_report(m, r) for r in RUN.SUBSCRIBER_REPORTS if r != "incorrect_card_tokens"}
    frames |= {IO.rule_report_name("S", r + ("_after_autocorrect" if r == "invalid_us_zip_codes" else ""), False, 1): RUN.joined_report(m, r) for r in RUN.JOINED_REPORTS}
    for name, df in frames.items():
        IO.write_csv(df, str(tmp_path / "single" / name))
    want = {n: v for n, v in _read_reports(str(tmp_path / "single")).items() if v[1]}
    assert got == want
    sizes = {f["name"]: (f["size"], f["rows"]) for f in one["output_files"]}
    listed = {r["name"]: (r["size"], r["rows"]) for r in IO.report_manifest(spark, str(tmp_path / "one")).collect()}
    assert sizes == listed
    steps = {s["step"]: s for s in one["validation_results"]}
    assert steps["price_id_validation"]["download_file"] == "S_invalid_price_ids_production_1"


def test_counts_are_observed_by_the_write(spark, tmp_path):
    m = C.plain_migration(spark, SF001).materialize(str(tmp_path / "w"))
    observed = dict(m._observed)
    for df in (m.subscriber_counts, m.joined_counts):
        row = df.first().asDict()
        assert row == {k: observed[k] for k in row}


def _own_migration(spark):
    """60 subscribers on 60 cards: two in three share an email, every fifth has an unknown country, every seventh no card."""
    from vaultshift import constants as K
    from vaultshift.plans.pipeline import ROW_ID, Migration, MigrationOptions
    names = list(K.REQUIRED_SUBSCRIBER_COLUMNS)
    given = lambda i: {"customer_email": "shared@x.com" if i % 3 else f"u{i}@x.com", "customer_full_name": 'A, "B"' if i % 2 else " ", "address_country_code": "XYZ" if i % 5 == 0 else "BR",
                       "started_at": "2024-01-01T00:00:00Z", "current_period_started_at": "2024-01-01T00:00:00Z", "current_period_ends_at": "2025-01-01T00:00:00Z",
                       "subscription_external_id": f"s{i}", "card_token": f"c{i}", "price_id_1": "pri_1", "quantity_1": "1", "business_name": None if i % 4 else ""}
    subs = spark.createDataFrame([(i, *[given(i).get(n, "") for n in names]) for i in range(60)], f"{ROW_ID} long, " + ", ".join(f"`{n}` string" for n in names))
    vault = spark.createDataFrame([(f"c{i}", f"tok{i}") for i in range(60) if i % 7], "`card.id` string, `card.number` string")
    return Migration(subs, vault, MigrationOptions(seller_name="S", as_of="2024-06-01T00:00:00Z"))


_EXPECTED = {"S_stripe_final_import": {i for i in range(60) if i % 5 and i % 7}, "S_stripe_no_token_found": {i for i in range(60) if i % 7 == 0},
             "S_stripe_duplicate_emails": {i for i in range(60) if i % 3}, "S_invalid_address_country_codes_production_1": {i for i in range(60) if i % 5 == 0}}


@pytest.mark.parametrize("key_order", [False, True])
def test_a_run_keeps_no_shuffle_and_no_copy_it_has_done_with(spark, tmp_path, monkeypatch, key_order):
    """When the reports of a kind of rows are written, the shuffles of the rounds before are gone, and so are copies that
    no round still reads; every report is whole."""
    import csv
    import time

    from vaultshift.plans import run as RUN

    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (files.apply(k) for k in range(files.size())) if f.getName().startswith("shuffle_")}

    seen, delete, before = [], RUN.delete, shuffles()

    def watched(session, path):
        work = path if "/_work-" in path and "/" not in path.split("/_work-")[1] else path.rpartition("/")[0]
        until = time.time() + 20
        while shuffles() - before and time.time() < until:  # they go in the background
            time.sleep(0.1)
        seen.append((path.removeprefix(work).strip("/"), shuffles() - before, {x for x in os.listdir(work) if x in RUN.COPIES}))
        delete(session, path)

    monkeypatch.setattr(RUN, "delete", watched)
    spark.sparkContext._jvm.System.gc()
    out = str(tmp_path / "out")
    res = RUN.run_to_directory(_own_migration(spark), out, epoch=1, file_rows=7, key_order=key_order)
    assert [(name, left) for name, left, _ in seen if left] == []
    assert {name for name, _, _ in seen} == {"prepared_mapping", "joined", ""} and seen[-1][2] == {"prepared_subscribers"}
    assert sorted(os.listdir(out)) == sorted(res["reports"])
    got = {}
    for name in _EXPECTED:
        parts = [csv.DictReader(open(f"{out}/{name}/{f}", encoding="utf-8", newline="")) for f in os.listdir(f"{out}/{name}") if f.endswith(".csv")]
        got[name] = [int(r["subscription_external_id"][1:]) for p in parts for r in p]
    assert got == {n: sorted(v, key=got[n].index) for n, v in _EXPECTED.items()}
    assert {f["name"]: f["rows"] for f in res["output_files"]}.items() >= {n: len(v) for n, v in _EXPECTED.items()}.items()


def test_the_setting_of_a_run_is_put_back(spark, tmp_path):
    from vaultshift.session import RELEASE_CONF, shuffles_released
    before = spark.conf.get(RELEASE_CONF)
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        assert spark.conf.get(RELEASE_CONF) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(RELEASE_CONF) == before


def test_blank_cells_are_bare(spark, tmp_path):
    """Blank cells are written as the reference writes them (nothing between the commas), null or '' alike; other cells
    come back as they were."""
    import csv

    from vaultshift.sources import csv_io as IO
    run_to_directory(_own_migration(spark), str(tmp_path / "run"), epoch=1)
    folder = tmp_path / "run" / "S_invalid_address_country_codes_production_1"
    (text,) = [p.read_text(encoding="utf-8") for p in folder.glob("*.csv")]
    rows = list(csv.DictReader(text.splitlines()))
    assert ',"",' not in text and ",," in text and len(rows) == 12
    assert {(r["customer_full_name"], r["business_name"]) for r in rows} == {('A, "B"', ""), (" ", "")}
    one = spark.createDataFrame([("",), ("x",)], "a string")  # a blank line would be no record
    IO.write_csv(one.coalesce(1), str(tmp_path / "one"))
    assert IO.record_count(spark, str(tmp_path / "one")).first()["n"] == 2
