"""CSV scans lose no cell: quoting, encodings, headers, row lengths; report names and manifest."""

import os

import pytest

from vaultshift.sources import csv_io as IO


def test_subscriber_scan(spark, tmp_path):
    p = tmp_path / "subs.csv"
    p.write_text('customer_email,address_postal_code,note\n'
                 'a@x.com,02134,"comma, inside"\n'
                 '_,,"line\nbreak"\n'
                 '"b@x.com"," 10001 ","say ""hi"""\n', encoding="utf-8")
    df = IO.scan_subscribers(spark, str(p))
    rows = [tuple(r) for r in df.drop("_temp_row_id").collect()]
    assert rows == [("a@x.com", "02134", "comma, inside"), (None, "", "line\nbreak"),
                    ("b@x.com", " 10001 ", 'say "hi"')]
    assert df.select("_temp_row_id").distinct().count() == 3


@pytest.mark.parametrize("multi_line", [True, False])
def test_mapping_scan_latin1_and_na(spark, tmp_path, multi_line):
    p = tmp_path / "map.csv"
    p.write_bytes('card.id,card.name,card.address_zip\nc1,Jos\xe9,NA\nc2,None,\nc3,Null,02134\n'.encode("latin-1"))
    df = IO.scan_mapping(spark, str(p), multi_line)
    assert df.columns == ["card.id", "card.name", "card.address_zip"]
    assert [tuple(r) for r in df.collect()] == [("c1", "José", None), ("c2", None, None), ("c3", "Null", "02134")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_reordered_headers_are_read_by_name(spark, tmp_path, multi_line):
    (tmp_path / "1.csv").write_text('a,b\n1,2\n"3","4,5"\n')
    (tmp_path / "2.csv").write_text("b,a\n7,6\n")
    (tmp_path / "3.csv").write_text("a,b\n8,9\n")
    df = IO.scan_subscribers(spark, str(tmp_path / "*.csv"), multi_line).drop("_temp_row_id")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("3", "4,5"), ("6", "7"), ("8", "9")]
    (tmp_path / "4.csv").write_text("a,c\n8,9\n")
    with pytest.raises(ValueError, match="columns differ"):
        IO.scan_subscribers(spark, str(tmp_path), multi_line)


@pytest.mark.parametrize("multi_line", [True, False])
def test_row_lengths(spark, tmp_path, multi_line):
    (tmp_path / "short.csv").write_text("a,b,c\n1,2\n3,4,5\n")
    df = IO.scan_subscribers(spark, str(tmp_path / "short.csv"), multi_line).drop("_temp_row_id")
    assert [tuple(r) for r in df.collect()] == [("1", "2", ""), ("3", "4", "5")]
    (tmp_path / "long.csv").write_text('a,b,c\n1,2,3\n4,"5,5",6,7\n')
    df = IO.scan_subscribers(spark, str(tmp_path / "long.csv"), multi_line)
    for run in (df.count, df.select("a").collect):
        with pytest.raises(Exception, match="more cells than the header"):
            run()


def test_quoted_line_breaks_are_never_split_silently(spark, tmp_path):
    for i, body in enumerate(('a,b,c\n"x\ny",2,3\n', 'a,b,c\n1,2,"x\ny"\n')):
        p = tmp_path / f"{i}.csv"
        p.write_text(body)
        assert IO.scan_subscribers(spark, str(p)).count() == 1
        with pytest.raises(Exception, match="multi_line=True"):
            IO.scan_subscribers(spark, str(p), multi_line=False).count()


@pytest.mark.parametrize("multi_line", [True, False])
def test_audit_lines_follow_files_and_rows(spark, tmp_path, multi_line):
    head = "address_country_code,address_postal_code\n"
    for name, n, start in (("a", 3000, 0), ("b", 5, 3000), ("c", 900, 3005)):
        (tmp_path / f"{name}.csv").write_text(head + "".join(f"US,{start + i + 1}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = IO.scan_audit(spark, str(tmp_path), multi_line).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.line for r in rows) == list(range(1, 3906))
    assert all(r.line == int(r.address_postal_code) for r in rows)


def test_audit_scan_needs_its_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="Required columns"):
        IO.scan_audit(spark, str(tmp_path / "x.csv"))


def test_report_writer_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("v1.0", None, True), ("nan", "x", False)], "a string, b string, f boolean")
    out = str(tmp_path / "reports" / "demo_report")
    IO.write_csv(df, out)
    back = spark.read.option("header", True).csv(out)
    assert sorted((tuple(r) for r in back.collect()), key=repr) == sorted(
        [("v1", None, "True"), (None, "x", "False")], key=repr)
    man = IO.report_manifest(spark, str(tmp_path / "reports")).collect()
    assert man[0]["name"] == "demo_report" and man[0]["size"] > 0
    assert os.path.isdir(out)


def test_output_names():
    assert IO.output_base_name("Acme Inc.! ", "Stripe", True) == "Acme_Inc_stripe_sandbox"
    assert IO.output_base_name("", "bluesnap", False, "/x/subs.csv") == "subs_bluesnap"
