"""Quoted line breaks over many splits, against Python's csv module; headers by job; counts without parsing."""

import csv
import io
import random

import pytest

from vaultshift.sources import csv_io as IO
from vaultshift.sources import quoted_csv as Q


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rng):
    kind = rng.randrange(7)
    if kind == 0:
        return "".join(rng.choice('ab,"\n ') for _ in range(rng.randrange(12)))
    if kind == 1:
        return "\n".join("x" * rng.randrange(60) for _ in range(rng.randrange(1, 12)))
    return rng.choice(["", "1", "plain", 'say "hi"', "a,b", "é", "_x"])


def write(path, rows, columns):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerow(columns)
    w.writerows(rows)
    path.write_text(out.getvalue(), encoding="utf-8")


@pytest.mark.parametrize("seed", range(2))
def test_one_file_of_many_splits(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    rows = [[str(i), *(cell(rng) for _ in range(3))] for i in range(200)]
    rows += [["200", "y\n" * 700, "z", '"\n"' * 90]]  # records over many splits
    rows += [[str(201 + i), *(cell(rng) for _ in range(3))] for i in range(60)]
    write(tmp_path / "one.csv", rows, ["id", "a", "b", "c"])
    df = IO._scan(spark, str(tmp_path / "one.csv"), True, numbered=True)
    assert Q.lines_of(spark, str(tmp_path / "one.csv")).rdd.getNumPartitions() > 20
    got = [[*("" if v is None else v for v in r[:4]), r.line] for r in sorted(df.collect(), key=lambda r: r.line)]
    assert got == [[*r, k + 1] for k, r in enumerate(rows)]
    assert IO.record_count(spark, str(tmp_path)).first().n == len(rows)


def test_stray_quotes_in_bare_cells_open_nothing(spark, tmp_path):
    text = 'a,b\n12" pipe,x\n7" tube,"l1\nl2"\nq""r,s"t"u\n\n"x,""y""\n",3\n'
    (tmp_path / "q.csv").write_text(text)
    got = IO.scan_subscribers(spark, str(tmp_path)).drop(IO.ROW_ID).collect()
    assert [list(r) for r in got] == [r for r in list(csv.reader(io.StringIO(text)))[1:] if r]


def test_line_functions_follow_the_csv_module():
    rng = random.Random(1)
    for _ in range(4000):
        line = "".join(rng.choice('a",') for _ in range(rng.randrange(9)))
        for prefix, fn in (("", Q.opens), ('"', Q.stays_open)):
            try:
                list(csv.reader(io.StringIO(prefix + line), strict=False))
                rows = list(csv.reader(io.StringIO(prefix + line + "\nEND,OF\n")))
            except csv.Error:
                continue
            # a line that ends inside a cell swallows the next one
            assert fn(line) == (rows[-1] != ["END", "OF"]), (prefix, line)


def test_headers_are_grouped_by_a_job(spark, tmp_path, monkeypatch):
    for i in range(120):
        cols = ["a", "b", "c"] if i % 3 else ["c", "a", "b"]
        write(tmp_path / f"{i:03}.csv", [[f"{x}{i}" for x in cols], [f"{x}{i}\n!" for x in cols]], cols)
    headers, splits = Q.header_records(spark, str(tmp_path))
    assert headers == [("a,b,c", 80), ("c,a,b", 40)] and splits == 120
    got = {tuple(r) for r in IO._scan(spark, str(tmp_path), True).collect()}
    assert got == {tuple(f"{x}{i}{e}" for x in "abc") for i in range(120) for e in ("", "\n!")}
    assert sorted(r.line for r in IO._scan(spark, str(tmp_path), True, numbered=True).collect()) == list(range(1, 241))


def test_header_with_line_breaks_and_bom(spark, tmp_path, tiny_splits):
    head = '﻿"first\nname","' + "long\n" * 30 + '",c\n'
    (tmp_path / "h.csv").write_text(head + "1,2,3\n" + '4,"5\n",6\n', encoding="utf-8")
    df = IO._scan(spark, str(tmp_path), True)
    assert df.columns == ["first\nname", "long\n" * 30, "c"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", "3"), ("4", "5\n", "6")]
    (tmp_path / "h.csv").write_text('a,"' + "long\n" * 100 + '",c\n1,2,3\n')
    with pytest.raises(ValueError, match="header does not end"):
        IO._scan(spark, str(tmp_path), True)


def test_open_quote_at_the_end_and_empty_files(spark, tmp_path, tiny_splits):
    (tmp_path / "open.csv").write_text('a,b\n1,2\n3,"4\n' + "5,6\n" * 200)
    df = IO._scan(spark, str(tmp_path / "open.csv"), True)
    with pytest.raises(Exception, match="a quote stays open"):
        df.count()
    (tmp_path / "bare.csv").write_text("a,b\n")
    (tmp_path / "void.csv").write_text("")
    assert IO._scan(spark, str(tmp_path / "bare.csv"), True).collect() == []
    assert IO.record_count(spark, str(tmp_path / "bare.csv")).first().n == 0
    with pytest.raises(ValueError, match="no file has a header"):
        IO._scan(spark, str(tmp_path / "void.csv"), True)
    with pytest.raises(FileNotFoundError):
        IO._scan(spark, str(tmp_path / "none.csv"), True)


def test_headers_stop_early(spark, tmp_path):
    """A large file gives its header without being read to its end."""
    (tmp_path / "big.csv").write_text("a,b\n" + "1,2\n" * 3_000_000)
    import time
    t = time.time()
    headers, _ = Q.header_records(spark, str(tmp_path))
    assert headers == [("a,b", 1)] and time.time() - t < 30


@pytest.mark.parametrize("cells,want", [
    (["02134", " 501", "+7"], ["2134", "501", "7"]), (["02134", ""], ["2134.0", "nan"]), (["1.5", "2", "1e3"], ["1.5", "2.0", "1000.0"]),
    (["02134", "x", "NA"], ["02134", "x", "nan"]), (["1", "99999999999999999999"], ["1.0", "100000000000000000000.0"])])
def test_inferred_columns_render_as_one_type(spark, cells, want):
    from vaultshift.operators import postal as P
    df = spark.createDataFrame(list(enumerate(cells)), "i int, c string")
    if "999" not in cells[-1]:
        assert [r.c for r in P.inferred(df, "c").orderBy("i").collect()] == want
    else:  # beyond 64 bits: no whole numbers, so floats
        assert P.inferred(df, "c").orderBy("i").first().c == "1.0"
