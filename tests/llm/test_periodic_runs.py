"""Periodic runs against a brute-force search over all lags, and the whole query against plain Python."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from vaultshift.llm import periodic_runs
from vaultshift.llm.periodic_runs import find_runs
from vaultshift.llm.textnum import Text, mix
from vaultshift.llm.wordspans import word_hashes

from conftest import SF001


def brute_runs(words):
    """All maximal stretches of each period, then those whose smallest period it is and that are long enough."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(24, 3 * q):
                part = words[s:s + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (doc_id, n, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def runs_of(lists):
    word = mix(np.array([w for x in lists for w in x], np.uint64) + np.uint64(1))
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    got = find_runs(word, row, len(lists))
    return [[tuple(r[1:]) for r in got.tolist() if r[0] == k] for k in range(len(lists))]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    lists = []
    for _ in range(60):
        x = []
        for _ in range(rng.integers(0, 6)):
            unit = rng.integers(0, rng.integers(1, 6), size=rng.integers(1, 50)).tolist()
            x += (unit * int(rng.integers(1, 9)))[: rng.integers(1, 300)]
        lists.append(x)
    assert runs_of(lists) == [brute_runs(x) for x in lists]


def test_periods_that_hold_repeats():
    """Units in which every gram occurs more than once: the nearest earlier occurrence is nearer than the period."""
    a, b = list(range(20)), list(range(20, 45))
    lists = [(a + a + b) * 4, (a + a + b + a + b + b) * 5, (a * 3 + b) * 3 + a * 2, [1] * 23, [1] * 24, [1, 2] * 12, ([1] * 30 + [2]) * 4]
    assert runs_of(lists) == [brute_runs(x) for x in lists]


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {tuple(r) for r in periodic_runs.report(docs, rewrite=True).collect()}
    want = {brute_report(r.doc_id, r.text) for r in docs.select("doc_id", "text").where("length(text) < 30000").collect()}
    assert want <= got and len(got) == docs.distinct().count()
    assert any(r[2] for r in want)


def test_edges(spark, make_docs):
    long = " ".join(["x y"] * 400_000) + " " + " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (None, "a " * 30), (5, "a\u00a0b " * 30), (5, "a\u00a0b " * 30), (6, long), (20, "z" * 3_000_000 + " q"),
            (21, "  " * 24)]
    docs = make_docs(rows, extra=True).withColumnRenamed("words", "n_runs")
    got = sorted(map(tuple, periodic_runs.report(docs).collect()), key=str)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r)
    empty = hashlib.sha256(b"").hexdigest()
    for k in (1, 2, 3):
        assert by[k] == [(k, 0, 0, None, None, None, None, empty, empty)]
    assert by[None][0][:7] == (None, 30, 1, 0, 30, 1, 30_000)
    assert len(by[5]) == 2 and by[5][0] == by[5][1] and by[5][0][2:6] == (1, 0, 30, 1)
    assert by[6][0][1:6] == (1_000_000, 1, 0, 800_000, 2)
    assert by[6][0][8] == hashlib.sha256(("x y " + " ".join(f"w{i}" for i in range(200_000))).encode()).hexdigest()
    assert by[20][0][8] == hashlib.sha256(("z" * 3_000_000 + " q").encode()).hexdigest()
    assert by[21][0][1:3] == (24, 1)
    assert periodic_runs.report(docs.limit(0)).collect() == []
    assert [tuple(r) for r in periodic_runs.all_runs(docs.where("doc_id = 6")).collect()] == [(6, 0, 800_000, 2)]


def test_long_plain_text_digest(spark, make_docs):
    rng = np.random.default_rng(1)
    text = "".join(f"w{rng.integers(10**9)}" + " \n\t  "[: rng.integers(1, 5)] for _ in range(400_000))
    got = periodic_runs.report(make_docs([(1, text)])).first()
    assert got.collapsed_sha256 == hashlib.sha256(b" ".join(text.encode().split())).hexdigest()


def test_hashes_by_pieces_equal_whole():
    t = Text(pa.array(["alpha  beta\ngamma " * 50, None, "délta " * 40]))
    s, e, _ = t.words()
    assert (word_hashes(t, s, e, piece=64) == t.hash(s, e)).all()
