import re
from collections import Counter

import pytest

from vaultshift.llm import mixing, rules

EDGE = [(1, None, None, None), (2, "", None, "b"), (3, " \n\t ", None, "a"), (4, "one two", None, "a"), (4, "one two", None, "a"),
        (5, "a b c d e f " * 3, None, "c"), (6, "x\ny\nx\n\nx \n", None, "c"), (7, "# $ % " * 4000, None, "a"), (None, "no id here", None, None),
        (8, "The cat sat on the mat. It was a good day for all of us, and the sun shone over the hills. " * 1 + "More plain words follow here.", None, "b")]


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    covered = {i + k for i, x in enumerate(win) if n[x] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_measures_match_brute_force(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.measures(docs).collect()}
    assert got == {i: brute(t) for i, t in rows.items()}
    edge = rules.measures(make_docs(EDGE, extra=True)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in edge) == sorted(
        (e[0] or -1, *brute(e[1])) for e in EDGE)


def test_label_edges_and_em(spark, make_docs, scratch):
    out = {(r.doc_id, r.n_words): r for r in rules.label(make_docs(EDGE, extra=True), scratch).collect()}
    assert not out[1, 0].kept and out[1, 0].base_failed and out[8, brute(EDGE[-1][1])[0]].kept
    assert out[7, 12000].base_failed
    from vaultshift.llm.common import Scratch
    assert rules.label(make_docs([]), Scratch(spark, "t")).count() == 0


def test_em_learns_accuracies(spark):
    """Votes drawn from known accuracies: EM finds them, and the posterior is Bayes' rule."""
    import itertools
    names = ["length", "word_size", "sentences"]
    good, bad, share = {1: 0.9, -1: 0.02, 0: 0.08}, {1: 0.2, -1: 0.7, 0: 0.1}, 0.8
    rows = []
    for v in itertools.product((1, -1, 0), repeat=3):
        g = share * good[v[0]] * good[v[1]] * good[v[2]]
        b = (1 - share) * bad[v[0]] * bad[v[1]] * bad[v[2]]
        rows.append((*v, round(1_000_000 * (g + b))))
    patterns = spark.createDataFrame(rows, "length int, word_size int, sentences int, n long")
    p = rules.fit(patterns, names, rounds=60)
    assert p["prior"] == pytest.approx(share, abs=0.06)
    for n in names:
        assert p[n]["g"] == pytest.approx((0.9, 0.02), abs=0.05) and p[n]["b"] == pytest.approx((0.2, 0.7), abs=0.12)
    got = patterns.select("*", rules.posterior(p, names).alias("p")).where("length = -1 and word_size = -1 and sentences = 1").first().p
    assert got < 0.05


def fill(sizes, weights):
    """Water filling by repeated sharing."""
    total, out = sum(sizes), [0.0] * len(sizes)
    free = list(range(len(sizes)))
    left = total
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > 3 * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = 3.0 * sizes[i]
        left -= sum(3 * sizes[i] for i in over)
        free = [i for i in free if i not in over]
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 5, 3, 700, 0], [0, 0], [7], [1, 1, 1, 1, 10**9]])
def test_targets(spark, sizes):
    rows = [(f"s{i:02d}" if i < len(sizes) - 1 else None, n) for i, n in enumerate(sizes)]
    got = mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    want = dict(zip([r[0] for r in rows], fill(sizes, [i % 3 + 1 for i in range(len(sizes))]), strict=True))
    assert {r.source: pytest.approx(r.target) for r in got} == want


def test_mix_matches_one_sort_per_source(spark, make_docs):
    from vaultshift.llm.common import Scratch
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = sorted(map(tuple, mixing.mix(docs, Scratch(spark, "t"), buckets=8).collect()))
    assert a == sorted(map(tuple, mixing.mix(docs.repartition(5), Scratch(spark, "t"), buckets=64).collect()))
    import duckdb
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert a == sorted(con.execute(mixing.SQL).fetchall())
    edge = mixing.mix(make_docs(EDGE, extra=True), Scratch(spark, "t")).collect()
    assert len(edge) == len(EDGE) and all(r.taken <= 3 * r["size"] for r in edge)
    assert mixing.mix(make_docs([]), Scratch(spark, "t")).count() == 0
