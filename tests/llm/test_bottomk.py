"""Bottom-k near-dedup against brute force over all pairs that share a shingle."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vaultshift.llm import bottomk
from vaultshift.llm.common import Scratch

from conftest import SF01

from .helpers import sentence

LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    w = (text or "").translate(LOWER).encode().split()
    return {b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """{(id, n, component)} of (id, text) rows; rows of one id are told apart by position."""
    sets = [shingle_set(t) for _, t in rows]
    inv = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            inv[x].add(k)
    comp = list(range(len(rows)))

    def root(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for k, s in enumerate(sets):
        for j in {j for x in s for j in inv[x] if j < k}:
            i = len(s & sets[j])
            if 100 * i >= 85 * (len(s) + len(sets[j]) - i):
                comp[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows) if i is not None)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    assert all(r.component_id is None and r.kept is None for r in rows if r.doc_id is None)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows if r.doc_id is not None)


def edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        k = int(rng.integers(len(w)))
        kind = rng.integers(3)
        if kind == 0:
            w[k] = f"z{rng.integers(10**6)}"
        elif kind == 1:
            w.insert(k, f"z{rng.integers(10**6)}")
        else:
            del w[k]
    return " ".join(w)


def test_on_the_table(spark, scratch):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(bottomk.near_copies(docs, scratch)) == brute(rows)


@pytest.mark.parametrize("block", [16, 512])
def test_chains_and_groups_around_the_threshold(spark, make_docs, monkeypatch, block):
    """Copies with zero to nine edits, copies of copies, shared passages, short texts, split lists and blocks."""
    monkeypatch.setattr(bottomk, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows, passage = [], sentence(rng, 60)
    for g in range(12):
        words = sentence(rng, int(rng.integers(20, 300))).split()
        for _ in range(int(rng.integers(2, 40))):
            rows.append(edited(rng, words, int(rng.integers(0, max(2, len(words) // 25)))))
            if rng.random() < 0.3:
                words = rows[-1].split()
    rows += [sentence(rng, int(rng.integers(5, 40))) + " " + passage + " " + sentence(rng, 10) for _ in range(60)]
    rows += [" ".join(sentence(rng, n, 3).split()) for n in (1, 2, 3, 4, 5, 6, 7) for _ in range(4)]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows, strict=True)]
    assert got(bottomk.near_copies(make_docs(rows), Scratch(spark, "t"))) == brute(rows)


def test_edges(spark, make_docs):
    rng = np.random.default_rng(3)
    words = sentence(rng, 150).split()
    long = sentence(rng, 300_000, 10**6)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE two"), (None, "one two"), (None, " ".join(words)), (6, edited(rng, words, 1)),
            (7, edited(rng, words, 1)), (8, sentence(rng, 90)), (8, "another text under the same id here"), (9, "another text under the same id here"),
            (9, "another text under the same id here"), (2**62, long), (2**62 + 1, long + " more"), (10, "É b c d e f"), (11, "é b c d e f"), (None, None)]
    res = bottomk.near_copies(make_docs(rows, extra=True).withColumnRenamed("words", "node"), Scratch(spark, "t"))
    assert got(res) == brute(rows) and res.count() == len(rows)
    assert bottomk.near_copies(make_docs(rows).limit(0), Scratch(spark, "t")).collect() == []
    assert got(bottomk.near_copies(make_docs([(1, None), (2, "")]), Scratch(spark, "t"))) == [(1, 0, 1), (2, 0, 2)]


def test_union_estimate_is_the_share_of_the_unions_least_values():
    rng = np.random.default_rng(5)
    vocab = np.sort(rng.integers(1, 1 << 62, size=400).astype(np.uint64))
    sets = [np.sort(rng.choice(vocab, size=int(rng.integers(5, 390)), replace=False)) for _ in range(60)]
    sk = bottomk.padded(pa.array([s[:bottomk.K].tobytes() for s in sets], pa.binary()))
    size = np.array([len(s) for s in sets])
    a, b = np.triu_indices(60, 1)
    ok = bottomk.union_estimate(sk, size, a, b)
    for x, y, k in zip(a, b, ok, strict=True):
        least = sorted(set(sets[x]) | set(sets[y]))[:bottomk.K]
        both = set(sets[x]) & set(sets[y])
        fits = 100 * min(size[x], size[y]) >= 85 * max(size[x], size[y])
        assert k == (fits and sum(v in both for v in least) * bottomk.K >= bottomk.LEAST * len(least))
