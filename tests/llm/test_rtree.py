"""Hard negatives against brute force, and the parts of the R-tree on their own."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultshift.llm import queries, rtree
from vaultshift.llm.common import Scratch

from conftest import SF01

ROWS = "vec_id long, label int, v array<int>"


def brute(rows, every):
    """Rows (id, label, vector) -> the result rows, by comparing everything with everything."""
    out = set()
    width = max(len(v) for _, _, v in rows)
    m = np.array([list(v) + [0] * (width - len(v)) for _, _, v in rows], dtype=object)
    for k, (i, lab, _) in enumerate(rows):
        if i % every:
            continue
        s = m @ m[k]
        order = sorted((j for j in range(len(rows)) if j != k), key=lambda j: (-s[j], rows[j][0]))
        for p in [j for j in order if rows[j][1] == lab][:5]:
            neg = [j for j in order if rows[j][1] != lab and 50 * s[p] <= 100 * s[j] <= 95 * s[p]][:3]
            out |= {(i, rows[p][0], r + 1, rows[j][0], int(s[p]), int(s[j])) for r, j in enumerate(neg)}
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("scale,dims", [(3, 6), (300, 16), (2**26, 3)])
def test_search_equals_brute_force(spark, monkeypatch, scale, dims):
    """Many ties, plain values, and scores beyond 2 ** 53; small leaves, tiles and cells."""
    for name, value in (("LEAF", 4), ("TILE", 32), ("TILE_MAX", 40), ("PART_ANCHORS", 16), ("BLOCK", 8), ("GROUPS", 5)):
        monkeypatch.setattr(rtree, name, value)
    rng = np.random.default_rng(scale)
    centre = rng.integers(-scale, scale + 1, size=(6, dims))
    rows = []
    for i in range(400):
        v = centre[rng.integers(6)] + rng.integers(-scale // 3, scale // 3 + 1, size=dims)
        rows.append((i, int(rng.integers(4)), [int(x) for x in np.clip(v, -scale, scale)]))
    rows += [(1000 + i, int(rng.integers(2)), rows[7][2]) for i in range(150)]  # one common vector
    df = spark.createDataFrame(rows, ROWS)
    assert got(rtree.hard_negatives(df, F.col("vec_id") % 10 == 0, Scratch(spark, "t"))) == brute(rows, 10)


def test_query_on_the_table(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [math.floor(256 * x) for x in r.embedding]) for r in emb]
    want = brute(rows, 50)
    assert want and got(queries.op12_hard_negatives(spark, SF01)) == want


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [0.5, 0.5]), (1, 1, [0.5, 0.25]), (2, 2, [0.3, 0.3]), (3, 2, None), (4, None, [0.5, 0.5]), (5, 2, [0.3, None]), (6, 2, [nan, 0.3]),
            (7, 2, [0.3, inf]), (8, 2, [0.3]), (9, 2, []), (None, 2, [0.3, 0.3]), (10, 2, [1e30, 0.1]), (2, 2, [0.3, 0.3]), (2, 3, [0.9, 0.9]), (50, 1, [-0.5, -0.5])]
    emb = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("grp", F.lit("x")).withColumn("n", F.lit(1))
    vec = rtree.whole_vectors(emb)
    assert sorted((r.vec_id, r.label, r.v) for r in vec.collect()) == [
        (0, 1, [128, 128]), (1, 1, [128, 64]), (2, 2, [76, 76]), (8, 2, [76]), (9, 2, []), (50, 1, [-128, -128])]
    res = got(rtree.hard_negatives(vec, F.col("vec_id") % 50 == 0, Scratch(spark, "t")))
    assert res == {(0, 1, 1, 2, 24576, 19456)}
    assert rtree.hard_negatives(vec.limit(0), F.col("vec_id") % 50 == 0, Scratch(spark, "t")).collect() == []
    assert rtree.hard_negatives(vec.where("vec_id = 1"), F.col("vec_id") % 50 == 0, Scratch(spark, "t")).collect() == []


def test_boxes_bound_every_inner_product():
    rng = np.random.default_rng(2)
    v = rng.integers(-50, 50, size=(1000, 7))
    order = rtree.str_order(v, 16)
    assert sorted(order) == list(range(1000))
    a = rng.integers(-50, 50, size=(20, 7))
    for k in range(0, 1000, 16):
        part = v[order[k:k + 16]]
        lo, hi = rtree.intervals(a, part.min(axis=0)[None], part.max(axis=0)[None])
        s = a @ part.T
        assert (lo[:, 0] <= s.min(axis=1)).all() and (s.max(axis=1) <= hi[:, 0]).all()


def test_tiles_take_every_row():
    rng = np.random.default_rng(3)
    v = rng.integers(-9, 9, size=(500, 3))
    cuts = rtree.str_cuts(v[:100], 5)
    tile = rtree.tile_of(v, cuts)
    assert tile.min() >= 0 and tile.max() < 32 and len(np.unique(tile)) > 16
