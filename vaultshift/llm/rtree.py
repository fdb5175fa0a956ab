"""Hard-negative mining with an STR-packed R-tree over integer vectors.

For every anchor: its positives are the ``POSITIVES`` other rows of its label with the greatest inner product;
for every positive, its hard negatives are the ``NEGATIVES`` rows of other labels with the greatest inner product
among those whose score lies in the window ``LOW`` to ``HIGH`` per cent of the positive's. Ties go to the smaller id.

1. Packing. Sort-tile-recursive: with many coordinates STR cuts each into two slabs, taking the coordinates by
   falling variance. The upper cuts (tiles of about ``TILE`` rows) are medians of a bounded sample of ``SAMPLE``
   rows, least hash of the id first; every row then goes to its tile, whatever the sample holds. Inside a tile rows
   are sorted and halved coordinate by coordinate down to leaves of ``LEAF`` rows. Leaves and tiles carry minimum
   bounding boxes. Tiles above ``TILE_MAX`` rows (equal vectors, say) are dealt into parts by a hash of the id.
2. Search. Tiles are dealt over groups, anchors over parts; every (group, part) is one cell, a bounded task that
   sees one group's boxes and one part's anchors. A box gives each anchor an interval of its inner products,
   coordinate by coordinate: max(a, 0) * hi + min(a, 0) * lo at most, and the mirror image at least. A best-first
   queue holds tiles, then their leaves, by the greatest score they can still yield; a box is dropped for an
   anchor when its interval misses the score window or its top is strictly below the k-th score so far (or equal
   to it with no id below the k-th's). Anchors of a block walk the queue together, so that bounds and leaf scores
   are matrix products; each is still pruned by its own k-th score.
3. The few best of each cell meet per anchor (and positive) and the best of those are the result.

All rows are searched and nothing is approximate: scores are whole numbers, kept exact by 64-bit floats below 2**53
and by 64-bit integers above.

Defined cases: rows with a null id or label, a null vector, or any null or non-finite component take no part, nor
rows with a component so large that 100 times a score could leave 64 bits (beyond sqrt(2**55 / dimensions)); shorter vectors count as filled up with zeros; of rows that share
an id the least (label, vector) takes part; anchors without positives, and positives without negatives, give no
rows (a negative positive score has an empty window); an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .jaccard_join import grouped

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LEAF = 64
TILE, TILE_MAX = 1024, 8192
SAMPLE, SAMPLES_A_TILE = 20_000, 8
GROUPS, GROUP_ROWS = 64, 131_072
PART_ANCHORS, BLOCK = 16_384, 256
NEG = -(2**62)
NO_ID = 2**63 - 1

SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_vectors(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v): components as floor(256 * x), one row an id, rows that take no part left out."""
    x256 = F.transform(vector, lambda x: x.cast("double") * 256)
    ok = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.sqrt(F.lit(2.0**55) / F.greatest(F.size("x"), F.lit(1)))) & (F.abs(x) < 2.0**31 - 1))
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), x256.alias("x"))
    rows = rows.where("vec_id is not null and label is not null and x is not null").where(ok)
    rows = rows.select("vec_id", "label", F.transform("x", lambda x: F.floor(x).cast("int")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def matrix(col: pa.Array, d: int) -> np.ndarray:
    """(rows, d) whole numbers of a list column, shorter lists filled up with zeros."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size = np.diff(col.offsets.to_numpy())
    out = np.zeros((len(col), d), np.int32)
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = col.flatten().to_numpy()
    return out


def str_cuts(sample: np.ndarray, levels: int) -> list[tuple[int, np.ndarray]]:
    """For each level the coordinate and the cut of each of its slabs (medians of the sample)."""
    order = np.argsort(-sample.var(axis=0), kind="stable")
    tile, cuts = np.zeros(len(sample), np.int64), []
    for level in range(levels):
        c = int(order[level % len(order)])
        cut = np.zeros(1 << level)
        for t in range(1 << level):
            own = sample[tile == t, c]
            cut[t] = np.median(own) if len(own) else 0
        cuts.append((c, cut))
        tile = 2 * tile + (sample[:, c] > cut[tile])
    return cuts


def tile_of(v: np.ndarray, cuts: list[tuple[int, np.ndarray]]) -> np.ndarray:
    tile = np.zeros(len(v), np.int64)
    for c, cut in cuts:
        tile = 2 * tile + (v[:, c] > cut[tile])
    return tile


def str_order(v: np.ndarray, leaf: int) -> np.ndarray:
    """Row order in which every ``leaf`` consecutive rows are a leaf: slabs are sorted by one coordinate after
    the other and halved at a whole number of leaves."""
    coords = np.argsort(-v.astype(np.float64).var(axis=0), kind="stable")
    slabs, level = [np.arange(len(v))], 0
    while any(len(s) > leaf for s in slabs):
        c, nxt = coords[level % len(coords)], []
        for s in slabs:
            if len(s) <= leaf:
                nxt.append(s)
                continue
            s = s[np.argsort(v[s, c], kind="stable")]
            half = leaf * (-(-len(s) // leaf) // 2)
            nxt += [s[:half], s[half:]]
        slabs, level = nxt, level + 1
    return np.concatenate(slabs) if slabs else np.zeros(0, np.int64)


def pack(rows: DataFrame, d: int, n: int, scratch: Scratch) -> DataFrame:
    """The index: one row a tile with its ids, labels and vectors in leaf order."""
    leaf_rows, levels = LEAF, max(0, min(math.ceil(math.log2(max(1, n / TILE))), int(math.log2(SAMPLE / SAMPLES_A_TILE))))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    cuts = str_cuts(matrix(sample.column("v"), d), levels)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tile_of(matrix(b.column("v"), d), cuts))], names=["vec_id", "label", "v", "tile"])

    tiled = scratch.write(rows.select("vec_id", "label", "v").mapInArrow(assign, "vec_id long, label int, v array<int>, tile long"), "tiled")
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / TILE_MAX).alias("parts"))  # 2 ** 11 rows at most
    tiled = tiled.join(F.broadcast(sizes), "tile").withColumn("grp", F.xxhash64("tile", F.pmod(F.xxhash64("vec_id"), "parts")))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "grp"):
            grp = t.column("grp").to_numpy()
            edge = np.append(np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])), len(grp))
            out = []
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                part = t.slice(lo, hi - lo)
                v, ids = matrix(part.column("v"), d), part.column("vec_id").to_numpy()
                order = str_order(v, leaf_rows)
                leaf = np.arange(len(order)) // leaf_rows
                order = order[np.lexsort((ids[order], leaf))]  # ids ascend inside a leaf: ties
                out.append((int(grp[lo]), len(order), ids[order].tobytes(), part.column("label").to_numpy()[order].astype(np.int32).tobytes(), v[order].tobytes()))
            if out:
                types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=["grp", "n", "ids", "labels", "vectors"])

    rows = tiled.select("grp", "vec_id", "label", "v").repartition("grp").sortWithinPartitions("grp")
    return scratch.write(rows.mapInArrow(leaves, "grp long, n long, ids binary, labels binary, vectors binary"), "index")


class Boxes:
    """The tiles of one cell: rows in leaf order, boxes of leaves and tiles."""

    def __init__(self, tiles: pa.Table, d: int, exact: type, leaf: int):
        ids, labels, vecs, leaf_at, tile_at, row = [], [], [], [], [0], 0
        for k in range(tiles.num_rows):
            n = tiles.column("n")[k].as_py()
            ids.append(np.frombuffer(tiles.column("ids")[k].as_py(), np.int64))
            labels.append(np.frombuffer(tiles.column("labels")[k].as_py(), np.int32))
            vecs.append(np.frombuffer(tiles.column("vectors")[k].as_py(), np.int32).reshape(n, d))
            leaf_at += range(row, row + n, leaf)
            row += n
            tile_at.append(len(leaf_at))
        self.ids, self.labels, self.v = np.concatenate(ids), np.concatenate(labels), np.concatenate(vecs).astype(exact)
        self.leaf = np.append(leaf_at, row)
        self.tile = np.array(tile_at)
        self.lo = np.minimum.reduceat(self.v, self.leaf[:-1], axis=0)
        self.hi = np.maximum.reduceat(self.v, self.leaf[:-1], axis=0)
        self.tile_lo = np.minimum.reduceat(self.lo, self.tile[:-1], axis=0)
        self.tile_hi = np.maximum.reduceat(self.hi, self.tile[:-1], axis=0)
        self.least_id = np.minimum.reduceat(self.ids, self.leaf[:-1])


def intervals(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, boxes) least and greatest inner product of each anchor with any vector inside each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def search(boxes: Boxes, ids: np.ndarray, labels: np.ndarray, a: np.ndarray, low: np.ndarray, high: np.ndarray, k: int,
           same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for a block of anchors: (anchors, windows, k) scores and ids, best first, NEG / NO_ID
    where there are fewer. Windows are [low, high] by anchor; ``same``: rows of the anchor's label (but itself),
    else rows of other labels."""
    n, w = low.shape
    best_s = np.full((n, w, k), NEG, a.dtype)
    best_i = np.full((n, w, k), NO_ID, np.int64)

    def wanted(lb, ub, least):
        """Windows (anchors, w) for which a box may hold a better row."""
        ub, lb = ub[:, None], lb[:, None]
        kth, kid = best_s[:, :, -1], best_i[:, :, -1]
        return (lb <= high) & (ub >= low) & ((ub > kth) | ((ub == kth) & (least < kid)))

    def rank(lb, ub, least):
        live = wanted(lb, ub, least)
        return float(np.minimum(ub[:, None], high)[live].max()) if live.any() else None

    heap = []
    t_lb, t_ub = intervals(a, boxes.tile_lo, boxes.tile_hi)
    for t in range(len(boxes.tile_lo)):
        top = rank(t_lb[:, t], t_ub[:, t], NEG)
        if top is not None:
            heap.append((-top, 0, t, t_lb[:, t], t_ub[:, t]))
    heap = [(p, kind, t, x) for x, (p, kind, t, *_) in enumerate(heap)]
    held = {x: (t_lb[:, t], t_ub[:, t]) for _, _, t, x in heap}
    heapq.heapify(heap)
    serial = len(heap)
    while heap:
        _, kind, at, x = heapq.heappop(heap)
        lb, ub = held.pop(x)
        live = wanted(lb, ub, boxes.least_id[at] if kind else NEG)
        if not live.any():
            continue
        if not kind:  # a tile: its leaves join the queue
            p, q = boxes.tile[at], boxes.tile[at + 1]
            l_lb, l_ub = intervals(a, boxes.lo[p:q], boxes.hi[p:q])
            for leaf in range(p, q):
                bounds = l_lb[:, leaf - p], l_ub[:, leaf - p]
                top = rank(*bounds, boxes.least_id[leaf])
                if top is not None:
                    heapq.heappush(heap, (-top, 1, leaf, serial))
                    held[serial] = bounds
                    serial += 1
            continue
        who = np.flatnonzero(live.any(axis=1))
        p, q = boxes.leaf[at], boxes.leaf[at + 1]
        own = boxes.ids[p:q]
        score = a[who] @ boxes.v[p:q].T
        right = boxes.labels[None, p:q] == labels[who, None]
        right = right & (own[None, :] != ids[who, None]) if same else ~right
        for j in range(w):
            kth, kid = best_s[who, j, -1:], best_i[who, j, -1:]
            good = right & (score >= low[who, j : j + 1]) & (score <= high[who, j : j + 1]) & ((score > kth) | ((score == kth) & (own[None, :] < kid)))
            rows = np.flatnonzero(good.any(axis=1))
            if not len(rows):
                continue
            s = np.where(good[rows], score[rows], NEG)
            first = np.argsort(-s, axis=1, kind="stable")[:, :k]
            s = np.take_along_axis(s, first, axis=1)
            s_all = np.concatenate([best_s[who[rows], j], s], axis=1)
            i_all = np.concatenate([best_i[who[rows], j], np.where(s > NEG, own[first], NO_ID)], axis=1)
            order = np.lexsort((i_all, -s_all), axis=1)[:, :k]
            best_s[who[rows], j] = np.take_along_axis(s_all, order, axis=1)
            best_i[who[rows], j] = np.take_along_axis(i_all, order, axis=1)
    return best_s, best_i


def _cells(index: DataFrame, anchors: DataFrame, groups: int, parts: int):
    """Tiles copied to every anchor part, anchors to every tile group, by cell."""
    part, group = F.pmod(F.xxhash64("vec_id"), F.lit(parts)), F.pmod("grp", F.lit(groups))
    tiles = index.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: p * groups + group)))
    return tiles, anchors.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: part * groups + g)))


def hard_negatives(rows: DataFrame, anchor: Column, scratch: Scratch, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """``rows`` (vec_id, label, v: whole numbers) -> one row per anchor, positive and rank of its negative."""
    spark, leaf_rows = rows.sparkSession, LEAF
    rows = scratch.write(rows, "rows")
    d, n, n_anchors, top = rows.agg(F.max(F.size("v")), F.count("*"), F.count_if(anchor), F.max(F.greatest(
        F.abs(F.array_max("v").cast("long")), F.abs(F.array_min("v").cast("long"))))).first()
    if not n_anchors:
        return spark.createDataFrame([], SCHEMA)
    d = max(1, d)
    exact = np.float64 if d * int(top or 0) ** 2 < 2**53 else np.int64
    index = pack(rows, d, n, scratch)
    tiles_n = index.count()
    groups = max(min(GROUPS, tiles_n), math.ceil(n / GROUP_ROWS))
    parts = math.ceil(n_anchors / PART_ANCHORS)
    anchors = rows.where(anchor)

    def first_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            boxes = Boxes(left, d, exact, leaf_rows)
            for lo in range(0, right.num_rows, BLOCK):
                t = right.slice(lo, BLOCK)
                ids, labels, a = t.column("vec_id").to_numpy(), t.column("label").to_numpy(), matrix(t.column("v"), d).astype(exact)
                s, i = search(boxes, ids, labels, a, np.full((len(ids), 1), NEG, exact), np.full((len(ids), 1), -NEG, exact), positives, True)
                r, _, c = np.nonzero(i != NO_ID)
                out[0].append(ids[r])
                out[1].append(i[r, 0, c])
                out[2].append(s[r, 0, c].astype(np.int64))
        return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out], names=["anchor_id", "positive_id", "positive_score"])

    tiles, asked = _cells(index, anchors, groups, parts)
    near = tiles.groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(first_pass, "anchor_id long, positive_id long, positive_score long")
    best = F.row_number().over(_by(["anchor_id"], "positive_score", "positive_id"))
    chosen = scratch.write(near.withColumn("_r", best).where(F.col("_r") <= positives).drop("_r"), "positives")

    windows = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("p"))  # at most ``positives`` each
    windows = windows.select(F.col("anchor_id").alias("vec_id"), F.col("p.positive_id").alias("p_id"), F.col("p.positive_score").alias("p_score"))

    def second_pass(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            boxes = Boxes(left, d, exact, leaf_rows)
            for lo in range(0, right.num_rows, BLOCK):
                t = right.slice(lo, BLOCK)
                ids, labels, a = t.column("vec_id").to_numpy(), t.column("label").to_numpy(), matrix(t.column("v"), d).astype(exact)
                p_id, p_score = np.full((len(ids), positives), NO_ID), np.full((len(ids), positives), -1, np.int64)
                for r, (x, y) in enumerate(zip(t.column("p_id").to_pylist(), t.column("p_score").to_pylist(), strict=True)):
                    p_id[r, : len(x)], p_score[r, : len(y)] = x, y
                # low * positive <= 100 * negative <= high * positive in whole numbers; unused places: an empty window
                least, most = -((-low * p_score) // 100), (high * p_score) // 100
                least = np.where(p_id == NO_ID, 1, least).astype(exact)
                most = np.where(p_id == NO_ID, 0, most).astype(exact)
                s, i = search(boxes, ids, labels, a, least, most, negatives, False)
                r, j, c = np.nonzero(i != NO_ID)
                for have, new in zip(out, (ids[r], p_id[r, j], i[r, j, c], p_score[r, j], s[r, j, c].astype(np.int64)), strict=True):
                    have.append(new)
        return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out],
                        names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    tiles, asked = _cells(index, anchors.join(windows, "vec_id"), groups, parts)
    found = tiles.groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(
        second_pass, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(_by(["anchor_id", "positive_id"], "negative_score", "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(*(f.split()[0] for f in SCHEMA.split(", ")))


def _by(keys: list[str], score: str, tie: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))


#: The query in DuckDB, by comparing every anchor with every row.
SQL = """
WITH rows0 AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows0 a JOIN rows0 b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), neg AS (
  SELECT p.anchor_id, p.positive_id, n.other AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS rank
  FROM pos p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  WHERE 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""
