"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles; two texts are linked if their Jaccard similarity is at least 0.8.

1. Copies are folded first: texts are grouped by digest (partial aggregation), one representative each,
   so a group of copies of any size costs one row from here on.
2. A MinHash signature of ``K`` values is computed per text; ``BANDS`` bands of ``ROWS`` values are hashed to
   buckets. A pair at 0.8 shares no bucket with probability (1 - 0.8**5)**24 = 7e-5.
3. Buckets of two or more meet in sorted partitions. A bucket's pairs are compared ``STEP`` values at a
   time; after each step a pair is dropped when the posterior probability (uniform prior) that its
   similarity reaches the threshold is below ``TOLERANCE``. A pair is looked at in its first common
   bucket only. Survivors leave as the spanning stars of the bucket, never as all pairs.
4. Components of those stars are the blocks for the exact step: any surviving pair lies in one. A
   block's texts meet once and the exact Jaccard similarity of all its pairs is taken from a
   matrix product over shared shingles. Links are counted per text; stars of verified links leave.
5. Components of verified stars are the classes.

Buckets and blocks above ``BLOCK`` rows are split: members are hashed into parts, and each pair of parts
is a group of its own, at most ``2 * BLOCK`` rows on average, so one hot group is spread over many tasks.

Defined cases: null doc_id: class null, 0 links; null text and texts without words: no shingles, linked
to nothing, a class each; texts of one to four words have one shingle, all their words; repeated rows
are copies; of a class the least doc_id is the class id; an empty table gives an empty result; extra
columns are ignored. Words are maximal runs outside white space, in lower case.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, hint_small, small_batches
from .textnum import Text, chunks, column, mix, segment_starts, shingles

WIDTH = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction, so that the exact test is in whole numbers
ROWS, BANDS = 5, 24
K = ROWS * BANDS
STEP = 20
TOLERANCE = 1e-4
BLOCK = 512
SMALL = 48
PAIRS = 1 << 17  # pairs compared at once
CHUNK = 1 << 20

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(1, 1 << 63, size=K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, size=K, dtype=np.uint64)


def minhash(sh: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, K) MinHash values of the sets whose shingles begin at ``starts`` (none empty)."""
    out = np.empty((len(starts), K), np.uint32)
    buf = np.empty(len(sh), np.uint64)
    for k in range(K):
        np.multiply(sh, _MUL[k], out=buf)
        buf += _ADD[k]
        out[:, k] = np.minimum.reduceat(buf, starts) >> np.uint64(32)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys; the band is part of the key."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return acc.view(np.int64)


def least_matches(threshold: float = THRESHOLD[0] / THRESHOLD[1], tolerance: float = TOLERANCE) -> list[int]:
    """For 20, 40, ... compared values the least number of matches that keeps a pair: with a uniform
    prior the posterior of the similarity is Beta(m + 1, n - m + 1), whose tail above the threshold is
    a binomial sum."""
    need = []
    for n in range(STEP, K + 1, STEP):
        tail, m = 0.0, -1
        while tail < tolerance and m < n:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        need.append(m)
    return need


NEED = least_matches()


def survivors(sig: np.ndarray, a: np.ndarray, b: np.ndarray, band: int | np.ndarray) -> np.ndarray:
    """Indices of the pairs (a, b) whose first common bucket is in ``band`` and that no step drops."""
    live = np.arange(len(a))
    matched = np.zeros(len(a), np.int32)
    for step, need in enumerate(NEED):
        sl = slice(step * STEP, (step + 1) * STEP)
        eq = sig[a[live], sl] == sig[b[live], sl]
        bands = step * (STEP // ROWS) + np.arange(STEP // ROWS)
        common = eq.reshape(len(live), STEP // ROWS, ROWS).all(axis=2)
        earlier = (common & (bands[None, :] < (band if np.isscalar(band) else band[live][:, None]))).any(axis=1)
        matched = matched + eq.sum(axis=1)
        keep = (matched >= need) & ~earlier
        live, matched = live[keep], matched[keep]
        if not len(live):
            break
    return live


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member reached from each of n nodes over the links (a, b)."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables holding whole groups of adjacent rows with one key (about a batch each)."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        keys = t.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1], side="left")) if len(keys) else 0
        if last:
            yield t.slice(0, last).combine_chunks()
        held = t.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def split_groups(members: DataFrame, key: str, size: str, node: str, block: int = BLOCK) -> DataFrame:
    """Adds ``grp`` and ``side``: groups of at most ``block`` members stay whole (side 0); the members of larger
    ones are hashed into parts, every pair of parts (equal ones too) becomes a group, and a member joins
    the groups of its part: side 0 or 1 tells which of the two parts it is in."""
    parts = F.ceil(F.col(size) / block).cast("int")
    d = members.withColumn("_n", parts).withColumn("_p", F.when(F.col("_n") > 1, F.pmod(F.xxhash64(node), F.col("_n"))).otherwise(0).cast("int"))
    d = d.withColumn("_q", F.explode(F.when(F.col("_n") > 1, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.array(F.lit(0)))))
    lo, hi = F.least("_p", "_q"), F.greatest("_p", "_q")
    return d.withColumn("grp", F.xxhash64(F.col(key), lo, hi)).withColumn("side", (F.col("_p") > F.col("_q")).cast("int")).withColumn(
        "cross", lo != hi).drop("_n", "_p", "_q")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, number of shingles, signature, bucket keys; rows without words left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for i, j in chunks(texts, CHUNK):
                t = Text(texts.slice(i, j - i), lower=True)
                s, e, row = t.words()
                sh, sr = shingles(t.hash(s, e), row, t.n, WIDTH)
                at = np.unique(sr)
                if not len(at):
                    continue
                sig = minhash(sh, segment_starts(sr, t.n)[at])
                take = pa.array(i + at)
                keys = band_keys(sig)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(list(map(bytes, sig)), pa.binary()),
                     pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * BANDS, pa.array(keys.ravel()))],
                    names=["doc_id", "digest", "sig", "keys"])

    src = docs.select("doc_id", F.unhex(F.md5(F.lower("text").cast("binary"))).alias("digest"), "text").where("doc_id is not null and text is not null")
    return src.mapInArrow(run, "doc_id long, digest binary, sig binary, keys array<long>")


def candidate_stars(buckets: DataFrame, sigs: DataFrame, scratch: Scratch) -> DataFrame:
    """Stars (a, b) that span the pairs surviving Bayesian pruning."""
    full = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.write(buckets.join(full, "bucket"), "members")
    grouped_rows = split_groups(members, "bucket", "n", "rep").join(sigs, "rep")
    grouped_rows = grouped_rows.select("grp", "band", "cross", "side", "rep", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "grp"):
            grp, band = t.column("grp").to_numpy(), t.column("band").to_numpy()
            rep, side = t.column("rep").to_numpy(), t.column("side").to_numpy()
            cross = t.column("cross").to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(-1, K)
            first = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]]))
            size = np.diff(np.append(first, len(grp)))
            left, right = [], []
            for n in np.unique(size):
                if n < 2:
                    continue
                at = first[size == n]
                if n <= SMALL:
                    i, j = np.triu_indices(n, 1)
                    a, b = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
                    ok = ~cross[a] | (side[a] != side[b])
                    a, b = a[ok], b[ok]
                    for c in range(0, len(a), PAIRS):
                        part = slice(c, c + PAIRS)
                        live = c + survivors(sig, a[part], b[part], band[a[part]])
                        left.append(a[live])
                        right.append(b[live])
                    continue
                for start in at:
                    rows = max(1, PAIRS // n)
                    for x in range(0, n, rows):
                        i, j = np.nonzero(np.arange(x, min(x + rows, n))[:, None] < np.arange(n)[None, :])
                        a, b = start + x + i, start + j
                        if cross[start]:
                            meet = side[a] != side[b]
                            a, b = a[meet], b[meet]
                        live = survivors(sig, a, b, int(band[start]))
                        left.append(a[live])
                        right.append(b[live])
            if left:
                root = roots(len(grp), np.concatenate(left), np.concatenate(right))
                far = np.flatnonzero(root != np.arange(len(grp)))
                if len(far):
                    yield pa.RecordBatch.from_arrays([pa.array(rep[far]), pa.array(rep[root[far]])], names=["a", "b"])

    return grouped_rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def verified(blocks: DataFrame) -> DataFrame:
    """(grp, cross, side, rep, copies, text) -> rows (a, b, n): b null: text a gained n links; else a star link."""
    up, down = THRESHOLD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "grp"):
            same = np.zeros(t.num_rows, bool)  # a repeated row of a representative counts once
            same[1:] = (t.column("grp").to_numpy()[1:] == t.column("grp").to_numpy()[:-1]) & (t.column("rep").to_numpy()[1:] == t.column("rep").to_numpy()[:-1])
            t = t.filter(pa.array(~same)).combine_chunks() if same.any() else t
            grp, rep, copies = (t.column(c).to_numpy() for c in ("grp", "rep", "copies"))
            side, cross = t.column("side").to_numpy(), t.column("cross").to_numpy(zero_copy_only=False)
            texts = t.column("text")
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            first = np.append(np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])), len(grp))
            out_a, out_b, out_n = [], [], []
            for lo, hi in zip(first[:-1], first[1:], strict=True):
                n = hi - lo
                if n < 2:
                    continue
                x = Text(texts.slice(lo, n), lower=True)
                s, e, row = x.words()
                sh, sr = shingles(x.hash(s, e), row, n, WIDTH)
                order = np.lexsort((sr, sh))
                sh, sr = sh[order], sr[order]
                once = np.ones(len(sh), bool)
                once[1:] = (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])
                sh, sr = sh[once], sr[once]
                size = np.bincount(sr, minlength=n)
                start = np.concatenate([[True], sh[1:] != sh[:-1]])
                col = np.cumsum(start) - 1
                shared = np.bincount(col)[col] > 1
                col, sr = col[shared], sr[shared]
                if not len(col):
                    continue
                col = np.cumsum(np.concatenate([[False], col[1:] != col[:-1]]))
                inter = np.zeros((n, n), np.float64)
                width = max(64, (1 << 22) // n)
                edges = np.searchsorted(col, np.arange(0, col[-1] + width, width))
                for c0, (p, q) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    m = np.zeros((n, min(width, col[-1] + 1 - c0 * width)), np.float32)
                    m[sr[p:q], col[p:q] - c0 * width] = 1
                    inter += m @ m.T
                linked = down * inter >= up * (size[:, None] + size[None, :] - inter)
                np.fill_diagonal(linked, False)
                if cross[lo]:
                    linked &= side[lo:hi, None] != side[None, lo:hi]
                gained = linked @ copies[lo:hi]
                has = np.flatnonzero(gained)
                if not len(has):
                    continue
                i, j = np.nonzero(np.triu(linked))
                root = roots(n, i, j)
                far = np.flatnonzero(root != np.arange(n))
                out_a += [rep[lo + has], rep[lo + far]]
                out_b += [np.full(len(has), -1), rep[lo + root[far]]]
                out_n += [gained[has], np.zeros(len(far), np.int64)]
            if out_a:
                a, b, n = np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_n)
                links = np.concatenate([np.full(len(v), k % 2 == 1) for k, v in enumerate(out_a)])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=~links), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    rows = blocks.select("grp", "cross", "side", "rep", "copies", "text").repartition("grp").sortWithinPartitions("grp", "rep")
    return rows.mapInArrow(run, "a long, b long, n long")


def classes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text) -> doc_id, class_id, n_links (other documents linked to it, copies included)."""
    small_batches(docs.sparkSession)
    base = docs.select("doc_id", "text")
    sigs = scratch.write(signatures(base), "sigs")
    ids = sigs.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    ids = scratch.write(ids, "texts")
    own = sigs.join(ids.select(F.col("digest").alias("_d"), "rep"), (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("_d")))
    reps = scratch.write(own.dropDuplicates(["rep"]).select("rep", "sig", "keys"), "reps")
    buckets = reps.select("rep", F.posexplode("keys").alias("band", "bucket"))
    stars = scratch.write(candidate_stars(buckets, reps.select("rep", "sig"), scratch), "stars")
    scratch.drop("members", "reps")
    scratch.release()
    blocks = scratch.write(components(stars, scratch, "blocks"), "block_of")
    scratch.drop("stars")
    sized = blocks.join(blocks.groupBy("comp").agg(F.count("*").alias("n")), "comp").withColumnRenamed("node", "rep")
    sized = scratch.write(sized.join(ids.groupBy("rep").agg(F.max("copies").alias("copies")), "rep"), "sized")
    texts = base.where("text is not null").join(hint_small(sized.withColumnRenamed("rep", "doc_id")), "doc_id").withColumnRenamed("doc_id", "rep")
    found = scratch.write(verified(split_groups(texts, "comp", "n", "rep", BLOCK // 2)), "found")
    scratch.release()
    label = components(found.where("b is not null").select("a", "b"), scratch, "cls")
    gained = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    near = gained.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    per_text = scratch.write(
        ids.join(near, "rep", "left").select("digest", F.coalesce("comp", "rep").alias("class_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "per_text")
    linked = sigs.select("doc_id", "digest").join(per_text, "digest").select("doc_id", "class_id", "n_links")
    linked = scratch.write(linked, "linked")
    scratch.drop("sigs", "texts", "sized", "found", "per_text", "block_of")
    rest = base.select("doc_id", "text").where("doc_id is null or text is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    return linked.unionByName(rest.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
