"""MinHash near-dedup with bottom-k sketches from one hash function.

A text is the set of its distinct five-word shingles; two texts are linked if 100 * intersection >= 85 *
union. Classes are the connected components of links.

1. Equal sets are folded first (by a 128-bit digest of the set, partial aggregation): a group of copies of
   any size costs one row from here on.
2. One hash function gives every shingle a 64-bit value; the ``K`` = 64 least values of a set are its sketch.
3. Inverted lists: the ``LISTED`` = 32 least values are counted over all sketches. Linked sets share at least
   14 of them but for a chance below 1e-8 (hypergeometric at similarity 0.85), so a set goes to the lists of its
   19 rarest values only: two sets with 14 values in common meet in one of those. Values found once make no list.
4. Linear start: of the lists' least members, the one a set meets most often is compared with it, by the
   union-sketch estimate (the share of the union's k least values that both sketches hold) and then exactly.
   Most copies are joined to their group here, one comparison a set, whatever the group's size.
5. Lists whose members still lie in several components ("open" lists) are compared all against all, in
   blocks: pairs inside one component are settled and skipped, the rest is filtered by size and by the
   union-sketch estimate. Pairs that pass leave as spanning stars, never as all pairs.
6. Components of those stars are the blocks of the last step, where the exact similarity of all pairs of
   different components is taken from the full shingle sets. Verified links, added to those of step 4,
   give the classes.

Lists and blocks above ``BLOCK`` rows are split: members are hashed into parts, each pair of parts is a group
of its own. Nothing is capped: an unlinked pair costs one comparison, a linked one its share of a star.

Words are maximal runs outside white space; only A-Z are lower-cased. A text of one to four words has one
shingle, all its words. The estimate must reach ``LEAST`` = 38 of 64, 4.7 standard deviations below 0.85.

Defined cases: null text, empty text and texts without words: n_shingles 0, linked with nothing, their own
id as component; null doc_id: n_shingles as it is, component_id and kept null, the row links no others through
itself unless its set has rows with ids; repeated rows are copies; rows that share an id but differ in text
are separate sets; an empty table gives an empty result; extra columns are ignored. Sets are compared by 64-bit
shingle hashes. Long texts are hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, hint_small
from .jaccard_join import grouped, roots, split_groups
from .textnum import Text, chunks, column, mix, segment_starts, shingles
from .wordspans import word_hashes

WIDTH = 5
NUM, DEN = 85, 100  # the threshold as whole numbers
K = 64
LEAST = 38
LISTED, SHARED = 32, 14
BLOCK = 512
LOAD = 8192  # a text counts in a block as one row for every so many shingles
LEAVES = 256  # sets compared with one centre in a group
CHUNK = 1 << 20
PAIRS = 1 << 14
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)

WORDLESS = "text is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges): the sorted distinct shingle hashes of each text, text i's at edges[i]:edges[i+1]."""
    t = Text(pc.ascii_lower(texts))
    s, e, row = t.words()
    sh, sr = shingles(word_hashes(t, s, e), row, t.n, WIDTH)
    order = np.lexsort((sh, sr))
    sh, sr = sh[order], sr[order]
    once = np.ones(len(sh), bool)
    once[1:] = (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])
    sh, sr = sh[once], sr[once]
    return sh, segment_starts(sr, t.n)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the text as it is), digest of the set, n, sketch (the K least values as bytes) of every text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for i, j in chunks(texts, CHUNK):
                sh, edges = shingle_sets(texts.slice(i, j - i))
                at = np.flatnonzero(edges[1:] > edges[:-1])
                if not len(at):
                    continue
                take, lo, n = pa.array(i + at), edges[at], (edges[at + 1] - edges[at]).astype(np.int64)
                both = np.stack([np.add.reduceat(mix(sh ^ _A), lo), np.add.reduceat(mix(sh ^ _B), lo) + n.astype(np.uint64)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(list(map(bytes, both)), pa.binary()), pa.array(n),
                     pa.array([sh[x : x + min(K, m)].tobytes() for x, m in zip(lo, n, strict=True)], pa.binary())],
                    names=["doc_id", "text_key", "digest", "n", "sketch"])

    src = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return src.mapInArrow(run, "doc_id long, text_key long, digest binary, n long, sketch binary")


def listed_values(sets: DataFrame) -> DataFrame:
    """(node, m, value): the LISTED least values of each sketch; m is their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sk = [np.frombuffer(x, np.int64)[:LISTED] for x in b.column(1).to_pylist()]
            m = np.array([len(x) for x in sk], np.int64)
            if len(m):
                node = np.repeat(b.column(0).to_numpy(), m)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.repeat(m, m).astype(np.int32)), pa.array(np.concatenate(sk))],
                                                 names=["node", "m", "value"])

    return sets.select("node", "sketch").mapInArrow(run, "node long, m int, value long")


def inverted_lists(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(value, size, node): each set in the lists of its rarest values, as many as one of them must be
    shared by any linked pair. Lists of one are left out."""
    values = listed_values(sets)
    found = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    rows = values.join(found, "value").groupBy("node", "m").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("often"))  # at most LISTED values
    # linked sets share SHARED of LISTED values; values found once are rarer than all others and come first
    need = F.greatest(F.floor(F.col("m") * SHARED / LISTED), F.lit(1))
    prefix = F.col("m") - need + 1 - (F.col("m") - F.size("often"))
    rows = rows.select("node", F.explode(F.slice("often", 1, F.greatest(prefix, F.lit(0)).cast("int"))).alias("v"))
    rows = rows.select("node", F.col("v.value").alias("value"))
    rows = scratch.write(rows, "prefixes")
    sizes = rows.groupBy("value").agg(F.count("*").alias("size"), F.min("node").alias("centre")).where("size > 1")
    return rows.join(sizes, "value")


def union_estimate(sk: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the union-sketch estimate of each pair (rows a, b of the padded sketches) is high enough.

    The union's k least values (k = K, fewer only where both sets are held whole) are those of the merged
    sketches; the estimate is the share of them that both hold. It must reach LEAST / K."""
    keep = np.zeros(len(a), bool)
    for c in range(0, len(a), PAIRS):
        x, y = a[c : c + PAIRS], b[c : c + PAIRS]
        both = np.sort(np.concatenate([sk[x], sk[y]], axis=1), axis=1)
        same = both[:, 1:] == both[:, :-1]
        real = both[:, 1:] != np.uint64(0xFFFFFFFFFFFFFFFF)
        rank = np.cumsum(np.concatenate([np.ones((len(x), 1), bool), ~same], axis=1), axis=1)  # of the distinct values
        shared = (same & real & (rank[:, 1:] <= K)).sum(axis=1)
        whole = (both != np.uint64(0xFFFFFFFFFFFFFFFF)).sum(axis=1) - (same & real).sum(axis=1)
        keep[c : c + PAIRS] = shared * K >= LEAST * np.minimum(K, whole)
    small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
    return keep & (DEN * small >= NUM * large)


def padded(column: pa.Array) -> np.ndarray:
    """(rows, K) sketch values, filled up with the greatest value."""
    out = np.full((len(column), K), np.uint64(0xFFFFFFFFFFFFFFFF))
    for r, x in enumerate(column.to_pylist()):
        v = np.frombuffer(x, np.uint64)
        out[r, : len(v)] = v
    return out


def likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union-sketch estimate is high enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            n = t.num_rows
            if not n:
                continue
            sk = np.concatenate([padded(t.column(4)), padded(t.column(5))])
            size = np.concatenate([t.column(2).to_numpy(), t.column(3).to_numpy()])
            ok = union_estimate(sk, size, np.arange(n), n + np.arange(n))
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([t.column(0).filter(keep), t.column(1).filter(keep)], names=["a", "b"])

    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a: leaf, b: centre) that are links by their full sets. Each leaf's text travels once a
    pair, a centre's once for every LEAVES leaves."""
    many = pairs.groupBy("b").agg(F.count("*").alias("_n"))
    cells = pairs.join(many, "b").withColumn("grp", F.xxhash64("b", F.pmod(F.xxhash64("a"), F.ceil(F.col("_n") / LEAVES))))
    leaf = cells.select("grp", F.col("a").alias("node"), F.lit(1).alias("leaf"))
    centre = cells.select("grp", F.col("b").alias("node"), F.lit(0).alias("leaf")).distinct()
    rows = leaf.unionByName(centre).join(texts, "node").select("grp", "leaf", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, have, who = None, None, None
        for b in batches:
            texts_ = column(b, "text")
            grp, leaf_, node = (b.column(c).to_numpy() for c in range(3))
            left, right = [], []
            for i, j in chunks(texts_, CHUNK):
                sh, edges = shingle_sets(texts_.slice(i, j - i))
                for r in range(i, j):
                    mine = sh[edges[r - i] : edges[r - i + 1]]
                    if not leaf_[r]:
                        own, have, who = grp[r], mine.copy(), node[r]
                    elif grp[r] == own and len(mine):
                        at = np.minimum(np.searchsorted(have, mine), len(have) - 1)
                        inter = int((have[at] == mine).sum())
                        if DEN * inter >= NUM * (len(have) + len(mine) - inter):
                            left.append(node[r])
                            right.append(who)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return rows.repartition("grp").sortWithinPartitions("grp", "leaf").mapInArrow(run, "a long, b long")


def _overlap(col: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """(n, n) numbers of common values from the distinct (value, row) incidences, by matrix products."""
    inter = np.zeros((n, n), np.float32)
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    if not len(col):
        return inter
    fresh = np.concatenate([[True], col[1:] != col[:-1]])
    number = np.cumsum(fresh) - 1
    shared = np.bincount(number)[number] > 1
    number, row = number[shared], row[shared]
    if not len(number):
        return inter
    number = np.cumsum(np.concatenate([[False], number[1:] != number[:-1]]))
    width = max(64, (1 << 22) // n)
    cuts = np.searchsorted(number, np.arange(0, number[-1] + width, width))
    for k, (p, q) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        m = np.zeros((n, min(width, number[-1] + 1 - k * width)), np.float32)
        m[row[p:q], number[p:q] - k * width] = 1
        inter += m @ m.T
    return inter


def _groups(t: pa.Table) -> Iterator[tuple[int, int]]:
    grp = t.column("grp").to_numpy()
    first = np.append(np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])), len(grp))
    yield from ((int(lo), int(hi)) for lo, hi in zip(first[:-1], first[1:], strict=True) if hi - lo > 1)


def _apart(t: pa.Table, lo: int, hi: int) -> np.ndarray:
    """Pairs a < b of a group that lie in different components (and in different parts of a split group)."""
    comp, side = t.column("comp").to_numpy()[lo:hi], t.column("side").to_numpy()[lo:hi]
    apart = np.triu(comp[:, None] != comp[None, :], 1)
    if t.column("cross")[lo].as_py():
        apart &= side[:, None] != side[None, :]
    return apart


def open_stars(lists: DataFrame, label: DataFrame, sets: DataFrame) -> DataFrame:
    """Stars (a, b) that span the likely pairs of different components within the lists."""
    rows = lists.select("value", "size", "node").join(label, "node")
    ends = rows.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("value")
    still = rows.join(ends, "value")
    still = split_groups(still, "value", "size", "node", BLOCK).join(sets.select("node", "n", "sketch"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "grp"):
            node, size = t.column("node").to_numpy(), t.column("n").to_numpy()
            sk = padded(t.column("sketch").combine_chunks())
            left, right = [], []
            for lo, hi in _groups(t):
                n = hi - lo
                apart = _apart(t, lo, hi)
                if not apart.any():
                    continue
                r, c = np.nonzero(sk[lo:hi] != np.uint64(0xFFFFFFFFFFFFFFFF))
                common = _overlap(sk[lo + r, c], r, n)
                held = np.minimum(K, size[lo:hi])
                # the estimate counts no more than all common values, out of the larger sketch at least
                apart &= common * K >= LEAST * np.maximum(held[:, None], held[None, :]) - 0.5
                a, b = np.nonzero(apart)
                ok = union_estimate(sk, size, lo + a, lo + b)
                left.append(lo + a[ok])
                right.append(lo + b[ok])
            if left:
                root = roots(len(node), np.concatenate(left), np.concatenate(right))
                far = np.flatnonzero(root != np.arange(len(node)))
                yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[root[far]])], names=["a", "b"])

    rows = still.select("grp", "cross", "side", "node", "comp", "n", "sketch")
    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a long, b long")


def block_links(blocks: DataFrame) -> DataFrame:
    """(grp, cross, side, node, comp, text): spanning stars of the exact links between different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, "grp"):
            node = t.column("node").to_numpy()
            texts = t.column("text").combine_chunks()
            left, right = [], []
            for lo, hi in _groups(t):
                n = hi - lo
                apart = _apart(t, lo, hi)
                if not apart.any():
                    continue
                sets = [shingle_sets(texts.slice(lo + i, j - i)) for i, j in chunks(texts.slice(lo, n), CHUNK)]
                sh, size = np.concatenate([x for x, _ in sets]), np.concatenate([np.diff(edges) for _, edges in sets])
                inter = _overlap(sh, np.repeat(np.arange(n), size), n).astype(np.int64)
                apart &= DEN * inter >= NUM * (size[:, None] + size[None, :] - inter)
                a, b = np.nonzero(apart)
                left.append(lo + a)
                right.append(lo + b)
            if left:
                root = roots(len(node), np.concatenate(left), np.concatenate(right))
                far = np.flatnonzero(root != np.arange(len(node)))
                yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[root[far]])], names=["a", "b"])

    rows = blocks.select("grp", "cross", "side", "node", "comp", "text").repartition("grp").sortWithinPartitions("grp")
    return rows.mapInArrow(run, "a long, b long")


def texts_of(nodes: DataFrame, sets: DataFrame, base: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, text): one text of each node, found by id and hash of the text."""
    want = scratch.write(sets.join(nodes.select("node").distinct(), "node").select("node", F.col("one.doc_id").alias("_id"), F.col("one.text_key").alias("_key")), name)
    rows = base.where("text is not null").withColumn("_hash", F.xxhash64("text"))
    found = rows.join(hint_small(want), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")))
    return found.select("node", "text").dropDuplicates(["node"])


def near_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id, kept."""
    base = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    each = scratch.write(sketches(base), "sketches")
    sets = each.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "text_key")).alias("one"),
                                      F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    sets = scratch.write(sets.withColumn("node", F.monotonically_increasing_id()), "sets")  # numbers stay as written
    lists = scratch.write(inverted_lists(sets, scratch), "lists")
    scratch.drop("prefixes")

    mode = lists.where("node <> centre").groupBy("node", "centre").agg(F.count("*").alias("c")).groupBy("node").agg(
        F.max_by("centre", F.struct("c", F.negative("centre"))).alias("centre"))
    start = scratch.write(likely(mode.select(F.col("node").alias("a"), F.col("centre").alias("b")), sets), "start")
    ends = start.select(F.col("a").alias("node")).unionByName(start.select(F.col("b").alias("node")))
    first_links = scratch.write(confirmed(start, texts_of(ends, sets, base, scratch, "ends")), "links1")
    joined = components(first_links, scratch, "c1")
    label = lists.select("node").distinct().join(joined, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))
    label = scratch.write(label, "label")
    stars = scratch.write(open_stars(lists, label, sets), "stars")
    scratch.drop("lists", "start", "ends")

    block = scratch.write(components(stars, scratch, "c2").withColumnRenamed("comp", "block").join(sets.select("node", "n"), "node"), "blocks")
    load = block.groupBy("block").agg(F.greatest(F.count("*"), F.ceil(F.sum("n") / LOAD)).alias("size"))
    cells = split_groups(block.drop("n").join(load, "block").join(label, "node"), "block", "size", "node", BLOCK // 2)
    more = scratch.write(block_links(cells.join(texts_of(block, sets, base, scratch, "inner"), "node")), "links2")
    comp = components(first_links.unionByName(more), scratch, "c3")
    named = sets.select("node", "digest", "first").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = scratch.write(named, "named")
    least = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    by_digest = scratch.write(named.join(least, "comp").select("digest", "component_id"), "by_digest")
    own = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    out = scratch.write(each.select("doc_id", "digest", "n").join(by_digest, "digest").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")), "linked")
    scratch.drop("sketches", "sets", "links1", "label", "stars", "blocks", "inner", "links2", "named", "by_digest")
    rest = base.where(WORDLESS).select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("doc_id") == F.col("component_id"))


#: The query in DuckDB: exact similarity of all pairs that share a shingle, components by reachability.
SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_reached AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(r.b, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(r.b, s.doc_id)) AS kept
FROM sets s LEFT JOIN least_reached r ON r.a = s.doc_id
"""
