"""Benchmark decontamination: BM25 over an inverted index of test items, queried with every passage.

Items are indexed by their words (lower-cased runs of letters and digits). A posting's impact is its
BM25 weight over the item's own total, so a passage that holds all words of an item scores 1 and
"above threshold" means the same for short and long items. Every document is cut into overlapping
passages of twice the longest item's length at steps of that length, so that each run of words as long
as any item lies whole in some passage; a passage's query is its distinct words.

Retrieval is block-max WAND with a fixed threshold, vectorised over a chunk of texts:

* pivot: with an item's words ordered from rare to frequent, the words behind the point where the
  impacts left sum to less than the threshold cannot reach it alone, so a passage must hold one of the
  words before it; only these postings produce candidates;
* block-max: items lie in blocks of ``BLOCK`` by length; a candidate whose passage's sum of block maxima
  stays below the threshold is skipped;
* the exact score is taken for what is left, and *all* items at or above the threshold are kept.

Each retrieved pair is verified: the item's words are split into question (the first two thirds) and
answer, and the shares of their word trigrams that occur in the passage must reach ``QUESTION`` and ``ANSWER``.

The index is broadcast in shards of at most ``SHARD_CHARS`` characters of item text, one pass over the
documents per shard, so its size in memory is bounded whatever the benchmark's size.

Items with fewer than ``MIN_WORDS`` words are found by exact match of all their words in a row. In scripts without
spaces every character is a word, so that trigrams are of characters there. Word weights, mean length and passage
span are taken over the whole benchmark, whatever the number of shards.

Defined cases: null and empty texts and items hold nothing and match nothing; null ids match nothing; repeated rows
of a document or item give one result row per pair of ids; empty tables give an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .textnum import Text, chunks, column, shingles

THRESHOLD = 0.6
QUESTION, ANSWER = 0.7, 0.5
MIN_WORDS = 8
K1, B = 1.2, 0.75
BLOCK = 16
SHARD_CHARS = 32 << 20
CHUNK = 1 << 20
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
UNSPACED_MARKS = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}]"


@dataclass
class Index:
    ids: np.ndarray        # item ids, shortest item first
    span: int              # words of the longest item
    terms: np.ndarray      # sorted word hashes
    ess_ptr: np.ndarray    # per term: items for which it lies before the pivot
    ess_item: np.ndarray
    keys: np.ndarray       # term * items + item, sorted
    impact: np.ndarray
    block_keys: np.ndarray  # term * blocks + block, sorted
    block_max: np.ndarray
    question: list[np.ndarray]  # sorted trigram hashes
    answer: list[np.ndarray]
    length: np.ndarray     # words of each item
    short: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # number of words: sorted hashes, item ids

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)


@dataclass
class Stats:
    """Of all items of at least ``MIN_WORDS`` words: how many, their words, the longest, and in how many each word is."""

    items: int = 0
    words: int = 0
    longest: int = 1
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, texts: list[str]) -> None:
        t = parsed(pa.array(texts, pa.string()))
        s, e, row = t.alnum_words()
        n_words = np.bincount(row, minlength=t.n) if len(row) else np.zeros(t.n, np.int64)
        long = n_words[n_words >= MIN_WORDS]
        self.items, self.words = self.items + len(long), self.words + int(long.sum())
        self.longest = max(self.longest, int(long.max(initial=1)))
        keep = n_words[row] >= MIN_WORDS
        tid, inv = np.unique(t.hash(s, e)[keep], return_inverse=True)
        own = np.bincount(np.unique(inv * max(t.n, 1) + row[keep]) // max(t.n, 1), minlength=len(tid))
        terms, at = np.unique(np.concatenate([self.terms, tid]), return_inverse=True)
        self.df = np.bincount(at, weights=np.concatenate([self.df, own]), minlength=len(terms)).astype(np.int64)
        self.terms = terms


def parsed(arr: pa.Array) -> Text:
    """Texts whose characters of scripts without spaces are words of their own."""
    t = Text(arr, lower=True)
    if not (t.data >= 0xE0).any():
        return t
    arr = pc.replace_substring_regex(arr, UNSPACED_MARKS, " ")
    return Text(pc.replace_substring_regex(arr, "(" + UNSPACED + ")", r" \1 "), lower=True)


def build(ids: list[int], texts: list[str], stats: Stats | None = None) -> Index:
    """The index of a shard; ``stats`` are those of the whole benchmark (default: of these items)."""
    if stats is None:
        stats = Stats()
        stats.add(texts)
    t = parsed(pa.array(texts, pa.string()))
    s, e, row = t.alnum_words()
    h = t.hash(s, e)
    n_words = np.bincount(row, minlength=t.n) if len(row) else np.zeros(t.n, np.int64)
    order = [i for i in np.argsort(n_words, kind="stable") if n_words[i] >= MIN_WORDS]
    place = np.full(t.n, -1)
    place[order] = np.arange(len(order))
    keep = place[row] >= 0
    h, item = h[keep], place[row[keep]]
    n = len(order)
    terms, tid = np.unique(h, return_inverse=True)
    length = n_words[order].astype(float)
    pair, tf = np.unique(tid * max(n, 1) + item, return_counts=True)
    term, it = pair // max(n, 1), pair % max(n, 1)
    df = stats.df[np.searchsorted(stats.terms, terms)] if n else np.zeros(0, np.int64)
    idf = np.log(1 + (stats.items - df + 0.5) / (df + 0.5))
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[it] * stats.items / stats.words)) if n else np.zeros(0)
    total = np.bincount(it, weights=weight, minlength=n)
    impact = weight / total[it] if n else weight
    # the pivot of each item: rarest words first, until the rest cannot reach the threshold
    by = np.lexsort((term, df[term], it))
    run = np.cumsum(impact[by])
    first = np.searchsorted(it[by], np.arange(n))
    before = run - impact[by] - np.repeat(np.concatenate([[0], run])[first], np.bincount(it, minlength=n)) if n else run
    essential = by[1 - before >= THRESHOLD - 1e-9]
    ess = essential[np.argsort(term[essential], kind="stable")]
    ess_ptr = np.searchsorted(term[ess], np.arange(len(terms) + 1))
    blocks = max(1, -(-n // BLOCK))
    bkeys, inv = np.unique(term * blocks + it // BLOCK, return_inverse=True)
    bmax = np.zeros(len(bkeys))
    np.maximum.at(bmax, inv, impact)
    question, answer = [], []
    all_h = t.hash(s, e)
    bounds = np.searchsorted(row, np.arange(t.n + 1))  # rows are in order: one pass over the words
    for i in order:
        wh = all_h[bounds[i] : bounds[i + 1]]
        cut = max(3, len(wh) * 2 // 3)
        for part, out in ((wh[:cut], question), (wh[cut - 2 :], answer)):
            out.append(np.unique(shingles(part, np.zeros(len(part), np.int64), 1, 3)[0]))
    short = {}
    for k in range(1, MIN_WORDS):
        rows = np.flatnonzero(n_words == k)
        if len(rows):
            of = np.isin(row, rows)
            got = shingles(all_h[of], np.searchsorted(rows, row[of]), len(rows), k)[0]
            by = np.argsort(got, kind="stable")
            short[k] = got[by], np.array(ids, np.int64)[rows[by]]
    return Index(np.array([ids[i] for i in order], np.int64), stats.longest, terms, ess_ptr, it[ess], pair, impact, bkeys, bmax, question, answer,
                 n_words[order].astype(np.int64), short)


def _score(keys: np.ndarray, values: np.ndarray, width: int, p_first: np.ndarray, term: np.ndarray, passage: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Sum of the values found under (term, column) over each passage's distinct terms."""
    n = p_first[passage + 1] - p_first[passage]
    at = np.repeat(p_first[passage] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    group = np.repeat(np.arange(len(passage)), n)
    wanted = term[at] * width + col[group]
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.bincount(group, weights=np.where(keys[place] == wanted, values[place], 0.0), minlength=len(passage))


def search(t: Text, x: Index) -> list[tuple[int, int, float, float, float]]:
    """(row, item place, score, question share, answer share) of verified pairs in a chunk of texts, a
    passage at a time."""
    s, e, row = t.alnum_words()
    if not len(s) or not len(x.ids):
        return []
    h = t.hash(s, e)
    tid = np.minimum(np.searchsorted(x.terms, h), len(x.terms) - 1)
    tid = np.where(x.terms[tid] == h, tid, -1)
    first = np.searchsorted(row, np.arange(t.n + 1))
    slot = (np.arange(len(row)) - first[row]) // x.span
    slots = np.concatenate([[0], np.cumsum((np.diff(first) + x.span - 1) // x.span)])
    slot = slots[row] + slot  # global number of the step a word is in; passage p holds the steps p and p + 1
    step_row = np.repeat(np.arange(t.n), np.diff(slots))
    deg = x.ess_ptr[tid + 1] - x.ess_ptr[tid]
    deg[tid < 0] = 0
    hit = np.flatnonzero(deg)
    if not len(hit):
        return []
    d = deg[hit]
    items = x.ess_item[np.repeat(x.ess_ptr[tid[hit]] - (np.cumsum(d) - d), d) + np.arange(int(d.sum()))]
    steps = np.repeat(slot[hit], d)
    m = len(x.ids)
    cand = np.unique(np.concatenate([steps * m + items, (np.maximum(steps, slots[step_row[steps]] + 1) - 1) * m + items]))
    passage, item = cand // m, cand % m
    # distinct words of the passages that have a candidate
    step_first = np.searchsorted(slot, np.arange(slots[-1] + 1))
    ps, inv = np.unique(passage, return_inverse=True)
    lo = step_first[ps]
    hi = step_first[np.minimum(ps + 2, slots[step_row[ps] + 1])]
    size = hi - lo
    words = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    owner = np.repeat(np.arange(len(ps)), size)
    known = tid[words] >= 0
    pt = np.unique(owner[known] * len(x.terms) + tid[words[known]])
    p_of, term = pt // len(x.terms), pt % len(x.terms)
    p_first = np.searchsorted(p_of, np.arange(len(ps) + 1))
    out = []
    for a in range(0, len(cand), 4096):
        c_p, c_i = inv[a : a + 4096], item[a : a + 4096]
        keep = _score(x.block_keys, x.block_max, x.blocks, p_first, term, c_p, c_i // BLOCK) >= THRESHOLD - 1e-9
        c_p, c_i = c_p[keep], c_i[keep]
        score = _score(x.keys, x.impact, m, p_first, term, c_p, c_i)
        for p, i, sc in zip(c_p, c_i, score, strict=True):
            if sc < THRESHOLD - 1e-9:
                continue
            grams = shingles(h[lo[p] : hi[p]], np.zeros(hi[p] - lo[p], np.int64), 1, 3)[0]
            q, r = float(np.isin(x.question[i], grams).mean()), float(np.isin(x.answer[i], grams).mean())
            if q >= QUESTION and r >= ANSWER:
                out.append((int(row[lo[p]]), int(i), float(sc), q, r))
    return out


def search_short(t: Text, x: Index) -> list[tuple[int, int, int]]:
    """(row, item id, its words) of the short items whose words stand in a row in a text."""
    s, e, row = t.alnum_words()
    h, out = t.hash(s, e), set()
    for k, (keys, ids) in x.short.items():
        sh, r = shingles(h, row, t.n, k)
        if not len(sh):
            continue
        full = np.bincount(row, minlength=t.n)[r] >= k
        lo, hi = (np.searchsorted(keys, sh, side) for side in ("left", "right"))
        for at in np.flatnonzero((hi > lo) & full).tolist():
            out.update((int(r[at]), int(i), k) for i in ids[lo[at] : hi[at]])
    return sorted(out)


def leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, item_words, n_passages: the contaminated pairs."""
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // SHARD_CHARS))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, item_words long"
    found = None
    shard = lambda k: items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).distinct().orderBy("item_id", "text").collect()
    stats = Stats()
    for k in range(shards):
        stats.add([r["text"] for r in shard(k)])
    for k in range(shards):
        rows = shard(k)
        index = docs.sparkSession.sparkContext.broadcast(build([r["item_id"] for r in rows], [r["text"] for r in rows], stats))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index.value
            for batch in batches:
                texts, rows = column(batch, "text"), []
                for i, j in chunks(texts, CHUNK):
                    t = parsed(texts.slice(i, j - i))
                    rows += [(i + r, x.ids[p], x.length[p], *rest) for r, p, *rest in search(t, x)]
                    rows += [(i + r, item, k, 1.0, 1.0, 1.0) for r, item, k in search_short(t, x)]
                if rows:
                    at, item, size, *rest = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), *(pa.array(v, pa.float64()) for v in rest),
                         pa.array(size, pa.int64())],
                        names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "item_words"])

        part = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(run, schema)
        part = scratch.write(part, f"hits{k}")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max("question_overlap").alias("question_overlap"), F.max("answer_overlap").alias("answer_overlap"),
        F.max("item_words").alias("item_words"), F.count("*").alias("n_passages"))
