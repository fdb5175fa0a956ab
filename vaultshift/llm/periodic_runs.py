"""Periodic runs: stretches of words that repeat with a period, found by a sparse diagonal DP.

A run with period q is a maximal stretch in which words q apart are equal, q being its smallest period
and its length at least ``max(MIN_LENGTH, 3 * q)``. On the word-by-word match matrix it is a diagonal at
lag q of ``length - q`` matches, which is never less than ``GRAM`` = 16 and never less than 2 * q.

The DP walks the words of a text. For every word its earlier occurrences open or extend diagonals: the
match length at (word, lag) is the one at (previous word, same lag) plus one, and a diagonal that ends
long enough emits its run there and then. Counting every pair of equal words would be quadratic in a
frequent word, so earlier occurrences are looked up through the gram of ``L`` words that the diagonal must
hold anyway: L = 16 for periods up to 16, 32 for 17 to 32, 64 for 33 to 64 and so on. At the scale L of a
period q (q <= L) the nearest earlier occurrence of the gram is exactly q back at every word of the run's
diagonal, or at none: were one nearer, at p < q, the gram and its shift would have periods p and q over
at least p + q words, hence the greatest common divisor of both (Fine and Wilf), and so would the whole
stretch, whose smallest period then is not q. One lag a word is therefore enough, nothing is lost, and
the diagonals active at a scale cost no more than the grams that occur twice; a gram that occurs once
is out of all longer scales.

The words of a whole Arrow chunk go through the DP side by side (grams never cross texts). Words are
compared by 64-bit hashes. A text is scanned inside one task; memory is a few arrays of its word count.

Defined cases: null text or text without words: n_words 0, no runs, collapsed text empty; null doc_id:
the text as it is (only ``rewritten`` uses the id), the id stays null; repeated rows give repeated rows; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textnum import Text, chunks, column, mix
from .wordspans import word_hashes

MIN_LENGTH = 24
GRAM = 16
CHUNK = 1 << 20
JOIN_WORDS = 1 << 14
_MUL = np.uint64(0xC2B2AE3D27D4EB4F)

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
RUNS_SCHEMA = "doc_id long, start long, length long, period long"


def _doubled(gram: np.ndarray, width: int) -> np.ndarray:
    """Hashes of 2 * width words from those of width words, by first word (shorter by width)."""
    return mix(gram[:-width] * _MUL + gram[width:]) if len(gram) > width else np.zeros(0, np.uint64)


def find_runs(word: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """(runs, 4): row, start (word number in its row), length, period, sorted; ``row`` is ascending."""
    counts = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    end = np.cumsum(counts)
    base = end - counts
    gram, width = word, 1
    while width < GRAM:
        gram, width = _doubled(gram, width), width * 2
    live = np.arange(len(gram))  # first words of grams that may occur twice
    found, low = [], 0  # this scale: periods above ``low``, up to ``width``
    while len(live):
        r = row[live]
        live = live[(live + width <= end[r]) & (counts[r] >= max(MIN_LENGTH, 3 * (low + 1)))]
        if not len(live):
            break
        key = gram[live] + mix(row[live].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        again = key[order[1:]] == key[order[:-1]]
        at, before = live[order[1:][again]], live[order[:-1][again]]
        lag = at - before  # to the nearest earlier occurrence
        fits = (lag > low) & (lag <= width)
        at, lag = at[fits], lag[fits]
        walk = np.argsort(at)
        at, lag = at[walk], lag[walk]
        if len(at):  # diagonals: neighbouring words on one lag
            opens = np.ones(len(at), bool)
            opens[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(at)) - 1
            q = lag[first]
            length = at[last] - at[first] + width + q
            emit = length >= np.maximum(MIN_LENGTH, 3 * q)
            first, q, length = first[emit], q[emit], length[emit]
            of = row[at[first]]
            found.append(np.stack([of, at[first] - q - base[of], length, q], axis=1))
        twice = np.zeros(len(gram), bool)
        twice[live[order[1:][again]]] = True
        twice[live[order[:-1][again]]] = True
        starts = np.flatnonzero(twice)
        gram, low = _doubled(gram, width), width
        starts = starts[starts < len(gram)]
        live = starts[twice[starts + width]]
        width *= 2
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def rewritten(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's planted repeats: of a document with crc32(id) % 10 = 0 word i >= a becomes word
    a + (i - a) % p. Returns the word taken for each place, None for all other documents."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    take = np.arange(n)
    take[a:] = a + (take[a:] - a) % p
    return take


def _texts(batch: pa.RecordBatch, rewrite: bool):
    """For each chunk: ids, Text, word starts, ends, words' count and first word by row, word taken for
    each place, runs."""
    ids, texts = batch.column(0), column(batch, "text")
    for i, j in chunks(texts, CHUNK):
        t = Text(texts.slice(i, j - i))
        s, e, row = t.words()
        h = word_hashes(t, s, e)
        counts = np.bincount(row, minlength=t.n) if len(row) else np.zeros(t.n, np.int64)
        base = np.cumsum(counts) - counts
        own = ids.slice(i, j - i).to_pylist()
        take = np.arange(len(s))
        if rewrite:
            for k in range(t.n):
                new = rewritten(own[k], int(counts[k]))
                if new is not None:
                    take[base[k] : base[k] + counts[k]] = base[k] + new
        yield own, t, s, e, counts, base, take, find_runs(h[take], row, t.n)


def _joined_sha(t: Text, s: np.ndarray, e: np.ndarray, words: np.ndarray) -> str:
    """sha256 of the words joined by one space, a few thousand words at a time."""
    sha = hashlib.sha256()
    data = memoryview(t.data)
    for k in range(0, len(words), JOIN_WORDS):
        part = words[k : k + JOIN_WORDS]
        lo, hi = s[part].tolist(), e[part].tolist()
        sha.update((b" " if k else b"") + b" ".join([data[x:y] for x, y in zip(lo, hi, strict=True)]))
    return sha.hexdigest()


def _plain_sha(t: Text, k: int) -> str:
    """The same for all words of row k."""
    sha, lo, hi = hashlib.sha256(), int(t.offsets[k]), int(t.offsets[k + 1])
    first = True
    while lo < hi:
        cut = min(lo + CHUNK, hi)
        piece = t.data[lo:cut].tobytes()
        if cut < hi and piece[-1:].strip() and t.data[cut : cut + 1].tobytes().strip():  # inside a word: back to its start
            back = len(piece) - len(piece.split()[-1]) if len(piece.split()) > 1 else 0
            while not back:  # one word fills the piece
                cut = min(cut + CHUNK, hi)
                piece = t.data[lo:cut].tobytes()
                back = len(piece) if cut == hi else max((piece.rfind(c) + 1 for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")), default=0)
            cut, piece = lo + back, piece[:back]
        words = piece.split()
        if words:
            sha.update((b"" if first else b" ") + b" ".join(words))
            first = False
        lo = cut
    return sha.hexdigest()


def report(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """One row per document: number of runs, the run of greatest length / period (ties: least start, then
    period; nulls without a run), digests of the list of runs and of the text without repeats.

    The collapsed text keeps the words that no run contains after its first period, joined by one space.
    ``rewrite`` plants repeats by document id first (see ``rewritten``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, t, s, e, counts, base, take, runs in _texts(batch, rewrite):
                edge = np.searchsorted(runs[:, 0], np.arange(t.n + 1))
                out = []
                for k, doc_id in enumerate(own):
                    mine = runs[edge[k] : edge[k + 1], 1:].tolist()
                    n, lo = int(counts[k]), int(base[k])
                    best = max(mine, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                    listed = hashlib.sha256()
                    for r in mine:
                        listed.update(b"%d,%d,%d\n" % tuple(r))
                    if mine:
                        edges = np.zeros(n + 1, np.int64)
                        np.add.at(edges, [r[0] + r[2] for r in mine], 1)
                        np.add.at(edges, [r[0] + r[1] for r in mine], -1)
                        kept = take[lo : lo + n][np.cumsum(edges[:-1]) == 0]
                        sha = _joined_sha(t, s, e, kept)
                    elif rewrite and n and (take[lo : lo + n] != np.arange(lo, lo + n)).any():
                        sha = _joined_sha(t, s, e, take[lo : lo + n])
                    else:
                        sha = _plain_sha(t, k)
                    out.append((doc_id, n, len(mine), *(best or (None, None, None)),
                                1000 * best[1] // best[2] if best else None, listed.hexdigest(), sha))
                types = [pa.int64()] * 7 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def all_runs(docs: DataFrame) -> DataFrame:
    """One row per run: doc_id, start (word number from 0), length, period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, *_, runs in _texts(batch, False):
                if len(runs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own[k] for k in runs[:, 0]], pa.int64()), *(pa.array(runs[:, c]) for c in (1, 2, 3))],
                        names=["doc_id", "start", "length", "period"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, RUNS_SCHEMA)
