"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL-proximal.

A text is split into tokens: runs of letters and digits, and runs of other visible characters. Features
are hashed into ``2 ** BITS`` buckets: token unigrams and bigrams, unigrams and bigrams of token shapes
(kind, case, length class), and token trigrams seen earlier in the same text. A feature's value is its
count over the number of tokens, so a text's score is the sparse dot product of its counts with the
weights, divided by its length, through the logistic function.

Training takes a bounded sample of labelled documents (:func:`training.labelled_sample`) in a fixed
order; per-coordinate FTRL keeps weights of uninformative buckets at exactly zero. Scoring streams
Arrow batches in chunks of a few MB over whole texts.

Defined cases: null, empty or token-less texts get the bias's score; without labels of both classes the
score is 0.5 everywhere; repeated rows get equal scores; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold
from .textnum import _ALNUM, _SPACE, Text, chunks, column, mix
from .training import labelled_sample

BITS = 20
PER_CLASS = 3000
SCALE = np.float32(8.0)
THRESHOLD = 0.3
CHUNK = 1 << 20

_CLASS = np.where(_SPACE, 0, np.where(_ALNUM, 1, 2)).astype(np.uint8)
_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[0x41:0x5B] = 1


def tokens(t: Text):
    """Starts, ends and rows of the tokens."""
    cls = _CLASS[t.data]
    n = len(cls)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    cut = np.ones(n + 1, dtype=bool)
    cut[1:n] = cls[1:] != cls[:-1]
    cut[t.offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    keep = cls[starts] > 0
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(t.offsets, starts, side="right") - 1


def bucket_families(t: Text):
    """Rows of the tokens and a list of (bucket per token, whether it counts) families."""
    s, e, row = tokens(t)
    if not len(s):
        return row, []
    h = t.hash(s, e)
    upper = np.concatenate([[0], np.cumsum(_UPPER[t.data])])
    size = e - s
    ups = upper[e] - upper[s]
    kind = _CLASS[t.data[s]].astype(np.uint64)
    case = np.where(ups == 0, 0, np.where(ups == size, 2, np.where(_UPPER[t.data[s]] == 1, 1, 3))).astype(np.uint64)
    shape = mix(kind * np.uint64(1000) + case * np.uint64(100) + np.minimum(size, 15).astype(np.uint64) + np.uint64(1))
    same = np.zeros(len(s), bool)
    same[1:] = row[1:] == row[:-1]
    mask = np.uint64((1 << BITS) - 1)

    def pair(x, salt):
        y = np.empty_like(x)
        y[1:] = x[:-1]
        y[0] = 0
        return mix(x * np.uint64(0x9E3779B97F4A7C15) + y + np.uint64(salt))

    two = pair(h, 11)
    third = np.zeros(len(s), bool)
    third[2:] = row[2:] == row[:-2]
    tri = pair(two, 13) ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    own = np.flatnonzero(third)  # trigrams that begin in the text before count for neither
    order = own[np.argsort(tri[own], kind="stable")]
    seen = np.zeros(len(s), bool)
    seen[order[1:]] = tri[order[1:]] == tri[order[:-1]]
    again = np.where(seen, np.uint64(7), np.uint64(5))
    return row, [((h & mask).astype(np.int64), None), ((two & mask).astype(np.int64), same), ((shape & mask).astype(np.int64), None),
                 ((pair(shape, 17) & mask).astype(np.int64), same), ((again & mask).astype(np.int64), third)]


def train(texts: list[str], labels: list[int], epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1,
          bias_share: float = 0.5) -> tuple[np.ndarray, float]:
    """FTRL-proximal; returns the weights and the bias. Classes count equally; ``bias_share`` is the
    share of label 1 that the bias is set to afterwards."""
    z, acc = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = b = 0.0
    data = []
    for text, y in zip(texts, labels, strict=True):
        row, fams = bucket_families(Text(pa.array([text], pa.string())))
        if not len(row):
            continue
        ids, cnt = np.unique(np.concatenate([k if ok is None else k[ok] for k, ok in fams]), return_counts=True)
        data.append((ids, cnt * (float(SCALE) / len(row)), y))
    ones = sum(y for *_, y in data)
    weight = {1: len(data) / (2 * max(ones, 1)), 0: len(data) / (2 * max(len(data) - ones, 1))}
    rng = np.random.default_rng(7)

    def current(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(acc[i])) / alpha + l2))

    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            ids, x, y = data[k]
            w = current(ids)
            p = 1 / (1 + np.exp(-min(max(w @ x + b, -35), 35)))
            g = (p - y) * weight[y]
            gx = g * x
            sigma = (np.sqrt(acc[ids] + gx * gx) - np.sqrt(acc[ids])) / alpha
            z[ids] += gx - sigma * w
            acc[ids] += gx * gx
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * b
            nb += g * g
            b = -zb / ((beta + np.sqrt(nb)) / alpha)
    share = min(max(bias_share, 0.01), 0.99)
    return current(np.arange(1 << BITS)).astype(np.float32), float(b + np.log(share / (1 - share)))


def score_texts(arr: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(arr))
    for i, j in chunks(arr, CHUNK):
        t = Text(arr.slice(i, j - i))
        row, fams = bucket_families(t)
        total = np.zeros(t.n)
        for k, ok in fams:
            v = weights[k]
            if ok is not None:
                v = v * ok
            total += np.bincount(row, weights=v, minlength=t.n)
        n = np.maximum(np.bincount(row, minlength=t.n) if len(row) else np.zeros(t.n), 1)
        out[i:j] = total * float(SCALE) / n + bias
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, bias: float, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for batch in batches:
            s = score_texts(column(batch, "text"), w, b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    rows = labelled_sample(docs, labels, "quality", 5, 0, per_class, [0, 1])
    held = fold(F.col("doc_id"), 5) == 0
    if len({r["label"] for r in rows}) < 2:
        return score(docs, np.zeros(1 << BITS, np.float32), 0.0, held)
    share = labels.where(fold(F.col("doc_id"), 5) != 0).agg(F.avg("quality")).first()[0]
    return score(docs, *train([r["text"] for r in rows], [r["label"] for r in rows], bias_share=0.5 + (share - 0.5) / 2), held)
