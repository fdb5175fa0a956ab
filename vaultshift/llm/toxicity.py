"""Toxicity: a convolutional text classifier over hashed word embeddings, trained by Spark tasks.

Words (lower-cased runs of letters and digits) are hashed into ``2 ** 30`` buckets; the buckets seen in
enough training documents have an embedding row, all others share a zero row. Filters of widths 1,
2 and 3 slide over the word sequence, ReLU and max pooling over the whole text give one number a
filter, a dense layer gives the logit.

Every labelled document outside the held-out fold teaches, with its whole text. Bucket counts are
grouped over all of them. An epoch is one pass of the tasks over their shares of the documents: each runs
AdaGrad from the common parameters, the changes are averaged by the number of documents (sums of
whole numbers, so their order does not matter) and make the next epoch's parameters. Classes count equally.

The decision threshold is calibrated by language: the logits of all training documents are counted in
steps of ``1 / STEPS``, the one of best F1 is found for each language, and scores are shifted so that
it comes out at ``THRESHOLD``. The language is guessed from the words alone (naive Bayes over the
same buckets); a document's lang is used in training only.

Scoring needs no embedding product: each filter tap's response to each bucket is tabulated once, a
word costs six row gathers. Texts are scored whole, in chunks of Arrow batches.

Defined cases: null, empty or word-less texts have zero responses and get a score; without labels of
both classes every score is 0; repeated rows get equal scores; an empty table gives an empty result;
extra columns are ignored. Labels that contradict each other for one id teach nothing; of the texts of
a repeated id the greatest teaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, hint_small
from .textnum import Text, chunks, column
from .training import labelled

MIN_DOCS = 5
SMOOTH = 30.0
MIN_SHARE = 0.004  # of the training documents a bucket must be in, classes counted equally
DIM = 12
FILTERS = 8
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
THRESHOLD = 0.3
MIN_CALIBRATION = 15
EPOCHS, BATCH, RATE = 5, 32, 0.05
TASK_DOCS = 5000  # training documents of a file
STEPS = 256
LONG = 1 << 16  # places of a text pooled at once in training
FIXED = 1 << 20  # parameter changes are summed in whole numbers of 1 / FIXED
CHUNK = 1 << 20


def buckets(t: Text) -> tuple[np.ndarray, np.ndarray]:
    s, e, row = t.alnum_words()
    return (t.hash(s, e) >> np.uint64(34)).astype(np.int64), row


@dataclass
class Model:
    vocab: np.ndarray          # sorted buckets; row k + 1 of the tables
    taps: list[np.ndarray]     # per width and tap: (rows, FILTERS)
    bias: list[np.ndarray]     # per width: (FILTERS,)
    dense: np.ndarray
    offset: float
    lang_logp: np.ndarray      # (rows, languages)
    threshold: np.ndarray      # logit by language; the last entry if no language is known

    @staticmethod
    def lookup(vocab: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(vocab):
            return np.zeros(len(b), np.int32)
        at = np.minimum(np.searchsorted(vocab, b), len(vocab) - 1)
        return np.where(vocab[at] == b, at + 1, 0).astype(np.int32)

    def rows_of(self, b: np.ndarray) -> np.ndarray:
        return self.lookup(self.vocab, b)

    def pooled(self, idx: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """(texts, widths * FILTERS) max-pooled responses; texts are padded with the zero row."""
        counts = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
        start = np.concatenate([[0], np.cumsum(counts + PAD + 1)])
        seq = np.zeros(start[-1] + PAD, np.int32)
        if len(row):
            seq[np.arange(len(idx)) + row * (PAD + 1)] = idx
        out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        # a text's windows begin at its words and the first place behind them, so none reaches the next text
        bounds = np.stack([start[:-1], start[:-1] + counts + 1], axis=1).ravel()
        k = 0
        for j, w in enumerate(WIDTHS):
            z = self.taps[k][seq[: start[-1]]]
            for tap in range(1, w):
                z = z + self.taps[k + tap][seq[tap : start[-1] + tap]]
            k += w
            out[:, j * FILTERS : (j + 1) * FILTERS] = np.maximum.reduceat(z, bounds, axis=0)[::2] + self.bias[j]
        return np.maximum(out, 0)

    def logits(self, idx: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language index) of each of n texts, given the table row and the text of each word."""
        logit = self.pooled(idx, row, n) @ self.dense + self.offset
        n_lang = self.lang_logp.shape[1]
        lang = np.full(n, n_lang)
        if n_lang and len(row):
            total = np.stack([np.bincount(row, weights=self.lang_logp[idx, c], minlength=n) for c in range(n_lang)], axis=1)
            lang = np.where(np.bincount(row[idx > 0], minlength=n) > 0, total.argmax(axis=1), lang)
        return logit, lang

    def scores(self, arr: pa.Array) -> np.ndarray:
        out = np.empty(len(arr))
        for i, j in chunks(arr, CHUNK):
            b, row = buckets(Text(arr.slice(i, j - i), lower=True))
            logit, lang = self.logits(self.rows_of(b), row, j - i)
            out[i:j] = logit - self.threshold[lang]
        return 1 / (1 + np.exp(-np.clip(out + np.log(THRESHOLD / (1 - THRESHOLD)), -35, 35)))


class Network:
    """Trainable parameters as one matrix of ``DIM`` columns: the embedding rows, the filters of each tap, then biases,
    dense weights and offset; ``state`` holds AdaGrad's sums of squares in the same places."""

    def __init__(self, values: np.ndarray, state: np.ndarray, rows: int):
        self.values, self.state, self.rows = values, state, rows

    @classmethod
    def start(cls, emb: np.ndarray, rng: np.random.Generator) -> Network:
        pool = len(WIDTHS) * FILTERS
        values = np.zeros((len(emb) + sum(WIDTHS) * FILTERS - (-(2 * pool + 1) // DIM), DIM))
        values[: len(emb)] = emb
        net = cls(values, np.full(values.shape, 1e-2), len(emb))
        _, kern, rest = net.parts(net.values)
        for k in kern:
            k[:] = rng.normal(0, 0.3, k.shape)
            k[0] = np.abs(k[0]) * np.where(np.arange(FILTERS) % 4 == 3, -1, 1)
        rest[pool : 2 * pool] = np.tile(np.where(np.arange(FILTERS) % 4 == 3, -0.2, 0.2), len(WIDTHS))
        return net

    def parts(self, m: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Views: embedding (rows, DIM), filters of each tap (DIM, FILTERS), biases + dense + offset."""
        at = self.rows + sum(WIDTHS) * FILTERS
        return m[: self.rows], [m[q : q + FILTERS].T for q in range(self.rows, at, FILTERS)], m[at:].reshape(-1)

    def step(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One AdaGrad step on texts given as table rows of their words."""
        emb, kern, rest = self.parts(self.values)
        pool = len(WIDTHS) * FILTERS
        bias, dense = rest[:pool], rest[pool : 2 * pool]
        idx = [np.concatenate([d, np.zeros(PAD + 1, np.int32)]) for d in docs]
        taps = [emb @ k for k in kern]
        pooled, where = np.full((len(docs), pool), -np.inf), np.zeros((len(docs), pool), np.int64)
        for r, seq in enumerate(idx):
            for lo in range(0, len(seq) - PAD, LONG):
                k, m = 0, min(LONG, len(seq) - PAD - lo)
                for j, w in enumerate(WIDTHS):
                    z = taps[k][seq[lo : lo + m]]
                    for tap in range(1, w):
                        z = z + taps[k + tap][seq[lo + tap : lo + tap + m]]
                    k += w
                    at = z.argmax(axis=0)
                    best, sl = z[at, np.arange(FILTERS)], slice(j * FILTERS, (j + 1) * FILTERS)
                    where[r, sl] = np.where(best > pooled[r, sl], at + lo, where[r, sl])
                    pooled[r, sl] = np.maximum(best, pooled[r, sl])
        pooled += bias
        act = np.maximum(pooled, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ dense + rest[2 * pool], -35, 35)))
        g = (p - y) * weight / len(docs)
        g_pool = g[:, None] * dense[None, :] * (pooled > 0)
        change = np.zeros_like(self.values[self.rows :])
        at = sum(WIDTHS) * FILTERS
        g_rest = change[at:].reshape(-1)
        g_rest[:pool], g_rest[pool : 2 * pool], g_rest[2 * pool] = g_pool.sum(axis=0), act.T @ g + 1e-3 * dense, g.sum()
        k, g_rows, g_vals = 0, [], []
        for j, w in enumerate(WIDTHS):
            sl = slice(j * FILTERS, (j + 1) * FILTERS)
            for tap in range(w):
                hit = np.stack([idx[r][where[r, sl] + tap] for r in range(len(docs))])
                gp = g_pool[:, sl]
                change[(k + tap) * FILTERS : (k + tap + 1) * FILTERS] = np.einsum("rfd,rf->fd", emb[hit], gp)
                g_rows.append(hit.ravel())
                g_vals.append((gp[:, :, None] * kern[k + tap].T[None]).reshape(-1, DIM))
            k += w
        uniq, inv = np.unique(np.concatenate(g_rows), return_inverse=True)
        g_emb = np.zeros((len(uniq), DIM))
        np.add.at(g_emb, inv, np.concatenate(g_vals))
        g_emb += 1e-3 * emb[uniq]
        g_emb[uniq == 0] = 0
        for rows, grad in ((uniq, g_emb), (slice(self.rows, None), change)):
            self.state[rows] += grad**2
            self.values[rows] -= rate * grad / np.sqrt(self.state[rows])

    def model(self, vocab: np.ndarray, lang_logp: np.ndarray, threshold: np.ndarray) -> Model:
        emb, kern, rest = self.parts(self.values)
        pool = len(WIDTHS) * FILTERS
        return Model(vocab, [(emb @ k).astype(np.float32) for k in kern], list(rest[:pool].astype(np.float32).reshape(len(WIDTHS), FILTERS)),
                     rest[pool : 2 * pool].astype(np.float32), float(rest[2 * pool]), lang_logp.astype(np.float32), threshold)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    col = batch.column(batch.schema.get_field_index(name))
    off = col.offsets.to_numpy()
    return col.values.to_numpy()[off[0] : off[-1]], off - off[0]


def _threshold(value: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """The logit of best F1, given how many documents of either class have each value; halfway to the next one below."""
    value, at = np.unique(value, return_inverse=True)
    pos, neg = (np.bincount(at, weights=x, minlength=len(value)) for x in (pos, neg))
    if not pos.sum() or not neg.sum():
        return 0.0
    middles = np.concatenate([[value[0] - 1], (value[1:] + value[:-1]) / 2])
    tp, fp = (x[::-1].cumsum()[::-1] for x in (pos, neg))
    f1 = 2 * tp / (tp + fp + pos.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    return float(middles[best[len(best) // 2]])


def word_rows(rows: DataFrame) -> DataFrame:
    """(doc_id, text, label, lang) -> doc_id, label, lang, words (buckets of the whole text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for i, j in chunks(texts, CHUNK):
                b, row = buckets(Text(texts.slice(i, j - i), lower=True))
                words = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32), pa.array(b.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)).slice(i, j - i) for c in ("doc_id", "label", "lang")), words],
                                                 names=["doc_id", "label", "lang", "words"])

    return rows.select("doc_id", "text", "label", "lang").mapInArrow(run, "doc_id long, label int, lang string, words array<int>")


def epoch(docs: DataFrame, net: Network, weight: tuple[float, float], seed: int, rate: float = RATE) -> Network:
    """One pass of all tasks over (label, words: table rows), each from ``net``; the mean of the outcomes."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = shared.value
        own, n, rng = Network(first.values.copy(), first.state.copy(), first.rows), 0, np.random.default_rng(seed)
        for batch in batches:
            idx, off = _lists(batch, "words")
            y = batch.column(batch.schema.get_field_index("label")).to_numpy().astype(np.float64)
            order = rng.permutation(len(y))
            for a in range(0, len(y), BATCH):
                part = order[a : a + BATCH]
                own.step([idx[off[i] : off[i + 1]] for i in part], y[part], np.where(y[part] == 1, weight[1], weight[0]), rate)
            n += len(y)
        if n:
            moved = np.concatenate([own.values - first.values, own.state - first.state], axis=1)
            at = np.flatnonzero(moved.any(axis=1))
            moved = np.rint(moved[at] * (n * FIXED)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in moved.T)], names=["at", *cols])

    cols = [f"c{k}" for k in range(2 * DIM)]
    moved = docs.select("label", "words").mapInArrow(run, f"at int, {', '.join(f'{c} long' for c in cols)}").groupBy("at").agg(*(F.sum(c).alias(c) for c in cols)).toArrow()
    change = np.zeros((len(net.values), 2 * DIM))
    change[moved.column("at").to_numpy()] = np.stack([moved.column(c).to_numpy() for c in cols], axis=1)
    change /= FIXED * docs.count()
    shared.destroy()
    return Network(net.values + change[:, :DIM], net.state + change[:, DIM:], net.rows)


def train(docs: DataFrame, n_docs: tuple[int, int], scratch: Scratch, epochs: int = EPOCHS) -> Model:
    """The model of all rows of (label, lang, words: buckets), ``n_docs`` of either class."""
    n_neg, n_pos = n_docs
    n = n_neg + n_pos
    seen = docs.select("label", F.explode(F.array_distinct("words")).alias("bucket")).groupBy("bucket").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    share = (F.col("pos") / n_pos + F.col("neg") / n_neg) / 2
    seen = seen.where((F.col("pos") + F.col("neg") >= MIN_DOCS) & (share >= MIN_SHARE)).toArrow().sort_by("bucket")
    vocab, pos, neg = (seen.column(c).to_numpy().astype(np.int64) for c in ("bucket", "pos", "neg"))
    v = len(vocab) + 1
    rng = np.random.default_rng(11)
    emb = rng.normal(0, 0.02, (v, DIM))
    # the first dimension starts at each bucket's smoothed log odds of the label, which points the max
    # pooling at telling words from the first step on
    emb[1:, 0] = np.clip(np.log((pos + SMOOTH * n_pos / n) / n_pos) - np.log((neg + SMOOTH * n_neg / n) / n_neg), -3, 3)
    emb[0] = 0
    net = Network.start(emb, rng)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, off = _lists(batch, "words")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(off, pa.array(Model.lookup(vocab, b)))],
                                             names=["label", "lang", "words"])

    known = scratch.write(docs.select("label", "lang", "words").mapInArrow(look_up, "label int, lang string, words array<int>"), "rows")
    for k in range(epochs):
        net = epoch(known, net, (n / (2 * n_neg), n / (2 * n_pos)), k)
    by_lang = known.where("lang is not null").select("lang", F.explode("words").alias("at")).groupBy("lang", "at").count().toArrow()
    names, lang = np.unique(by_lang.column("lang").to_numpy().astype(str), return_inverse=True)
    freq = np.full((v, len(names)), 0.1)
    freq[by_lang.column("at").to_numpy(), lang] += by_lang.column("count").to_numpy()
    logp = np.log(freq / freq.sum(axis=0))
    logp[0] = 0
    model = net.model(vocab, logp, np.zeros(len(names) + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, off = _lists(batch, "words")
            logit, lang = model.logits(idx, np.repeat(np.arange(len(off) - 1), np.diff(off)), len(off) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(np.rint(logit * STEPS).astype(np.int64)), batch.column(0)], names=["lang", "step", "label"])

    logits = known.select("label", "words").mapInArrow(count, "lang int, step long, label int").groupBy("lang", "step").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).toArrow()
    lang, step, pos, neg = (logits.column(c).to_numpy() for c in ("lang", "step", "pos", "neg"))
    own = lambda c: lang == c if pos[lang == c].sum() >= MIN_CALIBRATION else lang >= 0
    model.threshold = np.array([_threshold(step[own(c)] / STEPS, pos[own(c)], neg[own(c)]) for c in range(len(names) + 1)])
    scratch.drop("rows")
    return model


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    held = fold(F.col("doc_id"), 4) == 2
    known = hint_small(scratch.write(labelled(labels, "toxic", 4, 2).where("label in (0, 1)"), "known"))
    rows = docs.select("doc_id", "text", "lang").where("text <> ''").join(known, "doc_id")
    ids = scratch.write(rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.count("*").alias("n")), "ids")
    n_docs = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    if len(n_docs) < 2:
        return docs.select("doc_id", held.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    twice = ids.where("n > 1").select("doc_id")
    if not twice.isEmpty():
        once = rows.join(hint_small(twice), "doc_id", "left_semi").groupBy("doc_id", "label").agg(F.max(F.struct("text", "lang")).alias("r"))
        rows = rows.join(hint_small(twice), "doc_id", "left_anti").select("doc_id", "text", "lang", "label").unionByName(once.select("doc_id", "r.text", "r.lang", "label"))
    # dealt and put in order by id, so that every task gets a like share and reruns agree
    files = -(-sum(n_docs.values()) // TASK_DOCS)
    words = word_rows(rows.withColumn("label", F.col("label").cast("int"))).repartition(files, "doc_id").sortWithinPartitions(F.xxhash64("doc_id"))
    fitted = train(scratch.write(words, "words"), (n_docs[0], n_docs[1]), scratch)
    scratch.drop("known", "ids", "words")
    scratch.release()
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.value.scores(column(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
