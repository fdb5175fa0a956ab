"""Language ID: a linear-chain conditional random field that labels every word with a language.

A word (lower-cased run of letters and digits that holds a letter) has features for the lexicon (its own
hash), its affixes (first and last two and three bytes) and its byte trigrams, all hashed into tables of
one weight per language. Transition weights between the languages of neighbouring words are learned
together with them by gradient ascent on the conditional log likelihood; expectations come from
forward-backward. Training sequences are pieces of documents of one known language and code-switched
sequences made of spans of several, so that the transitions see switches.

A document's prediction is the language with the most expected words (sum of the words' posterior
marginals), its score that share of all words, ``known`` the share of its words that training has seen. Texts are
labelled whole, as one chain each. Pieces of ``PIECE`` words are processed side by side; products of a piece's transfer
matrices carry the messages over its borders, so marginals are those of the whole chain.

Defined cases: null text, or text without any letter, gives ``und`` with score 0; without training rows
every text gives ``und``; ties go to the first language in sorted order; repeated rows get equal
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fold
from .textnum import Text, chunks, column
from .training import MAX_TRAINING_CHARS

LEX_BITS, AFFIX_BITS, TRI_BITS = 18, 16, 16
PIECE = 64
WIDE = 16  # beyond so many languages whole rows are processed side by side: a piece's matrices would cost more than they save
PER_LANGUAGE = 400
PIECES_PER_TEXT = 6
MAX_LANGUAGES = 200
CHUNK = 1 << 19
UND = "und"

_LETTER = np.zeros(256, dtype=np.int32)
_LETTER[0x61:0x7B] = 1
_LETTER[0x80:] = 1


@dataclass
class Words:
    """The words of a chunk of texts: rows, and hashed feature ids."""

    row: np.ndarray
    ids: np.ndarray       # (words, 5): lexicon, two prefixes, two suffixes, offsets into one table
    tri: np.ndarray       # trigram ids of all words, in word order
    tri_start: np.ndarray  # first trigram of each word
    tri_count: np.ndarray


TABLE = (1 << LEX_BITS) + (1 << AFFIX_BITS) + (1 << TRI_BITS)


def words_of(t: Text) -> Words:
    s, e, row = t.alnum_words()
    letters = np.concatenate([[0], np.cumsum(_LETTER[t.data])])
    keep = letters[e] > letters[s]
    s, e, row = s[keep], e[keep], row[keep]
    size = e - s
    ids = np.empty((len(s), 5), np.int64)
    ids[:, 0] = (t.hash(s, e) & np.uint64((1 << LEX_BITS) - 1)).astype(np.int64)
    mask = np.uint64((1 << AFFIX_BITS) - 1)
    for c, (a, b, salt) in enumerate(((s, s + np.minimum(size, 2), 3), (s, s + np.minimum(size, 3), 5),
                                      (e - np.minimum(size, 2), e, 7), (e - np.minimum(size, 3), e, 9)), start=1):
        h = t.hash(a, b) * np.uint64(salt)
        ids[:, c] = ((h >> np.uint64(20)) & mask).astype(np.int64) + (1 << LEX_BITS)
    n = len(t.data)
    d = t.data.astype(np.uint32)
    code = np.zeros(n, np.uint32)
    if n > 2:
        code[: n - 2] = ((d[:-2] * np.uint32(0x9E3779B1)) ^ (d[1:-1] * np.uint32(0x85EBCA77)) ^ (d[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(32 - TRI_BITS)
    count = np.maximum(size - 2, 0)
    start = np.cumsum(count) - count
    at = np.repeat(s - start, count) + np.arange(int(count.sum()))
    return Words(row, ids, code[at].astype(np.int64) + (1 << LEX_BITS) + (1 << AFFIX_BITS), start, count)


def emissions(w: Words, table: np.ndarray) -> np.ndarray:
    """(words, languages) sums of feature weights; trigrams count with their mean."""
    out = table[w.ids[:, 0]]
    for c in range(1, 5):
        out = out + table[w.ids[:, c]]
    if len(w.tri):
        has = w.tri_count > 0
        sums = np.add.reduceat(table[w.tri], w.tri_start[has], axis=0)
        out[has] += sums / w.tri_count[has][:, None]
    return out


def pieces(row: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of rows' words, or of pieces of at most ``longest`` of them that never cross rows."""
    n = len(row)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    start = np.flatnonzero(place % longest == 0) if longest else first
    return start, np.diff(np.append(start, n))


def borders(pot: np.ndarray, t: np.ndarray, start: np.ndarray, size: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages (pieces, languages) into the first word of each piece from the words before it in its row, and into its
    last word from those after it; ``opens`` marks the first piece of each row (ones go in there, and into a row's end)."""
    k = pot.shape[1]
    order = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[order], -np.arange(int(size.max())), side="left")
    m = np.broadcast_to(np.eye(k), (len(start), k, k)).copy()  # what a piece does to a message that enters it
    for p, n in enumerate(live):
        who = order[:n]
        step = m[who]
        if p:
            step = (step.reshape(-1, k) @ t).reshape(-1, k, k)
        step *= pot[start[who] + p][:, None, :]
        m[who] = step / step.sum(axis=(1, 2), keepdims=True)
    first = np.flatnonzero(opens)
    count = np.diff(np.append(first, len(start)))
    enter, leave = np.full((len(start), k), 1.0 / k), np.full((len(start), k), 1.0 / k)
    by = np.argsort(-count, kind="stable")
    first, count = first[by], count[by]
    for q in range(1, int(count[0])):  # rows side by side, from piece to piece
        at = first[: np.searchsorted(-count, -q, side="left")] + q
        msg = np.einsum("ni,nij->nj", enter[at - 1], m[at - 1]) @ t
        enter[at] = msg / msg.sum(axis=1, keepdims=True)
    for q in range(int(count[0]) - 2, -1, -1):
        at = first[: np.searchsorted(-count, -(q + 1), side="left")] + q
        msg = np.einsum("nij,nj->ni", m[at + 1], leave[at + 1]) @ t.T
        leave[at] = msg / msg.sum(axis=1, keepdims=True)
    return enter, leave


def marginals_of_rows(em: np.ndarray, row: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Posterior marginals (words, languages), each row one chain."""
    if em.shape[1] > WIDE or not len(row):
        return forward_backward(em, *pieces(row), trans)[0]
    start, size = pieces(row, PIECE)
    opens = np.concatenate([[True], row[start][1:] != row[start][:-1]])
    if opens.all():
        return forward_backward(em, start, size, trans)[0]
    pot = np.exp(em - em.max(axis=1, keepdims=True))
    return forward_backward(em, start, size, trans, ends=borders(pot, np.exp(trans), start, size, opens))[0]


def forward_backward(em: np.ndarray, start: np.ndarray, size: np.ndarray, trans: np.ndarray, want_pairs: bool = False,
                     ends: tuple[np.ndarray, np.ndarray] | None = None):
    """Posterior marginals (words, languages) of all pieces at once; with ``want_pairs`` also the
    expected transition counts. ``trans`` holds log weights; ``ends`` the messages over the pieces' borders, else
    uniform before the first and after the last word."""
    n, k = em.shape
    if not n:
        return em, np.zeros((k, k))
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    enter, leave = (m[order] for m in ends) if ends else (None, None)
    pot = np.exp(em - em.max(axis=1, keepdims=True))
    t = np.exp(trans)
    alpha, beta = np.empty_like(pot), np.empty_like(pot)
    longest = int(size[0])
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # pieces longer than p
    for p in range(longest):
        at = start[: live[p]] + p
        a = (alpha[at - 1] @ t) * pot[at] if p else pot[at] if enter is None else pot[at] * enter
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for p in range(longest - 1, -1, -1):
        at = start[: live[p]] + p
        b = np.full((len(at), k), 1.0 / k, pot.dtype) if leave is None else leave[: len(at)].astype(pot.dtype)
        if p + 1 < longest and live[p + 1]:
            m = live[p + 1]
            nxt = pot[at[:m] + 1] * beta[at[:m] + 1]
            b[:m] = nxt @ t.T
            b[:m] /= b[:m].sum(axis=1, keepdims=True)
            if want_pairs:
                joint = alpha[at[:m]][:, :, None] * t[None] * nxt[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta[at] = b
    post = alpha * beta
    return post / post.sum(axis=1, keepdims=True), pairs


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    trans: np.ndarray

    def predict(self, arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, share of known words) of each text."""
        lang, score, seen = [], np.zeros(len(arr)), np.zeros(len(arr))
        for i, j in chunks(arr, CHUNK):
            part = arr.slice(i, j - i)
            t = Text(part, lower=True)
            share = np.zeros((t.n, len(self.languages)))
            if self.languages:
                w = words_of(t)
                post = marginals_of_rows(emissions(w, self.table), w.row, self.trans)
                hit = (self.table[w.ids[:, 0]] != 0).any(axis=1)  # training moves the lexicon weights of every word it sees
                words = np.bincount(w.row, minlength=t.n)
                seen[i:j] = np.bincount(w.row, weights=hit, minlength=t.n) / np.maximum(words, 1)
                for c in range(len(self.languages)):
                    share[:, c] = np.bincount(w.row, weights=post[:, c], minlength=t.n)
            total = share.sum(axis=1)
            letter = np.array(pc.match_substring_regex(part, r"\pL").to_pylist(), dtype=bool)
            known = (total > 0) & letter
            best = share.argmax(axis=1) if self.languages else np.zeros(t.n, int)
            score[i:j] = np.where(known, share.max(axis=1, initial=0) / np.maximum(total, 1e-300), 0)
            lang += [self.languages[b] if k else UND for b, k in zip(best, known, strict=True)]
        return lang, score, seen

    def marginals(self, text: str) -> tuple[list[str], np.ndarray]:
        """The words of one text and their (words, languages) posteriors."""
        t = Text(pa.array([text], pa.string()), lower=True)
        s, e, _ = t.alnum_words()
        letters = np.concatenate([[0], np.cumsum(_LETTER[t.data])])
        keep = letters[e] > letters[s]
        w = words_of(t)
        post = marginals_of_rows(emissions(w, self.table), w.row, self.trans)
        return [bytes(t.data[a:b]).decode() for a, b in zip(s[keep], e[keep], strict=True)], post


def _sequences(texts: list[str], langs: list[int], rng) -> list[tuple[str, list[int]]]:
    """Training texts of at most PIECE words with one label a word: spans of single documents, at most ``PIECES_PER_TEXT``
    from all over a text, and half as many code-switched ones."""
    spans = []
    for text, c in zip(texts, langs, strict=True):
        words = text.split()
        starts = np.arange(0, len(words), PIECE)
        if len(starts) > PIECES_PER_TEXT:
            starts = np.sort(rng.choice(starts, PIECES_PER_TEXT, replace=False))
        spans += [(words[i : i + PIECE], c) for i in starts]
    mono = [(" ".join(w), [c] * len(w)) for w, c in spans if w]
    mixed = []
    for _ in range(len(mono) // 2):
        words, labels = [], []
        while len(words) < PIECE:
            w, c = spans[rng.integers(len(spans))]
            n = int(rng.integers(4, 25))
            a = int(rng.integers(0, max(1, len(w) - n + 1)))
            part = w[a : a + n][: PIECE - len(words)]
            words += part
            labels += [c] * len(part)
        mixed.append((" ".join(words), labels))
    return mono + mixed


def train(texts: list[str], langs: list[str], epochs: int = 4, batch: int = 64, rate: float = 0.2, l2: float = 1e-5) -> Model:
    languages = sorted(set(langs))
    k = len(languages)
    model = Model(languages, np.zeros((TABLE, k), np.float32), np.zeros((k, k)))
    if not k:
        return model
    rng = np.random.default_rng(5)
    seqs = _sequences(texts, [languages.index(x) for x in langs], rng)
    table = np.zeros((TABLE, k))
    trans = np.eye(k)
    acc_table, acc_trans = np.full((TABLE, k), 1e-3), np.full((k, k), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(seqs))
        for a in range(0, len(order), batch):
            part = [seqs[i] for i in order[a : a + batch]]
            # the labels follow the words that are split at spaces; each may hold several word runs or none
            flat, lab = [], []
            for text, labels in part:
                flat.append(text)
                lab.append(labels)
            t = Text(pa.array(flat, pa.string()), lower=True)
            w = words_of(t)
            ws, _, wrow = t.words()
            s, e, _ = t.alnum_words()
            letters = np.concatenate([[0], np.cumsum(_LETTER[t.data])])
            s = s[letters[e] > letters[s]]
            first = np.searchsorted(wrow, np.arange(t.n))
            outer = np.searchsorted(ws, s, side="right") - 1
            y = np.array([lab[r][o - first[r]] for r, o in zip(w.row, outer, strict=True)], dtype=np.int64)
            if not len(y):
                continue
            start, size = pieces(w.row)
            post, pairs = forward_backward(emissions(w, table), start, size, trans, want_pairs=True)
            d = -post
            d[np.arange(len(y)), y] += 1
            d /= len(part)
            g_ids = np.concatenate([w.ids.ravel(), w.tri])
            g_val = np.concatenate([np.repeat(d, 5, axis=0), np.repeat(d / np.maximum(w.tri_count, 1)[:, None], w.tri_count, axis=0)])
            uniq, inv = np.unique(g_ids, return_inverse=True)
            g = np.stack([np.bincount(inv, weights=g_val[:, c], minlength=len(uniq)) for c in range(k)], axis=1) - l2 * table[uniq]
            acc_table[uniq] += g * g
            table[uniq] += rate * g / np.sqrt(acc_table[uniq])
            same = w.row[1:] == w.row[:-1]
            inner = np.ones(len(y), bool)
            inner[start] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:-1][same & inner[1:]], y[1:][same & inner[1:]]), 1)
            gt = (seen - pairs) / len(part)
            acc_trans += gt * gt
            trans += rate * gt / np.sqrt(acc_trans)
    model.table, model.trans = table.astype(np.float32), trans
    return model


def fit(docs: DataFrame, modulus: int = 4, held: int = 2, per_language: int = PER_LANGUAGE) -> Model:
    """Trains on at most ``per_language`` documents of each of the ``MAX_LANGUAGES`` most frequent languages (a language's
    weights take 1.6 MB of the model), least hash of the id first: of texts of at most MAX_TRAINING_CHARS characters at
    most ``PIECES_PER_TEXT`` pieces each, drawn from the whole text."""
    scratch = Scratch(docs.sparkSession, "langid")
    usable = F.col("lang").isNotNull() & (fold(F.col("doc_id"), modulus) != held) & F.length("text").between(1, MAX_TRAINING_CHARS)
    known = scratch.write(docs.where(usable).select("doc_id", "lang"), "known")
    languages = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()]
    if not languages:
        return train([], [])
    # one plan for all languages; Spark keeps the first rows of each language in every task before it shuffles
    least = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = known.where(F.col("lang").isin(languages)).withColumn("_n", least).where(F.col("_n") <= per_language).select("doc_id")
    rows = docs.where(usable).select("doc_id", "text", "lang").join(F.broadcast(ids.distinct()), "doc_id").collect()
    scratch.drop("known")
    rows = sorted({(r["doc_id"], r["text"], r["lang"]) for r in rows if r["lang"] in set(languages)})
    return train([r[1] for r in rows], [r[2] for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, known of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, known = shared.value.predict(column(b, "text"))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(known)],
                                             names=["doc_id", "held_out", "lang_pred", "score", "known"])

    return docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, known double")
