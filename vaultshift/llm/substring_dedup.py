"""Substring dedup over sliding paragraphs: MinHash banding, exact Jaccard, clusters by components.

Repeated passages do not keep to line breaks: they sit in the middle of other text. So a paragraph here is
every run of ``PARAGRAPH`` (50) consecutive words of a document. Its ``HASHES`` MinHashes are the least hashes of its
five-word shingles; overlapping paragraphs mostly share them, so a document yields about one for 24 words each. Two
bands are made of each, the MinHash's shingle with the ten words before it and with the ten words after
it (15 words each). In any two equal paragraphs at least one band collides, whatever surrounds them.

0. A document whose whole text an earlier one holds is cut as a whole; groups of copies take no further part.
1. Band keys of all other documents are grouped (partial aggregation, so a passage that a third of all
   documents share is no hot group); the least (document, place) of a key is its canonical occurrence.
2. Every other occurrence is aligned with the canonical one. For exact verification the canonical
   document is cut into tiles of ``TILE`` words, and only the tiles that some occurrence needs travel.
3. The tiles of all alignments of two documents are compared together: a paragraph is a repeat if the Jaccard
   similarity of its five-word shingles (each as often as it occurs) with those of a paragraph of the
   canonical document is at least 0.8 (41 of 46 in common), place by place along an alignment first, then
   as sets across alignments, for inserted and deleted words. The union of verified paragraphs, trimmed
   to common shingles, is removed from the later document; the canonical occurrence stays.
   An occurrence that its key's least one does not account for (that document may hold a part of the passage only)
   meets the others of its kind, and the least one's document, once more by closer keys: the hash of every paragraph
   that holds the key, so that equal paragraphs always meet, and the key with ``FINER`` more MinHashes of these
   paragraphs, for near ones. All its alignments are then verified as in 2 and 3.
4. Removals are clustered: tiles of verified spans are linked with the tiles they repeat, and the
   connected components are the classes, named by the least document of each.

Defined cases: null doc_id: passed through, no search; null text stays null and shares nothing; texts
under 50 words share nothing; of equal passages the one in the document with the least id stays, and
repeats inside one document are left alone; rows that repeat a doc_id and its text are one document (all rows stay, with the
same cuts), each other text under an id keeps its own words and loses what an earlier document holds of them; an empty table gives an empty result; extra columns are ignored. Words are maximal runs
outside white space, compared in lower case. Very long texts are processed whole, in tiles.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, hint_small, small_batches
from .textnum import SHINGLE_MUL, Text, chunks, column, mix, shingles

PARAGRAPH = 50
WIDTH = 5
CONTEXT = 10
TILE = 32
SHINGLES = PARAGRAPH - WIDTH + 1
NEED = -(-SHINGLES * 2 * 4 // 9)  # least a with a / (2 * SHINGLES - a) >= 0.8
RUN = 16
HINT_ROWS = 200_000
HASHES = 2  # MinHashes of a paragraph
SLAB = 1 << 12  # pairs of paragraphs compared at once
FINER = 6  # MinHashes that part the occurrences of a key that its least one does not account for
CHUNK = 1 << 20
LONG = 1 << 16  # words of a text taken at once
TEXT_KEY = "xxhash64(text) as text_key"


def anchors(t: Text):
    """(row, place, reach, key): band keys of the paragraphs of a chunk of texts; place is the first word of
    the 15 words that make the key, counted from the start of the row. Places of one key whose words touch or
    overlap are one entry, from the first to the last of them, ``reach``: all text between is periodic then. A single
    long text is taken ``LONG`` words at a time, in ranges that share more than a paragraph and its context."""
    if t.n == 1 and len(t.data) > CHUNK:
        s, e, _ = t.words()
        found = []
        for lo in range(0, max(len(s) - 2 * PARAGRAPH, 1), LONG):
            hi = min(lo + LONG + 4 * PARAGRAPH, len(s))
            if lo < hi:
                part = Text([t.data[s[lo] : e[hi - 1]].tobytes().decode()])
                r, p, k = _bands(part)
                found.append((r, p + lo, k))
        pr, pp, key = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    else:
        pr, pp, key = _bands(t)
    if not len(pr):
        return (np.zeros(0, np.int64),) * 4
    order = np.lexsort((pp, key, pr))
    pr, pp, key = pr[order], pp[order], key[order]
    head = np.ones(len(pr), bool)
    head[1:] = (pr[1:] != pr[:-1]) | (key[1:] != key[:-1]) | (pp[1:] - pp[:-1] > WIDTH + CONTEXT)
    at = np.flatnonzero(head)
    return pr[at], pp[at], pp[np.append(at[1:], len(pp)) - 1], key[at]


def _bands(t: Text):
    """(row, place, key) of every band of a chunk of texts."""
    s, e, row = t.words()
    h = t.hash(s, e)
    sh, sr = shingles(h, row, t.n, WIDTH)
    wide, wr = shingles(h, row, t.n, WIDTH + CONTEXT)
    none = np.zeros(0, np.int64)
    if len(sh) < SHINGLES:
        return none, none, none
    # in a run of one repeated shingle only every RUN-th place may be a minimum
    start = np.concatenate([[True], (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])])
    place = np.arange(len(sh))
    since = place - np.maximum.accumulate(np.where(start, place, 0))
    far = np.uint64(0xFFFFFFFFFFFFFFFF)
    picked = []
    for k in range(HASHES):
        best, at, n = np.where(since % RUN == 0, mix(sh + np.uint64(k)) if k else sh, far), place, 1
        while 2 * n <= SHINGLES:  # least value of n, 2n, 4n, ... places, and where it is
            second = best[n:] < best[:-n]
            at = np.where(second, at[n:], at[:-n])
            best = np.where(second, best[n:], best[:-n])
            n *= 2
        left = SHINGLES - n
        second = best[left:] < best[: len(best) - left]
        at = np.where(second, at[left:], at[: len(at) - left])[: len(sh) - SHINGLES + 1]
        picked.append(at[sr[: len(sh) - SHINGLES + 1] == sr[SHINGLES - 1 :]])
    at = np.unique(np.concatenate(picked))
    if not len(at):
        return none, none, none
    r = sr[at]
    local = at - np.searchsorted(sr, r)
    n_words = np.bincount(row, minlength=t.n)[r]
    first_wide = np.searchsorted(wr, np.arange(t.n))
    ok_l, ok_r = local >= CONTEXT, local + WIDTH + CONTEXT <= n_words
    pr = np.concatenate([r[ok_l], r[ok_r]])
    pp = np.concatenate([local[ok_l] - CONTEXT, local[ok_r]])
    both = np.unique(pr * (1 << 32) + pp)
    pr, pp = both >> 32, both & 0xFFFFFFFF
    return pr, pp, wide[first_wide[pr] + pp].view(np.int64)


def anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text")
            for i, j in chunks(texts, CHUNK):
                r, p, q, k = anchors(Text(texts.slice(i, j - i), lower=True))
                if len(r):
                    yield pa.RecordBatch.from_arrays([pa.array(k), batch.column(0).take(pa.array(i + r)), pa.array(p.astype(np.int32)),
                                                      pa.array(q.astype(np.int32))], names=["key", "doc_id", "place", "reach"])

    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(run, "key long, doc_id long, place int, reach int")


def tiles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text) and (doc_id, wanted: array of tile numbers) -> doc_id, tile, words (32-bit word hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, want = column(batch, "text"), batch.column(2).to_pylist()
            for i, j in chunks(texts, CHUNK):
                t = Text(texts.slice(i, j - i), lower=True)
                s, e, row = t.words()
                h = (t.hash(s, e) >> np.uint64(32)).astype(np.uint32)
                first = np.searchsorted(row, np.arange(t.n + 1))
                ids, numbers, words = [], [], []
                for r in range(t.n):
                    own = h[first[r] : first[r + 1]]
                    for k in want[i + r]:
                        if k * TILE < len(own):
                            ids.append(i + r)
                            numbers.append(k)
                            words.append(own[k * TILE : (k + 1) * TILE].tobytes())
                if ids:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids)), pa.array(numbers, pa.int32()), pa.array(words, pa.binary())],
                                                     names=["doc_id", "tile", "words"])

    return docs.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(run, "doc_id long, tile int, words binary")


def repeats(own: np.ndarray, shift: int, pieces: dict[int, np.ndarray]) -> np.ndarray:
    """Which words of ``own`` lie in a paragraph verified place by place, aligned with the canonical document at ``shift``."""
    n = len(own)
    equal = np.zeros(n + 1, np.int32)
    for tile, words in pieces.items():
        a = tile * TILE - shift
        lo, hi = max(a, 0), min(a + len(words), n)
        if lo < hi:
            equal[lo:hi] = own[lo:hi] == words[lo - a : hi - a]
    mask = np.zeros(n, bool)
    run = np.concatenate([[0], np.cumsum(equal[:n])])
    if n < PARAGRAPH or run[-1] < NEED:
        return mask
    same = run[WIDTH:] - run[:-WIDTH] == WIDTH
    agree = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(agree[SHINGLES:] - agree[:-SHINGLES] >= NEED)
    if not len(good):
        return mask
    cover = np.zeros(n + 1, np.int32)
    cover[good] += 1
    cover[good + PARAGRAPH] -= 1
    mask = np.cumsum(cover[:n]) > 0
    # a paragraph at 0.8 may reach into the later document's own words: trim to agreeing shingles
    held = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(same)
    held[at] += 1
    held[at + WIDTH] -= 1
    held = np.cumsum(held[:n]) > 0
    for a, b in spans_of(mask):
        inner = np.flatnonzero(held[a:b])
        mask[a : a + inner[0]] = False
        mask[a + inner[-1] + 1 : b] = False
    return mask


def grams(words: np.ndarray) -> np.ndarray:
    """The five-word shingles of a run of word hashes."""
    n = max(len(words) - WIDTH + 1, 0)
    acc = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        acc = acc * SHINGLE_MUL + words[k : k + n]
    return mix(acc)


def moved(own_sh: np.ndarray, mask: np.ndarray, pieces: dict[int, np.ndarray]) -> list[tuple[int, int, int]]:
    """Paragraphs outside ``mask`` that hold inserted or deleted words: (first word, end, shift) of those whose
    shingles, each as often as it occurs, have a Jaccard similarity of 0.8 with those of a paragraph of the
    canonical document. A paragraph's partners lie at the shifts of its common shingles, between two close ones
    of them, or at an end of the known text; of text without a rare shingle (periodic), the first partner will do."""
    if len(own_sh) < SHINGLES:
        return []
    covered = np.concatenate([[0], np.cumsum(mask)])
    left = covered[PARAGRAPH:] - covered[:-PARAGRAPH] < PARAGRAPH
    if not left.any():
        return []
    found: set[tuple[int, int, int]] = set()
    numbers = sorted(pieces)
    breaks = [0, *(i for i in range(1, len(numbers)) if numbers[i] != numbers[i - 1] + 1), len(numbers)]
    for i, j in zip(breaks, breaks[1:], strict=False):
        base = numbers[i] * TILE
        theirs = grams(np.concatenate([pieces[k] for k in numbers[i:j]]))
        if len(theirs) < SHINGLES:
            continue
        order = np.argsort(theirs, kind="stable")
        lo, hi = (np.searchsorted(theirs[order], own_sh, side) for side in ("left", "right"))
        hit = hi > lo
        hits = np.concatenate([[0], np.cumsum(hit)])
        w = np.flatnonzero((hits[SHINGLES:] - hits[:-SHINGLES] >= NEED) & left)
        if not len(w):
            continue
        # what a paragraph could add lies between its first and its last known shingle: none of it if all of that is covered
        place = np.arange(len(hit))
        after = np.minimum.accumulate(np.where(hit, place, len(hit))[::-1])[::-1]
        before = np.maximum.accumulate(np.where(hit, place, -1))[SHINGLES - 1 :]
        a, b = after[w], before[w] + WIDTH
        fresh = w[covered[b] - covered[a] < b - a]
        if len(fresh):
            partners = _partners(own_sh, theirs, order, lo, hi, fresh)
            found.update((w + a, w + b, base + v - w) for w, here in zip(fresh.tolist(), partners, strict=True) for a, b, v in here)
    return sorted(found)


def _partners(own_sh, theirs, order, lo, hi, fresh) -> list[list[tuple[int, int, int]]]:
    """Of every paragraph of ``fresh`` the canonical ones it repeats: (first and end of its common shingles' words, place).
    Equal paragraphs are compared once, and most pairs by where the one partner of each shingle lies."""
    hit, last = hi > lo, len(theirs) - SHINGLES
    # (place, diagonal) of the rare shingles' partners
    x = np.flatnonzero(hit & (hi - lo <= RUN))
    n = hi[x] - lo[x]
    px = np.repeat(x, n)
    diagonal = (order[np.repeat(lo[x] - np.cumsum(n) + n, n) + np.arange(len(px))] - px).tolist()
    known: dict[bytes, list[tuple[int, int, int]]] = {}
    out, pairs = [], []
    for w, i, j in zip(fresh.tolist(), np.searchsorted(px, fresh).tolist(), np.searchsorted(px, fresh + SHINGLES).tolist(), strict=True):
        mine = own_sh[w : w + SHINGLES]
        key = mine.tobytes()
        if key not in known:
            known[key] = here = []
            if i < j:
                at = sorted({min(max(w + d, 0), last) for d in set(diagonal[i:j])})
                pairs += [(w, v, here) for v in _between(at)]
            else:
                x = int(np.flatnonzero(hit[w : w + SHINGLES])[0]) + w
                for v in _between(sorted({min(max(w + int(y) - x, 0), last) for y in order[lo[x] : hi[x]]})):
                    if ends := _common(mine, theirs[v : v + SHINGLES]):
                        here.append((*ends, v))
                        break
        out.append(known[key])
    # a shingle found once in either text has its partner in a paragraph or not; where all are so, that is the exact number
    once = (hi - lo == 1) & (np.bincount(lo[hit], minlength=len(theirs) + 1)[lo] == 1)
    odd = np.concatenate([[0], np.cumsum(hit & ~once)])
    least, most = np.where(hit, order[np.minimum(lo, len(order) - 1)], len(theirs)), np.where(hit, order[hi - 1], -1)
    for k in range(0, len(pairs), SLAB):
        w, v = (np.array(c) for c in list(zip(*pairs[k : k + SLAB], strict=True))[:2])
        at = w[:, None] + np.arange(SHINGLES)
        near = (least[at] < v[:, None] + SHINGLES) & (most[at] >= v[:, None])
        exact = odd[w + SHINGLES] == odd[w]
        first, end = near.argmax(axis=1), SHINGLES - near[:, ::-1].argmax(axis=1) - 1 + WIDTH
        for m in np.flatnonzero(near.sum(axis=1) >= NEED).tolist():
            a, b, here = pairs[k + m]
            ends = (int(first[m]), int(end[m])) if exact[m] else _common(own_sh[a : a + SHINGLES], theirs[b : b + SHINGLES])
            if ends:
                here.append((*ends, b))
    return out


def _between(at: list[int]) -> list[int]:
    """The places, and those between two that lie close together."""
    return sorted(at + [v for a, b in zip(at, at[1:], strict=False) if b - a < SHINGLES - NEED + WIDTH for v in range(a + 1, b)])


def _common(mine: np.ndarray, right: np.ndarray) -> tuple[int, int] | None:
    """First and end of the words of the common shingles of two paragraphs, if they are similar enough."""
    if (Counter(mine.tolist()) & Counter(right.tolist())).total() < NEED:
        return None
    same = np.flatnonzero(np.isin(mine, right))
    return int(same[0]), int(same[-1]) + WIDTH


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def cut(data: bytes, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; a line break behind a span stays if text of its line is left."""
    out, at = [], 0
    for a, b in spans:
        out.append(data[at : starts[a]])
        at = int(starts[b]) if b < len(starts) else len(data)
        gap = data[int(ends[b - 1]) : at]
        kept = b"".join(out)
        if b"\n" in gap and kept and not kept.endswith(b"\n"):
            out = [kept.rstrip(b" \t"), b"\n"]
        else:
            out = [kept]
    return b"".join([*out, data[at:]]).decode()


LINK = ("head", "a_doc", "a_tile", "b_doc", "b_tile")
CUTS = ("doc_id long, text string, n_chars long, n_spans int, removed_words long, spans array<struct<a: int, b: int>>, "
        "links array<struct<head: boolean, a_doc: long, a_tile: int, b_doc: long, b_tile: int>>, text_key long")


def cuts(docs: DataFrame, evidence: DataFrame) -> DataFrame:
    """(doc_id, text) and (doc_id, found: array of (cdoc, tile, words), shifts: array of (cdoc, shift)) -> cut texts and
    cluster links. The tiles of all shifts of one canonical document are compared together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, aligned = column(batch, "text"), batch.column(2), batch.column(3)
            cdocs, numbers, words = (found.values.field(c) for c in ("cdoc", "tile", "words"))
            cdocs, numbers, first = cdocs.to_numpy(), numbers.to_numpy(), found.offsets.to_numpy()
            others, by_shift, head = *(aligned.values.field(c).to_numpy() for c in ("cdoc", "shift")), aligned.offsets.to_numpy()
            rows = []
            for i in range(len(texts)):
                part = texts.slice(i, 1)
                t = Text(part, lower=True)
                s, e, _ = t.words()
                own = (t.hash(s, e) >> np.uint64(32)).astype(np.uint32)
                by: dict[int, dict[int, np.ndarray]] = {}
                a, b = first[i], first[i + 1]
                for cdoc, tile, piece in zip(cdocs[a:b].tolist(), numbers[a:b].tolist(), words.slice(a, b - a).to_pylist(), strict=True):
                    by.setdefault(cdoc, {})[tile] = np.frombuffer(piece, np.uint32)
                shifts: dict[int, list[int]] = {}
                for cdoc, shift in zip(others[head[i] : head[i + 1]].tolist(), by_shift[head[i] : head[i + 1]].tolist(), strict=True):
                    shifts.setdefault(cdoc, []).append(shift)
                own_sh = grams(own)
                mask = np.zeros(len(own), bool)
                doc, seen = batch.column(0)[i].as_py(), []
                for cdoc, pieces in sorted(by.items()):
                    for shift in sorted(shifts[cdoc]):
                        hit = repeats(own, shift, pieces)
                        if (hit & ~mask).any():  # else earlier documents account for all of it
                            mask |= hit
                            seen += [(a, b, cdoc, shift) for a, b in spans_of(hit)]
                    for a, b, shift in moved(own_sh, mask, pieces):
                        if not mask[a:b].all():
                            mask[a:b] = True
                            seen.append((a, b, cdoc, shift))
                spans = spans_of(mask)
                if not spans:
                    continue
                # a removed span and the passages it repeats are one cluster; the span's head stands for it
                starts = [a for a, _ in spans]
                node = [a // TILE for a in starts]
                links = {(True, doc, k, doc, k) for k in node}
                for a, b, cdoc, shift in seen:
                    own_node = node[bisect_right(starts, a) - 1]
                    links.update((False, doc, own_node, cdoc, k) for k in range(max(a + shift, 0) // TILE, (b - 1 + shift) // TILE + 1))
                raw = Text(part)
                rs, re_, _ = raw.words()
                new = cut(raw.data.tobytes(), rs, re_, spans)
                rows.append((doc, new, len(new), len(spans), int(mask.sum()), [{"a": a, "b": b} for a, b in spans], [dict(zip(LINK, x, strict=True)) for x in sorted(links)],
                             batch.column(4)[i].as_py()))
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])),
                         pa.list_(pa.struct(list(zip(LINK, (pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)))), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=["doc_id", "text", "n_chars", "n_spans", "removed_words", "spans", "links", "text_key"])

    return docs.join(evidence, "doc_id").selectExpr("doc_id", "text", "found", "shifts", TEXT_KEY).mapInArrow(run, CUTS)


def copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, rep, n_words, lead of the documents whose text is that of an earlier document ``rep``; ``lead`` is
    the white space before the first word. Only texts of a paragraph or more count."""
    space = r"[\x20\x09-\x0D]"
    # words are counted in copies only: the pattern costs more than the digests of all texts
    known = docs.where("doc_id is not null and text is not null").where(F.length("text") >= 2 * PARAGRAPH - 1)
    known = scratch.write(known.selectExpr("doc_id", TEXT_KEY, "md5(cast(text as binary)) as digest"), "digests")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = hint_small(scratch.write(first, "first"), HINT_ROWS)
    later = known.join(first, "digest").where("doc_id <> rep").select("doc_id", "text_key", "rep").dropDuplicates(["doc_id", "text_key"])
    later = hint_small(scratch.write(later, "doubles"))
    same = docs.selectExpr("doc_id", "text", TEXT_KEY).join(later, ["doc_id", "text_key"])
    same = same.select("doc_id", "text_key", "rep", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n_words"), F.regexp_extract("text", f"^{space}*", 0).alias("lead"))
    # written first, or the filter would be pushed below the join and count all texts
    return scratch.write(same.dropDuplicates(["doc_id", "text_key"]), "counted").where(F.col("n_words") >= PARAGRAPH)


def whole_cuts(same: DataFrame) -> DataFrame:
    """The cut of a copy: all its words repeat its representative's."""
    tile = F.sequence(F.lit(0), F.floor((F.col("n_words") - 1) / TILE).cast("int"))
    link = lambda head, doc, k: F.struct(F.lit(head).alias("head"), F.col("doc_id").alias("a_doc"), F.lit(0).alias("a_tile"),
                                         doc.alias("b_doc"), k.alias("b_tile"))
    links = F.concat(F.array(link(True, F.col("doc_id"), F.lit(0))), F.transform(tile, lambda k: link(False, F.col("rep"), k)))
    return same.select("doc_id", F.col("lead").alias("text"), F.length("lead").cast("long").alias("n_chars"), F.lit(1).alias("n_spans"),
                       F.col("n_words").cast("long").alias("removed_words"),
                       F.array(F.struct(F.lit(0).alias("a"), F.col("n_words").cast("int").alias("b"))).alias("spans"), links.alias("links"), "text_key")


def _finer(t: Text, own: np.ndarray, key: np.ndarray, place: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, key) of the closer keys of occurrences (row ``own``, key, place, reach) in a chunk of texts."""
    s, e, row = t.words()
    h = t.hash(s, e)
    whole, wr = shingles(h, row, t.n, PARAGRAPH)
    sh, sr = shingles(h, row, t.n, WIDTH)
    n_words = np.bincount(row, minlength=t.n)
    lo, hi = np.maximum(place + WIDTH + CONTEXT - PARAGRAPH, 0), np.minimum(reach, n_words[own] - PARAGRAPH) + 1
    some = lo < hi
    own, key, place, lo, size = own[some], key[some], place[some], lo[some], (hi - lo)[some]
    if not len(own):
        return
    # occurrences in groups of about LONG paragraphs
    cuts = np.unique(np.append(np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), LONG)), len(own)))
    groups = [(a, np.repeat(np.arange(a, b), size[a:b])) for a, b in zip(np.append(0, cuts[:-1]), cuts, strict=True) if a < b]
    start = np.cumsum(size) - size
    groups = [(x, lo[x] + np.arange(len(x)) - (start[x] - start[a])) for a, x in groups]
    both = np.unique(np.concatenate([np.unique(own[x] * (1 << 32) + at) for x, at in groups]))
    r, p = both >> 32, both & 0xFFFFFFFF
    yield r, p, whole[np.searchsorted(wr, r) + p]
    first = np.searchsorted(sr, np.arange(t.n))
    for k in range(FINER):
        low, n = mix(sh + np.uint64(k + 1)), 1
        while 2 * n <= SHINGLES:  # least value of n, 2n, 4n, ... places
            low = np.minimum(low[n:], low[:-n])
            n *= 2
        low = np.minimum(low[SHINGLES - n :], low[: len(low) - SHINGLES + n])
        for x, at in groups:
            val = low[first[own[x]] + at]
            head = np.append(True, (val[1:] != val[:-1]) | (x[1:] != x[:-1]))
            x = x[head]
            yield own[x], place[x], mix(val[head] ^ key[x])


def closer(docs: DataFrame, pool: DataFrame) -> DataFrame:
    """Keys of the paragraphs around occurrences that the least one of their key does not account for: the hash of
    each paragraph that holds the key, equal for equal paragraphs whatever the key's least occurrence is, and the
    key with each of ``FINER`` more MinHashes of such a paragraph, for near ones. ``pool``: doc_id, at: array of (key, place, reach)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, at = column(batch, "text"), batch.column(0).to_numpy(), batch.column(2)
            first = at.offsets.to_numpy()
            keys, places, reaches = (at.values.field(c).to_numpy() for c in ("key", "place", "reach"))
            for i, j in chunks(texts, CHUNK):
                t = Text(texts.slice(i, j - i), lower=True)
                f = slice(first[i], first[j])
                for r, p, k in _finer(t, np.repeat(np.arange(t.n), np.diff(first[i : j + 1])), keys[f].view(np.uint64), places[f].astype(np.int64), reaches[f].astype(np.int64)):
                    p = pa.array(p.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(ids[i + r]), p, p], names=["key", "doc_id", "place", "reach"])

    # only texts with an occurrence in the pool are shuffled
    some = docs.join(hint_small(pool.select("doc_id")), "doc_id", "left_semi")
    return some.join(pool, "doc_id").select("doc_id", "text", "at").mapInArrow(run, "key long, doc_id long, place int, reach int")


def meet(keys: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """All occurrences of the keys that several documents hold (key, doc_id, place, reach, cdoc), and those outside the
    document ``cdoc`` of the least one, with its place: key, doc_id, place, reach, cdoc, cplace, creach. Keys of one document,
    most of them, are told by two numbers a key and go before anything is gathered about the others. The number of keys grows
    with the input, so both joins shuffle at every size: disk grows in proportion and no key goes through the driver."""
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("cdoc"), F.max("doc_id").alias("hi")).where("hi <> cdoc").drop("hi")
    shared = scratch.write(shared, f"{name}_shared")
    scratch.release()
    met = scratch.write(keys.join(shared.hint("shuffle_hash"), "key"), f"{name}_met")
    scratch.drop(f"{name}_shared")
    scratch.release()
    # place and reach in one number: the least of it needs no sorted aggregation
    at = met.where("doc_id = cdoc").groupBy("key").agg(F.min(F.expr("shiftleft(cast(place as long), 32) + reach")).alias("at"))
    at = at.selectExpr("key", "cast(shiftright(at, 32) as int) as cplace", "cast(at & 4294967295 as int) as creach")
    return met, met.where("doc_id <> cdoc").join(scratch.write(at, f"{name}_least").hint("shuffle_hash"), "key")


def alignments(hits: DataFrame) -> DataFrame:
    """doc_id, cdoc, shift, tiles: the canonical document's tiles that each alignment may need."""
    # periodic text is aligned at its start and at its end
    run = F.least(F.col("reach") - F.col("place"), F.col("creach") - F.col("cplace"))
    both = F.array_distinct(F.array(F.struct(F.col("cplace").alias("first"), (F.col("cplace") - F.col("place")).alias("shift")),
                                    F.struct((F.col("creach") - run).alias("first"), (F.col("creach") - F.col("reach")).alias("shift"))))
    at = hits.select("doc_id", "cdoc", run.alias("run"), F.explode(both).alias("at")).select("doc_id", "cdoc", "run", "at.first", "at.shift")
    near = F.sequence(F.floor((F.greatest(F.col("first") - PARAGRAPH, F.lit(0))) / TILE).cast("int"),
                      F.floor((F.col("first") + F.col("run") + PARAGRAPH + WIDTH + CONTEXT) / TILE).cast("int"))
    return at.select("doc_id", "cdoc", "shift", F.explode(near).alias("tile")).groupBy("doc_id", "cdoc", "shift").agg(
        F.sort_array(F.collect_set("tile")).alias("tiles"))


def verified(base: DataFrame, aligned: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The cuts of all documents of ``aligned``."""
    need = scratch.write(aligned.select("doc_id", "cdoc", F.explode("tiles").alias("tile")).distinct(), f"{name}_need")
    wanted = need.select(F.col("cdoc").alias("doc_id"), "tile").groupBy("doc_id").agg(F.sort_array(F.collect_set("tile")).alias("wanted"))
    wanted = scratch.write(wanted, f"{name}_wanted")
    later = hint_small(scratch.write(need.select("doc_id").distinct(), f"{name}_later"))
    texts = base.where("text is not null")
    source = texts.join(hint_small(wanted.select("doc_id")), "doc_id", "left_semi")
    pieces = scratch.write(tiles(source, wanted).dropDuplicates(["doc_id", "tile"]), f"{name}_tiles")
    scratch.release()
    evidence = need.join(pieces.withColumnRenamed("doc_id", "cdoc"), ["cdoc", "tile"])
    evidence = evidence.groupBy("doc_id").agg(F.collect_list(F.struct("cdoc", "tile", "words")).alias("found"))
    evidence = evidence.join(aligned.groupBy("doc_id").agg(F.collect_list(F.struct("cdoc", "shift")).alias("shifts")), "doc_id")
    out = scratch.write(cuts(texts.join(later, "doc_id", "left_semi"), evidence).dropDuplicates(["doc_id", "text_key"]), f"{name}_cuts")
    scratch.drop(*(f"{name}_{t}" for t in ("need", "wanted", "tiles", "later")))
    scratch.release()
    return out


def find_cuts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text (cut), n_chars, n_spans, removed_words, spans, links of every document with a repeat."""
    small_batches(docs.sparkSession)
    base = docs.select("doc_id", "text")
    same = scratch.write(copies(base, scratch), "copies")
    keys = scratch.write(anchor_rows(base), "anchors")
    keys = keys.join(hint_small(same.select("doc_id")), "doc_id", "left_anti")
    met, hits = meet(keys, scratch, "band")
    scratch.drop("anchors")
    aligned = scratch.write(alignments(hits), "aligned")
    scratch.drop("band_least")
    scratch.release()
    first = verified(base, aligned, scratch, "first")
    # occurrences that their key's least one does not account for meet once more, by closer keys
    spans = first.select("doc_id", "spans")
    outside = lambda x: x.join(spans, "doc_id", "left").where(
        F.expr(f"spans is null or not exists(spans, s -> s.a <= place and s.b >= least(reach, place + {PARAGRAPH}) + {WIDTH + CONTEXT})")).drop("spans")
    failed = scratch.write(outside(met.where("doc_id <> cdoc").drop("cdoc")).select("key").distinct(), "failed")
    pool = outside(met.drop("cdoc").join(hint_small(failed, HINT_ROWS), "key", "left_semi"))
    pool = scratch.write(pool.groupBy("doc_id").agg(F.collect_set(F.struct("key", "place", "reach")).alias("at")), "pool")
    scratch.drop("band_met", "failed")
    scratch.release()
    more = scratch.write(closer(base.where("text is not null"), pool), "closer")
    scratch.drop("pool")
    scratch.release()
    again = scratch.write(alignments(meet(more, scratch, "closer")[1]), "again")
    scratch.drop("closer", "closer_met", "closer_least")
    scratch.release()
    changed = scratch.write(again.select("doc_id").distinct(), "changed")
    every = aligned.join(hint_small(changed), "doc_id", "left_semi").unionByName(again)
    every = every.groupBy("doc_id", "cdoc", "shift").agg(F.array_distinct(F.flatten(F.collect_list("tiles"))).alias("tiles"))
    second = verified(base, scratch.write(every, "every"), scratch, "second")
    kept = first.join(hint_small(changed), "doc_id", "left_anti")
    out = scratch.write(kept.unionByName(second).unionByName(whole_cuts(same)), "cuts")
    scratch.drop("digests", "first", "doubles", "counted", "copies", "aligned", "again", "changed", "every", "first_cuts", "second_cuts")
    scratch.release()
    return out


def report(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text, n_chars, n_removed (spans), removed_words, class_ids of every row: the text without
    repeated passages, and the clusters that its removed passages belong to, each named by the document
    that keeps the cluster's first passage."""
    done = find_cuts(docs, scratch)
    links = done.select("doc_id", "text_key", F.explode("links").alias("l")).select(
        "doc_id", "text_key", "l.head", F.xxhash64("l.a_doc", "l.a_tile").alias("a"), "l.a_doc", F.xxhash64("l.b_doc", "l.b_tile").alias("b"), "l.b_doc")
    links = scratch.write(links, "links")
    label = scratch.write(components(links.where("not head").select("a", "b"), scratch, "passages"), "passages")
    ends = links.select(F.col("a").alias("node"), F.col("a_doc").alias("doc")).union(links.select("b", "b_doc"))
    name = label.join(ends, "node").groupBy("comp").agg(F.min("doc").alias("class_id"))
    classes = links.where("head").join(label, F.col("a") == F.col("node")).join(name, "comp").groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set("class_id")).alias("class_ids"))
    keys = ["doc_id", "text_key"]
    small = scratch.write(done.select(*keys, "text", "n_chars", "n_spans", "removed_words").dropDuplicates(keys).join(classes, keys, "left"), "report")
    scratch.drop("cuts", "links", "passages")
    ids = hint_small(small.select(*keys))
    every = docs.selectExpr("doc_id", "text", TEXT_KEY)
    clean = every.join(ids, keys, "left_anti")
    clean = clean.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), F.lit(0).alias("n_removed"),
                         F.lit(0).cast("long").alias("removed_words"), F.array().cast("array<long>").alias("class_ids"))
    again = every.select(*keys).join(ids, keys, "left_semi")
    touched = again.join(small, keys).select("doc_id", "text", "n_chars", F.col("n_spans").alias("n_removed"), "removed_words", "class_ids")
    return touched.unionByName(clean)
