"""Searches against brute force: Jaccard join, substring dedup, decontamination."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vaultshift.llm import decontaminate, jaccard_join, substring_dedup
from vaultshift.llm.common import Scratch, components
from vaultshift.llm.textnum import Text, mix, shingles

from conftest import SF001

from .helpers import sentence


def shingle_set(text):
    w = (text or "").lower().encode().split()
    return {b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    """(links of each id, class of each id) over all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    inv = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            inv[x].add(i)
    links = {i: {j for x in s for j in inv[x] if j != i and 5 * len(s & sets[j]) >= 4 * len(s | sets[j])} for i, s in sets.items()}
    cls = {i: i for i in sets}
    moved = True
    while moved:
        moved = False
        for i, js in links.items():
            low = min([cls[i], *(cls[j] for j in js)])
            for j in (i, *js):
                if cls[j] != low:
                    cls[j], moved = low, True
    return {i: len(js) for i, js in links.items()}, cls


def noisy(rng, words, share):
    return " ".join(f"z{rng.integers(10**6)}" if rng.random() < share else w for w in words)


def test_jaccard_join_on_the_table(spark, scratch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    links, cls = brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = jaccard_join.classes(docs, scratch).collect()
    assert {r.doc_id: r.n_links for r in got} == links and {r.doc_id: r.class_id for r in got} == cls


def test_jaccard_join_large_group_is_split(spark, make_docs, monkeypatch):
    """130 near copies around one text, blocks of 32: the same links as without a split."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 32)
    rng = np.random.default_rng(4)
    base = sentence(rng, 200).split()
    rows = [(i, noisy(rng, base, 0.004 * (i % 6))) for i in range(130)] + [(500 + i, sentence(rng, 60)) for i in range(40)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(30)]
    small = jaccard_join.split_groups
    monkeypatch.setattr(jaccard_join, "split_groups", lambda m, k, s, n, block=32: small(m, k, s, n, min(block, 32)))
    links, cls = brute_classes(rows)
    got = jaccard_join.classes(make_docs(rows).repartition(4), Scratch(spark, "t")).collect()
    assert {r.doc_id: r.class_id for r in got} == cls
    assert {r.doc_id: r.n_links for r in got} == links
    assert max(links.values()) > 60


EDGE = [(None, "lost words here today ok"), (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one two three"),
        (7, "a b c d e f g h"), (7, "a b c d e f g h"), (8, "x " * 30_000), (9, "x " * 30_000 + "y")]


def test_jaccard_join_edges(spark, make_docs, scratch):
    got = sorted(((r.doc_id or -1), r.class_id, r.n_links) for r in jaccard_join.classes(make_docs(EDGE, extra=True), scratch).collect())
    # 8 and 9: one shingle against two
    assert got == [(-1, None, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 1), (5, 4, 1), (6, 6, 0), (7, 7, 1), (7, 7, 1), (8, 8, 0), (9, 9, 0)]
    assert jaccard_join.classes(make_docs([]), Scratch(spark, "t")).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    rng = np.random.default_rng(0)
    for sim, kept in ((0.8, 0.99), (0.9, 0.999), (0.2, 0.0)):
        a = rng.integers(0, 1 << 32, (2000, jaccard_join.K), dtype=np.uint64).astype(np.uint32)
        b = np.where(rng.random(a.shape) < sim, a, a + 1)
        n = len(jaccard_join.survivors(np.concatenate([a, b]), np.arange(2000), np.arange(2000) + 2000, 0)) / 2000
        assert n >= kept if kept else n == 0
    assert len(jaccard_join.survivors(a, np.zeros(0, int), np.zeros(0, int), 0)) == 0


def test_components(spark, scratch):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000 + k) for k in range(40)]
    cls = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            cls[a] = cls[b] = min(cls[a], cls[b])
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: c for x, c in cls.items() if x in linked}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


# ---- substring dedup ----------------------------------------------------------------------------

def windows(text, n=50):
    w = (text or "").lower().encode().split()
    return {b" ".join(w[k:k + n]) for k in range(len(w) - n + 1)}


def check_dedup(rows, got):
    """No 50-word window that several documents shared is left in two; clean documents are as they were."""
    holders = defaultdict(set)
    for i, t in rows:
        for x in windows(t):
            holders[x].add(i)
    shared = {x for x, s in holders.items() if len(s) > 1}
    left = defaultdict(set)
    for r in got:
        for x in windows(r.text) & shared:
            left[x].add(r.doc_id)
    assert not [x for x, s in left.items() if len(s) > 1]
    first = {min(s) for x, s in holders.items() if x in shared}
    must = {i for x in shared for i in holders[x] if i != min(holders[x])}
    touched = {r.doc_id for r in got if r.n_removed}
    assert must <= touched
    text = dict(rows)
    assert all(r.text == text[r.doc_id] for r in got if not r.n_removed)
    return first, must, touched


def test_substring_dedup_on_the_table(spark, scratch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = substring_dedup.report(docs, scratch).collect()
    assert len(got) == len(rows)
    check_dedup(rows, got)


def test_passages_inside_other_text(spark, make_docs, scratch):
    rng = np.random.default_rng(8)
    own = [sentence(rng, 120, 10**6).split() for _ in range(12)]
    passage = sentence(rng, 53, 10**6)
    edited = passage.split()
    edited[26] = "changed"
    rows = [(10 + i, " ".join([*w[:10 + 7 * i], passage if i % 2 else passage.upper(), *w[10 + 7 * i:]])) for i, w in enumerate(own[:6])]
    rows += [(30, " ".join([*own[6][:40], *edited, *own[6][40:]])), (40, " ".join(own[7])), (41, " ".join([*own[8], *passage.split()[:40]])),
             (42, "\n".join([" ".join(own[9][:60]), passage, " ".join(own[9][60:])]))]
    got = {r.doc_id: r for r in substring_dedup.report(make_docs(rows, extra=True).repartition(3), scratch).collect()}
    text = dict(rows)
    assert got[10].text == text[10] and got[40].text == text[40] and got[41].text == text[41]
    for i in range(1, 6):
        assert got[10 + i].text.split() == own[i] and got[10 + i].removed_words == 53
    assert got[42].text == " ".join(own[9][:60]) + "\n" + " ".join(own[9][60:])
    assert got[30].n_removed == 1 and got[30].removed_words >= 50
    cls = {tuple(got[i].class_ids) for i in (11, 12, 13, 14, 15, 30, 42)}
    assert cls == {(10,)}


def test_substring_dedup_edges(spark, make_docs):
    rows = [*EDGE, (20, "q " * 49), (21, "q " * 49)]
    got = substring_dedup.report(make_docs(rows, extra=True), Scratch(spark, "t")).collect()
    assert len(got) == len(rows)
    assert all(r.n_removed == 0 for r in got if r.doc_id not in (9,))
    assert substring_dedup.report(make_docs([]), Scratch(spark, "t")).count() == 0


def test_equal_paragraphs_always_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(60):
        core = sentence(rng, 50, 50).split()
        a, b = (" ".join([*sentence(rng, int(n), 50).split(), *core, *sentence(rng, int(m), 50).split()]) for n, m in rng.integers(1, 90, (2, 2)))
        r, _, _, k = substring_dedup.anchors(Text(pa.array([a, b])))
        assert set(k[r == 0]) & set(k[r == 1])


def common(a, b):
    sh = [[tuple(w[k:k + 5]) for k in range(len(w) - 4)] for w in (a, b)]
    return 5 * len(set(sh[0]) & set(sh[1])) >= 4 * len(set(sh[0]) | set(sh[1]))


def test_moved_paragraphs_by_brute_force():
    """Substituted, inserted and deleted words: all paragraphs at a true Jaccard of 0.8, and only those."""
    rng = np.random.default_rng(3)
    for trial in range(60):
        n = int(rng.integers(50, 90))
        passage = rng.integers(0, 1 << 31, n).astype(np.uint32)
        edited = passage.tolist()
        for _ in range(1 + trial % 2):
            at, kind = int(rng.integers(5, len(edited) - 5)), rng.integers(3)
            edited[at : at + (kind != 1)] = [int(rng.integers(1 << 31))] * int(kind != 2)
        theirs = np.concatenate([rng.integers(0, 1 << 31, 70).astype(np.uint32), passage, rng.integers(0, 1 << 31, 80).astype(np.uint32)])
        own = np.concatenate([rng.integers(0, 1 << 31, 33).astype(np.uint32), np.array(edited, np.uint32), rng.integers(0, 1 << 31, 40).astype(np.uint32)])
        pieces = {k: theirs[k * 64 : k * 64 + 64] for k in range(-(-len(theirs) // 64))}
        found = np.zeros(len(own), bool)
        for a, b, _ in substring_dedup.moved(substring_dedup.grams(own), np.zeros(len(own), bool), pieces):
            found[a:b] = True
        want, o, c = np.zeros(len(own), bool), own.tolist(), theirs.tolist()
        for i in range(len(o) - 49):
            for j in range(max(0, i - 20), min(len(c) - 49, i + 100)):
                if common(o[i : i + 50], c[j : j + 50]):
                    known = {tuple(c[k : k + 5]) for k in range(j, j + 46)}
                    in_ = [k for k in range(i, i + 46) if tuple(o[k : k + 5]) in known]
                    want[in_[0] : in_[-1] + 5] = True
        assert (found == want).all(), trial


def test_paragraphs_of_unrepeated_shingles_need_no_counters(monkeypatch):
    """Most pairs are told by where the partner of each shingle lies; only repeated shingles are counted one by one."""
    rng = np.random.default_rng(8)
    theirs = rng.integers(0, 1 << 31, 192).astype(np.uint32)
    own = np.concatenate([theirs[40:80], rng.integers(0, 1 << 31, 1).astype(np.uint32), theirs[80:120]])
    pieces = {k: theirs[k * 32 : k * 32 + 32] for k in range(6)}
    monkeypatch.setattr(substring_dedup, "Counter", None)
    found = substring_dedup.moved(substring_dedup.grams(own), np.zeros(len(own), bool), pieces)
    assert min(a for a, _, _ in found) == 0 and max(b for _, b, _ in found) == len(own)


@pytest.mark.parametrize("vocab", [2, 4, 12])
def test_moved_paragraphs_with_repeated_shingles(vocab):
    """Shingles as often as they occur: every paragraph found repeats the place it names, and none is left that repeats its own diagonal."""
    rng = np.random.default_rng(vocab)
    hits = 0
    for _ in range(20):
        phrases = rng.integers(0, 1 << 31, (vocab, 9)).astype(np.uint32)
        theirs = phrases[rng.integers(0, vocab, 20)].ravel()[:160]
        own = np.delete(theirs[20:140], int(rng.integers(10, 100)))
        pieces = {k: theirs[k * 32 : k * 32 + 32] for k in range(5)}
        grams = [Counter(tuple(x[k : k + 5]) for k in range(46)) for x in (theirs[i : i + 50].tolist() for i in range(111))]
        found = substring_dedup.moved(substring_dedup.grams(own), np.zeros(len(own), bool), pieces)
        covered = np.zeros(len(own), bool)
        for a, b, shift in found:
            covered[a:b] = True
            near = [w for w in range(max(0, b - 50), min(a, len(own) - 50) + 1) if 0 <= w + shift <= 110
                    and (Counter(tuple(own[k : k + 5].tolist()) for k in range(w, w + 46)) & grams[w + shift]).total() >= 41]
            assert near
        for w in range(len(own) - 49):
            mine = Counter(tuple(own[k : k + 5].tolist()) for k in range(w, w + 46))
            if any((mine & g).total() == 46 for g in grams):
                assert covered[w : w + 50].all()
                hits += 1
    assert hits


def test_closer_keys_by_brute_force():
    """A key of every paragraph that holds an occurrence, and its least shingles under each of the finer hashes."""
    rng = np.random.default_rng(4)
    texts = [sentence(rng, n, 40) for n in (130, 20, 50, 0, 75)]
    t = Text(pa.array(texts), lower=True)
    own, place, reach = np.array([0, 0, 1, 2, 4]), np.array([0, 60, 2, 20, 50]), np.array([0, 70, 2, 20, 50])
    key = rng.integers(0, 1 << 63, 5).astype(np.uint64)
    got = {(int(r), int(p), int(k)) for part in substring_dedup._finer(t, own, key, place, reach) for r, p, k in zip(*part, strict=True)}
    want = set()
    for o, p, q, k in zip(own.tolist(), place.tolist(), reach.tolist(), key, strict=True):
        one = Text(pa.array([texts[o]]), lower=True)
        s, e, row = one.words()
        for a in range(max(0, p - 35), min(q, len(s) - 50) + 1):
            h = one.hash(s, e)[a : a + 50]
            want.add((o, a, int(shingles(h, row[:50], 1, 50)[0][0])))
            sh = shingles(h, row[:50], 1, 5)[0]
            want |= {(o, p, int(mix((mix(sh + np.uint64(r + 1)).min() ^ k)[None])[0])) for r in range(substring_dedup.FINER)}
    assert got == want


def test_copies_count_words_between_any_white_space(make_docs, scratch):
    word = [f"w{k}" for k in range(60)]
    texts = ["\n " + "\t \x0b".join(word) + " \r\n", "".join(w + c for w, c in zip(word, " \t\n\x0b\x0c\r" * 10, strict=True)), " ".join(word[:50]), "  ".join(word[:49]) + "\n" * 99]
    found = substring_dedup.copies(make_docs([(10 * k + i, t) for k, t in enumerate(texts) for i in (0, 1)]), scratch).collect()
    assert sorted((r.doc_id, r.rep, r.n_words, r.lead) for r in found) == [(1, 0, 60, "\n "), (11, 10, 60, ""), (21, 20, 50, "")]


def test_keys_meet_by_one_plan_at_every_size(spark, make_docs, scratch, monkeypatch):
    """The keys that documents share grow with the input: they are never broadcast, not even few of them."""
    rng = np.random.default_rng(5)
    passage, plans, write = sentence(rng, 60), {}, Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, table: plans.update({table: df._jdf.queryExecution().executedPlan().toString()}) or write(self, df, table))
    keys = substring_dedup.anchor_rows(make_docs([(k, sentence(rng, 40) + " " + passage) for k in range(3)]))
    met, hits = substring_dedup.meet(keys, scratch, "band")
    assert all("ShuffledHashJoin" in p and "BroadcastHashJoin" not in p for p in (plans["band_met"], hits._jdf.queryExecution().executedPlan().toString()))
    assert {r.doc_id for r in hits.collect()} == {1, 2} and {r.cdoc for r in met.collect()} == {0}


@pytest.mark.parametrize("kind", ["substituted", "inserted", "deleted"])
def test_passages_with_one_edited_word(spark, make_docs, kind):
    rng = np.random.default_rng(12)
    rows = []
    for k in range(24):
        n = (60, 80, 88)[k % 3]
        passage = sentence(rng, n, 10**6).split()
        edited = [*passage[: n // 2], *([] if kind == "deleted" else ["new"]), *passage[n // 2 + (kind != "inserted") :]]
        rows += [(100 + k, " ".join([sentence(rng, 40, 10**6), *passage, sentence(rng, 40, 10**6)])),
                 (200 + k, " ".join([sentence(rng, 30, 10**6), *edited, sentence(rng, 50, 10**6)]))]
    got = {r.doc_id: r for r in substring_dedup.report(make_docs(rows).repartition(3), Scratch(spark, "t")).collect()}
    whole = [k for k in range(24) if got[200 + k].removed_words == (60, 80, 88)[k % 3] + {"substituted": 0, "inserted": 1, "deleted": -1}[kind]]
    assert len(whole) >= 22 and all(got[200 + k].class_ids == [100 + k] for k in whole)


@pytest.mark.parametrize("edited", [False, True])
def test_least_document_holds_a_part_only(spark, make_docs, edited):
    """The middle 40 words in the first document, the whole passage in two later ones."""
    rng = np.random.default_rng(31)
    rows = []
    for k in range(60):
        n = (52, 56, 60)[k % 3]
        passage = sentence(rng, n, 10**6).split()
        lo = (n - 40) // 2
        for first, words in ((100, passage[lo : lo + 40]), (200, passage), (300, [*passage[: n // 2], *["new"] * edited, *passage[n // 2 :]])):
            rows.append((first + k, " ".join([sentence(rng, 60, 10**6), *words, sentence(rng, 60, 10**6)])))
    got = {r.doc_id: r for r in substring_dedup.report(make_docs(rows).repartition(3), Scratch(spark, "t")).collect()}
    assert all(got[100 + k].n_removed == 0 == got[200 + k].n_removed for k in range(60))
    whole = [got[300 + k].removed_words == (52, 56, 60)[k % 3] + edited for k in range(60)]
    assert sum(whole) >= (58 if edited else 60)


@pytest.mark.parametrize("repeated", [200, 100])
def test_repeated_line_before_a_passage(spark, make_docs, repeated):
    """A line that one of two documents repeats three times before the passage that follows it in both."""
    rng = np.random.default_rng(21)
    rows = []
    for k in range(40):
        line = sentence(rng, (25, 30, 40)[k % 3], 10**6)
        passage = [line, sentence(rng, 54 - len(line.split()), 10**6)]
        for first in (100, 200):
            rows.append((first + k, " ".join([sentence(rng, 40, 10**6), *[line] * (2 * (first == repeated)), *passage, sentence(rng, 60, 10**6)])))
    got = {r.doc_id: r for r in substring_dedup.report(make_docs(rows).repartition(3), Scratch(spark, "t")).collect()}
    assert [got[200 + k].removed_words >= 54 for k in range(40)] == [True] * 40


# ---- decontamination ----------------------------------------------------------------------------

def norm(text):
    return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "


def test_decontamination_on_the_table(spark, scratch):
    docs, bench = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, norm(r.text)) for r in bench.collect()]
    want = {(r.doc_id, i) for r in docs.select("doc_id", "text").collect() for i, q in items if q in norm(r.text)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, scratch).collect()}
    assert want and got == want


def test_retrieval_is_all_above_threshold():
    """Block-max WAND against scores taken the plain way, over passages that hold parts of items."""
    rng = np.random.default_rng(5)
    items = [sentence(rng, int(rng.integers(8, 40)), 400) for _ in range(60)]
    x = decontaminate.build(list(range(60)), items)
    impact = {(int(k) // 60, int(k) % 60): v for k, v in zip(x.keys, x.impact, strict=True)}
    for _ in range(40):
        words = sentence(rng, 30, 400).split() + items[rng.integers(60)].split()[: int(rng.integers(4, 40))]
        t = Text(pa.array([" ".join(words[: 2 * x.span])]))
        s, e, _ = t.alnum_words()
        terms = {int(np.searchsorted(x.terms, h)) for h in t.hash(s, e) if h in x.terms}
        score = {i: sum(impact.get((k, i), 0) for k in terms) for i in range(60)}
        want = {i for i, v in score.items() if v >= decontaminate.THRESHOLD}
        q, a = decontaminate.QUESTION, decontaminate.ANSWER
        decontaminate.QUESTION = decontaminate.ANSWER = 0.0
        try:
            got = {}
            for _, i, sc, *_ in decontaminate.search(t, x):  # of the first passage, which holds all words, and the second
                got[i] = max(sc, got.get(i, 0))
        finally:
            decontaminate.QUESTION, decontaminate.ANSWER = q, a
        assert set(got) == want and all(abs(got[i] - score[i]) < 1e-9 for i in got)


def test_decontamination_edges(spark, make_docs):
    bench = spark.createDataFrame([(1, "the capital of the old north is a town by the cold river"), (2, None), (3, ""), (4, "too short"), (None, "no id " * 9),
                                   (1, "the capital of the old north is a town by the cold river")], "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as score")
    leak = "Before, THE CAPITAL of the old\nnorth is: a town by the cold river. After " + "pad " * 50
    docs = make_docs([(1, leak), (1, leak), (2, None), (3, ""), (None, leak), (4, "the capital of the new south"), (5, "w " * 200_000 + leak)], extra=True)
    got = decontaminate.leaks(docs, bench, Scratch(spark, "t")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (5, 1)} and all(r.question_overlap == 1 == r.answer_overlap for r in got)
    assert decontaminate.leaks(docs, bench.limit(0), Scratch(spark, "t")).count() == 0
    assert decontaminate.leaks(make_docs([]), bench, Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("chars", [200, 10_000])
def test_index_shards_find_the_same(spark, make_docs, monkeypatch, chars):
    items = [(i, sentence(np.random.default_rng(i), 20)) for i in range(12)]
    docs = make_docs([(i, "pre " + t + " post") for i, t in items])
    monkeypatch.setattr(decontaminate, "SHARD_CHARS", chars)
    got = decontaminate.leaks(docs, spark.createDataFrame(items[:6], "item_id long, text string"), Scratch(spark, "t"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i in range(6)}


def test_short_and_unspaced_items(spark, make_docs):
    items = [(1, "What is the capital of France? Paris"), (2, "Paris"), (3, "\u6cd5\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f\u5df4\u9ece"),
             (4, "\u5df4\u9ece"), (5, "no such thing"), (6, "?!")]
    docs = make_docs([(1, "Quiz: what is the CAPITAL of France - Paris, of course"), (2, "the capital of France is Paris"), (3, "no such odd thing"), (4, "such"),
                      (5, "\u6211\u95ee\u4f60\u6cd5\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff0c\u5df4\u9ece\u5728\u4e1c"), (6, "\u9ece\u5df4"), (7, None)])
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "t"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 1), (1, 2), (2, 2), (5, 3), (5, 4)}


def test_few_words_are_no_evidence(spark, make_docs, tmp_path):
    """Operator 5 reports every item; the pipeline's stage drops only documents that hold one of five words or more."""
    from vaultshift.llm import stages
    items = [(1, "Yes"), (2, "what is the capital of france"), (3, "a long item of many words that stands in one of the documents only")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs([(1, "yes we can"), (2, "He asked: What is the capital of France? Paris."), (3, "clean"), (4, None), (5, "x " + items[2][1] + " y")])
    found = decontaminate.leaks(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet"), Scratch(spark, "t"))
    assert sorted((r.doc_id, r.item_id, r.item_words) for r in found.collect()) == [(1, 1, 1), (2, 2, 6), (5, 3, 14)]
    assert sorted(r.doc_id for r in stages.decontaminate(spark, docs, str(tmp_path)).collect()) == [1, 3, 4]


def test_index_of_many_items_is_linear():
    import time
    rng = np.random.default_rng(2)
    texts = [sentence(rng, 30) for _ in range(8000)]
    took = []
    for n in (2000, 8000):
        at = time.process_time()
        decontaminate.build(list(range(n)), texts[:n])
        took.append(time.process_time() - at)
    assert took[1] < 8 * took[0]


def test_weights_do_not_depend_on_the_shards(spark, make_docs, monkeypatch):
    items = [(i, sentence(np.random.default_rng(i), 8 + 3 * i, 60)) for i in range(12)]
    docs = make_docs([(i, "pre " + t.rsplit(" ", 2)[0] + " post") for i, t in items])
    got = []
    for chars in (10_000, 200):
        monkeypatch.setattr(decontaminate, "SHARD_CHARS", chars)
        rows = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "t")).collect()
        got.append({(r.doc_id, r.item_id): round(r.score, 9) for r in rows})
    assert got[0] and got[0] == got[1]


def test_substring_wide_ids_and_texts_under_one_id(spark, make_docs):
    """64-bit ids; two texts under one id: each keeps its own words and loses only what an earlier document holds."""
    rng = np.random.default_rng(77)
    passage, a, b, c = (sentence(rng, n) for n in (80, 60, 60, 60))
    rows = [(5, f"{a} {passage}"), (2**62, f"{b} {passage}"), (2**62, f"{c} {passage} end"), (2**62 + 1, f"{a} {passage}"), (2**62 + 1, f"{c} alone")]
    got = sorted((r.doc_id, " ".join(r.text.split()), r.class_ids) for r in substring_dedup.report(make_docs(rows), Scratch(spark, "t")).collect())
    assert [(i, t) for i, t, _ in got] == sorted([(5, f"{a} {passage}"), (2**62, b), (2**62, f"{c} end"), (2**62 + 1, ""), (2**62 + 1, f"{c} alone")]) or \
        [(i, t) for i, t, _ in got] == sorted([(5, f"{a} {passage}"), (2**62, b), (2**62, f"{c} end"), (2**62 + 1, ""), (2**62 + 1, "alone")])
    assert all(ids in ([], [5], [2**62], [5, 2**62]) for _, _, ids in got)


def test_substring_stage_keeps_columns_whatever_their_names(spark, make_docs):
    from pyspark.sql import functions as F
    from vaultshift.llm import stages
    rng = np.random.default_rng(78)
    passage = sentence(rng, 90)
    docs = make_docs([(1, passage), (2, f"own words {passage}"), (3, None), (None, passage)])
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("_text", "_n_chars", "d", "c", "text_key", "a.b")})
    out = {r.doc_id: r for r in stages.substring_dedup_stage(spark, docs, "").collect()}
    assert out[2].text.strip() == "own words" and out[2].n_chars == len(out[2].text) and out[2]._text == "_text2" and out[2]["a.b"] == "a.b2"
    assert out[1].text == passage and out[3].text is None and out[None].text == passage


def test_anchors_of_a_long_text_by_ranges(monkeypatch):
    rng = np.random.default_rng(79)
    text = sentence(rng, 3000) + " " + "again and again " * 200 + sentence(rng, 2000)
    whole = substring_dedup.anchors(Text([text], lower=True))
    monkeypatch.setattr(substring_dedup, "CHUNK", 100)
    monkeypatch.setattr(substring_dedup, "LONG", 500)
    parts = substring_dedup.anchors(Text([text], lower=True))
    keys = [set(zip(x[1].tolist(), x[3].tolist(), strict=True)) for x in (whole, parts)]
    assert keys[0] <= keys[1] and len(keys[1] - keys[0]) <= 60  # more only inside periodic text


def test_join_tasks_hold_small_batches(spark, make_docs, scratch, monkeypatch):
    """No task of the join gets or gives Arrow batches of more than 1 000 rows, whatever the session had."""
    monkeypatch.setattr(jaccard_join, "chunks", lambda arr, limit: [(0, len(arr))] if len(arr) <= 1000 else 1 / 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    docs = make_docs([(i, f"seven words make a short text {i % 1500}") for i in range(3000)]).coalesce(1)
    got = jaccard_join.classes(docs, scratch).collect()
    assert len(got) == 3000 and all(r.class_id == r.doc_id % 1500 and r.n_links == 1 for r in got)
