"""Classifiers: held-out accuracy on the tables, gradients, edge cases; stages and queries."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vaultshift.llm import langid, quality, toxicity
from vaultshift.llm import queries as Q

from conftest import SF01, SF001

EDGE = [(1, None), (2, ""), (3, "123 %% !!"), (4, "漢字 und Wörter"), (4, "漢字 und Wörter"), (None, "the cat"), (5, "long text " * 60_000)]


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = np.asarray(y) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def held_out(spark, name, label, modulus, held):
    rows = Q.QUERIES[name](spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    rows = [r for r in rows if r.held_out]
    return np.array([r.score for r in rows]), np.array([r[label] for r in rows])


def test_quality_held_out(spark):
    score, y = held_out(spark, "op3_quality_classifier", "quality", 5, 0)
    assert auc(score, y) > 0.97 and ((score >= 0.3) == (y == 1)).mean() > 0.93


def test_toxicity_held_out(spark):
    score, y = held_out(spark, "op2_toxicity", "toxic", 4, 2)  # one label in eight has no telling word
    assert auc(score, y) > 0.75 and ((score >= 0.3) == (y == 1)).mean() > 0.88


def test_language_held_out(spark):
    rows = Q.op4_language_id(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.99


def edge_docs(spark, make_docs):
    train = [(100 + i, ("good words here and there. " if i % 2 else "bad!! IDIOT %% trash ## ") * 4, "en" if i % 2 else "de") for i in range(60)]
    docs = make_docs([*[(*r, None, None) for r in EDGE], *[(i, t, lang, None) for i, t, lang in train]], extra=True)
    labels = spark.createDataFrame([(i, int("good" in t), int("IDIOT" in t)) for i, t, _ in train], "doc_id long, quality int, toxic int")
    return docs, labels


def test_classifier_edges(spark, make_docs):
    docs, labels = edge_docs(spark, make_docs)
    for f, col in ((quality.classify, "quality"), (toxicity.classify, "toxic")):
        got = f(docs, labels).collect()
        assert len(got) == 67 and all(0 <= r.score <= 1 for r in got)
        truth = {r.doc_id: r[col] for r in labels.collect()}
        assert np.mean([(r.score >= 0.5) == (truth[r.doc_id] == 1) for r in got if r.doc_id in truth]) > 0.95
        a = [r.score for r in got if r.doc_id == 4]
        assert a[0] == a[1]
        assert f(make_docs([]), labels).count() == 0
        assert f(docs, labels.limit(0)).count() == 67


def test_language_edges(spark, make_docs):
    docs, _ = edge_docs(spark, make_docs)
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[3].lang_pred) == ("und", "und", "und") and got[4].lang_pred in ("en", "de")
    assert len({got[100 + i].lang_pred for i in range(60) if i % 2}) == 1
    none = make_docs(EDGE)
    assert {r.lang_pred for r in langid.predict(none, langid.fit(none)).collect()} == {"und"}
    assert langid.predict(make_docs([]), langid.train([], [])).count() == 0


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    k, sizes = 3, [1, 4, 2, 5]
    em, trans = rng.normal(size=(sum(sizes), k)), rng.normal(size=(k, k))
    start = np.cumsum([0, *sizes[:-1]])
    post, pairs = langid.forward_backward(em, start, np.array(sizes), trans, want_pairs=True)
    want, want_pairs = np.zeros_like(em), np.zeros((k, k))
    for s, n in zip(start, sizes, strict=True):
        paths = np.array(np.meshgrid(*[range(k)] * n, indexing="ij")).reshape(n, -1).T
        w = np.exp([sum(em[s + i, p[i]] for i in range(n)) + sum(trans[p[i], p[i + 1]] for i in range(n - 1)) for p in paths])
        w /= w.sum()
        for p, x in zip(paths, w, strict=True):
            for i in range(n):
                want[s + i, p[i]] += x
                if i + 1 < n:
                    want_pairs[p[i], p[i + 1]] += x
    assert np.allclose(post, want) and np.allclose(pairs, want_pairs)


def test_pieces_carry_their_chain(monkeypatch):
    """Rows of many pieces get the marginals of the whole chain, with few languages and with many."""
    rng = np.random.default_rng(4)
    row = np.repeat(np.arange(6), [1, 64, 65, 700, 128, 3])
    em, trans = rng.normal(size=(len(row), 4)) * 3, rng.normal(size=(4, 4)) * 2
    want, _ = langid.forward_backward(em, *langid.pieces(row), trans)
    for piece in (1, 2, 7, 64, 4096):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert np.allclose(langid.marginals_of_rows(em, row, trans), want)
    monkeypatch.setattr(langid, "WIDE", 3)
    assert np.allclose(langid.marginals_of_rows(em, row, trans), want)
    cut, _ = langid.forward_backward(em, *langid.pieces(row, 64), trans)
    assert not np.allclose(cut, want)
    assert langid.marginals_of_rows(em[:0], row[:0], trans).shape == (0, 4)


def test_training_reads_past_a_common_opening():
    rng = np.random.default_rng(8)
    words = {x: [f"{a}{b}{e}" for a in "bcdfgl" for b in "aeiou" for e in ends] for x, ends in (("xx", ("no", "ra")), ("yy", ("sk", "pt")))}
    licence = " ".join(rng.choice([f"lic{a}{b}" for a in "abcd" for b in "uvw"], 400))
    text = {x: [licence + " " + " ".join(rng.choice(v, 800)) for _ in range(30)] for x, v in words.items()}
    model = langid.train(text["xx"] + text["yy"], ["xx"] * 30 + ["yy"] * 30)
    lang, score, known = model.predict(pa.array([" ".join(rng.choice(words[x], 50)) for x in ("xx", "yy")] + ["qqqq zzzz wwww"]))
    assert lang[:2] == ["xx", "yy"] and score[:2].min() > 0.8 and known[:2].min() > 0.8 and known[2] == 0


def test_language_stage_keeps_mixtures(spark, make_docs, tmp_path):
    from vaultshift.llm import stages
    rng = np.random.default_rng(9)
    words = {x: [f"{a}{b}{e}" for a in "bcdfgl" for b in "aeiou" for e in ends] for x, ends in
             (("pp", ("no", "ra")), ("qq", ("sk", "pt")), ("rr", ("wy", "xu")))}
    rows = [(100 * k + i, " ".join(rng.choice(v, 60)), x) for k, (x, v) in enumerate(words.items()) for i in range(40)]
    mixed = " ".join(w for v in words.values() for w in rng.choice(v, 30))
    docs = make_docs([(*r, "s") for r in rows] + [(1000, mixed, None, "s"), (1001, "--- 12", None, "s"), (1002, None, "pp", "s"), (None, mixed, None, "s")])
    got = stages.language_id(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert 1000 in ids and 1001 not in ids and 1002 not in ids and None in ids and len(ids) == 122


def test_code_switched_words(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.fit(docs)
    by = {r.lang: r.text.split()[:30] for r in docs.where("n_chars > 600").select("lang", "text").collect()}
    langs = sorted(by)[:2]
    _, post = model.marginals(" ".join(by[langs[0]] + by[langs[1]]))
    best = [model.languages[i] for i in post.argmax(axis=1)]
    half = len(best) // 2
    assert np.mean([b == langs[0] for b in best[:half - 2]]) > 0.8 and np.mean([b == langs[1] for b in best[half + 2:]]) > 0.8


def test_pooling_matches_plain_convolution():
    rng = np.random.default_rng(3)
    v = 20
    taps = [rng.normal(size=(v, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS for _ in range(w)]
    for t in taps:
        t[0] = 0
    m = toxicity.Model(np.arange(v - 1), taps, [np.zeros(toxicity.FILTERS, np.float32)] * 3, np.ones(24, np.float32), 0.0, np.zeros((v, 0), np.float32), np.zeros(1))
    texts = [rng.integers(0, v, n) for n in (0, 1, 2, 7, 40)]
    row = np.repeat(np.arange(5), [len(t) for t in texts])
    got = m.pooled(np.concatenate(texts).astype(np.int32), row, 5)
    for i, t in enumerate(texts):
        seq = np.concatenate([t, [0, 0, 0]]).astype(int)
        want, k = [], 0
        for w in toxicity.WIDTHS:
            z = np.stack([sum(taps[k + j][seq[p + j]] for j in range(w)) for p in range(len(t) + 1)])
            want.append(np.maximum(z.max(axis=0), 0))
            k += w
        assert np.allclose(got[i], np.concatenate(want), atol=1e-5)


def test_toxicity_learns_from_every_labelled_document(spark, make_docs):
    """One telling word in the 1 500 documents of least id hash, another one in all later ones."""
    by_hash = [r.id for r in spark.range(9000).where("id % 2 = 0").orderBy(F.xxhash64("id")).collect()]
    learn = [i for i in by_hash if zlib.crc32(str(i).encode()) % 4 != 2]
    early = set(learn[:1500])
    text = lambda i: f"some words {'' if i % 2 else 'alpha' if i in early else 'omega'} and others"
    docs = make_docs([(i, text(i)) for i in range(9000)])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(9000)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).where("held_out").collect()
    assert len(got) > 2000 and all(r.predicted == 1 - r.doc_id % 2 for r in got)


def test_toxicity_learns_from_long_texts_whole(spark, make_docs):
    far = "plain words " * 2000  # the telling word is behind 24 000 characters
    docs = make_docs([(i, far + ("nasty" if i % 2 else "pleasant")) for i in range(120)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.classify(docs, labels).collect())


def test_toxicity_step_takes_long_texts_in_pieces(monkeypatch):
    def stepped():
        rng = np.random.default_rng(5)
        net = toxicity.Network.start(rng.normal(size=(30, toxicity.DIM)), rng)
        docs = [rng.integers(0, 30, n).astype(np.int32) for n in (0, 1, 2, 7, 40, 41)]
        for _ in range(3):
            net.step(docs, np.array([0, 1, 0, 1, 0, 1.0]), np.ones(6), 0.05)
        return net
    whole = stepped()
    monkeypatch.setattr(toxicity, "LONG", 5)
    assert (stepped().values == whole.values).all() and (stepped().state == whole.state).all()


def test_ftrl_and_scores_by_brute_force():
    """A scalar FTRL over dictionaries, and scores as dictionary dot products."""
    from collections import Counter
    from math import exp, log, sqrt

    from vaultshift.llm.textnum import Text
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["good", "fine", "Text.", "JUNK", "%%%", "a", "a", "it"], int(rng.integers(1, 30)))) for _ in range(40)] + [""]
    labels = [int("%%%" not in t) for t in texts]
    alpha, beta, l1, l2 = 1.0, 1.0, 0.02, 0.1
    data = []
    for text in texts:
        row, fams = quality.bucket_families(Text(pa.array([text], pa.string())))
        got = Counter()
        for k, ok in fams:
            for j, b in enumerate(k.tolist()):
                if ok is None or ok[j]:
                    got[b] += float(quality.SCALE) / len(row)
        data.append(got)
    rows = [(x, y) for x, y in zip(data, labels, strict=True) if x]
    ones = sum(y for _, y in rows)
    cost = {1: len(rows) / (2 * ones), 0: len(rows) / (2 * (len(rows) - ones))}
    z, n, zb, nb, b = Counter(), Counter(), 0.0, 0.0, 0.0

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(3):
        for k in order.permutation(len(rows)):
            x, y = rows[k]
            w = {i: weight(i) for i in x}
            g = (1 / (1 + exp(-(sum(w[i] * v for i, v in x.items()) + b))) - y) * cost[y]
            for i, v in x.items():
                z[i] += g * v - (sqrt(n[i] + (g * v) ** 2) - sqrt(n[i])) / alpha * w[i]
                n[i] += (g * v) ** 2
            zb += g - (sqrt(nb + g * g) - sqrt(nb)) / alpha * b
            nb += g * g
            b = -zb / ((beta + sqrt(nb)) / alpha)
    b += log(0.3 / 0.7)
    w, bias = quality.train(texts, labels, bias_share=0.3)
    assert bias == pytest.approx(b) and set(np.flatnonzero(w)) == {i for i in z if weight(i)}
    assert all(w[i] == pytest.approx(weight(i), rel=1e-4, abs=1e-6) for i in z)
    want = [1 / (1 + exp(-(sum(weight(i) * v for i, v in x.items()) + b))) for x in data]
    assert quality.score_texts(pa.array(texts), w, bias) == pytest.approx(want, abs=1e-5)


def test_ftrl_is_sparse_and_scores_are_dot_products():
    texts = ["good fine text. " * 5, "JUNK!! %%% ### " * 5] * 30
    w, b = quality.train(texts, [1, 0] * 30)
    assert 0 < (w != 0).sum() < 500
    s = quality.score_texts(pa.array(texts[:2]), w, b)
    assert s[0] > 0.8 > 0.2 > s[1]


STAGE_IDS = ["language_id", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "source_mixing"]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as C
    assert [n for n, _ in C.STAGES] == STAGE_IDS
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    cols, seen = docs.columns, []
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF001).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(docs.count())
        assert name == "source_mixing" or docs.columns == cols
    assert seen == sorted(seen, reverse=True) and seen[0] >= 195
    out = C.run(spark, SF001)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))
    bench = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    final = spark.read.parquet(str(tmp_path / "3"))
    assert not [r for r in final.collect() if any(x in " ".join(r.text.lower().split()) for x in bench)]


@pytest.mark.parametrize("index", range(4))
def test_stage_edges(spark, make_docs, index):
    import corpus_pipeline as C
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "the cat sat on the mat and slept all day long", "en", "a"), (3, "the cat sat on the mat and slept all day long", "en", "a"),
            (None, "words without an id", "en", "a"), (5, "le chat dort sur le tapis toute la longue nuit", "fr", "b")]
    name, stage = C.STAGES[index]
    docs = make_docs(rows, extra=True)
    out = stage(spark, docs, SF001)
    assert out.columns == docs.columns
    got = out.collect()
    if name == "ngram_jaccard_join":
        assert sorted((r.doc_id or -1) for r in got) == [-1, 1, 2, 3, 5]
    elif name == "language_id":
        assert 1 not in {r.doc_id for r in got}
    else:
        assert len(got) == len(rows)
    assert stage(spark, docs.limit(0), SF001).count() == 0


def test_every_operator_has_a_query():
    import __spark_entry__ as E
    names = {n.split("_")[0] for n in E.queries() if n.startswith("op") and n[2].isdigit()}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in E.queries()
    assert "op10_mixing" in E.oracle_sql()


def test_native_rules_run_no_python(spark):
    plan = Q.op9_quality_rules(spark, SF001).withColumn("x", F.lit(1))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
