"""Quality rules as weak supervision: rules vote or abstain, EM estimates their accuracies.

Each rule votes that a document is good (1), bad (-1) or abstains (0). Documents are reduced to their
pattern of votes; the at most ``3 ** rules`` patterns with their counts over all documents feed the
expectation-maximisation of a two-class model in which every rule has an accuracy per class. The
posterior probability of "good" replaces all-must-pass filtering. Everything, EM included, is DataFrame
functions: an EM round is one aggregate over the pattern table.

Defined cases: null or empty text has no words, fails the base and is not kept; repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_AT = 0.5
EM_ROUNDS = 40
EM_TOLERANCE = 1e-6
PRIOR_SHARE = 0.02


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules read, one row per row of ``docs``."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select(
        "doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\u000b\u000c\r", "")) > 0).alias("lines"))
    d = d.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit(r"[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit(r"[.!?](?:[\x20\x09-\x0D]|$)")).cast("long").alias("n_ends"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    windows = F.when(F.size("h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(WINDOW)))))
    d = d.withColumn("win", windows).drop("h")
    d = d.withColumn("some", F.col("win").isNotNull() & (F.size(F.array_distinct("win")) < F.size("win")))
    # (window, place) sorted; a window is repeated if a neighbour in that order has the same hash
    d = d.withColumn("sorted", F.when(F.col("some"), F.array_sort(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("win")
    d = d.withColumn("at", F.when(F.col("some"), F.array_sort(F.transform(
        F.filter("sorted", lambda x, k: (F.get("sorted", k + 1)["h"] == x["h"]) | (F.get("sorted", k - 1)["h"] == x["h"])),
        lambda x: x["i"])))).drop("sorted")
    covered = F.aggregate(
        F.transform("at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.when(F.col("some"), covered).otherwise(F.lit(0).cast("long"))).drop("at", "some")


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules: name -> vote. Ratios are per word, line or character of the whole text."""
    c = F.col
    words, chars = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("word_chars"), F.lit(1))
    mean = c("word_chars") / words
    never = F.lit(False)
    return {
        "length": _vote(c("n_words") < 15, c("n_words") >= 40),
        "word_size": _vote((mean < 3) | (mean > 12), (mean >= 3.5) & (mean <= 9)),
        "sentences": _vote(c("n_ends") < 0.01 * words, (c("n_ends") >= 0.03 * words) & (c("n_ends") <= 0.2 * words)),
        # these know junk when they see it; that they see none says little, so they abstain
        "symbols": _vote(c("n_symbols") > 0.2 * words, never),
        "dup_lines": _vote(c("n_dup_lines") > 0.3 * F.greatest(c("n_lines"), F.lit(1)), never),
        "repeats": _vote(c("n_repeat_words") > 0.15 * words, never),
        "capitals": _vote(c("n_upper") > 0.4 * chars, never),
    }


def start(names: list[str]) -> dict:
    """What is assumed before EM: most documents are good, and a bad vote is rare for good ones. Per
    class a rule has P(good vote), P(bad vote); the remainder is P(abstain)."""
    return {"prior": 0.85} | {
        n: {"g": (0.75, 0.002), "b": (0.60, 0.25)} if n in ("length", "word_size", "sentences")
        else {"g": (0.001, 0.002), "b": (0.001, 0.40)} for n in names}


def posterior(params: dict, names: list[str]) -> Column:
    """P(good | votes) under ``params`` as :func:`start` has them."""
    logit = F.lit(math.log(params["prior"] / (1 - params["prior"])))
    for n in names:
        (gu, gd), (bu, bd) = params[n]["g"], params[n]["b"]
        logit = logit + F.when(F.col(n) == 1, math.log(gu / bu)).when(F.col(n) == -1, math.log(gd / bd)).otherwise(
            math.log((1 - gu - gd) / (1 - bu - bd)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def fit(patterns: DataFrame, names: list[str], rounds: int = EM_ROUNDS) -> dict:
    """EM over the pattern table (votes..., n); one aggregate a round. Each class's vote counts are
    smoothed with ``PRIOR_SHARE`` of all documents that vote as :func:`start` says, so that a rule
    that hardly ever votes keeps its meaning."""
    first = params = start(names)
    for _ in range(rounds):
        p = patterns.withColumn("p", posterior(params, names)).withColumn("g", F.col("p") * F.col("n")).withColumn("b", F.col("n") - F.col("g"))
        sums = [F.sum("g").alias("g"), F.sum("b").alias("b"), F.sum("n").alias("n")]
        for n in names:
            for cls in "gb":
                for v, tag in ((1, "up"), (-1, "down")):
                    sums.append(F.sum(F.when(F.col(n) == v, F.col(cls)).otherwise(0.0)).alias(f"{n}_{cls}_{tag}"))
        s = p.agg(*sums).first()
        if not s["n"]:
            return params
        extra = PRIOR_SHARE * s["n"] + 1
        new = {"prior": (s["g"] + extra * first["prior"]) / (s["n"] + extra)}
        for n in names:
            new[n] = {cls: tuple((s[f"{n}_{cls}_{tag}"] + extra * x) / (s[cls] + extra)
                                 for tag, x in zip(("up", "down"), first[n][cls], strict=True)) for cls in "gb"}
        moved = max(abs(x - y) for n in names for cls in "gb" for x, y in zip(new[n][cls], params[n][cls], strict=True))
        params = new
        if moved < EM_TOLERANCE:
            break
    return params


def label(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality."""
    rules = votes()
    names = list(rules)
    m = measures(docs).withColumns(rules)
    m = m.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    m = scratch.write(m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *names), "votes")
    patterns = scratch.write(m.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    p = posterior(fit(patterns, names), names)
    return m.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (p >= KEEP_AT)).alias("kept"), p.alias("quality"))


def oracle_sql() -> str:
    """The same rows in DuckDB: repeated windows by grouping, EM as a recursive query of EM_ROUNDS steps."""
    names = ["length", "word_size", "sentences", "symbols", "dup_lines", "repeats", "capitals"]
    first = start(names)
    rates = [(n, c, k, t) for n in names for c in "gb" for k, t in enumerate(("up", "down"))]
    logit = "ln(prior / (1 - prior))" + "".join(
        f" + CASE {n} WHEN 1 THEN ln({n}_g_up / {n}_b_up) WHEN -1 THEN ln({n}_g_down / {n}_b_down) "
        f"ELSE ln((1 - {n}_g_up - {n}_g_down) / (1 - {n}_b_up - {n}_b_down)) END" for n in names)
    seed = ", ".join([f"CAST({first['prior']} AS DOUBLE) AS prior"] + [f"CAST({first[n][c][k]} AS DOUBLE) AS {n}_{c}_{t}" for n, c, k, t in rates])
    total = "sum(n)"
    extra = f"({PRIOR_SHARE} * {total} + 1)"
    weight = {"g": "p * n", "b": "(1 - p) * n"}
    step = ", ".join([f"(sum(p * n) + {extra} * {first['prior']}) / ({total} + {extra}) AS prior"] + [
        f"(sum(CASE WHEN {n} = {1 - 2 * k} THEN {weight[c]} ELSE 0 END) + {extra} * {first[n][c][k]}) / (sum({weight[c]}) + {extra}) AS {n}_{c}_{t}"
        for n, c, k, t in rates])
    cols = ", ".join(["prior"] + [f"{n}_{c}_{t}" for n, c, _, t in rates])
    return rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT r, i, list_slice(words, i, i + {WINDOW - 1}) AS win FROM docs, unnest(range(1, len(words) - {WINDOW - 2})) AS u(i)),
twice AS (SELECT r, win FROM windows GROUP BY r, win HAVING count(*) > 1),
covered AS (SELECT w.r, count(DISTINCT w.i + k.k) AS n FROM windows w JOIN twice t ON w.r = t.r AND w.win = t.win, range({WINDOW}) AS k(k) GROUP BY w.r),
lined AS (SELECT *, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM docs),
m AS (
  SELECT l.r, doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[.!?](?:[\x20\x09-\x0D]|$)')) AS n_ends,
         greatest(len(words), 1) AS nw
  FROM lined l LEFT JOIN covered c ON l.r = c.r),
v AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    CASE WHEN n_words < 15 THEN -1 WHEN n_words >= 40 THEN 1 ELSE 0 END AS length,
    CASE WHEN word_chars / nw < 3 OR word_chars / nw > 12 THEN -1 WHEN word_chars / nw >= 3.5 AND word_chars / nw <= 9 THEN 1 ELSE 0 END AS word_size,
    CASE WHEN n_ends < 0.01 * nw THEN -1 WHEN n_ends >= 0.03 * nw AND n_ends <= 0.2 * nw THEN 1 ELSE 0 END AS sentences,
    CASE WHEN n_symbols > 0.2 * nw THEN -1 ELSE 0 END AS symbols,
    CASE WHEN n_dup_lines > 0.3 * greatest(n_lines, 1) THEN -1 ELSE 0 END AS dup_lines,
    CASE WHEN n_repeat_words > 0.15 * nw THEN -1 ELSE 0 END AS repeats,
    CASE WHEN n_upper > 0.4 * greatest(word_chars, 1) THEN -1 ELSE 0 END AS capitals
  FROM m),
patterns AS (SELECT {', '.join(names)}, count(*) AS n FROM v GROUP BY ALL),
em AS (
  SELECT 0 AS i, {seed}
  UNION ALL
  SELECT i + 1, {cols} FROM (
    SELECT i, {step} FROM (SELECT *, 1 / (1 + exp(-({logit}))) AS p FROM em, patterns WHERE i < {EM_ROUNDS}) GROUP BY i))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 1 / (1 + exp(-({logit}))) >= {KEEP_AT} AS kept
FROM v, (SELECT * FROM em ORDER BY i DESC LIMIT 1)
"""
