"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns they were given. Rows whose doc_id is null cannot be named in a
search's result and pass through the searching stages unchanged. Decisions are joined back by doc_id,
as a broadcast only while the list of decided ids is at most ``common.BROADCAST_ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as bm25
from . import jaccard_join, langid, mixing, substring_dedup
from .common import Scratch, hint_small, small_batches

#: A document whose best language has a smaller share of its words is rejected, unless most of its words are known.
MIN_LANGUAGE_SHARE = 0.5
MIN_KNOWN_SHARE = 0.5
#: Fewer words in a row are no evidence that a document holds a benchmark item: any text may say "yes" or "New York".
MIN_EVIDENCE_WORDS = 5


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(hint_small(ids), "doc_id", "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language or several: ``und`` goes, and texts without a language of ``MIN_LANGUAGE_SHARE`` whose words
    are not known either (less than ``MIN_KNOWN_SHARE`` of them); mixtures of known words stay."""
    scratch = Scratch(spark, "lang")
    small_batches(spark)
    found = langid.predict(docs, langid.fit(docs))
    strange = (F.col("score") < MIN_LANGUAGE_SHARE) & (F.col("known") < MIN_KNOWN_SHARE)
    rejected = found.where((F.col("lang_pred") == langid.UND) | strange).select("doc_id")
    return _without(docs, scratch.write(rejected.where("doc_id is not null").distinct(), "rejected"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents, the one with the least id. Rows that repeat a
    doc_id are one document and leave one row."""
    scratch = Scratch(spark, "near")
    found = scratch.write(jaccard_join.classes(docs, scratch), "classes")
    kept = _without(docs, scratch.write(found.where("doc_id <> class_id").select("doc_id").distinct(), "dropped"))
    twice = scratch.write(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    ids = hint_small(twice)
    return kept.join(ids, "doc_id", "left_anti").unionByName(kept.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with texts (and n_chars) that have lost the passages an earlier document holds."""
    scratch = Scratch(spark, "passages")
    cuts = substring_dedup.find_cuts(docs, scratch).select("doc_id", "text_key", "text", "n_chars")
    cuts = scratch.write(cuts.dropDuplicates(["doc_id", "text_key"]), "texts")
    scratch.drop("cuts")
    # rows and cuts as one column each: no name of theirs can clash; only rows with a cut are shuffled
    ids = cuts.select(F.struct("doc_id", "text_key").alias("i"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"))
    own = (F.col("d.doc_id") == F.col("i.doc_id")) & (F.xxhash64("d.text") == F.col("i.text_key"))
    clean = rows.join(hint_small(ids), own, "left_anti")
    new = cuts.select(F.struct(*cuts.columns).alias("i"))
    both = rows.join(hint_small(ids), own, "left_semi").join(new, own)
    out = {c: F.col(f"d.`{c}`") for c in docs.columns} | {"text": F.col("i.text")}
    if "n_chars" in out:
        out["n_chars"] = F.col("i.n_chars").cast(docs.schema["n_chars"].dataType)
    return clean.select("d.*").unionByName(both.select(*[e.alias(c) for c, e in out.items()]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item of at least ``MIN_EVIDENCE_WORDS`` words."""
    scratch = Scratch(spark, "leaks")
    found = bm25.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch)
    found = found.where(F.col("item_words") >= MIN_EVIDENCE_WORDS)
    return _without(docs, scratch.write(found.select("doc_id").distinct(), "leaked"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every remaining document (doc_id, size, source_size, target, taken)."""
    return mixing.mix(docs, Scratch(spark, "mix"))
