"""Labelled training documents of the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

MAX_TRAINING_CHARS = 20_000


def labelled(labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """doc_id, label of the labelled documents whose fold is not ``held``. Labels that contradict each other for one
    id are left out."""
    return labels.where((fold(F.col("doc_id"), modulus) != held) & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias("label"), F.max(label).alias("_hi")).where("label = _hi").select("doc_id", "label")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, per_class: int, classes: list,
                    extra: tuple[str, ...] = ()) -> list[dict]:
    """At most ``per_class`` labelled documents of each class whose fold is not ``held``, least hash of
    the id first. Documents of more than ``MAX_TRAINING_CHARS`` characters teach nothing (their texts
    are taken whole or not at all). Labels that contradict each other for one id are left out."""
    known = labelled(labels, label, modulus, held)
    ids = None
    for c in classes:
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    rows = docs.select("doc_id", "text", *extra).where(F.length("text").between(1, MAX_TRAINING_CHARS)).join(F.broadcast(ids), "doc_id").collect()
    once = {r["doc_id"]: r.asDict() for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))}
    return list(once.values())
