"""Bounded samples of labelled training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fold


def labelled_ids(labels: DataFrame, label_col: str, per_class: int, *, id_col: str = "doc_id") -> DataFrame:
    """(id, label): of each label 0 and 1, at most ``per_class`` ids outside fold 0, those first by hash.

    Of repeated ids the smaller label counts; null ids and other labels are left out.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(fold("id") != 0).groupBy("id").agg(F.min("label").alias("label"))
    parts = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def rate(labels: DataFrame, label_col: str, *, id_col: str = "doc_id") -> float | None:
    """The share of label 1 among all labelled rows outside fold 0; None where there are none."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    return known.where(fold("id") != 0).agg(F.avg("label")).first()[0]


def texts_of(docs: DataFrame, ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of the documents with these ids; ``ids`` is bounded by ``labelled_ids`` and so is broadcast."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.join(F.broadcast(ids), "id")
