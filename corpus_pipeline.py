"""The corpus pipeline: quality filter, near-duplicate removal, decontamination, secret redaction, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import containment, nearcopies, packing, quality, secrets
from quire.llm.common import fresh, materialize, table

#: A document scored below this by the quality classifier goes.
KEEP_FROM = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects. The model comes from the stage's own documents and the labels."""
    model, name = quality.fit(docs, table(spark, sf_dir, "labels")), fresh(docs, "quality")
    return quality.score(docs, model, output=name).where(F.col(name) >= KEEP_FROM).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: that with the smallest id (null ids last), of equal ids that with the least text hash.

    Groups are joined by SimHash multi-index hashing over 5-word shingles, verified by a Jaccard similarity of 0.8 or
    more, and completed by MinHash bands. Rows that repeat an id with another text are documents of their own.
    """
    first = nearcopies.near_components(docs).where("first").groupBy(F.col("id").alias("_id"), F.col("key").alias("_key")).agg(F.count("*").alias("_rows"))
    first, whole = materialize(first, "pipeline-keep"), F.struct(*[F.col(c) for c in docs.columns])
    on = lambda k: F.col("doc_id").cast("long").eqNullSafe(k["_id"]) & (F.xxhash64(F.col("text").cast("string")) == k["_key"])
    once, often = first.where("_rows = 1"), first.where("_rows > 1")
    # Of repeats of one row, which may differ in other columns, the least as JSON stays.
    repeats = docs.join(often, on(often), "left_semi").groupBy("doc_id", F.xxhash64(F.col("text").cast("string"))).agg(F.min_by(whole, F.to_json(whole)).alias("_row"))
    # Without the hint, a table of all kept ids would go through the driver wherever its files are just below Spark's threshold.
    return docs.join(once.hint("merge"), on(once), "left_semi").unionByName(repeats.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return containment.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redact secrets; no document goes, and n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.digests(packing.pack(docs))


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_neardup", dedup_stage),
    ("benchmark_decontamination", decontaminate_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

#: Latent vectors, fingerprints and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
