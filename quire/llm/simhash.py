"""SimHash near-duplicate components by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialize, measured_joins, release, trimmed
from quire.llm.components import components

#: A segment bucket with more fingerprints than this is contracted first, so that a large group of near copies costs no pairs.
CROWDED = 64
_HALF = 0xFFFFFFFF
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a whole text's word shingles, repeats included; 0 where there is no word."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, sizes = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    k = min(words, len(parts))
    first, last = (ends - sizes)[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), _BLOCK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(first[at : at + _BLOCK], last[at : at + _BLOCK], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(first)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = np.fromiter((fingerprint(t.as_py(), words, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made.view(np.int64))], names=["id", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(trimmed(run), "id long, fp long")


def _segments(df: DataFrame, *keep: str) -> DataFrame:
    """Each fingerprint's two halves, as rows (seg, key)."""
    halves = F.array(*[F.struct(F.lit(s).cast("tinyint").alias("seg"), k.alias("key")) for s, k in ((0, F.shiftrightunsigned("fp", 32)), (1, F.col("fp").bitwiseAND(F.lit(_HALF))))])
    return df.select("fp", *keep, F.explode(halves).alias("s")).select("fp", *keep, "s.seg", "s.key")


def links(nodes: DataFrame, *, max_bits: int = 3, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints that chains of links of at most ``max_bits`` bits connect.

    Multi-index hashing over two 32-bit segments: of at most three differing bits, one half holds at most one.
    Each fingerprint probes, for each half, the value itself and the values with one set bit cleared (of two
    halves one bit apart, one has that bit set); table matches are verified over all 64 bits.
    Segment buckets of more than ``crowded`` fingerprints are contracted before: fingerprints within one bit of
    a common value are within two of each other, so each such value makes one star; a star has at most 65 points.
    Matches inside one contracted class are not enumerated.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one cover at most three bits")
    halves = _segments(nodes)
    crowd = halves.groupBy("seg", "key").count().where(F.col("count") > crowded)
    full = materialize(halves.join(crowd, ["seg", "key"], "left_semi").select("fp").distinct(), "simhash-crowded")
    stars = None
    if max_bits >= 2 and not full.isEmpty():
        ball = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
        points = full.select("fp", F.explode(ball).alias("center")).groupBy("center").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
        stars = materialize(points.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).where("a <> b").distinct(), "simhash-stars")
        classes = components(stars, "simhash-classes")
        nodes = materialize(nodes.join(classes.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("cls")), "simhash-nodes")
        release(classes)
    else:
        nodes = nodes.select("fp", F.col("fp").alias("cls"))
    entries = _segments(nodes, "cls")
    tables = entries.groupBy("seg", "key", F.col("cls").alias("cls2")).agg(F.count("*").alias("n"), F.min("fp").alias("one"))
    flips = F.filter(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.col("key").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))), lambda k: k < F.col("key"))
    probes = entries.select("fp", "cls", "seg", F.col("key").alias("own"), F.explode(F.concat(F.array("key"), flips)).alias("key"))
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= max_bits
    met = probes.join(tables, ["seg", "key"]).where(F.when(F.col("own") == F.col("key"), F.col("cls") < F.col("cls2")).otherwise(F.col("cls") != F.col("cls2")) & ((F.col("n") > 1) | near("fp", "one")))
    if stars is None:
        return met.select(F.col("cls").alias("a"), F.col("cls2").alias("b")).distinct()
    met = materialize(met.select("fp", "cls", "cls2", "seg", "key", "n"), "simhash-met")
    alone = met.where("n = 1").select("cls", "cls2")
    inside = met.where("n > 1").join(entries.select("seg", "key", F.col("cls").alias("cls2"), F.col("fp").alias("fp2")), ["seg", "key", "cls2"]).where(near("fp", "fp2")).select("cls", "cls2")
    return alone.unionByName(inside).toDF("a", "b").distinct().unionByName(stars)


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, max_bits: int = 3, crowded: int = CROWDED) -> DataFrame:
    """(id, fp, component_id): one row per row of ``docs``; component_id is the smallest id that links reach.

    Null texts and texts without words have fingerprint zero and link like any other. A null id stays null and
    never names a component unless all ids of its component are null (then component_id is null). Repeated rows
    each get a row. Other columns of ``docs`` play no part, whatever their names. An empty table gives no rows.
    Exact copies collapse to one fingerprint (partial minimum before the shuffle), so a group of copies that
    holds a third of all rows costs one node.
    """
    with measured_joins(docs.sparkSession):
        marks = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, words=words, seed=seed), "simhash-fps")
        nodes = materialize(marks.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
        roots = components(links(nodes.select("fp"), max_bits=max_bits, crowded=crowded), "simhash-links")
        linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
        labels = materialize(linked.join(named, "root").select("fp", "component_id"), "simhash-labels")
        release(nodes, roots)
    return marks.join(labels.hint("merge"), "fp").select("id", "fp", "component_id")


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op6: doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
