"""Components of texts with a Jaccard similarity of word shingles: candidates by MinHash bands, decided by the exact sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import simhash
from quire.llm.common import materialize, measured_joins, release, trimmed
from quire.llm.components import components
from quire.llm.containment import Powers, mix, shingle_hashes

SHINGLE, THRESHOLD = 5, 0.8
#: Two texts of similarity s share no band with a chance of (1 - s**ROWS) ** BANDS: 8e-6 at 0.8, 2e-9 at 0.85.
ROWS, BANDS = 8, 64
#: PLANES bits of each MinHash; two texts of similarity s disagree in (1 - s) (1 - 2**-PLANES) of the MinHashes. Candidates
#: that disagree in more than DEVIATIONS standard deviations above what the threshold allows are not compared further.
HASHES, PLANES, DEVIATIONS = ROWS * BANDS, 4, 5
#: Mixed buckets of more texts than this are first compared with one text each, at most PIVOTS times; what is still mixed is compared in full.
CROWDED, PIVOTS = 64, 3

_U = np.uint64
_BLOCK = 1 << 11


def _set(text: str | None, powers: Powers, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; of fewer words, one of them all; of none, nothing."""
    return np.unique(shingle_hashes([" ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")], powers, words)[0])


def _bands(h: np.ndarray, multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's band keys, and some bits of each of its MinHashes, plane by plane."""
    if not len(h):
        return np.empty(0, np.int64), np.zeros(PLANES * HASHES // 64, np.int64)
    least = np.full(len(multipliers), ~_U(0))
    for at in range(0, len(h), _BLOCK):
        least = np.minimum(least, (multipliers[:, None] * h[None, at : at + _BLOCK]).min(axis=1))
    out = np.arange(1, BANDS + 1, dtype=_U)
    for column in least.reshape(BANDS, ROWS).T:
        out = mix(out * _U(0x9E3779B97F4A7C15) + column)
    planes = (mix(least)[None, :] >> np.arange(PLANES, dtype=_U)[:, None]) & _U(1)
    return out.view(np.int64), np.packbits(planes.astype(bool).ravel()).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small parts of batches, so that few texts' shingles are held at a time."""
    for b in batches:
        yield from (b.slice(at, rows) for at in range(0, b.num_rows, rows))


def _marks(source: DataFrame, words: int) -> DataFrame:
    """(id, key, node, n, fp, bits, bands) per row; key is the text's hash and node its node, 0 for all texts without words; fp is its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, multipliers = Powers(), np.random.default_rng(2014).integers(1 << 62, 1 << 63, ROWS * BANDS, dtype=np.uint64) | _U(1)
        for b in _slices(batches):
            texts = b.column(2).to_numpy(zero_copy_only=False).tolist()
            sets = [_set(t, powers, words) for t in texts]
            marks = np.fromiter((simhash.fingerprint(t, words) for t in texts), np.uint64, b.num_rows).view(np.int64)
            nodes = [v if len(s) else 0 for v, s in zip(b.column(1).to_pylist(), sets, strict=True)]
            bands, bits = (pa.array(x, pa.list_(pa.int64())) for x in zip(*(_bands(s, multipliers) for s in sets), strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(list(map(len, sets)), pa.int32()), pa.array(marks), bits, bands], names=["id", "key", "node", "n", "fp", "bits", "bands"])

    return source.mapInArrow(trimmed(run), "id long, key long, node long, n int, fp long, bits array<long>, bands array<long>")


def _sets(source: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the needed nodes. Only their texts are shuffled, and copies collapse before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for b in _slices(batches):
            sets = [_set(t.as_py(), powers, words).view(np.int64) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    texts = source.join(needed, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    return texts.mapInArrow(trimmed(run), "node long, shingles array<long>")


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets have the similarity."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(both / (F.size("sa") + F.size("sb") - both) >= threshold).select("a", "b")


def _hashed(nodes: DataFrame) -> DataFrame:
    """Candidates (a, b) of operator 6: texts of one SimHash fingerprint, and of fingerprints that its multi-index hashing links."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    same = nodes.join(first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = simhash.links(first.select("fp")).select(F.col("a").alias("fa"), F.col("b").alias("fb"))
    name = lambda fp, c: first.select(F.col("fp").alias(fp), F.col("first").alias(c))
    linked = near.join(name("fa", "a"), "fa").join(name("fb", "b"), "fb").select("a", "b")
    return same.unionByName(linked).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(source: DataFrame, nodes: DataFrame, *, words: int, threshold: float, crowded: int, pivots: int) -> DataFrame | None:
    """Links (a, b) that connect exactly the texts that chains of similar candidates connect; None where there is no candidate.

    ``nodes`` has (node, n, fp, bits, bands). SimHash links come first, since they bring most light copies together.
    Then texts that share a band are candidates. Pairs inside one class of linked texts are not enumerated: while mixed
    buckets are crowded, each is compared with one text only (that with most company over all buckets, which then
    leaves it), and classes are formed anew. Then pairs whose bits are as near as the threshold's are compared, and
    last all others between different classes. A pair meets in the first band that it shares and in no other.
    """
    entries = nodes.select("node", F.explode("bands").alias("key"))
    shared = materialize(entries.join(entries.groupBy("key").count().where("count > 1"), "key", "left_semi"), "near-shared")
    seeds = materialize(_hashed(nodes), "near-seeds")
    if shared.isEmpty() and seeds.isEmpty():
        release(shared, seeds)
        return None
    needed = materialize(shared.select("node").unionByName(seeds.select(F.col("a").alias("node"))).unionByName(seeds.select(F.col("b").alias("node"))).distinct(), "near-needed")
    sets = materialize(_sets(source, needed, words), "near-sets")
    known = materialize(nodes.join(needed, "node", "left_semi").select("node", "n", "bits", F.transform("bands", _digest).alias("digests")), "near-known")
    longs = HASHES // 64
    planes = lambda i, n: reduce(lambda x, y: x.bitwiseOR(y), [F.col("bits")[k * longs + i].bitwiseXOR(F.col("bits2")[k * longs + i]) for k in range(n)])
    differ = sum(F.bit_count(planes(i, PLANES)) for i in range(longs))
    p = (1 - threshold) * (1 - 2.0**-PLANES)
    above = lambda x: HASHES * x + DEVIATIONS * (HASHES * x * (1 - x)) ** 0.5
    near, far = HASHES * p, above(p)
    # The first plane alone, held to its own bound, spares most pairs the others.
    rough = sum(F.bit_count(planes(i, 1)) for i in range(longs)) <= above((1 - threshold) / 2)
    fits = (F.least("n", "n2") >= F.lit(threshold) * F.greatest("n", "n2") - 1e-6) & rough
    sides = known.select(F.col("node").alias("a"), "n", "bits"), known.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))
    parts = [materialize(_similar(seeds, sets, threshold), "near-first")]
    release(seeds, needed)
    weights = shared.join(shared.groupBy("key").agg(F.count("*").alias("members")), "key").groupBy("node").agg(F.sum("members").alias("w"))
    left = _classed(shared.join(weights, "node"), parts, shared)
    for _ in range(pivots):
        mixed = left.groupBy("key").agg(F.count("*").alias("members"), F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.max(F.struct("w", "node", "cls")).alias("p")).where("lo < hi")
        mixed = materialize(mixed.select("key", "members", F.col("p.node").alias("node2"), F.col("p.cls").alias("cls2")), "near-mixed")
        big = mixed.where(F.col("members") > crowded)
        if big.isEmpty():
            release(mixed)
            break
        pairs = left.join(big, "key").where("node <> node2 and cls <> cls2").select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
        pairs = pairs.join(sides[0], "a").join(sides[1], "b").where(fits & (differ <= far)).select("a", "b")
        more = materialize(_similar(pairs, sets, threshold), "near-pivots")
        rest = left.join(mixed.select("key", "node2", "members"), "key").where((F.col("node") != F.col("node2")) | (F.col("members") <= crowded)).select("key", "node", "w", "cls")
        parts.append(more)
        left = _classed(rest, [] if more.isEmpty() else parts, left, mixed)
    earlier = lambda i: (i < F.lit(BANDS)) & F.exists(F.zip_with(F.slice("digests", 1, i), F.slice("digests2", 1, i), lambda x, y: x == y), lambda x: x)
    for least, most in ((-1, near), (near, far)):
        mixed = left.join(left.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi"), "key", "left_semi").join(known, "node")
        mixed = mixed.select("key", "node", "cls", "n", "bits", "digests", (F.array_position("digests", _digest(F.col("key"))) - 1).cast("int").alias("band"))
        other = mixed.select("key", *[F.col(c).alias(f"{c}2") for c in mixed.columns if c != "key"])
        pairs = mixed.join(other, "key").where("node < node2 and cls <> cls2").where(fits & ((differ <= most) if least < 0 else (differ <= most) & (differ > least)) & ~earlier(F.col("band"))).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
        parts.append(materialize(_similar(pairs, sets, threshold), "near-links"))
        left = _classed(left, parts, left) if most == near else left
    found = materialize(_all(parts), "near-found")
    release(left, sets, known, *parts)
    return found


def _digest(key: Column) -> Column:
    """31 bits of a band key."""
    return F.shiftright(key, 33).cast("int")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _classed(left: DataFrame, parts: list[DataFrame], *old: DataFrame) -> DataFrame:
    """``left`` with the classes that the links found so far make (as it is, without links), written; ``old`` tables go then."""
    if not parts:
        made = materialize(left, "near-left")
    else:
        roots = components(_all(parts), "near-classes")
        made = materialize(left.select("key", "node", "w").join(roots, "node", "left").select("key", "node", "w", F.coalesce("root", "node").alias("cls")), "near-left")
        release(roots)
    release(*old)
    return made


def near_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, threshold: float = THRESHOLD, crowded: int = CROWDED, pivots: int = PIVOTS) -> DataFrame:
    """(id, key, component_id, first): one row per row of ``docs``; component_id is the smallest id that chains of similar texts reach.

    ``key`` is the text's xxhash64, and ``first`` is true where (id, key) is the least of its component, null ids last:
    so each component has one such pair, held by one row or by repeats of one row.
    Words are separated by white space, case plays no part. Null texts and texts without words are copies of one
    another. A null id stays null and never names a component unless all ids of its component are null. Repeated
    rows each get a row. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).select("id", F.xxhash64("text").alias("node"), "text")
    own = F.struct(F.col("id").isNull().alias("absent"), F.coalesce("id", F.lit(0)).alias("id"), F.col("key").alias("key"))
    with measured_joins(docs.sparkSession):
        marks = materialize(_marks(source, words), "near-marks")
        nodes = materialize(marks.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bits").alias("bits"), F.first("bands").alias("bands"), F.min(own).alias("least")), "near-nodes")
        rows = materialize(marks.select("id", "key", "node"), "near-rows")
        release(marks)
        made = links(source.select("node", "text"), nodes.where("n > 0"), words=words, threshold=threshold, crowded=crowded, pivots=pivots)
        if made is None:
            linked = nodes.select("node", "least", F.col("node").alias("root"))
        else:
            roots = components(made, "near-components")
            release(made)
            linked = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
        linked = materialize(linked, "near-linked")
        release(nodes, *([] if made is None else [roots]))
        labels = materialize(linked.join(linked.groupBy("root").agg(F.min("least").alias("lead")), "root").select("node", "lead"), "near-labels")
        release(linked)
    return rows.join(labels.hint("merge"), "node").select("id", "key", F.when(~F.col("lead.absent"), F.col("lead.id")).alias("component_id"), (own == F.col("lead")).alias("first"))
