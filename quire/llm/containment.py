"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialize, trimmed

#: Items searched in one pass over the documents; more are searched in several passes.
ITEMS = 20_000
#: MinHash functions. In the worst case (an item just above half its class's size, four fifths contained) a window
#: has a similarity of at least 0.25 to the item, and all 48 functions miss it with a chance of 1e-6.
PERMUTATIONS = 48
SHINGLE, THRESHOLD = 5, 0.8

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_TO_SPACE = bytes(32 if i < 128 and not chr(i).isalnum() else i for i in range(256))
_EMPTY = np.uint32(0xFFFFFFFF)
_SLICE = 1 << 20


def normal(text: str | None) -> bytes:
    """Lower case, with every ASCII character that is no letter or digit as a space."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE)


def shingles(words: list[bytes], k: int = SHINGLE) -> set[bytes]:
    """Distinct k-word shingles; of fewer words, the whole sequence; of none, nothing."""
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as many as the longest slice needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, _SLICE + (1 << 16))
            fill = lambda base: np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(n - 1, base, _U)]))
            self.up, self.down = fill(_U(_P)), fill(_U(pow(_P, -1, 1 << 64)))
        return self.up[:n], self.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    return h ^ (h >> _U(29))


def word_hashes(data: bytes, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of space-separated bytes; a word's hash depends on its bytes alone."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return np.empty(0, np.int64), np.empty(0, _U)
    up, down = powers.upto(len(a) + 1)
    blank = a <= 32
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    total = np.concatenate((np.zeros(1, _U), np.cumsum(up[: len(a)] * a.astype(_U))))
    return start, mix((total[end] - total[start]) * down[start])


def shingle_hashes(texts: list[bytes], powers: Powers, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its text) of the shingles of some texts in order; of fewer than k words, one of the whole sequence."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.cumsum(sizes) - sizes
    start, h = word_hashes(b" ".join(texts), powers)
    doc = np.searchsorted(begins, start, "right") - 1
    n = np.bincount(doc, minlength=len(texts))
    out = np.zeros(len(h), _U)
    for i in range(min(k, len(h))):
        out[: len(h) - i] = out[: len(h) - i] * _U(_P) + h[i:]
    last = np.cumsum(n)
    full = np.arange(len(h)) + k <= last[doc]
    short = np.flatnonzero((n > 0) & (n < k))
    keep, at = out[full], doc[full]
    if len(short):
        first = last[short] - n[short]
        whole = np.array([np.bitwise_xor.reduce(h[f : f + m] * np.arange(3, 3 + 2 * m, 2, dtype=_U)) for f, m in zip(first, n[short], strict=True)], _U) * (2 * n[short] + 1).astype(_U)
        keep, at = np.concatenate((keep, whole)), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        keep, at = keep[order], at[order]
    return mix(keep), at


class Sketch:
    """MinHash signatures of items, partitioned by size into classes of (u/2, u] shingles."""

    def __init__(self, ids: list[int], texts: list[str], permutations: int = PERMUTATIONS) -> None:
        self.ids, self.words = ids, [normal(t).split() for t in texts]
        self.sets = [shingles(w) for w in self.words]
        rng = np.random.default_rng(2016)
        self.multipliers = rng.integers(1 << 62, 1 << 63, permutations, dtype=np.uint64) | _U(1)
        powers, small, self.classes = Powers(), [], {}
        by_class: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, w in enumerate(self.words):
            if w:
                h = np.unique(shingle_hashes([b" ".join(w)], powers)[0])
                if len(h) <= 8:
                    small.append((i, h))
                else:
                    by_class.setdefault(1 << (len(h) - 1).bit_length(), []).append((i, h))
        # The smallest class has windows of one shingle, whose MinHash is the shingle.
        keys = np.concatenate([h for _, h in small]) if small else np.empty(0, _U)
        owner = np.concatenate([np.full(len(h), i) for i, h in small]) if small else np.empty(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.small = (keys[order], owner[order])
        for u, members in sorted(by_class.items()):
            values = np.array([[((h * m) >> _U(32)).astype(np.uint32).min() for m in self.multipliers] for _, h in members], np.uint32)
            owners = np.array([i for i, _ in members])
            tables = []
            for j in range(permutations):
                order = np.argsort(values[:, j], kind="stable")
                tables.append((values[order, j], owners[order]))
            self.classes[u] = tables
        self._filters()

    def _filters(self) -> None:
        """Bit tables of the keys' upper bits, so that few windows are looked up. Each worker makes its own; they are never sent."""
        self.bits = min(18, max(14, len(self.ids).bit_length() + 6))

        def there(keys: np.ndarray, width: int) -> np.ndarray:
            out = np.zeros(1 << self.bits, bool)
            out[(keys >> keys.dtype.type(width - self.bits)).astype(np.int64)] = True
            return out

        self.small_filter = there(self.small[0], 64)
        self.filters = {u: [there(keys, 32) for keys, _ in tables] for u, tables in self.classes.items()}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("small_filter", "filters")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._filters()

    @staticmethod
    def _meet(found: np.ndarray, at: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position, item) of values that equal a key; equal keys are adjacent, so all their owners follow."""
        a, b = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
        for x in np.flatnonzero(b > a):
            for o in owners[a[x] : b[x]]:
                yield int(at[x]), int(o)

    def candidates(self, h: np.ndarray, doc: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a MinHash in some window; h and doc as shingle_hashes gives them."""
        out: set[tuple[int, int]] = set()
        if len(self.small[0]):
            at = np.flatnonzero(self.small_filter[(h >> _U(64 - self.bits)).astype(np.int64)])
            out.update((int(doc[p]), o) for p, o in self._meet(h[at], at, *self.small))
        if not self.classes or not len(h):
            return out
        pad = -len(h) % 8
        for j, m in enumerate(self.multipliers):
            v = ((h * m) >> _U(32)).astype(np.uint32)
            v = np.concatenate((v, np.full(pad, _EMPTY))) if pad else v
            for _ in range(3):
                v = np.minimum(v[0::2], v[1::2])
            block = 8
            for u, tables in self.classes.items():
                while block < u // 2:
                    v = np.concatenate((v, [_EMPTY])) if len(v) % 2 else v
                    v, block = np.minimum(v[0::2], v[1::2]), 2 * block
                edge = np.concatenate((v, [_EMPTY, _EMPTY]))
                w = np.minimum(np.minimum(edge[:-2], edge[1:-1]), edge[2:])
                keys, owners = tables[j]
                at = np.flatnonzero(self.filters[u][j][w >> np.uint32(32 - self.bits)])
                for p, o in self._meet(w[at], at, keys, owners):
                    first, last = doc[min(p * block, len(h) - 1)], doc[min(p * block + 3 * block, len(h)) - 1]
                    out.update((int(d), o) for d in range(first, last + 1))
        return out

    def matches(self, texts: list[bytes], powers: Powers, threshold: float) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) with exact containment of at least the threshold."""
        h, doc = shingle_hashes(texts, powers)
        found, last, have = [], -1, set()
        for d, i in sorted(self.candidates(h, doc)):
            if d != last:
                last, have = d, shingles(texts[d].split())
            if (shared := len(self.sets[i] & have)) >= threshold * len(self.sets[i]) - 1e-9:
                found.append((d, i, shared))
        return found


def _slices(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about a megabyte, with the index of their first."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _SLICE:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def _sketches(benchmark: DataFrame, item_col: str, text_col: str, items: int, permutations: int) -> Iterator[object]:
    """Broadcast sketches of at most about ``items`` items each."""
    spark = benchmark.sparkSession
    source = benchmark.where(F.col(text_col).isNotNull() & F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    parts = -(-source.count() // items)
    for p in range(parts):
        rows = source.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p).orderBy("i", "t").collect() if parts > 1 else source.orderBy("i", "t").collect()
        yield spark.sparkContext.broadcast(Sketch([r["i"] for r in rows], [r["t"] for r in rows], permutations))


def contained_items(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, items: int = ITEMS, permutations: int = PERMUTATIONS) -> DataFrame:
    """(id, item_id, n_shingles, n_shared, containment): items of which a document holds at least ``threshold`` of the five-word shingles.

    Items are partitioned by their number of shingles; for each class, windows of one and a half times its size
    slide over the whole document in steps of half its size, so a passage of an item's length lies in one of them.
    A window and an item that share one of the MinHash values are a candidate, which the exact shingle sets decide.
    Case and ASCII punctuation play no part. Texts of fewer than five words have one shingle, the whole sequence.
    Null or wordless texts and items match nothing, null item ids are left out, null document ids stay; repeated
    documents and items each give rows. The items are broadcast ``items`` at a time, one pass over the documents for
    each such block; documents are never shuffled and empty tables give no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, item_id long, n_shingles long, n_shared long, containment double"
    passes = []
    for sketch in _sketches(benchmark, item_col, item_text_col, items, permutations):

        def run(batches: Iterator[pa.RecordBatch], sketch=sketch) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            powers, known = Powers(), sketch.value
            for b in batches:
                rows: list[tuple] = []
                ids = b.column(0).to_pylist()
                for at, texts in _slices([normal(t.as_py()) for t in b.column(1)]):
                    for d, i, shared in known.matches(texts, powers, threshold):
                        n = len(known.sets[i])
                        rows.append((ids[at + d], known.ids[i], n, shared, shared / n))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names=["id", "item_id", "n_shingles", "n_shared", "containment"])

        passes.append(source.mapInArrow(trimmed(run), schema))
    if not passes:
        return docs.sparkSession.createDataFrame([], schema)
    if len(passes) > 1:
        passes = [materialize(p, "containment") for p in passes]
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, items: int = ITEMS, permutations: int = PERMUTATIONS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item (as ``contained_items`` finds them); columns stay as they are, and no row is shuffled."""
    for sketch in _sketches(benchmark, item_col, item_text_col, items, permutations):

        def run(batches: Iterator[pa.RecordBatch], sketch=sketch) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            powers, known = Powers(), sketch.value
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for at, texts in _slices([normal(t.as_py()) for t in b.column(b.schema.get_field_index(text_col))]):
                    keep[[at + d for d, _, _ in known.matches(texts, powers, threshold)]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(trimmed(run), docs.schema)
    return docs


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op8: doc_id, item_id and containment of every benchmark item that a document holds."""
    found = contained_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumnRenamed("id", "doc_id")


#: The same pairs by exact shingle sets, without the search. Words are what remains of lower-cased text between
#: white space and ASCII signs.
SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x00-/:-@\[-`{-\x7f]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x00-/:-@\[-`{-\x7f]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_shared, CAST(n_shared AS DOUBLE) / n_shingles AS containment FROM m JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9
"""
