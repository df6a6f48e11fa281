"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quire.llm.common import held_out, trimmed
from quire.llm.containment import _TO_SPACE, Powers, word_hashes
from quire.llm.sampling import labelled_ids, rate, texts_of

#: Labelled rows of each class that are broadcast at most, latent dimensions, and neighbours that vote.
PER_CLASS, DIMENSIONS, NEIGHBOURS = 2048, 32, 8
#: Similarities count by this power, so near neighbours outweigh far ones.
SHARPNESS = 8
_ROWS = 512


def _classes() -> tuple[np.ndarray, int]:
    """A class for each byte: lower letters (with all beyond ASCII), capitals, digits, line ends, other controls; signs stand for themselves."""
    table, names = np.zeros(256, np.uint8), {}
    for b in range(256):
        c = chr(b)
        kind = "a" if b >= 128 or c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "\n" if c == "\n" else c if b >= 32 else "control"
        table[b] = names.setdefault(kind, len(names))
    return table, len(names)


_CLASS, _N = _classes()
#: Word terms: lower-cased words, hashed to so many.
WORDS = 1 << 11
SHAPE = _N * _N + 2
WIDTH = SHAPE + WORDS
#: How much the cosine of the words counts against that of the shape.
WORD_SHARE = 0.25
_POWERS = Powers()


def terms(text: str | None) -> np.ndarray:
    """Term counts of a whole text: pairs of neighbouring character classes, words equal to the word before, words seen before; then hashed words."""
    out = np.zeros(WIDTH, np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    codes = _CLASS[np.frombuffer(data, np.uint8)]
    if len(codes) > 1:
        out[: _N * _N] = np.bincount(codes[:-1].astype(np.int32) * _N + codes[1:], minlength=_N * _N)
    words = (text or "").split()
    out[SHAPE - 2], out[SHAPE - 1] = sum(map(eq, words, words[1:])), len(words) - len(set(words))
    _, h = word_hashes(data.lower().translate(_TO_SPACE), _POWERS)
    out[SHAPE:] = np.bincount((h >> np.uint64(53)).astype(np.int64), minlength=WORDS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _axes(rows: np.ndarray, dimensions: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    basis = np.random.default_rng(11).standard_normal((rows.shape[1], dimensions + 16)).astype(np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turn.T)[:, :dimensions])


@dataclass
class Model:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        """Square roots of the counts by inverse document frequency: unit vectors of the shape and of the words side by side."""
        scaled = np.sqrt(counts) * self.weights
        return np.concatenate((_unit(scaled[:, :SHAPE]) * (1 - WORD_SHARE) ** 0.5, _unit(scaled[:, SHAPE:]) * WORD_SHARE**0.5), axis=1)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(self.weighted(counts) @ self.axes)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted vote of the nearest labelled vectors by exact cosine; all that tie with the last of them vote too. The prior where a row has no terms or no similar neighbour."""
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        cosine = np.maximum(self.latent(counts) @ self.vectors.T, 0)
        k = min(self.neighbours, cosine.shape[1])
        last = np.partition(cosine, -k, axis=1)[:, -k, None]
        weight = np.where(cosine >= last, cosine, 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = weight @ self.labels / np.maximum(total, 1e-12)
        return np.clip(np.where((counts.sum(axis=1) > 0) & (total > 1e-9), vote, self.prior), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> Model:
    """A model from at most ``per_class`` labelled rows of each class outside fold 0.

    Only their term counts reach the driver. Without labelled rows every score is one half.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [terms(t.as_py()) for t in b.column(1)]
            sparse = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([s.tolist() for s in sparse], pa.list_(pa.int32())), pa.array([r[s].tolist() for r, s in zip(rows, sparse, strict=True)], pa.list_(pa.float32()))], names=["id", "label", "at", "n"])

    sample = texts_of(docs, labelled_ids(labels, label_col, per_class), id_col=id_col, text_col=text_col)
    rows = sample.mapInArrow(trimmed(run), "id long, label int, at array<int>, n array<float>").toArrow().combine_chunks()
    share = rate(labels, label_col)
    if not len(rows):
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.empty((0, 1), np.float32), np.empty(0), 0.5 if share is None else share, neighbours)
    # Rows come in any order; sums of them are taken in one.
    rows = rows.take(pa.array(np.lexsort((pc.list_value_length(rows.column("at")).to_numpy(), rows.column("id").to_numpy()))))
    at, n = rows.column("at").combine_chunks(), rows.column("n").combine_chunks()
    sizes = pc.list_value_length(at).to_numpy(zero_copy_only=False)
    counts = np.zeros((len(rows), WIDTH), np.float32)
    counts[np.repeat(np.arange(len(rows)), sizes), at.flatten().to_numpy()] = n.flatten().to_numpy()
    y = rows.column("label").to_numpy().astype(np.float64)
    weights = (np.log((1 + len(y)) / (1 + np.count_nonzero(counts, axis=0))) + 0.1).astype(np.float32)
    model = Model(weights, np.empty((0, 0), np.float32), np.empty((0, 1)), y, float(share), neighbours)
    for i in range(0, len(y), _ROWS):
        counts[i : i + _ROWS] = model.weighted(counts[i : i + _ROWS])
    model.axes = _axes(counts, dimensions)
    model.vectors = np.ascontiguousarray(_unit(counts @ model.axes))
    return model


def score(docs: DataFrame, model: Model, *, text_col: str = "text", output: str = "quality_score") -> DataFrame:
    """``docs`` with a score column, in one pass without a shuffle; the bounded model is broadcast.

    Null and empty texts get the model's prior. All rows and columns stay; a column already named ``output`` is replaced.
    """
    docs = docs.drop(output)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, made = b.column(b.schema.get_field_index(text_col)), np.zeros(b.num_rows)
            for at in range(0, b.num_rows, _ROWS):
                made[at : at + _ROWS] = shared.value.scores(np.array([terms(t.as_py()) for t in texts[at : at + _ROWS]]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made)], names=[*b.schema.names, output])

    return docs.mapInArrow(trimmed(run), StructType([*docs.schema.fields, StructField(output, DoubleType())]))


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op7: doc_id, held_out, score, predicted of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    made = score(docs.select("doc_id", "text"), model, output="score")
    return made.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
