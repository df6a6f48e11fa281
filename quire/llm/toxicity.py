"""Toxicity scores by weak supervision: mined voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quire.llm.common import fold, held_out, materialize
from quire.llm.sampling import labelled_ids, rate, texts_of

#: Labelled rows of each class that are learned from at most.
PER_CLASS = 5000
#: A lexicon entry occurs in so many toxic training texts at least, and so much oftener in toxic than in clean ones;
#: its evidence (the log of how unlikely its share of toxic texts is by chance) outweighs the number of entries tried.
LEAST, LIFT, EVIDENCE = 3, 8.0, 10.5
#: Toxic training texts whose signatures agree in this share are copies, of which one is mined.
SIGNATURE, SAME = 32, 0.5
#: Lexicons of words, and as many of beginnings, to which the entries are dealt.
LEXICONS = 4
#: Patterns that vote without any label: shouting, runs of marks, disguised spellings, a threat or insult to "you".
PATTERNS = (
    r"(?:\b[A-Z]{4,}\b\W+){3}",
    r"[!?]{3,}",
    r"\b[A-Za-z]+[*@#$]+[A-Za-z]+\b|\b[A-Za-z]+[013457][A-Za-z]+[013457]?[A-Za-z]*\b",
    r"(?i)\b(?:kill|hurt|hate|die|shut up)\b[^.!?]{0,20}\b(?:you|yourself)\b|\byou\b[^.!?]{0,12}\b(?:idiot|moron|stupid|dumb|trash|scum|loser)\b",
)
PREFIXES = (3, 4, 5)
_EDGE = "".join(chr(i) for i in range(128) if not chr(i).isalnum()) + "«»„“”‘’¿¡…–—"


def features(text: str | None) -> set[str]:
    """Distinct lower-cased words of a whole text, and their beginnings (marked by a hyphen)."""
    words = {w.strip(_EDGE) for w in set((text or "").lower().split())}
    words.discard("")
    return words.union(*({w[:k] + "-" for w in words if len(w) > k} for k in PREFIXES))


def _lookup(text: str | None, lexicon: dict[str, int]) -> list[int]:
    """The lexicon entries of a whole text."""
    out = set()
    for w in set((text or "").lower().split()):
        w = w.strip(_EDGE)
        if w in lexicon:
            out.add(lexicon[w])
        for k in PREFIXES:
            if len(w) > k and (p := w[:k] + "-") in lexicon:
                out.add(lexicon[p])
    return sorted(out)


def distinct_ids(toxic: DataFrame) -> list[int]:
    """Ids of a bounded sample's texts without near copies: MinHash signatures of their words, each compared with those kept so far."""
    rng = np.random.default_rng(7)
    odd = rng.integers(1 << 62, 1 << 63, SIGNATURE, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for t in b.column(1):
                h = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in set((t.as_py() or "").lower().split())] or [0], np.uint64)
                made.append((((h[:, None] + np.uint64(1)) * odd) >> np.uint64(33)).min(axis=0).astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.list_(pa.int64()))], names=["id", "signature"])

    rows = sorted(toxic.mapInArrow(run, "id long, signature array<long>").collect(), key=lambda r: (r["id"], r["signature"]))
    kept, ids = np.empty((len(rows), SIGNATURE), np.int64), []
    for r in rows:
        mine = np.array(r["signature"])
        if not len(ids) or (kept[: len(ids)] == mine).mean(axis=1).max() < SAME:
            kept[len(ids)] = mine
            ids.append(r["id"])
    return ids


_VOICES = [re.compile(p) for p in PATTERNS]


def patterns(text: str | None) -> int:
    """Which patterns a whole text holds, as bits."""
    return sum(1 << i for i, p in enumerate(_VOICES) if text and p.search(text))


def mine(sample: DataFrame, per_class: dict[int, int]) -> list[str]:
    """All entries typical enough of toxic texts of the sample, by document frequency summed over partitions; the sample bounds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, y in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                counts[y].update(features(text.as_py()))
        toxic = counts[1]
        names = list(toxic) + [w for w in counts[0] if w not in toxic]
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([toxic[w] for w in part], pa.int64()), pa.array([counts[0][w] for w in part], pa.int64())], names=["entry", "toxic", "clean"])

    found = sample.mapInArrow(run, "entry string, toxic long, clean long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lift = (F.col("toxic") / max(1, per_class[1])) / ((F.col("clean") + 0.5) / max(1, per_class[0]))
    share = per_class[1] / max(1, per_class[1] + per_class[0])
    t, c = F.col("toxic"), F.col("clean")
    evidence = t * F.log(t / (t + c) / share) + F.when(c > 0, c * F.log(c / (t + c) / max(1e-9, 1 - share))).otherwise(0)
    return [r["entry"] for r in found.where((t >= LEAST) & (lift >= LIFT) & (evidence >= EVIDENCE)).orderBy(F.desc("toxic"), "entry").collect()]


class LabelModel:
    """A generative model of voters (1 toxic, -1 clean, 0 no vote) given the unseen label.

    Expectation maximisation gives each voter's chances of each vote by label (so its accuracy). Voters that nearly
    repeat one another share one weight from the start, else they would pass for the label; the votes' remaining
    correlations given the label discount the others, and a second run uses these weights.
    """

    def __init__(self, prior: float, rounds: int = 25) -> None:
        self.prior, self.rounds = min(max(prior, 0.01), 0.99), rounds

    def _run(self, votes: np.ndarray, counts: np.ndarray, q: np.ndarray, weight: np.ndarray) -> np.ndarray:
        onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
        for _ in range(self.rounds):
            chances = []
            for p in (1 - q, q):
                seen = np.einsum("n,nmv->mv", p * counts, onehot) + np.array([0.1, 0.2, 0.1])
                chances.append(seen / seen.sum(axis=1, keepdims=True))
            self.chances = np.array(chances)
            ratio = np.log(self.chances[1]) - np.log(self.chances[0])
            logit = np.log(self.prior / (1 - self.prior)) + np.einsum("nmv,mv->n", onehot, ratio * weight[:, None])
            q = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return q

    def fit(self, votes: np.ndarray, counts: np.ndarray | None = None, start: np.ndarray | None = None) -> np.ndarray:
        """Posterior chances of label 1 of rows of votes that occur so many times each."""
        n, m = votes.shape
        if not n or not m:
            return np.full(n, self.prior)
        counts = np.ones(n) if counts is None else counts
        start = np.where(votes.sum(axis=1) > 0, 0.9, 0.05 * np.ones(n)) if start is None else start
        centred = votes - np.average(votes, axis=0, weights=counts)
        norm = np.sqrt(np.maximum((centred**2 * counts[:, None]).sum(axis=0), 1e-9))
        alike = np.abs((centred * counts[:, None]).T @ centred / np.outer(norm, norm))
        alike = np.where(alike > 0.9, alike, 0)
        np.fill_diagonal(alike, 1)
        self.weights = 1 / alike.sum(axis=1)
        q = self._run(votes, counts, start, self.weights)
        rest = np.zeros((m, m))
        for y, p in enumerate((1 - q, q)):
            centred = votes - (self.chances[y] @ np.array([-1, 0, 1.0]))
            rest += (centred * (p * counts)[:, None]).T @ centred
        scale = np.sqrt(np.maximum(np.diag(rest), 1e-9))
        self.correlations = rest / np.outer(scale, scale)
        linked = np.where(np.abs(self.correlations) > 0.2, np.abs(self.correlations), 0)
        np.fill_diagonal(linked, 1)
        self.weights = 1 / linked.sum(axis=1)
        return self._run(votes, counts, q, self.weights)


#: Voters: the lexicons, density, two for clean, the patterns. Each votes one way or not at all, so there are 2**VOTERS patterns of votes at most.
VOTERS = 2 * LEXICONS + 3 + len(PATTERNS)


def ballot(found: list[int], marks: int, lexicon_of: list[int]) -> int:
    """The votes of one text as bits. ``lexicon_of`` has each entry's lexicon, words first and then beginnings."""
    out = 0
    for i in found:
        out |= 1 << lexicon_of[i]
    words = out & ((1 << LEXICONS) - 1)
    return out | (len(found) >= 3) << 2 * LEXICONS | (not words) << 2 * LEXICONS + 1 | (out == words) << 2 * LEXICONS + 2 | marks << 2 * LEXICONS + 3


def lexicons(entries: list[str]) -> list[int]:
    """Each entry's lexicon: words and beginnings are dealt in turn, the most frequent first."""
    turn, out = [0, 0], []
    for w in entries:
        kind = w.endswith("-")
        out.append(kind * LEXICONS + turn[kind] % LEXICONS)
        turn[kind] += 1
    return out


def unpack(ballots: np.ndarray) -> np.ndarray:
    """Votes by ballot and voter: 1 for toxic, -1 of the two voters for clean, 0 for none."""
    votes = (ballots[:, None] >> np.arange(VOTERS) & 1).astype(np.int8)
    votes[:, 2 * LEXICONS + 1 : 2 * LEXICONS + 3] *= -1
    return votes


@dataclass
class Model:
    lexicon: dict[str, int]
    weights: np.ndarray
    dense: float
    bias: float

    def score(self, found: list[int]) -> float:
        logit = self.bias + float(self.weights[found].sum()) + self.dense * np.log1p(len(found))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def _linear(hits: list[list[int]], q: np.ndarray, width: int, rounds: int = 200, decay: float = 1e-4) -> tuple[np.ndarray, float, float]:
    """Logistic regression on soft labels: entry weights, weight of the number of entries, bias (Adam, full batches)."""
    n = len(hits)
    row = np.repeat(np.arange(n), [len(f) for f in hits])
    col = np.array([i for f in hits for i in f], np.int64)
    dense = np.log1p(np.array([len(f) for f in hits], float))
    w, m, v = (np.zeros(width + 2) for _ in range(3))
    for t in range(1, rounds + 1):
        logit = np.bincount(row, w[col], n) + dense * w[width] + w[width + 1]
        r = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - q) / n
        g = np.concatenate((np.bincount(col, r[row], width), [r @ dense, r.sum()])) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[:width], float(w[width]), float(w[width + 1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """A model of documents outside fold 0.

    Labels choose the lexicons only (from at most ``per_class`` rows of each label) and give the rate of label 1. The
    label model sees the votes of all documents outside fold 0, as counts of their patterns. The classifier learns its
    posteriors on the bounded labelled sample. Without labelled rows there are no lexicons and every score is the
    prior's (one tenth).
    """
    ids = materialize(labelled_ids(labels, label_col, per_class), "toxicity-ids")
    n = {y: c for y, c in ids.groupBy("label").count().collect()}
    entries: list[str] = []
    if n.get(1):
        single = distinct_ids(texts_of(docs, ids.where("label = 1"), id_col=id_col, text_col=text_col))
        if single:
            base = ids.where("label = 0").unionByName(docs.sparkSession.createDataFrame([(i, 1) for i in sorted(set(single))], "id long, label int"))
            entries = mine(texts_of(docs, base, id_col=id_col, text_col=text_col), {0: n.get(0, 0), 1: len(set(single))})
    prior = rate(labels, label_col) or 0.1
    if not entries:
        return Model({}, np.empty(0), 0.0, float(np.log(prior / (1 - prior))))
    index, lexicon_of = {w: i for i, w in enumerate(entries)}, lexicons(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_lookup(t.as_py(), index) for t in b.column(1)]
            votes = [ballot(f, patterns(t.as_py()), lexicon_of) for f, t in zip(found, b.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32())), pa.array(votes, pa.int32())], names=["id", "hits", "votes"])

    schema = "id long, hits array<int>, votes int"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = source.where((fold("id") != 0) & F.col("id").isNotNull()).mapInArrow(run, schema).groupBy("votes").count().collect()
    ballots, counts = np.array([r["votes"] for r in counted], np.int64), np.array([r["count"] for r in counted], float)
    order = np.argsort(ballots)
    ballots, counts = ballots[order], counts[order]
    lexical = unpack(ballots)[:, : 2 * LEXICONS + 3]
    posterior = LabelModel(prior).fit(unpack(ballots), counts, np.where(lexical.sum(axis=1) > 0, 0.9, 0.05))
    told = dict(zip(ballots.tolist(), posterior.tolist(), strict=True))
    rows = sorted(texts_of(docs, ids.select("id"), id_col=id_col, text_col=text_col).select("id", "text").mapInArrow(run, schema).collect(), key=lambda r: (r["id"], r["hits"]))
    return Model(index, *_linear([list(r["hits"]) for r in rows], np.array([told[r["votes"]] for r in rows]), len(entries)))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", output: str = "toxicity") -> DataFrame:
    """``docs`` with a score column, in one pass without a shuffle; the bounded model is broadcast.

    Null and empty texts have no entries and get the bias's score. All rows and columns stay; a column already
    named ``output`` is replaced.
    """
    docs = docs.drop(output)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            made = [model.score(_lookup(t.as_py(), model.lexicon)) for t in b.column(b.schema.get_field_index(text_col))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.float64())], names=[*b.schema.names, output])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(output, DoubleType())]))


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op4: doc_id, held_out, score, predicted of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    made = score(docs.select("doc_id", "text"), model, output="score")
    return made.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
