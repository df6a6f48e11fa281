import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import containment, quality, secrets, toxicity
from quire.llm.common import crc_fold
from test_nearcopies import brute_components


def parts(spark, name, sf="sf0.01"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


def area(scores, truth):
    """The chance that a row of label 1 scores above one of label 0, ties by half."""
    one, zero = scores[truth == 1][:, None], scores[truth == 0][None, :]
    return ((one > zero) + 0.5 * (one == zero)).mean()


# With the 40 toxic training rows of sf0.01 only the commonest language has entries of enough evidence.
@pytest.mark.parametrize(("module", "label", "sf", "least", "recall", "curve"), [(quality, "quality", "sf0.01", 0.95, 0.9, 0.97), (toxicity, "toxic", "sf0.01", 0.9, 0.6, 0.8), (toxicity, "toxic", "sf0.1", 0.95, 0.9, 0.95)])
def test_held_out_accuracy(spark, module, label, sf, least, recall, curve):
    rows = module.query(spark, f"/root/testdata/{sf}").collect()
    labels = {r["doc_id"]: r[label] for r in parts(spark, "labels", sf).collect()}
    assert len(rows) == parts(spark, "documents", sf).count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (crc_fold(r["doc_id"]) == 0) and 0 <= r["score"] <= 1 for r in rows)
    truth, told, scores = np.array([labels[r["doc_id"]] for r in held]), np.array([r["predicted"] for r in held]), np.array([r["score"] for r in held])
    assert (told == truth).mean() >= least and told[truth == 1].mean() >= recall and area(scores, truth) >= curve


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_scores_do_not_depend_on_partitions(spark, module, label):
    docs, labels = parts(spark, "documents", "sf0.001"), parts(spark, "labels", "sf0.001")
    some = [{r["doc_id"]: r["score"] for r in module.score(d, module.fit(d, labels), output="score").collect()} for d in (docs, docs.repartition(7, "text"))]
    assert some[0].keys() == some[1].keys() and all(abs(some[0][i] - some[1][i]) < 1e-4 for i in some[0])


def test_neighbours_that_tie_all_vote():
    counts = np.array([quality.terms(t) for t in ("aa bb cc", "aa bb cc", "aa bb cc", "12 !! ??")])
    model = quality.Model(np.ones(quality.WIDTH, np.float32), np.eye(quality.WIDTH, dtype=np.float32), np.empty((0, 1)), np.array([1.0, 0.0, 0.0, 1.0]), 0.5, 2)
    model.vectors = model.latent(counts)
    assert model.scores(counts[:1])[0] == pytest.approx(1 / 3)
    assert model.scores(np.zeros((1, quality.WIDTH), np.float32))[0] == 0.5


def test_quality_scores_against_brute_force(spark):
    docs, labels = parts(spark, "documents", "sf0.001"), parts(spark, "labels", "sf0.001")
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, model).collect()}
    for r in docs.collect():
        x = model.latent(quality.terms(r["text"])[None])[0]
        near = sorted(((max(float(x @ v), 0.0), y) for v, y in zip(model.vectors, model.labels, strict=True)), reverse=True)
        near = [n for n in near if n[0] >= near[min(model.neighbours, len(near)) - 1][0] - 1e-7]
        total = sum(c**quality.SHARPNESS for c, _ in near)
        want = sum(c**quality.SHARPNESS * y for c, y in near) / total if r["text"] and total > 1e-9 else model.prior
        assert got[r["doc_id"]] == pytest.approx(want, abs=1e-3)


def test_ballots_are_bounded_and_patterns_vote():
    kinds = toxicity.lexicons(["a", "b-", "c", "d", "e", "f", "g-"])
    assert kinds == [0, 4, 1, 2, 3, 0, 5]
    made = toxicity.ballot([0, 1, 5], toxicity.patterns("STOP THAT NOISE NOW!!! you are an idiot"), kinds)
    votes = toxicity.unpack(np.array([made, toxicity.ballot([], 0, kinds)]))
    assert made < 1 << toxicity.VOTERS and votes[0].tolist() == [1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 1, 1, 0, 1] and votes[1].sum() == -2
    assert toxicity.patterns("sh1t h3re d@mn") == 4 and toxicity.patterns(None) == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, odd, none, module):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (5, 1, 0), (None, 1, 1), (7, None, 3)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false")):
        model = module.fit(odd, known)
        rows = module.score(odd, model, output="score").collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(none, model).count() == 0


def test_label_model_discounts_repeated_voters():
    rng = np.random.default_rng(1)
    truth = rng.random(3000) < 0.3
    good = [np.where(rng.random(3000) < 0.85, np.where(truth, 1, -1), np.where(truth, -1, 1)) for _ in range(3)]
    noise = np.where(rng.random(3000) < 0.6, np.where(truth, 1, -1), np.where(truth, -1, 1))
    votes = np.stack([*good, noise, noise, noise, noise], axis=1)
    model = toxicity.LabelModel(0.3)
    assert ((model.fit(votes) > 0.5) == truth).mean() > 0.9
    assert model.weights[3:].max() < 0.5 < model.weights[:3].min()


def test_pipeline_stages_do_what_they_say(spark):
    sf = "/root/testdata/sf0.001"
    docs = parts(spark, "documents", "sf0.001")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = stage(spark, before, sf).cache()
        seen[name] = {r["doc_id"]: r for r in now.collect()} if name != "packing" else now.collect()
        if name != "packing":
            assert now.columns == docs.columns
    first = seen["quality_classifier"]
    assert set(seen["simhash_neardup"]) == set(brute_components({i: r["text"] for i, r in first.items()}).values())
    items = [containment.shingles(containment.normal(r["text"]).split()) for r in parts(spark, "benchmark", "sf0.001").collect()]
    clean = {i for i, r in seen["simhash_neardup"].items() if not any(s and len(s & containment.shingles(containment.normal(r["text"]).split())) >= 0.8 * len(s) for s in items)}
    assert set(seen["benchmark_decontamination"]) == clean == set(seen["secret_scan"])
    for r in seen["secret_scan"].values():
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    assert {r["doc_id"] for r in seen["packing"]} == clean


def test_pipeline_odd_rows(spark, odd):
    docs = odd.selectExpr("doc_id", "text", "'en' lang", "source", "cast(length(text) as bigint) n_chars", "component_id", "fp", "score", "1.5 _quality", "'k' _key", "2 _id", "3 node", "4 secret_spans")
    again = docs.where("doc_id = 1").withColumn("text", F.lit("something else entirely, which shares its id with another text and stays"))
    docs = docs.unionByName(again)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() > 0 and (name == "packing" or docs.columns == before.columns)
        if name not in ("quality_classifier", "packing"):
            assert all(r["_quality"] == 1.5 and r["_key"] == "k" and r["secret_spans"] == 4 for r in docs.collect())


def test_dedup_keeps_one_row_of_each_group(spark, odd):
    docs = odd.unionByName(odd.where("doc_id = 1").withColumn("text", F.lit("another text with the id of the first")))
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_stage(spark, docs, "").collect()), key=repr)
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    want = [t for t in texts if t[0] in (1, 5, 7, None) or t[0] == 3]
    assert kept == sorted(want, key=repr)
    assert corpus_pipeline.dedup_stage(spark, docs.where("false"), "").count() == 0
