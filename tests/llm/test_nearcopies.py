import random

import corpus_pipeline
import pytest

from quire.llm.nearcopies import near_components


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    """Least id of each id's component over all pairs of Jaccard similarity 0.8 or more."""
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in texts:
        for b in texts:
            x, y = sets[a], sets[b]
            if a < b and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                r, s = find(a), find(b)
                parent[max(r, s)] = min(r, s)
    return {i: find(i) for i in texts}


def test_stage_finds_all_pairs_that_brute_force_finds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = set(brute_components({r["doc_id"]: r["text"] for r in docs.collect()}).values())
    assert {r["doc_id"] for r in corpus_pipeline.dedup_stage(spark, docs, "/root/testdata/sf0.01").collect()} == want


@pytest.mark.parametrize("crowded", [1, 5, 1000])
def test_crowded_groups(spark, crowded):
    rnd, texts = random.Random(5), []
    for _ in range(6):
        base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.choice((0, 1, 2, 3, 4, 5))):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(5000)}"
            texts.append(" ".join(copy))
    rnd.shuffle(texts)
    texts = dict(enumerate(texts))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["id"]: r["component_id"] for r in near_components(docs, crowded=crowded).collect()} == brute_components(texts)


def test_odd_rows(odd, none):
    by = {}
    rows = near_components(odd).collect()
    for r in rows:
        by.setdefault(r["id"], set()).add(r["component_id"])
    assert len(rows) == odd.count() and by[1] == by[2] == {1} and by[3] == by[4] == by[6] == {3} and by[None] == {None}
    assert near_components(none).count() == 0
