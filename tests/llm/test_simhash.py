import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import components as components_module
from quire.llm import nearcopies, simhash
from quire.llm.common import materialize
from quire.llm.components import components
from quire.llm.simhash import fingerprint, links, query, simhash_components


def brute_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    parent = {f: f for f in marks}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in marks:
        for b in marks:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    return {f: find(f) for f in marks}


@given(st.text(alphabet="aAbB é\n\t.", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


def test_links_connect_what_brute_force_connects(spark):
    rnd = random.Random(3)
    marks = set()
    for _ in range(40):
        f = rnd.getrandbits(64)
        marks.add(f)
        for _ in range(rnd.choice((0, 0, 3, 30))):
            f ^= sum(1 << rnd.randrange(64) for _ in range(rnd.choice((1, 2, 3, 4))))
            marks.add(f & (2**64 - 1))
    signed = lambda f: f - 2**64 if f >= 2**63 else f
    nodes = spark.createDataFrame([(signed(f),) for f in marks], "fp long")
    want = brute_components(sorted(marks))
    for crowded in (0, 2, 1000):
        got = {r["node"]: r["root"] for r in components(links(nodes, crowded=crowded)).collect()}
        groups, have = {}, {}
        for f in marks:
            groups.setdefault(want[f], set()).add(f)
            have.setdefault(got.get(signed(f), signed(f)), set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, have.values()))


def test_odd_rows(odd, none):
    rows = simhash_components(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["id"], set()).add(r["component_id"])
    assert by[1] == by[2] == {1}
    assert by[3] == by[4] == by[6] == {3}
    assert by[None] == {None}
    assert simhash_components(none).count() == 0


def test_query(spark, small):
    rows = {r["doc_id"]: r for r in query(spark, small).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    marks = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert all(int(rows[i]["fingerprint"], 16) == f for i, f in marks.items())
    roots = brute_components(sorted(set(marks.values())))
    least = {}
    for i in sorted(marks):
        least.setdefault(roots[marks[i]], i)
    assert all(rows[i]["component_id"] == least[roots[f]] for i, f in marks.items())


def test_driver_builds_no_table_of_unmeasured_rows(spark, small, monkeypatch):
    """File sizes say little of rows that are exploded or compress well, so no join may broadcast a side by them."""
    plans, before = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().sparkPlan().toString()))
        return materialize(df, label)

    for module in (simhash, nearcopies, components_module):
        monkeypatch.setattr(module, "materialize", noted)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for found in (simhash_components(docs, crowded=0), nearcopies.near_components(docs)):
        plans.append(("result", found._jdf.queryExecution().sparkPlan().toString()))
        assert found.count() == docs.count()
    assert any("SortMergeJoin" in plan for _, plan in plans)
    assert [label for label, plan in plans if "Broadcast" in plan] == []
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
