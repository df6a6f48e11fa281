"""Queries against brute force over whole tables."""

import re

import pytest
from quire.plans import registry

SF = "/root/testdata/sf0.01"


def rows(spark, name, sf=SF):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


def word_set(text):
    return set(re.findall("[a-z0-9]+", text.lower()))


def title(html):
    found = re.search("(?s)<title>(.*?)</title>", html)
    return word_set(found[1]) if found else set()


def test_longest_prefix_uses_all_parts_as_outline(spark):
    parts = [(r["p_partkey"], (r["p_size"] % 5, r["p_size"] % 3, r["p_partkey"] % 7)) for r in rows(spark, "part")]
    last = {}
    for key, number in parts:
        for prefix in [number[:1]] + [number[:2]] * (key % 3 == 0):
            last[prefix] = max(key, last.get(prefix, key))
    want = {}
    for key, number in parts:
        prefix = next((number[:n] for n in (3, 2, 1) if number[:n] in last), None)
        want[key] = (prefix and ".".join(map(str, prefix)), last.get(prefix))
    assert {r["p_partkey"]: (r["prefix"], r["entry"]) for r in registry.QUERIES["longest_prefix"](spark, SF).collect()} == want


def test_best_evidence_compares_all_words_and_keeps_all_pages(spark):
    items, want = [(r["item_id"], word_set(r["text"])) for r in rows(spark, "benchmark")], {}
    for page in rows(spark, "pages"):
        words = title(page["html"])
        found = [(-round(len(words & w) / len(words | w), 9), i) for i, w in items if words & w]
        want[page["page_id"]] = (min(found)[1], -min(found)[0]) if found else (None, 0.0)
    assert {r["page_id"]: (r["item_id"], pytest.approx(r["similarity"], abs=2e-9)) for r in registry.QUERIES["best_evidence"](spark, SF).collect()} == want


def test_bookmarks_meet_every_page(spark, tmp_path):
    page = "<title>{}</title><h1>x</h1>".format
    spark.createDataFrame([(3, page("Alpha beta")), (4, page("other words")), (6, page("alpha"))], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(3, "alpha beta"), (4, "alpha beta"), (5, "alpha beta"), (6, "alpha beta")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["key"]: (r["warning"], r["similarity"]) for r in registry.QUERIES["bookmark_disagreement"](spark, str(tmp_path)).collect()}
    assert got == {3: ("same", 1.0), 4: ("different title", 0.0), 5: ("missing", 0.0), 6: ("same", 0.5)}


def test_first_seen_over_files_in_mixed_time_order(spark, tmp_path):
    events = rows(spark, "events")
    spark.read.parquet(f"{SF}/events.parquet").repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    # The query takes events.parquet as a pattern of files; a directory of several files stands in for it.
    got = [tuple(r) for r in registry.QUERIES["stream_first_seen"](spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == {(r["user_id"], r["event_type"]) for r in events}
