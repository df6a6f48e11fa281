"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import materialize, release


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round; edges (a, b), a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))).alias("e")).select("e.*")
    return small.where("a > b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Of links (a, b) between longs, one row (node, root) per node that has a link to another; root is the smallest reachable.

    Nulls and self links have no effect; an empty table gives an empty table. Every round is written to the
    shared folder, so the plan stays short and survives lost executors; the result is such a table, and those of the
    rounds are deleted. Hubs are reduced by a partial minimum
    before the shuffle, and the join that hands a hub's minimum back may be split by the adaptive skew join.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = materialize(edges, label), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
        if (state["n"], state["h"]) == seen or not state["n"]:
            break
        seen, before = (state["n"], state["h"]), edges
        edges = materialize(_stars(before), label)
        release(before)
    made = materialize(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct(), f"{label}-roots")
    release(edges)
    return made
