"""Joins between boxes of a page."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from statistics import median

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from quire.functions import geometry as G

_BOX = ("x0", "y0", "x1", "y1")


def _box(prefix: str = "") -> tuple:
    return tuple(F.col(prefix + c) for c in _BOX)


def overlapping(lines: DataFrame, regions: DataFrame, by: list[str], threshold: float, how: str = "left_semi") -> DataFrame:
    """Lines of which at least the threshold's share of area lies in one region of their page (left_semi), or none does (left_anti)."""
    boxes = regions.select(*[F.col(c).alias(f"r_{c}") for c in [*by, *_BOX]])
    on = G.share_inside(_box(), _box("r_")) >= threshold
    for c in by:
        on = (F.col(c) == F.col(f"r_{c}")) & on
    return lines.join(boxes, on, how)


def nearest(left: DataFrame, right: DataFrame, by: list[str], key: str, position: str, other: str, other_position: str, *, width: float) -> DataFrame:
    """For each left row the right row of its group at the least distance, ties to the smaller position and then key.

    Positions go to buckets of a width. Windows within buckets give the right rows next below and above; where a bucket
    has none, those of the nearest bucket with any are carried over from a table of buckets. No rows are paired.
    """
    bucket = lambda c: F.floor(F.col(c) / width)
    spot = F.struct(F.col("_p").alias("p"), F.col("_k").alias("k"))
    points = right.groupBy(*by, F.col(other_position).alias("_p")).agg(F.min(other).alias("_k")).withColumn("_b", bucket("_p"))
    rows = left.select(*by, key, F.col(position).alias("_p"), bucket(position).alias("_b"))
    edges = points.groupBy(*by, "_b").agg(F.max(spot).alias("_top"), F.min(spot).alias("_low")).unionByName(rows.select(*by, "_b").distinct(), allowMissingColumns=True).groupBy(*by, "_b").agg(F.first("_top", ignorenulls=True).alias("_top"), F.first("_low", ignorenulls=True).alias("_low"))
    over = Window.partitionBy(*by).orderBy("_b")
    edges = edges.select(*by, "_b", F.last("_top", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_under"), F.first("_low", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_over"))
    both = rows.withColumn("_s", F.lit(None).cast(points.select(spot.alias("s")).schema["s"].dataType)).unionByName(points.select(*by, F.lit(None).cast(rows.schema[key].dataType).alias(key), "_p", "_b", spot.alias("_s")))
    w = Window.partitionBy(*by, "_b").orderBy("_p")
    seen = both.withColumn("_below", F.last("_s", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))).withColumn("_above", F.first("_s", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing)))
    joined = seen.where(F.col("_s").isNull()).join(edges, [*by, "_b"], "left")
    ends = F.filter(F.array(F.coalesce("_below", "_under"), F.coalesce("_above", "_over")), lambda e: e.isNotNull())
    best = F.array_min(F.transform(ends, lambda e: F.struct(F.abs(e["p"] - F.col("_p")).alias("distance"), e["p"].alias("p"), e["k"].alias("k"))))
    return joined.select(*by, key, best.alias("m")).where("m is not null").select(*by, key, F.col("m.k").alias(other), "m.distance")


def fold_groups(df: DataFrame, by: list[str], fold: Callable[[list[dict]], list[dict]], schema: StructType) -> DataFrame:
    """Rows that a Python fold makes of each group's rows; a group is a page or document, many groups share one Arrow batch."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                rows = [r for group in b.column(0).slice(at, 1000).to_pylist() for r in fold(group)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    grouped = df.groupBy(*by).agg(F.collect_list(F.struct(*df.columns)).alias("_rows")).select("_rows")
    return grouped.mapInArrow(run, schema)


def drop_nested(boxes: DataFrame, by: list[str], order: list[str], share: float = 0.95) -> DataFrame:
    """Boxes without those of which a kept earlier box of the page covers the share of the smaller area; the kept one takes the longer text.

    The outcome of each box depends on which earlier ones were kept, so a page is folded in order.
    """

    def fold(page: list[dict]) -> list[dict]:
        kept: list[dict] = []
        for row in sorted(page, key=lambda r: [r[c] for c in order]):
            for k in kept:
                w = min(row["x1"], k["x1"]) - max(row["x0"], k["x0"])
                h = min(row["y1"], k["y1"]) - max(row["y0"], k["y0"])
                small = min((r["x1"] - r["x0"]) * (r["y1"] - r["y0"]) for r in (row, k))
                if w > 0 and h > 0 and small > 0 and w * h / small >= share:
                    if len(row["text"]) > len(k["text"]):
                        k["text"] = row["text"]
                    break
            else:
                kept.append(row)
        return kept

    return fold_groups(boxes, by, fold, boxes.schema)


def _with_row_no(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("row_no", IntegerType())])


def visual_rows(items: DataFrame, by: list[str], *, share: float = 0.35, look_back: int = 3) -> DataFrame:
    """Items (x0, y0, x1, y1, ord) with ``row_no``: an item joins the newest of the last rows that it overlaps by the share of the smaller height, else opens one."""

    def fold(page: list[dict]) -> list[dict]:
        rows: list[tuple[float, float]] = []
        for item in sorted(page, key=lambda r: ((r["y0"] + r["y1"]) / 2, r["x0"], r["ord"])):
            y0, y1 = item["y0"], item["y1"]
            for i in range(len(rows) - 1, max(-1, len(rows) - 1 - look_back), -1):
                top, bottom = rows[i]
                if min(bottom, y1) - max(top, y0) >= share * min(max(y1 - y0, 1.0), bottom - top):
                    rows[i] = (min(top, y0), max(bottom, y1))
                    break
            else:
                i = len(rows)
                rows.append((y0, y1))
            item["row_no"] = i
        return page

    return fold_groups(items, by, fold, _with_row_no(items.schema))


def center_rows(items: DataFrame, by: list[str]) -> DataFrame:
    """Items (y0, y1, x0, ord) with ``row_no``: an item joins the last row if its center is within max(1.5, 0.3 median heights) of the mean of that row's centers."""

    def fold(page: list[dict]) -> list[dict]:
        tolerance = max(1.5, 0.3 * median(r["y1"] - r["y0"] for r in page))
        total, n, row = 0.0, 0, -1
        for item in sorted(page, key=lambda r: (r["y0"], r["x0"], r["ord"])):
            center = (item["y0"] + item["y1"]) / 2
            if n and abs(center - total / n) <= tolerance:
                total, n = total + center, n + 1
            else:
                row, total, n = row + 1, center, 1
            item["row_no"] = row
        return page

    return fold_groups(items, by, fold, _with_row_no(items.schema))


def merge_rows(items: DataFrame, by: list[str], row: str = "row_no") -> DataFrame:
    """(by, row, text, x0, y0, x1, y1, font_size, bold, italic): one line per visual row, texts from left to right, with the box around them, the largest font and whether any is bold or italic."""
    texts = F.array_sort(F.collect_list(F.struct("x0", "ord", "text")))
    merged = items.groupBy(*by, row).agg(texts.alias("_t"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max("font_size").alias("font_size"), F.bool_or("bold").alias("bold"), F.bool_or("italic").alias("italic"))
    text = F.array_join(F.filter(F.transform("_t", lambda t: t["text"]), lambda t: t != ""), " ")
    return merged.select(*by, row, text.alias("text"), "x0", "y0", "x1", "y1", "font_size", "bold", "italic")
