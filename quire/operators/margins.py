"""Repeated edge lines, margin suggestions, medians and deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repeated_lines(lines: DataFrame, fingerprint: str, page: str, least: int) -> DataFrame:
    """Fingerprints on at least so many distinct pages. Pairs are made distinct first, so a very common line is counted from partial results."""
    return lines.select(fingerprint, page).distinct().groupBy(fingerprint).agg(F.count("*").alias("pages")).where(F.col("pages") >= least)


def middle(df: DataFrame, by: list[str], value: str, output: str, bins: int = 1024) -> DataFrame:
    """Exact median per group (the mean of the middle two), nulls left out.

    Values are counted in bins between the group's extremes; only the bins that hold the middle ranks are sorted, so
    a group of very many rows meets in no task.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v is not null")
    ends = rows.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    place = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))).otherwise(0)
    placed = rows.join(ends, by).withColumn("_bin", place)
    counts = placed.groupBy(*by, "_bin").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"))
    counts = counts.withColumn("_before", F.sum("_c").over(Window.partitionBy(*by).orderBy("_bin")) - F.col("_c"))
    first, second = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    held = counts.where((F.col("_before") < second) & (F.col("_before") + F.col("_c") >= first)).select(*by, "_bin", "_before")
    ranked = placed.join(held, [*by, "_bin"]).withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy(*by, "_bin").orderBy("_v")))
    return ranked.where(F.col("_rank").between(first, second)).groupBy(*by).agg(F.avg("_v").alias(output))


def median_mad(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Exact median and median absolute deviation per group."""
    median = middle(df, by, value, "median")
    away = df.join(median, by).withColumn("_away", F.abs(F.col(value) - F.col("median")))
    return median.join(middle(away, by, "_away", "mad"), by)


def margin_suggestion(lines: DataFrame, by: list[str], repeated: str, y: str, band: float = 0.2, default: float = 0.03) -> DataFrame:
    """Top and bottom margin ratios: the middle between the innermost repeated edge line and the body line next to it, to three digits, half-even; null without repeats.

    Without such a body line in the band the edge line plus (or minus) the default, held within the band.
    """
    edges = lines.groupBy(*by).agg(F.max(F.when(F.col(repeated) & (F.col(y) <= band), F.col(y))).alias("_head"), F.min(F.when(F.col(repeated) & (F.col(y) >= 1 - band), F.col(y))).alias("_foot"))
    both = lines.join(edges, by)
    body = both.groupBy(*by).agg(
        F.first("_head").alias("_head"), F.first("_foot").alias("_foot"),
        F.min(F.when(~F.col(repeated) & (F.col(y) > F.col("_head")) & (F.col(y) <= band), F.col(y))).alias("_first"),
        F.max(F.when(~F.col(repeated) & (F.col(y) < F.col("_foot")) & (F.col(y) >= 1 - band), F.col(y))).alias("_last"),
    )
    top = F.when(F.col("_head").isNotNull(), F.coalesce((F.col("_head") + F.col("_first")) / 2, F.least(F.col("_head") + default, F.lit(band))))
    low = F.when(F.col("_foot").isNotNull(), F.coalesce(1 - (F.col("_foot") + F.col("_last")) / 2, F.least(1 - F.col("_foot") + default, F.lit(band))))
    return body.select(*by, F.bround(top, 3).alias("top_margin"), F.bround(low, 3).alias("bottom_margin"))


def kleene_or(flag: Column) -> Column:
    """True if any is true, else null if any is unknown, else false."""
    return F.when(F.coalesce(F.bool_or(flag), F.lit(False)), True).when(F.count_if(flag.isNull()) > 0, None).otherwise(False)
