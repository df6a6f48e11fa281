"""Order-dependent operators within partitions: carry-forward, gaps, islands, duplicates, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(df: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The last non-null value at or before each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def islands(df: DataFrame, by: list[str], order: list[str], barrier: Column, name: str) -> DataFrame:
    """A run number that grows at each barrier row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(barrier, 1).otherwise(0)).over(w))


def order_violations(df: DataFrame, by: list[str], order: list[str], key: Column) -> DataFrame:
    """Rows whose key sorts below that of the row before."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_key", key).withColumn("_before", F.lag("_key").over(w)).where(F.col("_key") < F.col("_before"))


def sibling_gaps(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, first_missing, last_missing) between neighbouring distinct numbers."""
    w = Window.partitionBy(*by).orderBy(number)
    pairs = df.select(*by, number).distinct().withColumn("_before", F.lag(number).over(w))
    return pairs.where(F.col(number) - F.col("_before") > 1).select(*by, (F.col("_before") + 1).alias("first_missing"), (F.col(number) - 1).alias("last_missing"))


def keep_first(df: DataFrame, by: list[Column], order: list[str]) -> DataFrame:
    """Rows with ``occurrence`` (1 for the first) and ``first_of``, the order key of the first."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("occurrence", F.row_number().over(w)).withColumn("first_of", F.first(order[0]).over(w))


def counter(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def chunked_counter(df: DataFrame, by: list[str], chunk: Column, order: list[str], name: str) -> DataFrame:
    """A counter over few large groups: rows are numbered within chunks, which ``chunk`` orders as ``order`` does, and each chunk starts behind those before it."""
    rows = df.withColumn("_chunk", chunk)
    sizes = rows.groupBy(*by, "_chunk").agg(F.count("*").alias("_n"))
    before = sizes.select(*by, "_chunk", (F.sum("_n").over(Window.partitionBy(*by).orderBy("_chunk")) - F.col("_n")).alias("_before"))
    numbered = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy(*order)))
    return numbered.join(before, [*by, "_chunk"]).withColumn(name, F.col("_before") + F.col("_at")).drop("_chunk", "_before", "_at")


def take_while(df: DataFrame, by: list[str], order: list[str], stop: Column) -> DataFrame:
    """The rows of each group before its first row where ``stop`` is true; a null stops nothing."""
    seen = F.max(F.coalesce(stop, F.lit(False))).over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_stop", seen).where("not _stop").drop("_stop")
