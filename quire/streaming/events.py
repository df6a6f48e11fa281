"""Stream versions of carry-forward and first-seen over event files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def first_seen(stream: DataFrame, keys: list[str]) -> DataFrame:
    """One row per distinct keys, in whatever order of time the rows come. State holds each key seen, so keys must be bounded."""
    return stream.dropDuplicates(keys)


def carry_forward(stream: DataFrame, key: str, order: str, header: str, value: str) -> DataFrame:
    """(key, order, carried): the last header value of the key at or before each row, over batches; rows of a batch are taken in order."""

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        carried = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(order)
        out = []
        for is_header, v in zip(rows[header], rows[value], strict=True):
            carried = int(v) if is_header else carried
            out.append(carried)
        if carried is not None:
            state.update((carried,))
        yield pd.DataFrame({key: rows[key], order: rows[order], "carried": pd.array(out, dtype="Int64")})

    kind = dict(stream.dtypes)
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind[key]}, {order} {kind[order]}, carried bigint", "carried bigint", "append", GroupStateTimeout.NoTimeout)


def per_window(stream: DataFrame, time: str, width: str, late: str = "1 day") -> DataFrame:
    """Counts per event type and tumbling window."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), "event_type").agg(F.count("*").alias("n"))
