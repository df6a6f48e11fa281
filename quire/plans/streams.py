"""Event files as streams: each query runs to the end of what is there and gives the written rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.streaming import events


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Rows and checkpoint go to the shared folder of spark.checkpoint.dir; to a local one only where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="quire-stream-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, since a stream takes a plain path for a directory and this may be one file.
    return events.event_stream(spark, f"{sf_dir}/event[s].parquet", spark.read.parquet(f"{sf_dir}/events.parquet").schema).withColumn("ts", F.col("ts").cast("timestamp"))


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and event type of all event files."""
    return _run(spark, events.first_seen(_events(spark, sf_dir), ["user_id", "event_type"]).select("user_id", "event_type"), "first-seen")


def stream_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sign-up event of a user at or before each event."""
    rows = _events(spark, sf_dir).select("user_id", "event_id", (F.col("event_type") == "signup").alias("header"), F.col("event_id").alias("value"))
    return _run(spark, events.carry_forward(rows, "user_id", "event_id", "header", "value"), "carry-forward")


QUERIES = {f.__name__: f for f in (stream_first_seen, stream_carry_forward)}

#: The streams end where the files do, so their rows are those of a batch.
SQL = {
    "stream_first_seen": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_carry_forward": "SELECT user_id, event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events",
}
