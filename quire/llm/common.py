"""Shared plumbing of the training-data operators: tables, scratch space, crc folds."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows with ``crc32(id as text) % FOLDS == 0`` are held out from learning.
FOLDS = 5
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BROADCAST, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir``, or (only where unset) a local one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        found = tempfile.mkdtemp(prefix="quire-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path for a table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut, a lost executor costs nothing.

    The shuffle files of the write go as soon as it is done, as no later plan reads them.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._scratch_path = path
    return made


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile broadcasts a side of a join only where its shuffle has shown it to be small.

    Before a shuffle Spark goes by the size of the files below. Rows that compress well or are exploded hold many
    times that, which the driver would gather and build a table of.
    """
    given = {k: spark.conf.get(k, None) for k in (_BROADCAST, _MEASURED)}
    spark.conf.set(_MEASURED, given[_MEASURED] or spark.conf.get(_BROADCAST))
    spark.conf.set(_BROADCAST, "-1")
    try:
        yield
    finally:
        for k, v in given.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def release(*tables: DataFrame) -> None:
    """Delete materialized tables. Nothing may read them any more: what was made of them has been written, too.

    The driver then collects its garbage: only so do plans, broadcasts and shuffles that are done leave it (and the
    executors), and over dozens of writes its heap would otherwise grow to its limit.
    """
    for t in tables:
        at = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which the reused worker gives the memory that it has freed back to the system."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return inner


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def fold(id_column: str) -> Column:
    """crc32 of the id's decimal text modulo ``FOLDS``; null ids are in fold 0, so they are never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS, F.lit(0))


def held_out(id_column: str) -> Column:
    return fold(id_column) == 0


def crc_fold(value: object) -> int:
    """The same fold in Python, for tests and brute-force versions."""
    return zlib.crc32(str(value).encode()) % FOLDS
