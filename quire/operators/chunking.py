"""Splitting and packing paragraphs into size-bounded chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CHARS, JOINT = 3000, "\n\n"


def split_oversize(text: str, limit: int = MAX_CHARS) -> list[str]:
    """Pieces of at most ``limit`` characters: whole sentences while they fit, else words, else cuts every ``limit`` characters.

    What a cut leaves over becomes the pending piece, which the next sentence may join; a full cut leaves nothing.
    """
    if len(text) <= limit:
        return [text]
    out: list[str] = []
    pending = ""
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        if len(sentence) <= limit:
            if pending and len(pending) + 1 + len(sentence) <= limit:
                pending += " " + sentence
            else:
                out += [pending] if pending else []
                pending = sentence
            continue
        out += [pending] if pending else []
        pending = ""
        for word in sentence.split():
            if pending and len(pending) + 1 + len(word) <= limit:
                pending += " " + word
                continue
            out += [pending] if pending else []
            whole = len(word) - len(word) % limit
            out += [word[i : i + limit] for i in range(0, whole, limit)]
            pending = word[whole:]
    return out + [pending] if pending else out


def pack_parts(parts: list[str], limit: int = MAX_CHARS) -> list[str]:
    """Parts joined by a blank line while the whole stays within the limit; a part beyond it stands alone."""
    out: list[str] = []
    for part in parts:
        if out and len(out[-1]) + len(JOINT) + len(part) <= limit:
            out[-1] += JOINT + part
        else:
            out.append(part)
    return out


def chunk_starts(sizes: Column, limit: int = MAX_CHARS) -> Column:
    """Greedy packing of ordered part sizes as the positions (from 1) of the parts that start a chunk, in one fold that writes at starts only."""
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("size"), F.expr("cast(array() as array<int>)").alias("at"))

    def step(acc: Column, size: Column) -> Column:
        fits = (acc["i"] > 0) & (acc["size"] + len(JOINT) + size <= limit)
        i = acc["i"] + 1
        return F.struct(i.alias("i"), F.when(fits, acc["size"] + len(JOINT) + size).otherwise(size).alias("size"), F.when(fits, acc["at"]).otherwise(F.concat(acc["at"], F.array(i))).alias("at"))

    return F.aggregate(sizes, start, step, lambda acc: acc["at"])


def packed(df: DataFrame, parts_col: str, sizes: Column, limit: int = MAX_CHARS) -> DataFrame:
    """``df`` with one row per chunk of the ordered parts: chunk_no from 1, and the chunk's parts in place of all."""
    n = F.size(parts_col)
    started = df.withColumn("_starts", chunk_starts(sizes, limit)).select("*", F.posexplode("_starts").alias("_j", "_from"))
    until = F.coalesce(F.get("_starts", F.col("_j") + 1), n + 1)
    return started.withColumn("chunk_no", F.col("_j") + 1).withColumn(parts_col, F.slice(parts_col, F.col("_from"), until - F.col("_from"))).drop("_starts", "_j", "_from")


def split_parts(df: DataFrame, text_col: str, limit: int = MAX_CHARS, output: str = "parts") -> DataFrame:
    """``df`` with an array of the pieces of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [split_oversize(t.as_py() or "", limit) for t in b.column(b.schema.get_field_index(text_col))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.list_(pa.string()))], names=[*b.schema.names, output])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, {output} array<string>")


def chunk_parts(df: DataFrame, parts_col: str, limit: int = MAX_CHARS, output: str = "chunks") -> DataFrame:
    """``df`` with its ordered parts split and packed into an array of chunk texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(parts_col)
            made = [pack_parts([p for part in (parts.as_py() or []) for p in split_oversize(part, limit)], limit) for parts in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.list_(pa.string()))], names=[*b.schema.names, output])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, {output} array<string>")
