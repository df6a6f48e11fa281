"""Sum-of-squares online packing of documents' token ids into training sequences."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenizers import Tokenizer
from tokenizers import normalizers as N
from tokenizers import pre_tokenizers as P

from quire.llm.common import trimmed
from quire.llm.tokens import Cores, Pieces, marked, runs

_SCHEMA = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_ROWS = 4096
_IDS: dict[str, Pieces] = {}


def id_pieces(path: str) -> Pieces:
    """Little-endian 32-bit ids of pieces, for a vocabulary that marks the ends of words with </w> and folds case; kept for the life of a worker.

    Words of plain letters are folded here and go to the same model without its normaliser and pattern, which
    leave such words as they are.
    """
    if path not in _IDS:
        plain = Tokenizer.from_file(path)
        plain.normalizer = N.Sequence([])
        plain.pre_tokenizer = P.Sequence([P.WhitespaceSplit(), P.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])

        def cut(ids: np.ndarray, cuts: list[int]) -> list[bytes]:
            raw = ids.astype("<u4").tobytes()
            return [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]

        _IDS[path] = Pieces(path, Cores(plain, {" ": marked(plain, end="</w>")}, True, cut), lambda ids: array("I", ids).tobytes(), fold=True)
    return _IDS[path]


def token_ids(texts: pa.StringArray, path: str) -> Iterator[np.ndarray]:
    """The token ids of each whole text. The tokenizer drops white space and never joins over it, so cutting at blanks and line ends gives the same ids."""
    cut = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
    codes = cut.flatten().dictionary_encode()
    values = id_pieces(path).values(codes.dictionary)
    flat = np.frombuffer(b"".join(values), "<u4")
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    begins = np.cumsum(sizes) - sizes
    at = codes.indices.to_numpy()
    n = sizes[at]
    ends = np.cumsum(n)
    ids = flat[np.repeat(begins[at] - (ends - n), n) + np.arange(n.sum())]
    bounds = np.concatenate(([0], ends))[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        yield ids[a:b]


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.count = capacity, np.zeros(capacity + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(capacity + 1)]

    def place(self, piece: tuple) -> list | None:
        """Put a piece (id, start, length, ids, doc_tokens) where the squared counts of open levels grow least; the window, if that fills it.

        Ties go to the fullest level. count[capacity] stays zero: full windows are no longer open.
        """
        size, cap, count = piece[2], self.capacity, self.count
        level, best = 0, (2 * int(count[size]) + 1 if size < cap else 0)
        if size < cap:
            change = 2 * (count[size + 1 :] - count[1 : cap - size + 1]) + 2
            change[-1] -= 1
            change[count[1 : cap - size + 1] == 0] = 1 << 60
            at = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                level = at + 1
        window = self.open[level].pop() if level else []
        if level:
            count[level] -= 1
        window.append(piece)
        if level + size == cap:
            return window
        count[level + size] += 1
        self.open[level + size].append(window)
        return None

    def close(self) -> Iterator[list]:
        """The windows still open at the end: the emptiest are cut to fill the fullest, so at most one stays short."""
        left = [w for level in range(self.capacity, 0, -1) for w in self.open[level]]
        give: list[tuple] = []
        while left:
            window = left.pop(0)
            room = self.capacity - sum(p[2] for p in window)
            while room and (give or left):
                if not give:
                    give = left.pop()
                doc, start, size, ids, total = give.pop()
                take = min(room, size)
                window.append((doc, start, take, ids[: 4 * take], total))
                room -= take
                if take < size:
                    give.append((doc, start + take, size - take, ids[4 * take :], total))
            yield window
        while give:  # what the last filled window left of its donor
            window, give = give, []
            yield window


def pack(docs: DataFrame, *, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset): one row per piece; ids are little-endian unsigned 32-bit.

    A document is its token ids and then ``end_id``. Whole windows are cut off its front as sequences of their own;
    the remainder goes, in order of arrival, to the fill level at which the sum of squared counts of partially
    filled windows grows least (a level array of counts). Each partition packs for itself in one pass, without a
    shuffle, and holds open windows only; at its end the emptiest of these are cut to fill the others, so
    that a partition leaves at most one short sequence. sequence_id holds the partition number in its upper bits;
    as partitions of a file scan are the same at each attempt, a repeated task gives the same rows.
    Null and empty texts are documents of one id. Null ids stay, repeated rows are packed each, other columns play
    no part, and an empty table gives no rows.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, made = Levels(capacity), 0
        base, end, out = TaskContext.get().partitionId() << 36, array("I", [end_id]).tobytes(), []

        def emit(window: list) -> None:
            nonlocal made
            at = 0
            for doc, start, size, ids, total in window:
                out.append((doc, start, size, ids, total, base + made, at))
                at += size
            made += 1

        def flush() -> pa.RecordBatch:
            made_batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
            out.clear()
            return made_batch

        def documents() -> Iterator[tuple]:
            for b in batches:
                ids = b.column(0).to_pylist()
                made = (t.tobytes() + end for part in runs(b.column(1)) for t in token_ids(part, path))
                yield from zip(ids, made, strict=True)

        for doc, ids in documents():
            total, at = len(ids) // 4, 0
            for at in range(0, total - capacity + 1, capacity):
                emit([(doc, at, capacity, ids[4 * at : 4 * (at + capacity)], total)])
            at = total - total % capacity
            if at < total and (full := levels.place((doc, at, total - at, ids[4 * at :], total))):
                emit(full)
            if len(out) >= _ROWS:
                yield flush()
        for window in levels.close():
            emit(window)
            if len(out) >= _ROWS:
                yield flush()
        if out:
            yield flush()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(trimmed(run), "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a crc32 in place of their ids."""
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op5: the pieces of all documents, packed into sequences of at most 2048 ids."""
    return digests(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))
