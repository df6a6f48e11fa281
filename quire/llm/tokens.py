"""Token counts: exact splicing of overlapping chunks, and memoised encoding between proven boundaries."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Texts longer than this many characters are encoded as overlapping chunks.
CHUNK, OVERLAP = 1 << 15, 256
#: Words that one generation of a worker's memo holds; longer keys than LONG_KEY characters are not remembered.
MEMO, LONG_KEY = 200_000, 64
#: Bytes of text whose pieces are looked up together.
GATHER = 1 << 22

# Characters beside which a single space is certainly the start of a new pre-token: they are no white space,
# and in byte-level patterns only white space can extend over a following space.
_PLAIN = r"!-~\u00c0-\u02af\u0370-\u0482\u048a-\u0556"
_BOUNDARY = re.compile(f"(?<=[{_PLAIN}]) (?=[{_PLAIN}])")
_RARE_SPACE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")

# A plain word, perhaps behind a line end, and the signs that may follow it.
_WORD, _SIGNS = r"^\n?[A-Za-zÀ-ÖØ-öø-ÿ]+\z", ".,;:!?%*&$#|"

_LOADED: dict[str, Tokenizer] = {}
_COUNTS: dict[str, object] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, kept for the life of a worker; its own thread pool stays off, since Spark owns the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LOADED:
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def marked_pieces(text: str) -> str:
    """The text with NUL for each single space (and before each line end) that certainly starts a pre-token; a piece keeps a line end, and all but the first have lost a space."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " " or text[-1:] == " " or _RARE_SPACE.search(text):
        return _BOUNDARY.sub("\0", text)
    return text.replace("\n", "\0\n").replace(" ", "\0")


class Memo:
    """Values by key in two generations: when the young one is full it becomes the old one, so keys in use stay and others go."""

    def __init__(self, limit: int) -> None:
        self.young, self.old, self.limit = {}, {}, limit

    def values(self, keys: list[str], make) -> list:  # noqa: ANN001
        """The values of distinct keys; ``make`` gives those of new ones together."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        out = list(map(young.get, keys))
        new = []
        for i in [i for i, v in enumerate(out) if v is None]:
            if (v := old.get(keys[i])) is None:
                new.append(i)
            else:
                out[i] = young[keys[i]] = v
        if new:
            for i, v in zip(new, make([keys[i] for i in new]), strict=True):
                out[i] = v
                if len(keys[i]) <= LONG_KEY:
                    young[keys[i]] = v
        return out


class Cores:
    """Values of plain words, each behind its lead (a space or line end), from one joined encoding of many words.

    The words are letters only, so a token that holds the lead (or that ends a word) marks where the next word's
    tokens begin, without offsets.
    """

    def __init__(self, tokenizer: Tokenizer, marks: dict[str, np.ndarray], at_end: bool, value) -> None:  # noqa: ANN001
        self.tokenizer, self.marks, self.at_end, self.value = tokenizer, marks, at_end, value

    def make(self, words: list[str]) -> list:
        out: list = [None] * len(words)
        for lead, mark in self.marks.items():
            mine = [i for i, w in enumerate(words) if w[0] == lead]
            for at in range(0, len(mine), 2000):
                part = mine[at : at + 2000]
                (made,) = self.tokenizer.encode_batch_fast(["".join([words[i] for i in part])], add_special_tokens=False)
                ids = np.array(made.ids, np.uint32)
                cuts = np.flatnonzero(mark[ids])
                cuts = np.append(0, cuts + 1) if self.at_end else np.append(cuts, len(ids))
                if len(cuts) != len(part) + 1:
                    raise ValueError("the vocabulary does not mark the bounds of words")
                for i, v in zip(part, self.value(ids, cuts.tolist()), strict=True):
                    out[i] = v
        return out


class Pieces:
    """What a function of a piece's token ids gives, for the distinct pieces of many texts at a time.

    A piece of letters and then punctuation is the sum of the two, whose ids never depend on each other; other
    pieces are encoded as they are. Values are remembered per word (and per other piece) in bounded memory.
    """

    def __init__(self, path: str, cores: Cores, one, *, fold: bool = False, limit: int = MEMO) -> None:  # noqa: ANN001
        self.tokenizer, self.cores, self.one, self.fold = load(path), cores, one, fold
        self.words, self.ends, self.others = Memo(limit), Memo(limit // 40), Memo(limit // 10)

    def _natively(self, pieces: list[str], lead: str) -> list:
        out = []
        for at in range(0, len(pieces), 20_000):
            made = self.tokenizer.encode_batch_fast([p if p[:1] == "\n" else lead + p for p in pieces[at : at + 20_000]], add_special_tokens=False)
            out += [self.one(e.ids) for e in made]
        return out

    def values(self, pieces: pa.StringArray) -> list:
        """The values of distinct pieces, each taken as if a space (or the line end it starts with) were before it."""
        body = pc.utf8_rtrim(pieces, characters=_SIGNS)
        plain = pc.match_substring_regex(body, pattern=_WORD)
        cores = body.filter(plain)
        cores = (pc.utf8_lower(cores) if self.fold else cores).dictionary_encode()
        words = [w if w[0] == "\n" else " " + w for w in cores.dictionary.to_numpy(zero_copy_only=False).tolist()]
        known = self.words.values(words, self.cores.make)
        names, at = pieces.to_numpy(zero_copy_only=False), np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        out = np.empty(len(pieces), object)
        out[at] = [known[c] for c in cores.indices.to_numpy().tolist()]
        cut = (pc.binary_length(pieces).to_numpy() - pc.binary_length(body).to_numpy())[at]
        signed = at[cut > 0].tolist()
        ends = [names[i][-n:] for i, n in zip(signed, cut[cut > 0].tolist(), strict=True)]
        distinct = list(dict.fromkeys(ends))
        value = dict(zip(distinct, self.ends.values(distinct, lambda new: self._natively(new, "")), strict=True))
        for i, e in zip(signed, ends, strict=True):
            out[i] = out[i] + value[e]
        rest = np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist()
        for i, v in zip(rest, self.others.values([names[i] for i in rest], lambda new: self._natively(new, " ")), strict=True):
            out[i] = v
        return out.tolist()


def runs(texts: pa.StringArray, size: int = GATHER) -> Iterator[pa.StringArray]:
    """Slices of about ``size`` bytes, one text at least."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts[at:stop]
        at = stop


def marked(tokenizer: Tokenizer, *, start: str = "", end: str = "") -> np.ndarray:
    """By id, whether a vocabulary entry starts (or ends) with a mark."""
    vocabulary = tokenizer.get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for t, i in vocabulary.items() if t.startswith(start) and t.endswith(end)]] = True
    return out


def count_pieces(path: str) -> Pieces:
    """Token counts of pieces, for a byte-level vocabulary (its signs for a space and a line end are U+0120 and U+010A); kept for the life of a worker."""
    if path not in _COUNTS:
        tokenizer = load(path)
        marks = {" ": marked(tokenizer, start="\u0120"), "\n": marked(tokenizer, start="\u010a")}
        _COUNTS[path] = Pieces(path, Cores(tokenizer, marks, False, lambda ids, cuts: np.diff(cuts).tolist()), len)
    return _COUNTS[path]


def piecewise_counts(texts: list[str], path: str) -> np.ndarray:
    """Token counts of whole texts from the counts of their pieces."""
    native = [i for i, t in enumerate(texts) if "\0" in t]
    cut = pc.split_pattern(pa.array([marked_pieces(t) if "\0" not in t else "" for t in texts], pa.large_string()), "\0")
    flat, begins = cut.flatten(), cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
    codes = flat.dictionary_encode()
    values, at = np.zeros(len(codes.dictionary), np.int64), codes.indices.to_numpy().copy()
    # The first piece has lost no space, so it is encoded as it stands.
    firsts = flat.take(pa.array(begins)).to_numpy(zero_copy_only=False).tolist()
    heads = np.array([len(e) for e in load(path).encode_batch_fast(firsts, add_special_tokens=False)], np.int64)
    later = np.ones(len(at), bool)
    later[begins] = False
    used = np.unique(at[later])
    values[used] = count_pieces(path).values(codes.dictionary.take(pa.array(used)))
    counts = values[at] * later
    counts[begins] = heads
    sums = np.add.reduceat(counts, begins) if len(begins) else np.empty(0, np.int64)
    for i in native:
        sums[i] = len(load(path).encode(texts[i], add_special_tokens=False))
    return sums


def spliced_count(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a long text from overlapping chunks.

    Two neighbouring chunks are spliced at a position in their overlap where both have a token start and where
    the characters prove a pre-token boundary (a single space between plain characters): left of it the first
    chunk's tokens are those of the whole text, right of it the second's. If the overlap has no such position
    it is widened twofold, in the end to the whole rest of the text.
    """
    encode, n = load(path).encode, len(text)

    def starts(a: int, b: int) -> np.ndarray:
        return np.array([x for x, _ in encode(text[a:b], add_special_tokens=False).offsets], np.int64) + a

    total, known, begin, end = 0, 0, 0, min(chunk, n)
    now = starts(begin, end)
    while end < n:
        wide = overlap
        while True:
            after = max(begin, end - wide)
            stop = min(n, after + chunk + wide)
            if after <= known:  # no boundary anywhere in what the first chunk holds: take both together
                begin, end = known, min(n, end + wide)
                now = starts(begin, end)
                break
            following = starts(after, stop)
            proven = np.array([after + m.start() for m in _BOUNDARY.finditer(text[after:end])], np.int64)
            common = np.intersect1d(np.intersect1d(now, following), proven)
            common = common[common > max(after, known)]
            if len(common):
                cut = int(common[len(common) // 2])
                total += int(np.count_nonzero((now >= known) & (now < cut)))
                known, begin, end, now = cut, after, stop, following
                break
            wide *= 2
    return total + int(np.count_nonzero(now >= known))


def token_counts(docs: DataFrame, *, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_bytes, n_tokens): one row per row of ``docs``, in one pass without a shuffle.

    Counts are those of the tokenizer file's own encoding of the whole text, without added special tokens, special
    strings inside texts as by default. Texts up to ``chunk`` characters are encoded piece by piece between proven
    boundaries, each distinct piece once per worker; longer ones by ``spliced_count``. Null and empty texts have
    no bytes and no tokens; null ids stay; repeated rows each get a row; other columns play no part.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = []
            for part in runs(b.column(1)):
                texts = part.to_numpy(zero_copy_only=False).tolist()
                made = piecewise_counts([t if len(t) <= chunk else "" for t in texts], path)
                for i, t in enumerate(texts):
                    if len(t) > chunk:
                        made[i] = spliced_count(t, path, chunk, overlap)
                counts.append(made)
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(np.concatenate([np.empty(0, np.int64), *counts]))], names=["id", "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "id long, n_bytes long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op10: doc_id, n_bytes, n_tokens, over_limit of every document."""
    made = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
