import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import packing, tokens

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.text(alphabet=" \n\tabAB.,'1é日 ́\x1c<|>", max_size=80)


def encode(path, text):
    return tokens.load(path).encode(text, add_special_tokens=False).ids


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_pieces_count_as_the_whole(text):
    assert tokens.piecewise_counts([text, "", text + "\0"], BYTES).tolist() == [len(encode(BYTES, t)) for t in (text, "", text + "\0")]


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_splicing(text):
    assert tokens.spliced_count(text, BYTES, 12, 3) == len(encode(BYTES, text))


def test_special_strings_and_no_boundaries():
    for text in ("a <|endoftext|> b<|endoftext|>c " * 50, "x" * 5000, "日本語" * 700, "a  b " * 400):
        assert tokens.spliced_count(text, BYTES, 256, 16) == len(encode(BYTES, text))


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_word_ids(text):
    assert [ids.tolist() for ids in packing.token_ids(pa.array(["", text]), WORDS)] == [[], encode(WORDS, text)]


def test_memo_keeps_what_is_used_and_forgets_the_rest():
    memo, made = tokens.Memo(3), []
    make = lambda keys: made.extend(keys) or [k.upper() for k in keys]
    for _ in range(5):
        assert memo.values(["a", "b"], make) == ["A", "B"]
        assert memo.values(["c", "d", "x" * 100], make) == ["C", "D", "X" * 100]
    assert made.count("a") == 1 and made.count("x" * 100) == 5
    for i in range(50):
        memo.values([f"k{i}"], make)
    assert len(memo.young) + len(memo.old) <= 10 and memo.values(["a"], make) == ["A"] and made.count("a") == 2


def test_long_real_texts_are_spliced(spark, small):
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert all(tokens.spliced_count(t, BYTES, 512, 64) == len(encode(BYTES, t)) for t in texts)
    long = "\n".join(texts)
    assert len(long) > 4 * tokens.CHUNK and tokens.spliced_count(long, BYTES) == len(encode(BYTES, long))
    docs = spark.createDataFrame([(1, long), (2, long[:100])], "doc_id long, text string")
    assert {r["id"]: r["n_tokens"] for r in tokens.token_counts(docs).collect()} == {1: len(encode(BYTES, long)), 2: len(encode(BYTES, long[:100]))}


def test_counts_of_odd_rows(odd, none):
    rows = tokens.token_counts(odd, chunk=5000).collect()
    texts = odd.select("doc_id", "text").collect()
    assert sorted((r["id"] or -1, r["n_bytes"], r["n_tokens"]) for r in rows) == sorted((t["doc_id"] or -1, len((t["text"] or "").encode()), len(encode(BYTES, t["text"] or ""))) for t in texts)
    assert tokens.token_counts(none).count() == 0


def check_packing(pieces, texts, capacity):
    documents = sorted(np.array([*encode(WORDS, t or ""), 1], "<u4").tobytes() for t in texts)
    by_sequence, by_document = {}, {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_document.setdefault((r["id"], r["doc_tokens"]), []).append(r)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at <= capacity
    assert sum(r["length"] for r in pieces) == sum(len(d) // 4 for d in documents)
    return by_document, len(by_sequence)


def test_packing_odd_rows(odd, none):
    pieces = packing.pack(odd.coalesce(1), capacity=64).collect()
    check_packing(pieces, [r["text"] for r in odd.collect()], 64)
    assert packing.pack(none).count() == 0


def test_packing_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_document, sequences = check_packing(packing.pack(docs).collect(), texts.values(), 2048)
    for (doc, total), rows in by_document.items():
        ids = b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["start"]))
        assert np.frombuffer(ids, "<u4").tolist() == [*encode(WORDS, texts[doc]), 1] and len(ids) == 4 * total
    total = sum(t for _, t in by_document)
    assert sequences <= total // 2048 + 8
    first = packing.query(spark, small).orderBy("doc_id", "start").first()
    assert first["ids_crc32"] == zlib.crc32(np.array([*encode(WORDS, texts[0]), 1], "<u4")[: first["length"]].tobytes())
