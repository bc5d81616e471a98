import hashlib

import public_tokenizers
import pytest
import tiktoken

from orderlens.llm import byte_bpe

TEXTS = [
    None, "", " ", "   \n\n\t ", "Hello world, it's we'll don't", "Größe ñandú été çà 漢字 🎉🎉 ½ Ⅷ ²", "\x00\x01\x7f nul", "▁ <unk> <s> </s> <0x41> ▁▁a",
    "a" * 5000, "word " * 30_000, "1234567890 12 345", "​  x\r\n\r\ny", "Hello world, it's we'll don't",
]


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_equals_tiktoken_and_round_trips(frame, name):
    path = public_tokenizers.path(name)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    df = frame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in byte_bpe.decode(byte_bpe.encode(df, path=path), path=path).collect()}
    short = {r.doc_id: r for r in byte_bpe.round_trip(df, path=path).collect()}
    for i, text in enumerate(TEXTS):
        ids = enc.encode_ordinary(text or "")
        assert got[i].ids == ids and bytes(got[i].decoded) == (text or "").encode()
        assert short[i].n_tokens == len(ids)
        assert short[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_real_documents(docs):
    enc = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY)), special_tokens={}
    )
    got = {r.doc_id: r.ids for r in byte_bpe.encode(docs).select("doc_id", "ids").collect()}
    assert all(got[r.doc_id] == enc.encode_ordinary(r.text or "") for r in docs.collect())


def test_small_cache_changes_nothing(monkeypatch):
    model = byte_bpe.serialised_model(byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY)))
    want = list(byte_bpe.Codec(model, public_tokenizers.PATTERN).encode(TEXTS))
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(byte_bpe, "PRE_TOKENS_HELD", 2)
    assert list(byte_bpe.Codec(model, public_tokenizers.PATTERN).encode(TEXTS)) == want


def test_clashing_columns_empty_table_and_gaps(spark, frame):
    df = frame([(1, "text", "mine", "x")], "doc_id long, text string, ids string, n_tokens string")
    assert dict(byte_bpe.encode(df).dtypes)["ids"] == "array<int>"
    out = byte_bpe.round_trip(df)
    assert dict(out.dtypes)["n_tokens"] == "bigint" and out.collect()[0]["ids"] == "mine"
    assert byte_bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        byte_bpe.serialised_model({b"a": 0, b"b": 2})
