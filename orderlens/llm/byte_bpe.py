"""Byte-level BPE encoding and decoding through a sentencepiece model.

A rank file (token bytes in base64, rank) is turned into a sentencepiece BPE model
without any training: every token's bytes become a piece of one printable character
per byte, its score is the negative rank, and normalisation is the identity. Byte
pairs then merge in rank order. Texts are cut into pre-tokens by the tokenizer's
pattern; each pre-token is encoded by itself (a pre-token that is a token as a whole
is that token). Decoding maps ids back to their bytes.

The model is serialised on the driver and travels in the closure of the function; its
size is that of the vocabulary file. A worker keeps encoded pre-tokens in a cache of
at most ``CACHE_ENTRIES``.

Edge cases: null and empty texts have no tokens; very long texts are encoded whole;
equal rows get equal ids; extra columns stay, those named like a result are replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from orderlens.llm.common import quoted, ship_package, with_results
from orderlens.llm.textscan import release_memory

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_ENTRIES = 150_000
#: Texts are taken together up to about so many pre-tokens.
PRE_TOKENS_HELD = 200_000

_SPACE_MARK = "▁"


def byte_characters() -> str:
    """256 different characters, one per byte: printable latin bytes stand for
    themselves, the others follow from U+0100 on in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in own else chr(next(others)) for b in range(256))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a sentencepiece BPE model; ids are the ranks, then <unk>."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    letters = byte_characters()
    model = model_pb2.ModelProto()
    spec = model.trainer_spec
    spec.model_type = model_pb2.TrainerSpec.BPE
    spec.vocab_size = len(tokens) + 1
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(tokens), -1, -1, -1
    spec.split_by_whitespace = spec.split_by_unicode_script = spec.split_by_number = False
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    for rank, token in enumerate(tokens):
        model.pieces.add(piece=token.decode("latin-1").translate(letters), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=model_pb2.ModelProto.SentencePiece.UNKNOWN)
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, model: bytes, pattern: str) -> None:
        self.model, self.pattern = model, pattern
        self.find = regex.compile(pattern).findall
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.letters = byte_characters()
        back = {ord(c): b for b, c in enumerate(self.letters)}
        n = self.pieces.get_piece_size() - 1
        self.token = [self.pieces.id_to_piece(i).translate(back).encode("latin-1") for i in range(n)]
        self.rank = {t: i for i, t in enumerate(self.token)}
        self.number = list(range(n))  # one object per id, whatever the cache holds
        self.decimal = [str(i) for i in range(n)]
        self.cache: dict[str, tuple[int, ...]] = {}

    def encode(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The ids of each text. New pre-tokens of some texts are encoded together."""
        found, held = [], 0
        for text in texts:
            found.append(self.find(text or ""))
            held += len(found[-1])
            if held >= PRE_TOKENS_HELD:
                yield from self._ids(found)
                found, held = [], 0
        yield from self._ids(found)

    def _ids(self, found: list[list[str]]) -> Iterator[list[int]]:
        cache, rank = self.cache, self.rank
        wanted = set(chain.from_iterable(found))
        missing = [p for p in wanted if p not in cache]
        if len(cache) + len(missing) > CACHE_ENTRIES:
            cache.clear()
            missing = list(wanted)
        raw = [p.encode() for p in missing]
        mapped = self.pieces.encode([r.decode("latin-1").translate(self.letters) for r in raw], num_threads=1)
        for p, r, ids in zip(missing, raw, mapped):
            cache[p] = (rank[r],) if r in rank else tuple(map(self.number.__getitem__, ids))
        for pre_tokens in found:
            yield list(chain.from_iterable(map(cache.__getitem__, pre_tokens)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(model: bytes, pattern: str) -> Codec:
    """One codec a worker process."""
    return Codec(model, pattern)


_DIGEST = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
     T.StructField("decoded_sha256", T.StringType())]
)


def _functions(path: str, pattern: str):
    model = serialised_model(read_ranks(path))

    def encode(texts: pa.Array) -> pa.Array:
        c = codec(model, pattern)
        return pa.array(list(c.encode(t.as_py() for t in texts)), pa.list_(pa.int32()))

    def decode(ids: pa.Array) -> pa.Array:
        c = codec(model, pattern)
        return pa.array([None if x is None else c.decode(x) for x in ids.to_pylist()], pa.binary())

    def digest(texts: pa.Array) -> pa.Array:
        c = codec(model, pattern)
        counts, ids_sha, decoded_sha = [], [], []
        for ids in c.encode(t.as_py() for t in texts):
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
            decoded_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
        release_memory()
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return encode, decode, digest


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``ids`` (array of int)."""
    ship_package(docs.sparkSession)
    run, _, _ = _functions(path or public_tokenizers.path(VOCABULARY), pattern)
    udf = F.arrow_udf(run, T.ArrayType(T.IntegerType()))
    return with_results(docs, {"ids": udf(quoted(text_col).cast("string"))})


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``encoded`` with ``decoded`` (binary), the bytes of the ids."""
    ship_package(encoded.sparkSession)
    _, run, _ = _functions(path or public_tokenizers.path(VOCABULARY), pattern)
    udf = F.arrow_udf(run, T.BinaryType())
    return with_results(encoded, {"decoded": udf(quoted(ids_col))})


def round_trip(docs: DataFrame, text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: every text is
    encoded and decoded again in one pass; ids and bytes stay in the worker."""
    ship_package(docs.sparkSession)
    _, _, run = _functions(path or public_tokenizers.path(VOCABULARY), pattern)
    udf = F.arrow_udf(run, _DIGEST)
    found = docs.select("*", udf(quoted(text_col).cast("string")).alias("__digest"))
    return with_results(found, {f.name: F.col("__digest")[f.name] for f in _DIGEST.fields}).drop("__digest")
