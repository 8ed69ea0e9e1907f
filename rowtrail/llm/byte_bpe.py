"""Byte-level BPE through a sentencepiece model written directly from a rank file.

The model holds one piece per vocabulary entry. A piece's bytes are mapped to printable characters, one
character a byte, and its score is its negative rank, so that the library joins the pair of lowest rank
first, leftmost on ties. The text is normalised by nothing. Each match of the split pattern is encoded on
its own; decoding maps ids back to their bytes.

Cases: a null text counts as empty; an empty text has no ids; repeated rows give repeated rows; text of any
length is encoded whole, row by row; other columns of the input play no part.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.llm.common import small_batches

#: Pre-tokens whose ids a worker remembers; when full, it starts afresh.
MEMORY = 300_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which have no gaps."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[rank] for rank in range(len(tokens))]


def byte_characters() -> list[str]:
    """A distinct printable character for each byte value: Latin-1 letters and signs stay, others go behind them."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(value) if value in plain else chr(next(others)) for value in range(256)]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, content: bytes | int | float) -> bytes:
    if isinstance(content, bytes):
        return _varint(number << 3 | 2) + _varint(len(content)) + content
    if isinstance(content, float):
        return _varint(number << 3 | 5) + struct.pack("<f", content)
    return _varint(number << 3) + _varint(content)


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model as bytes: ids are the ranks; one unknown piece, never produced, comes last."""
    mapped = byte_characters()
    # Fixed: field numbers and values of the public model format.
    pieces = [_field(1, _field(1, "".join(mapped[b] for b in token).encode()) + _field(2, float(-rank))) for rank, token in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"\x20unknown\x20") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens)) + _field(41, (1 << 64) - 1) + _field(42, (1 << 64) - 1) + _field(43, (1 << 64) - 1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = tokens
        self.split = regex.compile(pattern).findall
        self.mapped = {value: character for value, character in enumerate(byte_characters())}
        self.known: dict[str, bytes] = {}

    def learn(self, fresh: list[str]) -> None:
        """Encode pre-tokens not met before, all in one call of the library."""
        written = [token.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.mapped) for token in fresh]
        for token, ids in zip(fresh, self.processor.encode(written, num_threads=1), strict=True):
            self.known[token] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.split(text)
        distinct = set(parts)
        if len(self.known) + len(distinct) > MEMORY:
            self.known.clear()
        if fresh := [token for token in distinct if token not in self.known]:
            self.learn(fresh)
        return b"".join(map(self.known.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _shipped(spark: SparkSession, path: str):
    """The model is as large as the rank file, whatever the corpus; workers get it by broadcast."""
    tokens = read_ranks(path)
    return spark.sparkContext.broadcast((serialise(tokens), tokens))


def encode_column(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """Token ids of each text as an array of integers."""
    small_batches(spark)
    shipped = _shipped(spark, path)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(*shipped.value, pattern)
        for texts in batches:
            yield pd.Series([np.frombuffer(codec.encode(text or ""), "<u4").astype("int32") for text in texts], index=texts.index, dtype=object)

    return ids(text)


def decode_column(spark: SparkSession, ids: Column, path: str) -> Column:
    """The bytes that each array of token ids stands for; null for null."""
    small_batches(spark)
    shipped = _shipped(spark, path)

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = shipped.value[1]
        for arrays in batches:
            yield pd.Series([None if row is None else b"".join(tokens[i] for i in row) for row in arrays], index=arrays.index, dtype=object)

    return decoded(ids)


def round_trip(spark: SparkSession, documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text in one pass: count and digest of the ids, digest of the decoded bytes."""
    small_batches(spark)
    shipped = _shipped(spark, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(*shipped.value, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                ids = codec.encode(text or "")
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", digests("text").alias("coded")).select("doc_id", "coded.*")
