"""Documents as one stream of token ids in compressed blocks that can be read from any place, in parallel.

Documents are dealt out by ranges of their id, so that partition after partition holds them in order. Each task writes the ids of its part of the
stream (a shard) as blocks of 2^19 plain ids; no task holds more than one block and a few MB of documents. All ids are counted from these, for the frequency
table that all blocks share, and each block is coded by :mod:`rowtrail.llm.rans`. The plain blocks then go. Texts are split and encoded once.

The stream is a folder of Parquet tables: ``table`` (symbol, count), ``blocks`` (one row a block: shard, block, first, tokens, payload,
documents) and ``shards`` (shard, tokens, first). ``payload`` is a whole block with its own head, checkpoints and checksums. ``documents`` says
which documents lie in the block: doc_id, start in the shard, number of ids. Blocks depend on nothing but the table, so any number of tasks
can read them, and a few ids are read from the nearest checkpoint.

Cases: a null or empty text is its end id alone; documents without an id come first; rows that share an id are ordered by a hash of
their text, and alike in all where their text is equal too; long texts run over several blocks; an empty table gives an empty stream; other columns do not matter.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowtrail.llm import rans
from rowtrail.llm.common import forget, small_batches, small_or_shuffled
from rowtrail.session import run_folder

END_ID = 1
#: Pieces of text in each of the two generations that a worker remembers.
MEMORY = 300_000
#: Texts that a worker splits at once.
BATCH_BYTES = 8 << 20
#: Fixed: letters of one and two bytes that stay single letters in lower case.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc9][\x80-\xbf])+")
_BLOCKS = "shard int, block int, first long, tokens int, payload binary, documents array<struct<doc_id:bigint,start:bigint,tokens:bigint>>"
_BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("tokens", pa.int32()), ("payload", pa.binary()),
    ("documents", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("tokens", pa.int64())])))])


def _classes() -> np.ndarray:
    """What each byte of lower-cased text is: 0 white space, 1 letter or part of a character beyond ASCII, 2 digit, 3 other."""
    found = np.full(256, 3, "uint8")
    found[list(b" \t\n\x0b\x0c\r")] = 0
    found[list(range(ord("a"), ord("z") + 1)) + list(range(128, 256))] = 1
    found[list(range(ord("0"), ord("9") + 1))] = 2
    return found


def _piece_starts(text: np.ndarray, classes: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Where pieces begin in lower-cased texts that lie one behind the other.

    Fixed: the pattern of the vocabulary, for ASCII and Latin letters: a contraction, a run of letters, one digit, or a run of other characters. Text
    between white space that has other characters stays in one piece, which the tokenizer splits. White space is a piece without ids.
    """
    n, kind = len(text), classes[text]
    begins = np.ones(n + 1, "bool")
    begins[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begins[documents] = True
    # 's 't 'm 'd 're 've 'll, where the apostrophe begins a piece and letters follow it at once
    marks = np.nonzero(text == ord("'"))[0]
    marks = marks[begins[marks] & (marks + 1 < n)]
    marks = marks[begins[marks + 1] & (kind[marks + 1] == 1)]
    if len(marks):
        within = np.zeros(n + 1, "bool")
        within[documents] = True
        marks = marks[~within[marks + 1]]
        padded = np.concatenate([text, np.zeros(3, "uint8")])
        first, second = padded[marks + 1], padded[marks + 2]
        size = np.where(np.isin(first, list(b"stmd")), 1, 0)
        for letters in (b"re", b"ve", b"ll"):
            size[(first == letters[0]) & (second == letters[1]) & ~within[np.minimum(marks + 2, n)]] = 2
        marks, size = marks[size > 0], size[size > 0]
        begins[marks + 1] = False
        begins[marks + 1 + size] = True
    wide = text >= 128
    if wide.any():
        # Letters of two bytes, U+00C0 to U+027F, need no care but for two signs among them and for one that lower case parts in two.
        lead = (text >= 0xC3) & (text <= 0xC9)
        after = np.append(text[1:], 0)
        lead &= ~((text == 0xC3) & ((after == 0x97) | (after == 0xB7))) & ~((text == 0xC4) & (after == 0xB0))
        wide &= ~lead
        wide[1:] &= ~lead[:-1]
    if wide.any():
        spaces = kind == 0
        # Chunks between white space, and whether they have such a character
        edges = np.zeros(n, "bool")
        edges[1:] = spaces[1:] != spaces[:-1]
        edges[0] = True
        edges[documents[documents < n]] = True
        heads = np.nonzero(edges)[0]
        has = np.logical_or.reduceat(wide, heads)
        begins[:n] &= edges | ~np.repeat(has, np.diff(heads, append=n))
    return np.nonzero(begins[:n])[0]


class Pieces:
    """The tokenizer of one worker, over pieces of text.

    The vocabulary drops white space, and no merge, composition or pattern of its reaches across it or across pieces, so a text's ids are those of
    its pieces, one after the other. The ids of pieces met lately are remembered in two generations. Strings of special tokens are ordinary text.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Fixed: how the vocabulary marks the ends of words.
        self.largest = max(vocabulary.values())
        self.ending = np.zeros(self.largest + 1, "bool")
        self.ending[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.classes = _classes()
        self.lower = np.frombuffer(bytes(range(256)).lower(), "uint8")
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces as little-endian 32-bit integers."""
        if len(self.recent) > MEMORY:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        fresh = [piece for piece in pieces if piece not in recent and recent.setdefault(piece, older.get(piece)) is None]
        plain = [piece for piece in fresh if (piece.isascii() and not piece.isspace()) or LETTERS.fullmatch(piece)]
        for start in range(0, len(plain), 1024):
            # Such a piece is one word to the tokenizer, and ends with an id that ends a word.
            part = plain[start : start + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.nonzero(self.ending[ids])[0] + 4).tolist()
            if len(ends) != len(part):
                raise ValueError("a piece of text is not one word of the tokenizer")
            raw, begin = ids.tobytes(), 0
            for piece, end in zip(part, ends, strict=True):
                recent[piece] = raw[begin:end]
                begin = end
        for piece in fresh:
            if recent[piece] is None:
                recent[piece] = np.array(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return [self.recent[piece] for piece in pieces]

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of a column of binary texts: which distinct piece each piece is, the first piece of each text and the end, and the ids of the distinct pieces."""
        texts = texts.cast(pa.large_binary())
        whole = pa.concat_arrays([texts.fill_null(b"")])
        places = np.frombuffer(whole.buffers()[1], "int64", len(whole) + 1, whole.offset * 8)
        data = self.lower[np.frombuffer(whole.buffers()[2] or b"", "uint8")[places[0] : places[-1]]]
        places = places - places[0]
        if not len(data):
            return np.empty(0, "int64"), np.zeros(len(texts) + 1, "int64"), []
        starts = _piece_starts(data, self.classes, places)
        offsets = np.append(starts, len(data)).astype("int64")
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        return pieces.indices.to_numpy(), np.searchsorted(starts, places), self.ids_of(pieces.dictionary.to_pylist())

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and how many each has."""
        which, firsts, known = self.split(texts)
        sizes = np.fromiter((len(x) // 4 for x in known), "int64", len(known))
        flat, begins = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        lengths = sizes[which]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(begins[which] - before[:-1], lengths) + np.arange(before[-1])]
        counts = np.diff(before[firsts])
        return np.insert(ids, before[firsts[1:]], end_id).astype("<u4"), counts + 1


class Vocabulary:
    """What is sent to workers: the tokenizer's file. A worker makes its tokenizer once, and keeps the pieces it remembers from task to task."""

    def __init__(self, model: str):
        self.model = model
        self._pieces: Pieces | None = None

    def __getstate__(self) -> dict:
        return {"model": self.model, "_pieces": None}

    @property
    def pieces(self) -> Pieces:
        if self._pieces is None:
            self._pieces = Pieces(self.model)
        return self._pieces


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have a few MB, so that pieces repeat in them."""
    waiting, size = [], 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.nbytes
        if size >= BATCH_BYTES:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _symbol_counts(blocks: DataFrame, kind: str) -> DataFrame:
    """How often each id occurs in plain blocks: (symbol, count). A task sends one row for each id it met."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, "int64")
        for batch in batches:
            for payload in batch.column(0):
                seen = np.bincount(np.frombuffer(payload.as_buffer(), kind), minlength=len(total))
                seen[: len(total)] += total
                total = seen
        symbols = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.int64()), pa.array(total[symbols], pa.int64())], ["symbol", "count"])

    return blocks.select("payload").mapInArrow(counted, "symbol long, count long").groupBy("symbol").agg(F.sum("count").alias("count"))


class _Writer:
    """The plain blocks of one shard."""

    def __init__(self, shard: int, kind: str):
        self.shard, self.kind = shard, kind
        self.block = self.first = self.buffered = 0
        self.parts: list[np.ndarray] = []
        self.documents: list[dict] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.documents.append({"doc_id": doc_id, "start": self.first + self.buffered, "tokens": len(ids)})
        while self.buffered + len(ids) >= rans.BLOCK_SYMBOLS:
            taken = rans.BLOCK_SYMBOLS - self.buffered
            self.parts.append(ids[:taken])
            ids = ids[taken:]
            yield self.flush()
        self.parts.append(ids)
        self.buffered += len(ids)

    def flush(self) -> pa.RecordBatch:
        symbols = np.concatenate(self.parts)
        row = {"shard": self.shard, "block": self.block, "first": self.first, "tokens": len(symbols), "payload": symbols.astype(self.kind).tobytes(), "documents": self.documents}
        self.block, self.first, self.buffered, self.parts = self.block + 1, self.first + len(symbols), 0, []
        # The last document goes on in the next block unless it has just ended.
        self.documents = [d for d in self.documents[-1:] if d["start"] + d["tokens"] > self.first]
        return pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)


def write_stream(spark: SparkSession, documents: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents (doc_id, text), in ascending order of doc_id, to a new folder.

    A shard is a partition of the range shuffle: their number is the session's, their bounds come from Spark's sample of the ids, and rows that
    share one id and text may be dealt to several.
    """
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(Vocabulary(file.read()))
    kind = "<u2" if max(end_id, vocabulary.value.pieces.largest) < 1 << 16 else "<u4"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in _larger(batches):
            if writer is None:
                writer = _Writer(batch.column(0)[0].as_py(), kind)
            ids, counts = vocabulary.value.pieces.encode(batch.column(2), end_id)
            for doc_id, own in zip(batch.column(1).to_pylist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                yield from writer.add(doc_id, own)
        if writer is not None and writer.buffered:
            yield writer.flush()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie").select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    plain = run_folder(spark, "plain-blocks")
    ordered.mapInArrow(written, _BLOCKS).write.option("compression", "zstd").parquet(plain)
    blocks = spark.read.schema(_BLOCKS).parquet(plain)
    _symbol_counts(blocks, kind).write.parquet(f"{path}/table")
    shipped = spark.sparkContext.broadcast(_read_table(spark, path))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(*shipped.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                payload = rans.encode(np.frombuffer(row.column(4)[0].as_buffer(), kind), table)
                yield row.set_column(4, "payload", pa.array([payload], pa.binary()))

    blocks.mapInArrow(coded, _BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    forget(spark, plain)
    sizes = read_blocks(spark, path).groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard: partitions of a shuffle, whatever the corpus
    sizes.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{path}/shards")


def _read_table(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray, int]:
    """At most one row for each id of the vocabulary."""
    rows = spark.read.schema("symbol long, count long").parquet(f"{path}/table").collect()
    table = rans.Table.of_counts({r["symbol"]: r["count"] for r in rows})
    return table.symbols, table.frequencies, table.bits


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard int, tokens long, first long").parquet(f"{path}/shards")


def crc_shifted(crc: int, zeros: int) -> int:
    """What a CRC-32 becomes when ``zeros`` bytes follow, so that crc(a + b) = crc_shifted(crc(a), len(b)) xor crc(b)."""
    def times(a: int, b: int) -> int:
        product = 0
        for _ in range(32):
            if a & 0x80000000:
                product ^= b
            a = a << 1 & 0xFFFFFFFF
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return product

    power = 0x00800000  # x^8, in the reflected order of bits
    while zeros:
        if zeros & 1:
            crc = times(crc, power)
        power = times(power, power)
        zeros >>= 1
    return crc


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Every document as the files have it: doc_id, start in the whole stream, n_tokens, CRC-32 of its ids as little-endian 32-bit integers.

    Each block is decoded by itself. A document in several blocks gets a share of its CRC from each, and shares combine by exclusive or, in any order.
    """
    shipped = spark.sparkContext.broadcast(_read_table(spark, path))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(*shipped.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids, first = rans.decode(row["payload"], table).astype("<u4"), row["first"]
                if len(ids) != row["tokens"]:
                    raise rans.DamagedBlock("the block has another number of ids")
                out = []
                for d in row["documents"]:
                    end = d["start"] + d["tokens"]
                    here = ids[max(0, d["start"] - first) : end - first]
                    rest = max(0, end - first - len(ids))
                    crc = zlib.crc32(here.tobytes())
                    out.append((row["shard"], d["doc_id"], d["start"], d["tokens"], len(here), crc_shifted(crc, 4 * rest) if rest else crc))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), *[pa.int64()] * 5), strict=True)], ["shard", "doc_id", "start", "n_tokens", "here", "crc"])

    found = read_blocks(spark, path).mapInArrow(shares, "shard int, doc_id long, start long, n_tokens long, here long, crc long")
    whole = found.groupBy("shard", "start", "doc_id", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("here").alias("here"))
    checked = F.when(F.col("here") == F.col("n_tokens"), F.col("ids_crc32")).otherwise(F.raise_error(F.lit("a block of the stream is missing")).cast("long"))
    shards = small_or_shuffled(read_shards(spark, path).select("shard", "first"))
    return whole.join(shards, "shard").select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", checked.alias("ids_crc32"), "shard")


def read_window(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Ids ``first`` to ``last`` (exclusive) of the whole stream, one row for each block that holds some: (start, ids).

    Only shards and blocks in the window are opened, and of a block only what lies behind the nearest checkpoint is decoded.
    """
    shipped = spark.sparkContext.broadcast(_read_table(spark, path))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(*shipped.value)
        for batch in batches:
            for row in batch.to_pylist():
                begin = max(first, row["start"])
                ids = rans.decode(row["payload"], table, begin - row["start"], last - row["start"])
                yield pa.RecordBatch.from_arrays([pa.array([begin], pa.int64()), pa.array([ids.astype("int64")], pa.list_(pa.int64()))], ["start", "ids"])

    shards = read_shards(spark, path).filter((F.col("first") < last) & (F.col("first") + F.col("tokens") > first)).select("shard", F.col("first").alias("before"))
    start: Column = F.col("before") + F.col("first")
    held = read_blocks(spark, path).select("shard", "first", "tokens", "payload").join(small_or_shuffled(shards), "shard")
    return held.filter((start < last) & (start + F.col("tokens") > first)).select(start.alias("start"), "payload").mapInArrow(cut, "start long, ids array<long>")
