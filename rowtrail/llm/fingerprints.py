"""Lempel-Ziv phrase fingerprints of documents, and each document's likeness to its successor.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the shortest run not yet in the dictionary, and is
then entered. The set of phrases is hashed, and of each of ``BINS`` parts of the hash range the least hash is kept.
The share of bins in which two signatures agree estimates how many phrases two texts share, which is what makes one
compress well given the other.

Cases: a null text counts as empty; an empty text has an empty signature, like only another empty one (1.0); equal texts
have equal signatures; a text of any length is parsed whole with one dictionary, which takes memory in proportion to that one text and goes with it.
The successor of a document is the next by descending id, null ids last, rows of one id by a
hash of their text; the last one's successor is the first, so a lone row succeeds itself. Other columns play no part.

Skew: documents are walked through in runs of neighbours. An id that many rows share, or none, is cut into runs by the hash of the text.
"""

from __future__ import annotations

import gc
import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtrail.llm.common import small_batches

BINS = 128
#: Stands for an empty bin in a signature.
NOTHING = 0x10000
#: Documents in a run of neighbours that one task walks through, until there are ``MAX_CUTS`` quantiles of the ids with ``SPLIT`` runs between two of them.
RUN_ROWS = 256
MAX_CUTS = 4096
SPLIT = 8
#: Runs that one id, or the rows without one, may be cut into, as a power of two.
MAX_BITS = 15

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Code points fed at once; a longer text is parsed on in further steps.
STEP = 1 << 20
_BASE = 0x100000001B3  # fixed odd base of the phrase hash


class Parse:
    """A parse under way. The dictionary is a tree of dicts; a text may be fed in parts, or tried out and taken back."""

    def __init__(self):
        self.root: dict = {}
        self.node, self.open = self.root, b""
        self.least = np.full(BINS, _EMPTY)

    def feed(self, text: str, log: list | None = None) -> Parse:
        """Parse on; ``log`` gets the nodes that something was entered in, in order, so that it can be taken out again."""
        for at in range(0, len(text), STEP):
            self._feed(text[at:at + STEP].encode("utf-8", "surrogatepass"), log)
        return self

    def _feed(self, content: bytes, log: list | None) -> None:
        root, node = self.root, self.node
        ends: list[int] = []
        end = ends.append
        for place, byte in enumerate(content, len(self.open) + 1):
            if byte in node:
                node = node[byte]
            else:
                node[byte] = {}
                if log is not None:
                    log.append(node)
                end(place)
                node = root
        self.node = node
        content = self.open + content
        if ends:
            self._keep(content, np.array(ends))
            content = content[ends[-1]:]
        self.open = content

    def _keep(self, content: bytes, ends: np.ndarray) -> None:
        """Hash the phrases by sums over their bytes and keep the least hash of each bin."""
        powers, inverses = _powers(len(content) + 1)
        values = (np.frombuffer(content, np.uint8).astype(np.uint64) + np.uint64(1)) * powers[:len(content)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        starts = np.concatenate([[0], ends[:-1]])
        mixed = (sums[ends] - sums[starts]) * inverses[starts]
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(factor)
        mixed.sort()
        bins = (mixed >> np.uint64(64 - (BINS.bit_length() - 1))).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        self.least[bins[first]] = np.minimum(self.least[bins[first]], mixed[first])

    def signature(self) -> np.ndarray:
        """Sixteen bits of the least hash of each bin, one more than these can hold where a bin is empty."""
        return np.where(self.least == _EMPTY, NOTHING, self.least & np.uint64(0xFFFF)).astype(np.int32)

    def signature_with(self, text: str) -> np.ndarray:
        """The signature as if ``text`` followed what was fed; afterwards all is as before."""
        state, least, log = (self.node, self.open), self.least.copy(), []
        found = self.feed(text, log).signature()
        for node in reversed(log):
            node.popitem()  # the last one entered
        (self.node, self.open), self.least = state, least
        return found


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, kept and grown by doubling."""
    if not _TABLES or len(_TABLES[0][0]) < size:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
            tables.append(out)
        _TABLES[:] = [(tables[0], tables[1])]
    return _TABLES[0]


@contextmanager
def no_cycle_search():
    """The dictionaries are trees of very many dicts without a cycle: they go by their counts, and searching them for cycles again and again finds nothing."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def signature(text: str) -> np.ndarray:
    return Parse().feed(text).signature()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins filled in either signature that agree; 1 for two empty ones."""
    filled = (a != NOTHING) | (b != NOTHING)
    return float((a == b)[filled].mean()) if filled.any() else 1.0


def written(values: np.ndarray) -> str:
    """A signature as text: four hex digits a bin, ``----`` for an empty one."""
    return "".join("----" if value == NOTHING else f"{value:04x}" for value in values.tolist())


def cut_points(ids: DataFrame) -> tuple[list[float], dict[float, int], int]:
    """Where the ids (a column ``place`` of doubles) are cut into runs, the ids that get several runs of their own, and how many rows without an id do; both as powers of two."""
    rows, named = ids.agg(F.count(F.lit(1)), F.count("place")).first()
    wanted = math.ceil(named / RUN_ROWS)
    coarse = min(MAX_CUTS, wanted)
    quantiles = sorted(ids.filter("place IS NOT NULL").approxQuantile("place", [i / coarse for i in range(1, coarse)], 1 / (4 * coarse))) if coarse > 1 else []
    between = min(SPLIT, math.ceil(wanted / coarse)) if coarse else 1
    cuts = {low + (high - low) * k / between for low, high in zip(quantiles, quantiles[1:]) for k in range(between)} | set(quantiles)
    # Several quantiles on one id: it gets [id, id + 1) to itself. Beyond 2^53 a double may stand for several ids, and they stay together.
    shared = {place: min(MAX_BITS, (n * between - 1).bit_length()) for place, n in Counter(quantiles).items() if n > 1 and abs(place) < 1 << 53}
    return sorted(cuts | {place + 1 for place in shared}), shared, min(MAX_BITS, max(0, math.ceil((rows - named) / RUN_ROWS) - 1).bit_length())


def runs(documents: DataFrame) -> DataFrame:
    """Rows dealt in runs of neighbours by descending id: (run, guest, doc_id, tie, text).

    Each run ends with a guest, a copy of the first row of the following run, so that a run can be walked through
    without its neighbour. Runs are cut at quantiles of the ids, which are narrow to read, and evenly between these; only the runs'
    first rows, whose number the constants bound, are collected. Texts are moved once.
    """
    spark = documents.sparkSession
    cuts, shared, bits = cut_points(documents.select(F.col("doc_id").cast("double").alias("place")))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = texts.withColumns({"place": F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)), "tie": F.xxhash64("text")})
    slots = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="place", outputCol="slot").transform(placed) if cuts else placed.withColumn("slot", F.lit(0.0))
    several = spark.createDataFrame([(float(cuts.index(place) + 1), n) for place, n in shared.items()], "slot double, bits int")
    known = slots.join(F.broadcast(several), "slot", "left").withColumn("bits", F.when(F.col("doc_id").isNull(), bits).otherwise(F.col("bits")))
    # The leading bits of the hash, which also orders the rows of one id; null ids come last.
    part = F.when(F.col("bits") > 0, F.expr("shiftright(tie, 64 - bits) + shiftleft(1L, bits - 1)")).otherwise(0)
    slot = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(len(cuts) - F.col("slot").cast("int"))
    ordered = known.select((F.shiftleft(slot.cast("long"), MAX_BITS) + part).alias("own"), "doc_id", "tie", "text")
    # The greatest id, then the least tie, is a run's first row. The complement turns the order round for every long.
    firsts = sorted(ordered.groupBy("own").agg(F.min(F.struct(F.bitwise_not("doc_id").alias("back"), F.col("tie"))).alias("first")).collect())
    before = [(row["own"], None if row["first"]["back"] is None else ~row["first"]["back"], row["first"]["tie"], firsts[i - 1]["own"]) for i, row in enumerate(firsts)]
    first = spark.createDataFrame(before, "first_own long, first_id long, first_tie long, before long")
    matched = (F.col("own") == F.col("first_own")) & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    both = ordered.join(F.broadcast(first), matched, "left")
    copies = F.array_compact(F.array(
        F.struct(F.col("own").alias("run"), F.lit(False).alias("guest")), F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("run"), F.lit(True).alias("guest")))))
    return (
        both.select(F.explode(copies).alias("dealt"), "doc_id", "tie", "text").select("dealt.*", "doc_id", "tie", "text")
        .repartition("run").sortWithinPartitions("run", "guest", F.col("doc_id").desc_nulls_last(), "tie", "text"))


def compare_with_successor(documents: DataFrame) -> DataFrame:
    """Fingerprint of each whole text and of its edited form, with their likeness and the one to the next document.

    The edited form has the last third of the code points replaced by as many from the start of the next document. Both
    forms start alike, so the parse of the common part is done once.
    """
    small_batches(documents.sparkSession)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        waiting = None
        for batch in batches:
            rows = []
            with no_cycle_search():
                for run, guest, doc_id, text in zip(batch["run"], batch["guest"], batch["doc_id"], batch["text"], strict=True):
                    if guest and waiting is None:
                        continue  # a repeated row of the same first id
                    third = len(text) // 3
                    common = Parse().feed(text[:len(text) - third])
                    own = common.signature_with(text[len(text) - third:])
                    if waiting is not None:
                        last_id, last_text, last_third, last_common, last_own = waiting
                        added = text[:last_third]
                        edited = last_common.signature_with(added)
                        digest = hashlib.sha256((last_text[:len(last_text) - last_third] + added).encode("utf-8", "surrogatepass")).hexdigest()
                        rows.append((last_id, len(last_text), digest, written(last_own), written(edited), likeness(last_own, edited), likeness(last_own, own)))
                    waiting = None if guest else (None if pd.isna(doc_id) else int(doc_id), text, third, common, own)
            frame = pd.DataFrame(rows, columns=columns)
            yield frame.assign(doc_id=pd.array([row[0] for row in rows], "Int64"))

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return runs(documents).select("run", "guest", F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(walk, schema)
