"""Hard negatives by exact inner products, computed with tables of subset sums (the method of Four Russians).

Vectors are whole numbers. An anchor's components are taken in groups of eight, and for each group the sums of all 256 subsets are listed once. Candidates are
packed into bit planes: plane b of a group is one byte that says which of its eight components have bit b. The sum that a byte picks from its
group's table is what the plane adds, so an inner product is a few table lookups, doubled from plane to plane; the highest plane holds the sign
and counts negatively. Scores are exact.

Candidates are packed, label by label, into blocks of at most ``CANDIDATES`` rows; anchors into blocks of about ``ANCHORS``. The anchors are the stated queries:
each of their blocks meets each block of candidates once. A task holds its share of the candidates and reads all blocks of anchors past them, so neither side is
broadcast nor written more than once. A task keeps the best few of each anchor it has met, so what it sends grows with its anchors and not with the pairs it scored. First the positives are found among the candidates of the anchor's
label, then the negatives among the others, where each positive's score sets the band.

Cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; a shorter vector counts as filled up with zeros, an empty one
scores 0; repeated rows count once; rows that share an id but not their label and vector are rows of their own, none of which is a positive or a
negative of the others; ties go to the smaller id; a label of one row has no positives and gives no rows; an empty table gives none; other columns
do not matter. Components beyond 2^22 once scaled are refused with an error, since scores could then exceed 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtrail.llm.common import held

GROUP = 8
CANDIDATES = 2048
ANCHORS = 128
#: Blocks of anchors whose best rows a task keeps before it sends them on, and whose tables it keeps.
KEPT_BLOCKS = 512
KEPT_TABLES = 32
LIMIT = 1 << 22
_NONE = np.iinfo("int64").min


def whole_numbers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(embedding: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    broken = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(broken, F.lit(False))


def prepared(rows: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """The rows that take part, once each: (vec_id, label, vector)."""
    found = rows.filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding"))
    found = found.filter("vec_id IS NOT NULL AND label IS NOT NULL")
    large = F.exists("embedding", lambda x: F.abs(x.cast("double")) > LIMIT / scale)
    small = F.when(large, F.raise_error(F.lit(f"a component of a vector is beyond {LIMIT / scale}")).cast("array<bigint>")).otherwise(whole_numbers(F.col("embedding"), scale))
    return found.select("vec_id", "label", small.alias("vector")).dropDuplicates()


def _matrix(vectors: list[list[int]]) -> np.ndarray:
    """Vectors as rows, filled up with zeros to whole groups."""
    arrays = [np.asarray(v, "int64") for v in vectors]
    width = max((len(a) for a in arrays), default=0)
    out = np.zeros((len(arrays), -(-width // GROUP) * GROUP), "int64")
    for row, array in zip(out, arrays, strict=True):
        row[: len(array)] = array
    return out


def planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes of bit planes, [plane][group][vector], from the lowest plane to the sign's."""
    n, width = vectors.shape
    largest = int(max(vectors.max(initial=0), -vectors.min(initial=0) - 1, 0))
    bits = largest.bit_length() + 1
    grouped = vectors.reshape(n, width // GROUP, GROUP)
    return np.stack([np.packbits((grouped >> b & 1).astype("uint8"), axis=2, bitorder="little")[:, :, 0].T for b in range(bits)])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums of all subsets of each group's components, [group][subset][anchor]."""
    count, width = anchors.shape
    columns = anchors.T.reshape(width // GROUP, GROUP, count)
    sums = np.zeros((width // GROUP, 1 << GROUP, count), "int64")
    for j in range(GROUP):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + columns[:, j : j + 1]
    return sums


def scores(bytes_: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products [candidate][anchor]; components that only one side has count for nothing."""
    bits, groups, n = bytes_.shape
    largest = int(np.abs(sums).max(initial=0)) * max(1, groups) << bits
    kind = "int32" if largest < 1 << 30 else "int64"
    sums = sums.astype(kind, copy=False)
    total = np.zeros((n, sums.shape[2]), kind)
    looked = np.empty_like(total)
    for b in range(bits - 1, -1, -1):
        if b != bits - 1:
            total <<= 1
        for g in range(min(groups, len(sums))):
            np.take(sums[g], bytes_[b, g], axis=0, out=looked)
            if b == bits - 1:
                total -= looked
            else:
                total += looked
    return total


def _best(ranked: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest scores of each column with their ids; ties to the earlier row. ``_NONE`` marks what does not count."""
    n = len(ranked)
    if n and max(int(ranked.max()), -int(np.where(ranked == _NONE, 0, ranked).min())) >= (1 << 62) // n:  # score and row do not fit one number
        order = np.argsort(-(ranked + 1), axis=0, kind="stable")[:count]
        first = np.take_along_axis(ranked, order, 0)
        return first.T, np.where(first != _NONE, ids[order], 0).T
    keys = np.where(ranked == _NONE, _NONE, ranked * n + (n - 1 - np.arange(n))[:, None])
    if n > count:
        keys = np.partition(keys, n - count, axis=0)[n - count :]
    there = keys != _NONE
    return np.where(there, keys // n, _NONE).T, np.where(there, ids[n - 1 - keys % n], 0).T


def _merged(kept: tuple[np.ndarray, np.ndarray], found: tuple[np.ndarray, np.ndarray], count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` first of both along the last axis: higher scores first, then smaller ids."""
    score, ids = np.concatenate([kept[0], found[0]], -1), np.concatenate([kept[1], found[1]], -1)
    order = np.lexsort((ids, -(score + 1)), axis=-1)[..., :count]  # the least number has no negative; one more has
    return np.take_along_axis(score, order, -1), np.take_along_axis(ids, order, -1)


_BLOCK = "label long, vec_ids binary, planes binary, bits int, n int"


def candidate_blocks(rows: DataFrame) -> DataFrame:
    """Prepared rows packed by label in the order of their ids: (label, vec_ids, planes, bits, n)."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, list[int]]] = []

        def block() -> pa.RecordBatch:
            nonlocal waiting
            found = planes(_matrix([v for _, _, v in waiting]))
            row = {"label": waiting[0][1], "vec_ids": np.array([i for i, _, _ in waiting], "<i8").tobytes(), "planes": found.tobytes(), "bits": len(found), "n": len(waiting)}
            waiting = []
            return pa.RecordBatch.from_pylist([row], pa.schema([("label", pa.int64()), ("vec_ids", pa.binary()), ("planes", pa.binary()), ("bits", pa.int32()), ("n", pa.int32())]))

        for batch in batches:
            for vec_id, label, vector in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if waiting and (waiting[0][1] != label or len(waiting) >= CANDIDATES):
                    yield block()
                waiting.append((vec_id, label, vector))
        if waiting:
            yield block()

    ordered = rows.repartitionByRange("label", "vec_id").sortWithinPartitions("label", "vec_id")
    return ordered.select("vec_id", "label", "vector").mapInArrow(packed, _BLOCK)


def anchor_blocks(anchors: DataFrame) -> DataFrame:
    """Prepared anchors in blocks by a hash: (block, anchors), each anchor with its label and vector; about ``ANCHORS`` in a block."""
    blocks = -(-anchors.count() // ANCHORS) or 1
    placed = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)))
    return placed.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("vec_id", "label", "vector"))).alias("anchors"))


class _Met:
    """One block of anchors against the blocks of candidates that a task has."""

    def __init__(self, anchors: list[dict], width: tuple[int, ...]):
        self.ids = np.array([a["vec_id"] for a in anchors], "int64")
        self.labels = np.array([a["label"] for a in anchors], "int64")
        self.vectors = _matrix([a["vector"] for a in anchors])
        self.sums: np.ndarray | None = None
        self.score = np.full((len(anchors), *width), _NONE, "int64")
        self.found = np.zeros((len(anchors), *width), "int64")

    def scored(self, block: dict, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of a block's candidates for some of the anchors (none for rows of the anchor's own id), and the candidates' ids."""
        ids = np.frombuffer(block["vec_ids"], "<i8")
        bytes_ = np.frombuffer(block["planes"], "uint8").reshape(block["bits"], -1, block["n"])
        if self.sums is None:
            self.sums = subset_sums(self.vectors)
        chosen = self.sums if len(which) == len(self.ids) else self.sums[:, :, which]
        found = scores(bytes_, chosen).astype("int64")
        found[ids[:, None] == self.ids[which][None, :]] = _NONE
        return found, ids

    def keep(self, at: tuple, found: tuple[np.ndarray, np.ndarray]) -> None:
        self.score[at], self.found[at] = _merged((self.score[at], self.found[at]), found, self.score.shape[-1])


_SCORED = "block long, slot int, positive int, score long, vec_id long"


def _swept(pairs: DataFrame, width: tuple[int, ...], sweep) -> DataFrame:
    """Run ``sweep(met, row)`` on every pair of blocks, and send what each block of anchors has kept: (block, slot, positive, score, vec_id)."""
    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, _Met] = {}
        warm: list[_Met] = []

        def sent() -> Iterator[pa.RecordBatch]:
            for number, m in met.items():
                places = np.argwhere(m.score != _NONE)
                if len(places):
                    at = tuple(places.T)
                    positive = places[:, 1] if len(width) > 1 else np.zeros(len(places), "int64")
                    columns = [np.full(len(places), number, "int64"), places[:, 0].astype("int32"), positive.astype("int32"), m.score[at], m.found[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "slot", "positive", "score", "vec_id"])
            met.clear()
            warm.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names) if name != "anchors"}
                if row["block"] not in met:
                    if len(met) >= KEPT_BLOCKS:
                        yield from sent()
                    met[row["block"]] = _Met(batch.column(batch.schema.names.index("anchors"))[k].as_py(), width)
                m = met[row["block"]]
                if m.sums is None:
                    warm.append(m)
                    if len(warm) > KEPT_TABLES:
                        warm.pop(0).sums = None
                sweep(m, row)
        yield from sent()

    return pairs.mapInArrow(swept, _SCORED)


def _first(found: DataFrame, count: int) -> DataFrame:
    """The first few of each anchor (and positive), with their rank; cut on the map side."""
    order = Window.partitionBy("block", "slot", "positive").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """Hard negatives of each anchor for each of its first positives: those whose score is ``least`` to ``most`` hundredths of the positive's.

    Rows and anchors as :func:`prepared` gives them: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    """
    spark = rows.sparkSession
    blocks = held(candidate_blocks(rows), "candidate-blocks")
    queries = held(anchor_blocks(anchors), "anchor-blocks")

    def meet(asked: DataFrame, condition: str) -> DataFrame:
        # The right side's share lies in a task's memory (and spills) while the left side passes; the hint keeps either from being broadcast.
        dealt = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return asked.coalesce(1).hint("shuffle_replicate_nl").join(dealt, F.expr(condition))

    def best_positives(met: _Met, row: dict) -> None:
        which = np.nonzero(met.labels == row["label"])[0]
        met.keep((which,), _best(*met.scored(row, which), positives))

    def best_negatives(met: _Met, row: dict) -> None:
        if not hasattr(met, "bounds"):
            met.bounds = np.full((len(met.ids), positives), _NONE, "int64")
            for p in row["positives"]:
                met.bounds[p["slot"], p["positive"]] = p["score"]
        which = np.nonzero(met.labels != row["label"])[0]
        ranked, ids = met.scored(row, which)
        for k in range(positives):
            bound = met.bounds[which, k]
            asked = np.nonzero(bound != _NONE)[0]
            if not len(asked):
                continue
            part, limit = ranked[:, asked], bound[asked][None, :]
            inside = (part != _NONE) & (most * limit >= 100 * part) & (100 * part >= least * limit)
            some = np.nonzero(inside.any(axis=0))[0]
            if len(some):
                met.keep((which[asked[some]], k), _best(np.where(inside[:, some], part[:, some], _NONE), ids, negatives))

    first = _first(_swept(meet(queries, "exists(anchors, a -> a.label = label)"), (positives,), best_positives), positives)
    chosen = held(first.select("block", "slot", (F.col("rank") - 1).alias("positive"), "score", "vec_id"), "positives")
    asked = queries.join(chosen.groupBy("block").agg(F.collect_list(F.struct("slot", "positive", "score")).alias("positives")), "block")
    second = _first(_swept(meet(asked, "exists(anchors, a -> a.label <> label)"), (positives, negatives), best_negatives), negatives)
    named = queries.select("block", F.posexplode("anchors").alias("slot", "anchor")).select("block", "slot", F.col("anchor.vec_id").alias("anchor_id"))
    known = chosen.join(named, ["block", "slot"]).select("block", "slot", "positive", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return second.join(known, ["block", "slot", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
