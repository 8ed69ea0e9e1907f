"""Find and repair broken conversations: blank, repeated and cut rows, and turns out of order of roles.

Rows are put in order by one range shuffle on (conversation, turn), which splits a conversation of any size over many tasks. Each task cuts
its rows into segments of one conversation with at most ``SEGMENT_ROWS`` rows or ``SEGMENT_CHARACTERS`` characters and a row. A conversation that is one segment
and neither the first nor the last of its task is repaired where it lies, by the agenda of :mod:`rowtrail.llm.repair`. Of the others the texts seen in
earlier segments are found by a window over digests, each segment is solved from every state in parallel, and the solutions are brought together along the conversation.
That last step streams a conversation's segments through one task, since one digest covers all its repaired rows, in constant memory but for the audit.

Cases: in roles, texts and the hashed key a null is one space; rows without a conversation are one conversation; rows without a turn come first; rows of one turn are
ordered by a hash of role and text; repeated rows are duplicates; a conversation that keeps no row has zeros, an empty audit and the digest of
nothing; an empty table gives none; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtrail.llm import repair
from rowtrail.llm.common import held, small_batches

SEGMENT_ROWS = 512
SEGMENT_CHARACTERS = 4_000_000
_SEGMENT = "conv_id long, shard int, segment int, whole boolean, turns array<bigint>, roles array<string>, texts array<string>"
_SEGMENT_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("shard", pa.int32()), ("segment", pa.int32()), ("whole", pa.bool_()),
    ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT_ARROW = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
#: Fixed: pairs of neighbouring roles' initials that are in order.
LEGAL = {"su", "ua", "au"}


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after a damage that a CRC of their key decides: (conv_id, turn, role, text, present); a dropped row stays as one that is not present."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(fate == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"),
        (fate != 0).alias("present"), F.explode(F.array_repeat(F.lit(1), F.when(fate == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the same form."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(True).alias("present"))


class _Cutter:
    """Rows of one task, in order, to segments."""

    def __init__(self):
        self.shard, self.number, self.first = 0, 0, True
        self.begun = self.split = False
        self.conv_id: int | None = None
        self._new()

    def _new(self) -> None:
        self.turns, self.roles, self.texts, self.characters = [], [], [], 0

    def closed(self, whole: bool) -> dict:
        row = {"conv_id": self.conv_id, "shard": self.shard, "segment": self.number, "whole": whole and not self.first and not self.split, "turns": self.turns, "roles": self.roles, "texts": self.texts}
        self.number += 1
        self._new()
        return row

    def add(self, shard: int, conv_id: int | None, turn: int | None, role: str, text: str, present: bool) -> Iterator[dict]:
        if self.begun and conv_id != self.conv_id:
            yield self.closed(True)
            self.first = self.split = False
        self.shard, self.conv_id, self.begun = shard, conv_id, True
        if not present:
            return
        if len(self.turns) >= SEGMENT_ROWS or self.characters >= SEGMENT_CHARACTERS:
            self.split = True
            yield self.closed(False)
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.characters += len(text)

    def end(self) -> Iterator[dict]:
        if self.begun:
            yield self.closed(False)


def segments(rows: DataFrame) -> DataFrame:
    """Conversations in order, cut into segments; ``whole`` marks those that are surely all of their conversation."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _Cutter()
        for batch in batches:
            found = [s for row in zip(*[c.to_pylist() for c in batch.columns], strict=True) for s in cutter.add(*row)]
            if found:
                yield pa.RecordBatch.from_pylist(found, _SEGMENT_ARROW)
        yield pa.RecordBatch.from_pylist(list(cutter.end()), _SEGMENT_ARROW)

    # Rows alike in all that decides their order may be dealt to several tasks.
    told = rows.withColumn("tie", F.xxhash64("role", "text")).withColumn("row", F.monotonically_increasing_id())
    ordered = told.repartitionByRange("conv_id", "turn", "tie", "row").sortWithinPartitions("conv_id", "turn", "tie")
    return ordered.select(F.spark_partition_id().alias("shard"), "conv_id", "turn", "role", "text", "present").mapInArrow(cut, _SEGMENT)


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def _judged(roles: list[str], texts: list[str], seen: set[bytes]) -> list[repair.Row]:
    """Rows with their faults; ``seen``: digests of rows in earlier segments."""
    met, rows = set(seen), []
    for role, text in zip(roles, texts, strict=True):
        digest = _digest(role, text)
        rows.append(repair.Row(role, text, repair.fault_of(text, digest in met)))
        met.add(digest)
    return rows


class _Counts:
    """What is counted along a conversation, segment by segment."""

    def __init__(self):
        self.faults = dict.fromkeys((repair.BLANK, repair.DUPLICATE, repair.CUT), 0)
        self.illegal = self.distinct = 0
        self.least = self.last = self.initial = None

    def add(self, turns: list[int | None], rows: list[repair.Row]) -> None:
        for turn, row in zip(turns, rows, strict=True):
            if row.fault:
                self.faults[row.fault] += 1
            if self.initial is not None and self.initial + row.role[:1] not in LEGAL:
                self.illegal += 1
            self.initial = row.role[:1]
            if turn is not None and turn != self.last:
                self.least = turn if self.least is None else self.least
                self.last, self.distinct = turn, self.distinct + 1

    def row(self, conv_id: int | None, cost: int, audit: str, digest: str) -> dict:
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.distinct
        return {"conv_id": conv_id, "gaps": gaps} | self.faults | {"illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


def _repaired_whole(whole: DataFrame) -> DataFrame:
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for s in batch.to_pylist():
                rows, counts = _judged(s["roles"], s["texts"], set()), _Counts()
                counts.add(s["turns"], rows)
                cost, audit = repair.lightest_repair(rows)
                out.append(counts.row(s["conv_id"], cost, audit, hashlib.sha256("\n".join(repair.repaired(rows, repair.START, audit)).encode()).hexdigest()))
            yield pa.RecordBatch.from_pylist(out, _RESULT_ARROW)

    return whole.mapInArrow(solved, _RESULT)


def _seen_earlier(parts: DataFrame) -> DataFrame:
    """Digests of a segment's rows that an earlier segment of its conversation holds too: (shard, segment, seen)."""
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(s["conv_id"], s["shard"], s["segment"], d) for s in batch.to_pylist() for d in {_digest(r, t) for r, t in zip(s["roles"], s["texts"], strict=True)}]
            yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "shard", "segment", "digest"), row, strict=True)) for row in out], pa.schema([("conv_id", pa.int64()), ("shard", pa.int32()), ("segment", pa.int32()), ("digest", pa.binary())]))

    place = F.struct("shard", "segment")
    first = F.min(place).over(Window.partitionBy("conv_id", "digest"))
    found = parts.mapInArrow(told, "conv_id long, shard int, segment int, digest binary").withColumn("first", first).filter(F.col("first") < place)
    return found.groupBy("shard", "segment").agg(F.collect_list("digest").alias("seen"))


_SOLVED = _SEGMENT + ", faults array<string>, costs array<bigint>, audits array<string>"
_SOLVED_ARROW = pa.schema([*_SEGMENT_ARROW, ("faults", pa.list_(pa.string())), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])


def _repaired_parts(parts: DataFrame) -> DataFrame:
    """Conversations that may lie in several segments."""
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for s in batch.to_pylist():
                rows = _judged(s["roles"], s["texts"], set(s.pop("seen") or ()))
                ways = [found.get(then, (None, None)) for found in (repair.lightest_from(rows, q) for q in repair.STATES) for then in repair.STATES]
                out.append(s | {"faults": [row.fault for row in rows], "costs": [cost for cost, _ in ways], "audits": [audit for _, audit in ways]})
            yield pa.RecordBatch.from_pylist(out, _SOLVED_ARROW)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, along, counts = None, False, repair.Along(), _Counts()
        n = len(repair.STATES)
        for batch in batches:
            out = []
            for s in batch.to_pylist():
                if begun and s["conv_id"] != now:
                    out.append(counts.row(now, *along.ended()))
                    along, counts = repair.Along(), _Counts()
                now, begun = s["conv_id"], True
                rows = [repair.Row(*row) for row in zip(s["roles"], s["texts"], s["faults"], strict=True)]
                ways = list(zip(s["costs"], s["audits"], strict=True))
                along.add(rows, {q: {then: ways[q * n + then] for then in repair.STATES if ways[q * n + then][0] is not None} for q in repair.STATES})
                counts.add(s["turns"], rows)
            if out:
                yield pa.RecordBatch.from_pylist(out, _RESULT_ARROW)
        if begun:
            yield pa.RecordBatch.from_pylist([counts.row(now, *along.ended())], _RESULT_ARROW)

    known = parts.join(_seen_earlier(parts), ["shard", "segment"], "left").select(*_SEGMENT_ARROW.names, "seen")
    ready = known.mapInArrow(solved, _SOLVED).repartition("conv_id").sortWithinPartitions("conv_id", "shard", "segment")
    return ready.mapInArrow(together, _RESULT)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row a conversation: its gaps and faults, the cost and audit of its cheapest repair, and the digest of what the repair leaves.

    ``rows``: as :func:`damaged` and :func:`undamaged` give them.
    """
    small_batches(rows.sparkSession)
    cut = held(segments(rows), "segments")
    return _repaired_whole(cut.filter("whole")).unionByName(_repaired_parts(cut.filter("NOT whole")))
