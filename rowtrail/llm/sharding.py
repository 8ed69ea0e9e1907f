"""Shards that all match the mixture of sources: proportional stratified interleaving.

Within each source rows are put in the order of a seeded hash and ranked. All rows are then sorted by fractional
rank, (rank + 1/2) / rows of the source, and cut into shards of equal counts, at most one row apart. Any cut of that order
holds each source in proportion.

Ranks are found without gathering a source or the whole: the hash range, and then the range of fractions, are cut into slices
of some thousand rows; a row's rank is its place in its slice plus the rows of the slices before. Both are evenly
filled whatever the sizes of the sources.

Cases: a null text has 0 bytes; a null source is a source of its own; null ids are ordered by their text; repeated rows
have ranks one after the other, so that they are spread over shards like any rows of their source, and so are equal texts under different ids; an empty table gives none; with fewer rows than shards some shards
are empty; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtrail.llm.common import held

SEED = 20
OVERHEAD = 16  # fixed by the contract: bytes of a row besides its text
SLICE_ROWS = 1000
MIN_SLICE_BITS, MAX_SLICE_BITS = 8, 16


def interleave(documents: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, source, fraction, shard, slot) of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = held(
        documents.select(
            "doc_id", "source", F.coalesce(F.concat(F.lit("source "), "source"), F.lit("none")).alias("stratum"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), text)).alias("order")), "shard-rows")
    n = rows.count()
    bits = min(MAX_SLICE_BITS, max(MIN_SLICE_BITS, (n // SLICE_ROWS).bit_length()))

    sliced = rows.withColumn("slice", F.shiftright("order", 64 - bits))
    per_slice = sliced.groupBy("stratum", "slice").count()
    in_stratum = W.partitionBy("stratum")
    before = per_slice.select(
        "stratum", "slice", (F.sum("count").over(in_stratum.orderBy("slice")) - F.col("count")).alias("before"), F.sum("count").over(in_stratum).alias("stratum_rows"))
    inside = W.partitionBy("stratum", "slice").orderBy("order", "doc_id", "text_crc32", "size")
    ranked = sliced.withColumn("place", F.row_number().over(inside)).join(before, ["stratum", "slice"])
    rank = F.col("before") + F.col("place") - 1
    fractions = held(ranked.select(
        "doc_id", "size", "text_crc32", "source", "stratum", "order", ((2 * rank + 1) / (2 * F.col("stratum_rows"))).alias("fraction")), "shard-fractions")

    dealt = fractions.withColumn("slice", F.floor(F.col("fraction") * (1 << bits)).cast("int"))
    # At most 2 ** MAX_SLICE_BITS rows, whatever the input.
    ahead = dealt.groupBy("slice").count()
    ahead = ahead.select("slice", (F.sum("count").over(W.partitionBy(F.lit(1)).orderBy("slice")) - F.col("count")).alias("ahead"))
    across = W.partitionBy("slice").orderBy("fraction", "stratum", "order", "doc_id", "text_crc32", "size")
    placed = dealt.withColumn("place", F.row_number().over(across)).join(ahead, "slice").withColumn("place", F.col("ahead") + F.col("place") - 1)
    shard = F.expr(f"place * {shards} DIV {max(1, n)}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "source", "fraction", "shard", (F.col("place") - F.expr(f"(CAST(shard AS LONG) * {n} + {shards - 1}) DIV {shards}")).alias("slot"))
