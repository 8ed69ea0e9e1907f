"""Mix sources to target weights by repeating documents.

Words are added up per source. Every source has a share of the whole by its weight, but at most ``MAX_RATE`` times
its own words; what it can't take is shared among the others by weight until none is above. The repetition
rate is the target over the source's words. Each document is taken floor(rate) times, and once more if its hash,
seeded, falls below the fraction. The seed of a source is the one of ``SEEDS`` whose draw comes nearest to the
target, so small sources with long documents come near it too; the chance of each document stays the fraction.

Cases: a null text has no words; a null source is a source of its own, sorted last; with a null id the text is
hashed instead; repeated rows are drawn alike; no words at all gives targets of 0; an empty table gives none;
extra columns pass through ``repeat`` and play no part. A hot source is never gathered: its sums combine before the shuffle,
and documents are not moved for the join unless there are more sources than ``MAX_BROADCAST_ROWS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtrail.llm.common import WORD, free_name, held, small_or_shuffled

# Fixed by the contract: weights in the order of the sources, again from the start after the last, and the greatest rate.
WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEEDS = 32
RANGE = 1 << 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column) -> Column:
    """A number below ``RANGE`` from the id (or from the text, if the id is null)."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix "), named).cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """One row a source: (source, source_size, target). There are as many rows as sources, in one task."""
    every = W.partitionBy(F.lit(1))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    # Sources reach their limit in the order of limit over weight.
    filling = every.orderBy(F.col("limit") / F.col("weight"), "place")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = (
        per_source.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod("place", F.lit(len(WEIGHTS))) + 1))
        .withColumn("limit", F.col("source_size") * MAX_RATE))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    waiting = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (
        weighed.withColumn("level", left.cast("double") / waiting.cast("double"))
        .withColumn("level", F.first(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level")), ignorenulls=True).over(filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    limit = F.col("limit").cast("double")
    return level.select("source", "source_size", F.coalesce(F.least(limit, F.col("level") * F.col("weight")), limit).alias("target"))


def rates(sizes: DataFrame) -> DataFrame:
    """One row a source: (source, source_size, target, whole, fraction, turn); ``sizes`` is (source, size, draw)."""
    planned = held(
        targets(sizes).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "target", F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("fraction")), "mix-targets")
    # taken[k]: words of the source with seed k
    joined = _with_source(sizes, planned)
    taken = joined.groupBy("source").agg(*[F.sum(F.col("size") * copies(F.lit(k * (RANGE // SEEDS)))).alias(f"taken_{k}") for k in range(SEEDS)])
    off = F.array(*[F.struct(F.abs(F.col(f"taken_{k}") - F.col("target")).alias("off"), F.lit(k * (RANGE // SEEDS)).alias("turn")) for k in range(SEEDS)])
    same = taken.withColumnRenamed("source", "taken_source")
    chosen = planned.join(same, F.col("source").eqNullSafe(F.col("taken_source"))).select(*planned.columns, F.array_min(off)["turn"].alias("turn"))
    return held(chosen, "mix-rates")


def copies(turn: Column) -> Column:
    """How often a row with its source's ``whole`` and ``fraction`` is taken when draws are turned by the seed."""
    return F.col("whole") + F.when((F.col("draw") + turn) % RANGE < F.col("fraction") * RANGE, 1).otherwise(0)


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    known = per_source.withColumnRenamed("source", "known_source")
    return rows.join(small_or_shuffled(known), rows["source"].eqNullSafe(known["known_source"])).drop("known_source")


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, draw) of every document: all that deciding needs, written once."""
    return held(documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("draw")), "mix-sizes")


def mix(documents: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and the words taken of it."""
    sizes = measured(documents)
    return _with_source(sizes, rates(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("turn"))).alias("taken"), copies(F.col("turn")).alias("copies"))


def repeat(documents: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns it came with."""
    chosen = rates(measured(documents))
    prefix = free_name(documents, "mix")
    known = small_or_shuffled(chosen).select(*[F.col(c).alias(f"{prefix} {c}") for c in chosen.columns])
    drawn = documents.join(known, documents["source"].eqNullSafe(F.col(f"`{prefix} source`")))
    extra = F.when((draw(documents["doc_id"], documents["text"]) + F.col(f"`{prefix} turn`")) % RANGE < F.col(f"`{prefix} fraction`") * RANGE, 1).otherwise(0)
    times = (F.col(f"`{prefix} whole`") + extra).cast("int")
    return drawn.select(*[documents[c] for c in documents.columns], F.explode(F.array_repeat(F.lit(1), times)).alias(f"{prefix} copy")).drop(f"{prefix} copy")


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix ' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 8))::BIGINT AS draw
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes GROUP BY source),
weighed AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1] AS weight, source_size * {MAX_RATE} AS most FROM per_source),
levels AS (
  SELECT *, row_number() OVER filling AS rank,
    (sum(source_size) OVER () - coalesce(sum(most) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / (sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW filling AS (ORDER BY most / weight, place)),
planned AS (
  SELECT source, source_size, least(most::DOUBLE, weight * (SELECT arg_min(level, rank) FROM levels WHERE level * weight <= most)) AS target FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate, floor(rate)::BIGINT AS whole, rate - floor(rate) AS fraction FROM planned),
tried AS (
  SELECT d.source, k, sum(size * (whole + ((draw + k * {RANGE // SEEDS}) % {RANGE} < fraction * {RANGE})::INT)) AS taken, any_value(target) AS target
  FROM sizes d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source, range({SEEDS}) t(k) GROUP BY ALL),
seeds AS (SELECT source, arg_min(k, (abs(taken - target), k)) AS k FROM tried GROUP BY source)
SELECT doc_id, size, r.source_size, r.target, size * c AS taken, c AS copies
FROM (
  SELECT d.*, whole + ((draw + s.k * {RANGE // SEEDS}) % {RANGE} < fraction * {RANGE})::INT AS c, r.source_size, r.target
  FROM sizes d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source JOIN seeds s ON d.source IS NOT DISTINCT FROM s.source) r
"""
