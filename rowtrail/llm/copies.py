"""Groups of copies and near copies from sketches of word shingles, with DataFrame functions only.

For stages that must not run Python. Every class of equal texts has a sketch: the ``SKETCH`` least hashes of its shingles of ``WIDTH`` words. The least hash in each of
``BINS`` residue classes is a key of its own; among the classes that share a key all are compared with one, as many pairs as members. A pair is
linked when the sketches estimate a similarity of ``LIKE`` or more, which is exact for texts of fewer shingles than the sketch holds. Groups are
the components of these links. Counting copies once needs no more than that; ``near_dedup`` confirms its links on full sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtrail.llm.common import SPACES, held, small_or_shuffled
from rowtrail.llm.line_dedup import _LOWER, _UPPER, text_class
from rowtrail.llm.near_dedup import components

WIDTH = 5
SKETCH = 64
BINS = 8
#: Near copies of similarity 0.8 are estimated lower than this once in forty times.
LIKE = 0.7


def sketches(documents: DataFrame) -> DataFrame:
    """(same, sketch) of each class of equal texts that has a word."""
    worded = documents.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(text_class(), F.split(F.translate(F.btrim("text", F.lit(SPACES)), _UPPER, _LOWER), r"[\x20\x09-\x0D]+").alias("words"))
    # The column of words is used several times, so it is made once for each row; sort_array sorts plain numbers, without a comparator.
    shingled = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - WIDTH, F.lit(0))), lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WIDTH)]))
    sketch = F.slice(F.sort_array(F.array_distinct(shingled)), 1, SKETCH)
    return held(worded.select("same", sketch.alias("sketch")).groupBy("same").agg(F.first("sketch").alias("sketch")), "copy-sketches")


def likeness(one: Column, other: Column) -> Column:
    """Share of the union's least hashes that both sketches hold."""
    least = F.slice(F.sort_array(F.array_union(one, other)), 1, SKETCH)
    return F.size(F.array_intersect(least, F.array_intersect(one, other))) / F.size(least)


def copy_groups(documents: DataFrame) -> DataFrame:
    """(same, component) of the classes of equal texts that are linked with others."""
    every = sketches(documents)

    def least_in(b: int) -> Column:
        return F.array_min(F.filter("sketch", lambda h: F.pmod(h, F.lit(BINS)) == b))

    keyed = F.array(*[F.struct(F.lit(b).alias("bin"), least_in(b).alias("least")) for b in range(BINS)])
    members = every.select("same", F.explode(keyed).alias("k")).select("same", "k.bin", "k.least").filter("least IS NOT NULL")
    buckets = members.groupBy("bin", "least").agg(F.min("same").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pairs = held(members.join(buckets, ["bin", "least"]).filter("same <> leader").select("same", "leader").distinct(), "copy-pairs")
    needed = held(pairs.select("same").unionByName(pairs.select(F.col("leader").alias("same"))).distinct(), "copy-members")
    compared = held(every.join(small_or_shuffled(needed), "same"), "copy-compared")
    one = compared.select("same", F.col("sketch").alias("one"))
    other = compared.select(F.col("same").alias("leader"), F.col("sketch").alias("other"))
    links = pairs.join(one, "same").join(other, "leader").filter(likeness(F.col("one"), F.col("other")) >= LIKE).select(F.col("same").alias("a"), F.col("leader").alias("b"))
    return held(components(links).select(F.col("node").alias("same"), "component"), "copy-groups")
