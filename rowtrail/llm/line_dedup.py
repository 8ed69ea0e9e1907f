"""Take lines out that stand on many sites: distinct-site spread of every line, without Python.

Each line is known by a hash of its normal form (ASCII letters lower, runs of white space one space). A
HyperLogLog sketch of the sites is built for every line hash that occurs often enough, and sketches merge by aggregation, so a line that stands in a
third of all documents sends one sketch per task. Lines whose estimate lies within ``BAND`` of the threshold are
counted exactly; those above are boilerplate, and go from every document, whatever is left of it.

Copies of a text count once, for one of their sites: the one with the fewest documents, so that the copies on a busy mirror count for the sites
it mirrors (ties: the first by name). Copying thus makes no line wide. Copies are equal texts, or the groups that are given (see ``copies.copy_groups``).

Cases: a null text stays null; lines without a word are kept and have no spread; a null site counts as no site; repeated rows
and repeated lines count their site once; an empty table gives none; extra columns pass through. Rows of one id, or without one,
are told apart by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtrail.llm.common import free_name, held, small_or_shuffled

MIN_SITES = 10
#: Relative distance from the threshold within which sites are counted exactly: over four standard errors of the sketch.
BAND = 0.25
SKETCH_BITS = 8
#: Parts into which a line's occurrences are dealt when there are too many lines for a broadcast.
SALTS = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(line: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")), _UPPER, _LOWER)


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_hash(line: Column) -> Column:
    """64 bits of a line's normal form; null for a line without a word."""
    form = normal(line)
    return F.when(form != "", F.xxhash64(form))


def document_key() -> Column:
    """Rows that share it have the same lines to lose, so nothing hangs on its being unique."""
    return F.xxhash64("doc_id", "text").alias("key")


def text_class() -> Column:
    """The class of equal texts that a row belongs to."""
    return F.xxhash64("text").alias("same")


def listed(documents: DataFrame, site: str = "source") -> DataFrame:
    """Each document's line hashes in their order, written once: (key, same, site, hashes); rows without a text are left out."""
    rows = documents.filter("text IS NOT NULL")
    return held(rows.select(document_key(), text_class(), F.col(site).cast("string").alias("site"), F.transform(lines(F.col("text")), line_hash).alias("hashes")), "lines")


def counting(rows: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Rows of ``listed`` that count: of each group of copies those on one of its sites; groups: (same, component), the others are their own."""
    sited = rows.filter("site IS NOT NULL")
    busy = small_or_shuffled(held(sited.groupBy("site").agg(F.count(F.lit(1)).alias("busy")), "busy-sites"))
    owned = sited.select("same", "site").distinct()
    if groups is None:
        owned = owned.withColumn("component", F.col("same"))
    else:
        owned = owned.join(small_or_shuffled(groups), "same", "left").withColumn("component", F.coalesce("component", "same"))
    owned = held(owned.join(busy, "site").select("same", "site", "component", "busy"), "group-sites")
    chosen = owned.groupBy("component").agg(F.min(F.struct("busy", "site")).alias("least")).select("component", F.col("least.site").alias("chosen"))
    # Few texts stand on several sites: only those that do not count are told.
    passed = held(owned.join(chosen, "component").filter("site <> chosen").select("same", "site"), "other-sites")
    return sited.join(small_or_shuffled(passed), ["same", "site"], "left_anti")


def among(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Occurrences (line, salt, ...) of the wanted lines (line). Beyond a broadcast, those of one line are dealt out over ``SALTS`` parts."""
    hinted = small_or_shuffled(wanted)
    if hinted is not wanted:
        return found.join(hinted, "line", "left_semi")
    return found.join(wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["line", "salt"], "left_semi")


def spread(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines that stand on ``min_sites`` sites or more: (line)."""
    salt = F.pmod("key", F.lit(SALTS)).cast("int").alias("salt")
    found = rows.select(F.xxhash64("site").alias("site"), salt, F.explode(F.array_distinct("hashes")).alias("line")).filter("line IS NOT NULL")
    # A line seen fewer times than that can't be on as many sites; only the others need a sketch.
    often = held(found.groupBy("line").count().filter(F.col("count") >= min_sites).select("line"), "often")
    sketched = among(found, often).groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"))
    estimated = held(sketched.filter(F.col("sites") >= min_sites * (1 - BAND)), "line-sites")
    near = estimated.filter(F.col("sites") <= min_sites * (1 + BAND)).select("line")
    exact = among(found, near).select("line", "site").distinct().groupBy("line").count().filter(F.col("count") >= min_sites).select("line")
    return held(estimated.filter(F.col("sites") > min_sites * (1 + BAND)).select("line").unionByName(exact), "boilerplate")


def remove_boilerplate(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES, groups: DataFrame | None = None) -> DataFrame:
    """The documents with the same columns, texts without lines of wide spread; ``n_chars``, if there, is counted anew."""
    rows = listed(documents, site)
    wide = spread(counting(rows, groups), min_sites)
    # Which places go from which document: narrow rows, and only of documents that lose any.
    salt = F.pmod("key", F.lit(SALTS)).cast("int").alias("salt")
    gone = among(rows.select("key", salt, F.posexplode("hashes").alias("place", "line")), wide).groupBy("key").agg(F.collect_set("place").alias("gone"))
    prefix = free_name(documents, "lines")
    key, drop, listed_here = f"{prefix} key", f"{prefix} drop", f"{prefix} all"
    joined = documents.withColumn(key, document_key()).join(gone.select(F.col("key").alias(key), F.col("gone").alias(drop)), key, "left")
    split = joined.withColumn(listed_here, F.when(F.col(f"`{drop}`").isNotNull(), lines(F.col("text"))))
    every = F.col(f"`{listed_here}`")
    # Places are told apart as sets, so a text of many lines takes time in proportion.
    places = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(f"`{drop}`"))
    left = F.array_join(F.transform(places, lambda place: every[place]), "\n")
    text = F.when(every.isNotNull(), left).otherwise(F.col("text"))
    columns = {"text": text} | ({"n_chars": F.length(text).cast(dict(documents.dtypes)["n_chars"])} if "n_chars" in documents.columns else {})
    return split.withColumns(columns).select(*[F.col(f"`{c}`") for c in documents.columns])


#: The line, as the SQL below writes it in normal form.
_SQL_NORMAL = f"translate(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), '{_UPPER}', '{_LOWER}')"
SQL = f"""
WITH told AS (SELECT row_number() OVER () AS row, md5(text) AS same, * FROM documents),
busy AS (SELECT source, count(*) AS busy FROM told WHERE source IS NOT NULL AND text IS NOT NULL GROUP BY source),
chosen AS (SELECT same, source AS site FROM told JOIN busy USING (source) WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY same ORDER BY busy, source) = 1),
listed AS (SELECT row, same, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM told WHERE text IS NOT NULL),
formed AS (SELECT *, {_SQL_NORMAL} AS form FROM listed),
wide AS (SELECT form FROM formed JOIN chosen USING (same) WHERE form <> '' GROUP BY form HAVING count(DISTINCT site) >= {MIN_SITES}),
cut AS (SELECT row, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (form NOT IN (SELECT form FROM wide)), '') AS kept FROM formed GROUP BY row)
SELECT doc_id, source, lang, kept AS text, length(kept) AS n_chars FROM told LEFT JOIN cut USING (row)
"""
