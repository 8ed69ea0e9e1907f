"""Typed reading of JSON: absent, null, "", 0 and false stay apart, and 12 is not "12".

A document is parsed once to VARIANT; kinds are tested before any cast because a cast alone
would turn "15" into 15 and 5 into "5".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_TYPE = "map<string,variant>"


def parse(text: Column) -> Column:
    return F.try_parse_json(text)


def malformed(text: Column, parsed: Column) -> Column:
    """Text that is present and not blank but does not parse; blank text reads as an absent document."""
    return text.isNotNull() & parsed.isNull() & (F.trim(text) != "")


def at(value: Column, path: str) -> Column:
    """The VARIANT at a path: SQL null where absent, a VARIANT null where the JSON says null."""
    return F.try_variant_get(value, path, "variant")


def payload(value: Column) -> Column:
    """The ``payload`` of a document that carries both ``schema`` and ``payload``, else the document."""
    wrapped = wrapped_payload(value)
    return F.when(wrapped, at(value, "$.payload")).otherwise(value)


def wrapped_payload(value: Column) -> Column:
    return at(value, "$.schema").isNotNull() & at(value, "$.payload").isNotNull()


def token(value: Column, path: str) -> Column:
    """JSON text of the value at a path; its first character tells the kind. Null where absent."""
    return F.to_json(at(value, path))


def kind(value: Column) -> Column:
    """Type name of a VARIANT; null where absent."""
    return F.schema_of_variant(value)


def text_if_string(value: Column, text: Column) -> Column:
    """A field's ``text`` where its VARIANT says it is a non-empty JSON string, null for every other kind."""
    return F.when((kind(value) == "STRING") & (text != ""), text)


def long_if_number(value: Column, text: Column) -> Column:
    """A field's ``text`` as a long where its VARIANT is a number in range (a fraction is cut off), else null."""
    letters = F.substring(kind(value), 1, 2)
    return F.when(letters == "BI", text.try_cast("bigint")).when(
        letters.isin("DE", "DO", "FL"), text.try_cast("decimal(38,10)").try_cast("bigint"))


def is_integral(value: Column) -> Column:
    """A JSON number written without a fraction or exponent, within the long range."""
    return F.coalesce(F.schema_of_variant(value) == "BIGINT", F.lit(False))


def object_at(value: Column, path: str) -> Column:
    """The fields of the object at a path as a map, null where the path holds no object."""
    return F.try_variant_get(value, path, MAP_TYPE)


def is_object(value: Column) -> Column:
    """Whether a VARIANT is an object; as a struct any other kind is null."""
    return F.try_variant_get(value, "$", "struct<_: boolean>").isNotNull()


def is_fractional(value: Column) -> Column:
    """A JSON number written with a fraction or an exponent; an integer beyond the long range is not one."""
    return kind(value).rlike(r"^(DOUBLE|FLOAT|DECIMAL)") & ~kind(value).rlike(r"^DECIMAL\((19|[23]\d),0\)$")


def by_number_kind(fields: Column) -> Column:
    """Field values whose fractional numbers are doubles, so that JSON text tells 12 from 12.0 but not 1e3 from 1000.0.

    Numbers inside nested objects and arrays stay as VARIANT holds them; see :func:`marked` for those.
    """
    return F.transform_values(fields, lambda _, v: F.when(is_fractional(v), F.try_variant_get(v, "$", "double").cast("variant")).otherwise(v))


#: Before a fractional number that is kept as a string: a character without meaning, which documents of this kind do not hold.
MARK = "\ue000"
#: What lies before the next fractional number (strings, whole numbers and all else), and that number.
_NEXT_FRACTION = (
    r'\G((?:[^"0-9\-]++|"(?:[^"\\]++|\\.)*+"|-?[0-9]++(?![0-9.eE]))*+)(-?[0-9]++(?:\.[0-9]++(?:[eE][+\-]?[0-9]++)?|[eE][+\-]?[0-9]++))')
#: Significant digits that a double always holds.
_DOUBLE_DIGITS = 15


def needs_marks(kinds: Column) -> Column:
    """Whether a document of this VARIANT type has fractional numbers below its top level, or with more digits than a double."""
    inside = F.substring(kinds, 2, 1 << 30).rlike(r"OBJECT<|ARRAY<") | F.startswith(kinds, F.lit("ARRAY<"))
    return F.coalesce((inside & kinds.rlike(r"DECIMAL\(|DOUBLE|FLOAT|VARIANT")) | kinds.rlike(r"DECIMAL\((1[6-9]|[23]\d),[1-9]"), F.lit(False))


def _written(number: Column) -> Column:
    """A fractional number's one form: a double's, or its own digits where a double would lose some or all."""
    double, exact = number.cast("double"), number.try_cast("decimal(38,18)")
    digits = F.length(F.regexp_replace(F.substring_index(F.lower(number), "e", 1), "[^0-9]", ""))
    own = F.regexp_replace(F.regexp_replace(exact.cast("string"), "0+$", ""), r"\.$", ".0")
    beyond = F.abs(double) == float("inf")
    return F.when(beyond, F.lower(number)).when((digits > _DOUBLE_DIGITS) & exact.isNotNull() & ~F.coalesce(double.cast("string").try_cast("decimal(38,18)") == exact, F.lit(False)), own).otherwise(double.cast("string"))


def marked(text: Column) -> Column:
    """JSON text whose fractional numbers, at any depth, are strings of their one form behind a mark; VARIANT then keeps them apart from whole ones."""
    parts = F.split(F.regexp_replace(text, _NEXT_FRACTION, f'$1"{MARK}$2"'), f'"{MARK}')
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda part: F.concat(F.lit(f'"{MARK}'), _written(F.substring_index(part, '"', 1)), F.substring(part, F.instr(part, '"'), F.length(part))))
    return F.when(F.contains(text, F.lit(MARK)), text).otherwise(F.concat(parts[0], F.array_join(rest, "")))


def unmarked(text: Column) -> Column:
    """JSON text with the marked numbers as numbers."""
    return F.when(F.contains(text, F.lit(MARK)), F.regexp_replace(text, f'"{MARK}([^"]*)"', "$1")).otherwise(text)


def marked_fields(text: Column) -> Column:
    """The fields of an object's text as a map, with marked numbers."""
    return object_at(parse(marked(text)), "$")


def canonical(text: Column, value: Column, value_marked: Column) -> Column:
    """JSON text with the names of every object in order; arrays keep theirs. Whole and fractional numbers stay apart at every depth.

    ``value`` is read from ``text``, and ``value_marked`` is the same value parsed from its :func:`marked` text; it is read only where it is needed.
    Text without a digit before ``.``, ``e`` or ``E`` has no fractional number, and its kinds are not looked at.
    """
    plain = ~text.rlike(r"[0-9][.eE]")
    mixed = F.startswith(kind(value), F.lit("OBJECT<")) & kind(value).rlike("DECIMAL|DOUBLE|FLOAT")
    shallow = F.when(mixed, F.to_json(by_number_kind(object_at(value, "$")))).otherwise(F.to_json(value))
    return F.when(plain, F.to_json(value)).when(needs_marks(kind(value)), unmarked(F.to_json(value_marked))).otherwise(shallow)


def names(fields: Column) -> Column:
    return F.coalesce(F.map_keys(fields), F.array().cast("array<string>"))


TEXT_MAP_TYPE = "map<string,string>"


def _entries(fields: Column) -> Column:
    """Each field as one text: length of the name, the name, the value's JSON."""
    def entry(e: Column) -> Column:
        return F.concat(F.length(e["key"]).cast("string"), F.lit(":"), e["key"], F.to_json(e["value"]))

    return F.transform(F.map_entries(fields), entry)


def _differing_in_general(before: Column, after: Column) -> Column:
    """Names of entries that only one side has; as sets of text, which stays linear for a wide row."""
    left, right = _entries(before), _entries(after)
    changed = F.concat(F.array_except(left, right), F.array_except(right, left))

    def name(entry: Column) -> Column:
        size = F.substring_index(entry, ":", 1)
        return F.substring(entry, F.length(size) + F.lit(2), size.cast("int"))

    return F.sort_array(F.array_distinct(F.transform(changed, name)))


def with_differing_names(frame: DataFrame, name: str, before: str, after: str, before_text: str, after_text: str) -> DataFrame:
    """Add the ordered names whose typed value differs between two row images; an absent image has no names.

    The images come as JSON text, with whether they are objects. Where only one is present all its names
    differ. Where both have the same names in the same order with the same flat kinds, comparing the values'
    plain text is enough, and much cheaper than comparing typed values; the rest goes the general way.
    """
    b, a = F.col(before), F.col(after)
    both = b & a
    read = frame.select(
        "*",
        *[F.when(both, F.schema_of_variant(parse(F.col(text)))).alias(alias) for text, alias in ((before_text, "_b_shape"), (after_text, "_a_shape"))],
        *[F.when(both, F.from_json(text, TEXT_MAP_TYPE)).alias(alias) for text, alias in ((before_text, "_b_texts"), (after_text, "_a_texts"))])
    shape = F.col("_b_shape")
    # Nested values and fractional numbers (1e3 is 1000.0) can be equal under different texts.
    general = F.substring(shape, 2, 1 << 30).rlike(r"OBJECT<|ARRAY<|DECIMAL\(|DOUBLE|FLOAT")
    alike = (shape == F.col("_a_shape")) & ~general & (F.map_keys("_b_texts") == F.map_keys("_a_texts"))
    rows = F.arrays_zip(F.map_keys("_b_texts").alias("k"), F.map_values("_b_texts").alias("b"), F.map_values("_a_texts").alias("a"))
    differing = F.transform(F.filter(rows, lambda r: ~r["b"].eqNullSafe(r["a"])), lambda r: r["k"])
    found = (
        F.when(~b & ~a, F.array().cast("array<string>"))
        .when(~both, F.sort_array(F.array_distinct(F.json_object_keys(F.when(b, F.col(before_text)).otherwise(F.col(after_text))))))
        .when(alike, F.sort_array(differing))
        .when(needs_marks(shape) | needs_marks(F.col("_a_shape")), _differing_in_general(marked_fields(F.col(before_text)), marked_fields(F.col(after_text))))
        .otherwise(_differing_in_general(*[by_number_kind(object_at(parse(F.col(text)), "$")) for text in (before_text, after_text)])))
    return read.withColumn(name, found).drop("_b_shape", "_a_shape", "_b_texts", "_a_texts")


def value_kind(text: Column) -> Column:
    """absent, null, string, number, boolean, object or array from a value's JSON text."""
    first = F.substring(text, 1, 1)
    return (
        F.when(text.isNull(), "absent")
        .when(first == '"', "string")
        .when(text == "null", "null")
        .when(first.isin("t", "f"), "boolean")
        .when(first == "{", "object")
        .when(first == "[", "array")
        .otherwise("number")
    )
