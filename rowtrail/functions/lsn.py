"""Log positions: text ``8hex:8hex:4hex``, ordered as ten unsigned bytes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text form of a log position and the unset position.
LSN_PATTERN = r"\A[0-9a-fA-F]{8}:[0-9a-fA-F]{8}:[0-9a-fA-F]{4}\z"
ZERO_LSN_HEX = "00000000000000000000"
NO_CHANGE_POSITION = "NULL"
INVALID_POSITION = "INVALID_SOURCE_POSITION"


def valid_lsn(text: Column) -> Column:
    """True only for well-formed text; null counts as malformed."""
    return F.coalesce(text.rlike(LSN_PATTERN), F.lit(False))


def checked(text: str) -> str:
    """A position given as an argument, refused if malformed: no row would compare with it."""
    if not re.fullmatch(LSN_PATTERN.removeprefix(r"\A").removesuffix(r"\z"), text):
        raise ValueError(f"{INVALID_POSITION}: {text!r}")
    return text


def with_position_code(frame: DataFrame, broken: Column) -> DataFrame:
    """Add ``error_code`` where a row's position can't be read."""
    return frame.withColumn("error_code", F.when(broken, INVALID_POSITION))


def lsn_bytes(text: Column) -> Column:
    """Ten bytes in log order, or null where the text is malformed."""
    return F.when(valid_lsn(text), F.unhex(F.replace(text, F.lit(":"), F.lit(""))))


def lsn_text(value: Column) -> Column:
    """Lower-case text of ten bytes."""
    digits = F.lower(F.hex(value))
    return F.concat(F.substring(digits, 1, 8), F.lit(":"), F.substring(digits, 9, 8), F.lit(":"), F.substring(digits, 17, 4))


def ready_lsn(value: Column) -> Column:
    """A capture's start counts once it has ten bytes that are not all zero."""
    return F.coalesce((F.length(value) == 10) & (value != F.unhex(F.lit(ZERO_LSN_HEX))), F.lit(False))


def position(commit: Column, change: Column, serial: Column) -> Column:
    """Full source position; struct comparison is lexicographic and an unset change position sorts first."""
    change_bytes = F.when(change == NO_CHANGE_POSITION, F.unhex(F.lit(""))).otherwise(lsn_bytes(change))
    return F.struct(lsn_bytes(commit).alias("commit"), change_bytes.alias("change"), serial.cast("bigint").alias("serial"))


def make_lsn(vlf: Column, block: Column, slot: Column) -> Column:
    """Position text from its three parts, as ``%08x:%08x:%04x`` writes them; a formatter would cost several times as much."""
    def digits(part: Column, width: int) -> Column:
        text = F.lower(F.hex(part.cast("bigint")))
        padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
        return F.coalesce(padded, F.lit("null".rjust(width)))

    return F.concat(digits(vlf, 8), F.lit(":"), digits(block, 8), F.lit(":"), digits(slot, 4))
