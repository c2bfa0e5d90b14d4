"""Guards and tolerant casts for text that should hold numbers or times.

ANSI mode makes a bad cast fail the job, so every cast here is a ``try_cast``. Patterns are
anchored with ``\\A`` and ``\\z``: ``$`` would let a trailing newline through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that the loader accepts as numbers.
DIGITS = r"\A[0-9]+\z"
UNSIGNED_DECIMAL = r"\A[0-9]+(\.[0-9]+)?\z"
DATE_TIME = r"\A\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?\z"


def station_code(column: str) -> Column:
    """Unsigned whole number or blank."""
    text = F.col(column)
    return F.when(text.rlike(DIGITS), text.try_cast("int"))


def optional_code(column: str) -> Column:
    """Whole number; empty text counts as absent."""
    return F.nullif(F.col(column), F.lit("")).try_cast("int")


def fare(column: str) -> Column:
    """Unsigned amount with two decimals; blank when malformed or too wide."""
    text = F.col(column)
    return F.when(text.rlike(UNSIGNED_DECIMAL), text.try_cast("decimal(10,2)"))


def timestamp(column: str) -> Column:
    text = F.trim(F.col(column))
    return F.when(text.rlike(DATE_TIME), text.try_cast("timestamp_ntz"))


def date_part(column: str) -> Column:
    """Date from the text before the first blank."""
    return F.substring_index(F.col(column), " ", 1).try_cast("date")
