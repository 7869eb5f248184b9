"""Text cleaning and numeric parsing as Column expressions (JVM-side, codegen).

All functions are ANSI-safe: malformed input yields NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal or scientific number after commas are removed. Text such as
# NaN, Infinity or 12d is a valid Java double but not a number in a data file.
PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def as_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def blank_to_null(c: Column | str) -> Column:
    """Trim; an empty result becomes NULL."""
    t = F.trim(as_text(c))
    return F.when(t != "", t)


def upper_text(c: Column | str) -> Column:
    """Trimmed, upper-cased text, NULL when blank."""
    return F.upper(blank_to_null(c))


def number_text(c: Column | str) -> Column:
    """Trimmed text with thousands commas removed."""
    return F.replace(F.trim(as_text(c)), F.lit(","), F.lit(""))


def is_number(c: Column | str) -> Column:
    """True exactly when :func:`parse_number` is not NULL."""
    return parse_number(c).isNotNull()


def parse_number(c: Column | str) -> Column:
    """Text to double; NULL unless the cleaned text is a plain number within the range of a double
    (``1e400`` is not)."""
    t = number_text(c)
    value = F.when(t.rlike(PLAIN_NUMBER), t.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def parse_int(c: Column | str) -> Column:
    """Text to int: digits with an optional plain fraction, which is cut (``2023.0``); no commas, no exponent.

    The cast is guarded by a pattern test so that blank or junk text never
    reaches it (a failed cast costs a caught exception per row)."""
    t = F.trim(as_text(c))
    return F.when(t.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$"), F.substring_index(t, ".", 1).try_cast("int"))
