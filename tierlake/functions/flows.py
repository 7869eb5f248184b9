"""Flow classification predicates.

Patterns are unanchored regular expressions over the upper-cased flow text,
so they overlap on purpose (``PROD`` also hits ``PRODUCTS TRANSFERRED``,
``EXP`` hits ``EXPECTED``, a row may be both import and export).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default flow patterns.
PRODUCTION_PATTERN = "PROD|PRODUCTION"
IMPORT_PATTERN = "IMPORT|IMP"
EXPORT_PATTERN = "EXPORT|EXP"

_LITERAL_ALTERNATION = re.compile(r"^[A-Za-z0-9 _]+(\|[A-Za-z0-9 _]+)*$")


def matches(flow: Column | str, pattern: str) -> Column:
    """``flow rlike pattern``.

    When the pattern is an alternation of plain words, the same test is a
    few substring checks: cheaper than a regex and still codegen'd. Words
    that contain another word of the list are redundant and dropped.
    """
    col = F.col(flow) if isinstance(flow, str) else flow
    if not _LITERAL_ALTERNATION.match(pattern):
        return col.rlike(pattern)
    words = pattern.split("|")
    needed = [w for w in words if not any(o != w and o in w for o in words)]
    needed = list(dict.fromkeys(needed))
    out = col.contains(needed[0])
    for w in needed[1:]:
        out = out | col.contains(w)
    return out


def is_production(flow: Column | str, pattern: str = PRODUCTION_PATTERN) -> Column:
    return matches(flow, pattern)


def is_import(flow: Column | str, pattern: str = IMPORT_PATTERN) -> Column:
    return matches(flow, pattern)


def is_export(flow: Column | str, pattern: str = EXPORT_PATTERN) -> Column:
    return matches(flow, pattern)
