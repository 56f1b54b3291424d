"""Content hashes in their many spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest64(c: Column) -> Column:
    """The 64 hex digits of a SHA-256 in lower case, whatever prefix, case or white space it is written with.

    Null for null, blank, all-zero and malformed values: such hashes agree with nothing.
    """
    digits = F.regexp_replace(F.lower(c), r"^\s*(sha-?256|0x)\s*[:=_-]?|[^0-9a-f]", "")
    return F.when((F.length(digits) == 64) & ~digits.rlike("^0+$"), digits)


def filled(c: Column) -> Column:
    """True if a string holds anything but white space; false for null."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))
