"""Built-in column expressions for the comma-separated text formats.

Everything here is a JVM-side expression, so parsing stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Java-style trim removes from both ends,
# every code point from U+0000 to U+0020 inclusive.
TRIM_CHARACTERS = "".join(chr(code) for code in range(0x00, 0x21))
# An integer field is an optional sign and decimal digits.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Strip control characters and spaces from both ends (Java `trim`)."""
    return F.btrim(_col(c), F.lit(TRIM_CHARACTERS))


def strip_trailing_separators(c: Column | str, sep: str = ",") -> Column:
    """Drop a run of separators at the end of a line.

    Splitting the result gives the same field count as Java's
    `String.split`, which discards trailing empty fields. A one-character
    separator is a plain right trim; longer ones need a pattern.
    """
    if len(sep) == 1:
        return F.rtrim(_col(c), F.lit(sep))
    return F.regexp_replace(_col(c), f"(?:{re.escape(sep)})+$", "")


def split_fields(c: Column | str, sep: str = ",", limit: int = -1) -> Column:
    """Split a line on a literal separator; `limit > 0` keeps the rest whole."""
    return F.split(_col(c), re.escape(sep), limit)


def field(fields: Column, index: int) -> Column:
    """0-based array access that yields null instead of failing when short."""
    return F.get(fields, index)


def strict_int(c: Column | str, what: str) -> Column:
    """Cast text to INT and fail the job on anything that is not an integer.

    Accepts an optional sign and decimal digits only (no fraction, no
    exponent), within the INT range; anything else raises, like the integer
    parsing of the original job. Independent of the session's ANSI setting.
    """
    text = _col(c)
    value = text.try_cast("int")
    valid = text.rlike(INTEGER_PATTERN) & value.isNotNull()
    return F.when(
        text.isNotNull() & ~valid,
        F.raise_error(F.concat(F.lit(f"malformed {what}: '"), text, F.lit("'"))),
    ).otherwise(value)
