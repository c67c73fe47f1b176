"""Integer casts of string levels with the two failure modes used upstream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(c: Column | str) -> Column:
    """``SAFE_CAST(x AS INT64)``: NULL when ``x`` is not an integer."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("bigint")


def strict_int(c: Column | str, what: str = "value") -> Column:
    """``CAST(x AS INT64)``: fails the job on a non-integer, whatever the
    session's ANSI setting; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    parsed = c.try_cast("bigint")
    return F.when(c.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot cast {what} to BIGINT: "),
                                         c.cast("string")))
                  ).otherwise(parsed)
