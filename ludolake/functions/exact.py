"""Exact ratio rounding.

``ROUND(a / b, 2)`` on floats depends on float noise near a tie, and engines
disagree on ties (HALF_UP vs. HALF_EVEN on the binary value). Every ratio in
the metric tables is a quotient of integers, so it is computed in integers and
rounded half away from zero: ``((200*|num| + den) div (2*den)) / 100`` with the
sign of ``num``. The result is exact, reproducible and order-independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio2(num: Column | str, den: Column | str) -> Column:
    """``round(num / den, 2)``, half away from zero, as DOUBLE; NULL when
    ``den`` is 0 or NULL. Integer expressions; ``den`` isn't negative."""
    n = _col(num).cast("decimal(38,0)")
    d = F.nullif(_col(den).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    # Integral division (SQL ``div``): exact, unlike decimal ``/`` whose
    # quotient is rounded to a fixed scale before ``floor`` could see it.
    hundredths = F.call_function("div", F.abs(n) * 200 + d, d * 2)
    return F.when(n < 0, -hundredths).otherwise(hundredths) / F.lit(100.0)


def money(c: Column | str) -> Column:
    """Money as DECIMAL(38, 12): sums become exact and order-independent.

    Bounds: amounts are rounded to 12 decimals, sums stay below 10**15 where
    they are multiplied by a count (``MONEY_FACTOR``)."""
    return _col(c).cast("decimal(38,12)")


#: Types that keep all 12 decimals through a product with a count, and a sum:
#: Spark takes decimals away where a result could need more than 38 digits.
MONEY_FACTOR, COUNT_FACTOR, MONEY_ADDEND = "decimal(27,12)", "decimal(10,0)", "decimal(37,12)"
