"""Typed lookup of one event parameter in the raw ``event_params`` array.

The warehouse form is a correlated scalar subquery over the unnested array
(``SELECT value.<slot> FROM UNNEST(event_params) WHERE key = K``). Here it is
the position of the key, looked up in the slot's own array: no explode, no
shuffle. The slot is taken before the element (``params.value.<slot>[i]``),
because only then does nested-column pruning read just ``key`` and that slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = ("string", "int", "double")


def _value(arr: Column, key: str, slot: str) -> Column:
    """The slot of the first entry with that key; NULL without one."""
    at = F.array_position(arr["key"], F.lit(key))
    # ``get`` is NULL out of bounds (``element_at`` raises under ANSI mode).
    return F.get(arr["value"][f"{slot}_value"], (at - 1).cast("int"))


def _occurrences(arr: Column, key: str) -> Column:
    return F.size(F.filter(arr["key"], lambda k: k == F.lit(key)))


def param(key: str, slot: str, strict: bool = True,
          params: str | Column = "event_params") -> Column:
    """Value of parameter ``key`` read from its ``<slot>_value`` field.

    NULL when the key is absent, the array is empty or NULL, or the value was
    stored in another slot. A key present twice makes the scalar subquery of
    the warehouse fail; ``strict=True`` raises likewise, ``strict=False``
    takes the first match.
    """
    if slot not in SLOTS:
        raise ValueError(f"slot must be one of {SLOTS}, got {slot!r}")
    arr = F.col(params) if isinstance(params, str) else params
    value = _value(arr, key, slot)
    if strict:
        value = F.when(
            _occurrences(arr, key) > 1,
            F.raise_error(F.lit(f"event parameter '{key}' occurs more than once")),
        ).otherwise(value)
    return value


def with_params(df: DataFrame, outputs: list[tuple], strict: bool = True,
                params: str = "event_params") -> DataFrame:
    """Select ``outputs``: ``(alias, column)``, ``(alias, key, slot)`` or
    ``(alias, key, slot, when)`` items; a ``when`` condition limits the
    lookup (and its duplicate check) to the rows where it holds, else NULL.

    The strict duplicate check is two-level: one codegen'd test per row
    (are all keys of the row distinct?) and, only for a row that has some
    repeated key, a count of the wanted key's matches. The common row pays
    one ``array_distinct`` instead of a second pass per parameter.
    """
    arr = F.col(params)
    keys_distinct = F.size(F.array_distinct(arr["key"])) == F.size(arr["key"])
    cols = []
    for out in outputs:
        if len(out) >= 3:
            alias, key, slot = out[:3]
            if slot not in SLOTS:
                raise ValueError(f"slot must be one of {SLOTS}, got {slot!r}")
            value = _value(arr, key, slot)
            if strict:
                value = F.when(
                    ~keys_distinct & (_occurrences(arr, key) > 1),
                    F.raise_error(F.lit(f"event parameter '{key}' occurs more than once")),
                ).otherwise(value)
            if len(out) == 4:
                value = F.when(out[3], value)
            cols.append(value.alias(alias))
        else:
            alias, col = out
            cols.append(col.alias(alias))
    return df.select(*cols)
