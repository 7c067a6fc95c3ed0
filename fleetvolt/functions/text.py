"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals_ignore_case(c: Column | str, value: str) -> Column:
    """``lower(c) == lower(value)``.

    ``lower(c)`` cannot be pushed to a parquet scan. For an ASCII ``value`` every case
    variant of it sorts between its all-upper and all-lower spellings, so that range is added
    as well: it is implied by the exact test (the result is unchanged) and it is pushed down,
    letting row-group statistics skip data. The one character outside ASCII that lower-cases to an
    ASCII one is the Kelvin sign (to ``k``), so a value with a ``k`` gets no range."""
    col = F.col(c) if isinstance(c, str) else c
    exact = F.lower(col) == F.lit(value.lower())
    if value.isascii() and "k" not in value.lower():
        return col.between(F.lit(value.upper()), F.lit(value.lower())) & exact
    return exact
