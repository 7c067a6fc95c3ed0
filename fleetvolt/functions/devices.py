"""Device-id predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetvolt import constants as K


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def is_numbered_series(device_id: Column | str, minimum: int = K.SERIES_MIN,
                       digits: int = K.SERIES_DIGITS) -> Column:
    """True when the last ``digits`` characters are all ASCII digits and, read as a number,
    are ``>= minimum``. NULL or shorter ids give False (never NULL)."""
    c = _c(device_id)
    tail = F.right(c, F.lit(digits))
    ok = (F.length(c) >= digits) & tail.rlike(f"^[0-9]{{{digits}}}$") & (tail.try_cast("int") >= minimum)
    return F.coalesce(ok, F.lit(False))


def is_paired(device_id: Column | str, device_name: Column | str) -> Column:
    """A device is paired when its id differs from its name (case-sensitive)."""
    return _c(device_id) != _c(device_name)
