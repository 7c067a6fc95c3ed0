"""Legacy payload text: voltage and power-mode label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetvolt import constants as K


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def payload_voltage(payload: Column | str) -> Column:
    """Voltage written as ``Battery Level <digits>.<digits>``; NULL when absent or not numeric."""
    txt = F.regexp_extract(_c(payload), K.VOLTAGE_PATTERN, 1)
    return F.nullif(txt, F.lit("")).try_cast("double")


def payload_mode(payload: Column | str) -> Column:
    """The word after ``Power mode``; the text ``None`` when there is no such label."""
    word = F.regexp_extract(_c(payload), K.MODE_PATTERN, 1)
    return F.coalesce(F.nullif(word, F.lit("")), F.lit(K.NO_LABEL))
