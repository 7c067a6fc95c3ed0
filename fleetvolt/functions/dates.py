"""Date labels used in snapshot names, the sent-date log and report headings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetvolt import constants as K


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def date_label(d: Column | str) -> Column:
    """File label such as ``5Jan26`` (no leading zero on the day)."""
    return F.date_format(_c(d), K.LABEL_FORMAT)


def parse_label(label: Column | str) -> Column:
    """Date from a label with or without a leading zero (``5Jan26``, ``05Jan26``); NULL if the
    text is not a label."""
    return F.try_to_date(F.trim(_c(label)), K.LABEL_FORMAT)


def display_date(d: Column | str, with_year: bool = True, full_month: bool | None = None) -> Column:
    """Heading text: ``5 Jan 2026`` or, without the year, ``5 January``. ``full_month`` picks the
    other two forms of the reports: ``5 January 2026`` (True) and, without the year, ``5 Jan`` (False)."""
    if full_month is None:
        full_month = not with_year
    if with_year:
        return F.date_format(_c(d), K.DISPLAY_LONG if full_month else K.DISPLAY_FORMAT)
    return F.date_format(_c(d), K.DISPLAY_DAY_MONTH if full_month else K.DISPLAY_SHORT)


def snapshot_file_name(d: Column | str, source: Column | str) -> Column:
    """Name of a stored snapshot file: ``latest_batt_<label>_<source>.csv``. ``source`` is a
    source name (text) or a column holding one."""
    src = F.lit(source) if isinstance(source, str) else source
    return F.concat(F.lit(K.SNAPSHOT_PREFIX), date_label(d), F.lit("_"), src, F.lit(K.SNAPSHOT_SUFFIX))
