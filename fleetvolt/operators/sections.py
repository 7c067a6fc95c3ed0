"""Customer sections (cohorts) of the reports, computed in one pass over a snapshot.

A snapshot has one row per device (per report date for the weekly trend). Every section's
predicate is evaluated on each row at once; the names of the matching sections form an array
that is exploded into a long ``section`` column. A device may belong to several sections.
One scan of the snapshot serves all sections, with no union of per-section scans.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import SectionSpec
from fleetvolt.functions.devices import is_numbered_series, is_paired
from fleetvolt.functions.timecalc import ntz, ratio_percent
from fleetvolt.operators.order import table_order
from fleetvolt.operators.positions import with_position

LISTED = "_listed"


def recent(ts: str, as_of: datetime, window: timedelta = K.RECENCY) -> Column:
    """``|as_of - ts| <= window``, written as a range so that it can prune a scan."""
    return F.col(ts).between(ntz(as_of - window), ntz(as_of + window))


def recent_devices(snapshot: DataFrame, as_of: datetime, window: timedelta = K.RECENCY) -> DataFrame:
    return snapshot.where(recent("EventTimeUTC", as_of, window))


def with_listed_flag(snapshot: DataFrame, allow_list: DataFrame | None) -> DataFrame:
    """Boolean ``_listed``: the device id is on the allow-list. A left join to the *distinct*
    list (so rows are never multiplied) and a not-NULL test; a semi-join cannot be used because
    the flag sits inside an OR."""
    if allow_list is None:
        return snapshot.withColumn(LISTED, F.lit(False))
    lst = allow_list.select(F.col("DeviceID").alias("_lid")).where("_lid IS NOT NULL").distinct()
    j = snapshot.join(lst, snapshot.DeviceID == lst._lid, "left")
    return j.select(*[snapshot[c] for c in snapshot.columns], F.col("_lid").isNotNull().alias(LISTED))


def section_predicate(spec: SectionSpec, as_of: datetime, window: timedelta) -> Column:
    p = ((F.lower(F.col("CustomerName")) == F.lit(spec.customer.lower()))
         & is_paired("DeviceID", "DeviceName")
         & recent("EventTimeUTC", as_of, window))
    if spec.id_prefix is not None:
        p = p & F.col("DeviceID").startswith(spec.id_prefix)
    if spec.listed_or_series:
        series = is_numbered_series("DeviceID", spec.series_min)
        if spec.series_prefix is not None:
            series = F.col("DeviceID").startswith(spec.series_prefix) & series
        p = p & (F.col(LISTED) | series)
    return F.coalesce(p, F.lit(False))


def _names(specs: Sequence[SectionSpec], as_of: datetime, window: timedelta) -> Column:
    return F.array_compact(F.array(*[F.when(section_predicate(sp, as_of, window), F.lit(sp.name)) for sp in specs]))


def assign_sections(snapshot: DataFrame, specs: Sequence[SectionSpec], as_of: datetime,
                    window: timedelta = K.RECENCY, allow_list: DataFrame | None = None,
                    active: DataFrame | None = None) -> DataFrame:
    """Long form ``section`` + snapshot columns for every (section, member device).

    ``active``: a frame with ``DeviceID`` of active devices, or None for no filter
    (an empty frame removes everything; None keeps everything).
    """
    s = snapshot.where(F.col("DeviceID").isNotNull() & F.col("DeviceName").isNotNull())
    if active is not None:
        s = s.join(active.select("DeviceID").where("DeviceID IS NOT NULL"), "DeviceID", "left_semi")
    if any(sp.listed_or_series for sp in specs):
        s = with_listed_flag(s, allow_list)
    return s.select(F.explode(_names(specs, as_of, window)).alias("section"), *snapshot.columns)


def with_device_sections(snapshot: DataFrame, specs: Sequence[SectionSpec], as_of: datetime,
                         window: timedelta = K.RECENCY, allow_list: DataFrame | None = None,
                         active: DataFrame | None = None) -> DataFrame:
    """The snapshot rows that carry a device id, with ``_sections``: the names of the sections that any row of the same device
    id is a member of (as ``assign_sections`` has it). One pass over the snapshot: the rows of a device, one or a few, meet in
    a window, so that nothing is joined back or stored."""
    s = snapshot.where(F.col("DeviceID").isNotNull())
    member = F.col("DeviceName").isNotNull()
    if active is not None:
        ids = active.select(F.col("DeviceID").alias("_aid")).where("_aid IS NOT NULL").distinct()
        s = s.join(ids, F.col("DeviceID") == F.col("_aid"), "left")
        member = member & F.col("_aid").isNotNull()
    if any(sp.listed_or_series for sp in specs):
        s = with_listed_flag(s, allow_list)
    own = F.when(member, _names(specs, as_of, window)).otherwise(F.array().cast("array<string>"))
    of_device = F.flatten(F.collect_list("_own").over(Window.partitionBy("DeviceID")))
    return s.withColumn("_own", own).select(*snapshot.columns, F.array_distinct(of_device).alias("_sections"))


def section_mode_counts(members: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Devices per (section, power mode); modes that do not occur have no row."""
    return (members.where(F.col("PowerMode").isNotNull())
            .groupBy(*by, "section", "PowerMode").agg(F.count(F.lit(1)).alias("n")))


def section_mode_summary(members: DataFrame, specs: Sequence[SectionSpec],
                         modes: Sequence[str] = K.TABLE_MODES, by: Sequence[str] = ()) -> DataFrame:
    """Zero-filled counts of the report modes (Critical, Low, Medium) and all members, per
    section, including sections without members.

    One global (or per-``by``) aggregate computes a count for every (section, mode) pair
    with conditional counts, and an array of structs turns the wide row into one row per section.
    Empty sections therefore still give zeros and no join with a section list is needed.
    """
    aggs = []
    for i, sp in enumerate(specs):
        in_s = F.col("section") == F.lit(sp.name)
        aggs.append(F.count_if(in_s).alias(f"_{i}__n"))
        for m in modes:
            aggs.append(F.count_if(in_s & (F.col("PowerMode") == F.lit(m))).alias(f"_{i}__{m}"))
    wide = members.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(sp.name).alias("section"), F.col(f"_{i}__n").alias("members"),
                              *[F.col(f"_{i}__{m}").alias(m) for m in modes]) for i, sp in enumerate(specs)])
    return wide.select(*by, F.inline(rows))


def cohort_shares(sectioned: DataFrame, modes: Sequence[str] = K.MODES,
                  paired_only: bool = True, customer: str | None = None) -> DataFrame:
    """Share of each of the four modes among the snapshot rows whose ``DeviceID`` is a member
    of the section (and paired; or of ``customer`` when ``paired_only`` is False), in percent
    with 2 decimals, from the rows of ``with_device_sections``. The denominator is every such row, ``Unknown`` included,
    so the four shares can sum below 100. Every (section, mode) pair appears, with 0 when absent."""
    # the chart tests "id differs from name" on the whole snapshot, where a missing name
    # counts as different (the member lists themselves never contain such rows)
    cond = F.coalesce(is_paired("DeviceID", "DeviceName"), F.lit(True)) if paired_only else \
        (F.lower(F.col("CustomerName")) == F.lit((customer or "").lower()))
    rows = sectioned.where(cond).select("PowerMode", F.explode("_sections").alias("section"))
    aggs = [F.count(F.lit(1)).alias("total")] + \
        [F.count_if(F.col("PowerMode") == F.lit(m)).alias(f"_n_{m}") for m in modes]
    per = rows.groupBy("section").agg(*aggs)
    stack = F.expr(f"stack({len(modes)}, " + ", ".join(f"'{m}', `_n_{m}`" for m in modes)
                   + ") AS (PowerMode, n)")
    long = per.select("section", "total", stack)
    return long.select("section", "PowerMode", "n", "total",
                       ratio_percent("n", "total").alias("share"))


def section_tables(members: DataFrame, specs: Sequence[SectionSpec],
                   drop: Sequence[str] = K.DROPPED_TABLE_COLUMNS) -> DataFrame:
    """Rows listed in each section's table: members whose mode is one of the section's table
    modes, without the internal columns (absent ones are ignored)."""
    cond = F.lit(False)
    for sp in specs:
        cond = cond | ((F.col("section") == F.lit(sp.name)) & F.col("PowerMode").isin(list(sp.table_modes)))
    return members.where(cond).drop(*drop)


def section_preview(tables: DataFrame, limit: int | None = K.PREVIEW_LIMIT,
                    by: Sequence[str] = ()) -> DataFrame:
    """First ``limit`` rows of each section table by voltage (ascending, missing last), with
    the table's total row count and the row's ``position``.

    ``row_number() <= limit`` is planned with a partial WindowGroupLimit, so at most ``limit``
    rows per section leave each task, however large a section is. ``limit=None`` ("show
    all") numbers the whole tables over ranges of their order (``positions``), so no section is one task."""
    totals = tables.groupBy(*by, "section").agg(F.count(F.lit(1)).alias("total_rows"))
    tie = [c for c in ("ReportID", "EventTimeUTC") if c in tables.columns]
    order = table_order() + [F.col(c).asc_nulls_last() for c in tie]
    if limit is None:
        return with_position(tables, order, [*by, "section"]).join(totals, [*by, "section"], "inner")
    w = Window.partitionBy(*by, "section").orderBy(*order)
    ranked = (tables.withColumn("position", F.row_number().over(w).cast("long"))
              .where(F.col("position") <= limit))
    return ranked.join(totals, [*by, "section"], "inner")


def low_battery(sectioned: DataFrame, section: str, modes: Sequence[str] = K.TABLE_MODES) -> DataFrame:
    """Snapshot rows of devices in ``section`` whose mode is one of ``modes``, from the rows of ``with_device_sections``."""
    return sectioned.where(F.array_contains("_sections", section) & F.col("PowerMode").isin(list(modes))).drop("_sections")
