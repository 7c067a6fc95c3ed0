"""Incremental dwell statistics: runs of each asset's readings that later runs only add to.

``dwell_statistics`` reads the whole history on every run. The state keeps, per asset, the runs of readings that carry
the same organization as segments (``dwell_segments``): first and last reading, the number of readings and the minutes per
band inside the run.

* ``dwell_state(readings)`` makes the runs of readings up to a cut-off.
* ``advance_dwell_state(state, new)`` appends the runs of readings after that cut-off, and makes one run of a run that goes on.
  This is exact because every new reading comes after every old one (the same no-late-data assumption as
  ``latest_reading_incremental``). Only the new readings are read; the state is a few rows per asset.
* ``dwell_statistics_from_state(state, ...)`` applies the report's filters to the runs. Every filter (active devices,
  organization list or id, group exclusion) tests the asset and the organization of a reading, so it selects whole runs, and the
  selected runs are merged as the selected readings would be. No reading is read again, also not for assets
  that change their organization.

An asset has as many runs as its readings change their organization, plus one; readings that alternate between organizations in
every minute have a run for each minute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fleetvolt.config import PowerBands
from fleetvolt.operators.dwell import dwell_readings, segment_statistics
from fleetvolt.operators.dwell_segments import SEGMENT, compacted, merged, organization_runs

STATE = ["AssetId", "OrganizationId", *SEGMENT]


def dwell_state(readings: DataFrame, bands: PowerBands = PowerBands()) -> DataFrame:
    """The runs of ``readings`` (all of them: the caller bounds them by time): columns ``STATE``."""
    return organization_runs(readings, bands).select(*STATE)


def advance_dwell_state(state: DataFrame, new_readings: DataFrame, bands: PowerBands = PowerBands()) -> DataFrame:
    """The state over the old readings plus ``new_readings``, which must all be later than
    every reading the state covers (pass the readings after the state's cut-off)."""
    return compacted(state.select(*STATE).unionByName(dwell_state(new_readings, bands))).select(*STATE)


def dwell_statistics_from_state(state: DataFrame, asset_view: DataFrame, assets: DataFrame,
                                organization_id: int | None = None, organization_ids: Sequence[int] | None = None,
                                exclude_asset_group_id: int | None = None, device_type: str = "") -> DataFrame:
    """The same row as ``dwell_statistics`` over the readings the state covers."""
    runs = dwell_readings(state, asset_view, assets, organization_id, organization_ids, exclude_asset_group_id, device_type)
    return segment_statistics(merged(runs, ["AssetId"]))
