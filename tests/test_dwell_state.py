from datetime import datetime

import pytest

from fleetvolt.operators import latest as L
from fleetvolt.operators.dwell import dwell_statistics
from fleetvolt.operators.dwell_state import advance_dwell_state, dwell_state, dwell_statistics_from_state

from helpers import asset_view, assets, readings, rows

STATS = ("TotalYears", "HighPercent", "MediumPercent", "LowPercent", "CriticalPercent")


def _data(spark):
    av = asset_view(spark, [(1, "A1", "t1", 7, "Acme", "Solar", "Active"), (2, "A2", "t2", 7, "Acme", "Solar", "Active"),
                            (3, "A3", "t3", 8, "Other", "Solar", "Active"), (4, "A4", "t4", 7, "Acme", "Solar", "Retired"),
                            (5, "A5", "t5", 8, "Other", "Solar", "Active")])
    a = assets(spark, [(1, "A1", "t1", 7, 100), (2, "A2", "t2", 7, None), (3, "A3", "t3", 8, 200),
                       (4, "A4", "t4", 7, 100), (5, "A5", "t5", 8, 300)])
    data = []
    i = 0
    for asset, org, n in ((1, 7, 40), (2, 7, 25), (3, 8, 30), (4, 7, 10), (5, None, 12)):
        for k in range(n):
            i += 1
            # asset 5 moves between organizations 8 and 7 (and some readings carry none)
            o = (8 if k % 3 == 0 else 7 if k % 3 == 1 else None) if asset == 5 else org
            t = f"2024-01-{1 + (k * 3) % 28:02d} {(k * 7) % 24:02d}:{(k * 11) % 60:02d}:{k % 60:02d}"
            v = [None, 0.0, 3.0, 3.19, 3.2, 3.21, 3.3, 3.4][(k + asset) % 8]
            data.append((i, o, asset, t, v))
    # a tie on time (larger id later), a reading without time, one without asset
    data += [(900, 7, 1, "2024-01-05 06:00:00", 3.3), (901, 7, 1, "2024-01-05 06:00:00", 3.1),
             (902, 7, 2, None, 3.3), (903, 7, None, "2024-01-03 00:00:00", 3.3)]
    return readings(spark, data), av, a


FILTERS = [dict(), dict(organization_id=8), dict(organization_ids=[7]), dict(organization_ids=[7, 8]),
           dict(organization_ids=[7, 8], exclude_asset_group_id=100), dict(organization_id=8, exclude_asset_group_id=300),
           dict(organization_id=8, organization_ids=[7], exclude_asset_group_id=200), dict(organization_ids=[9])]


@pytest.mark.parametrize("cut_day", [None, 15])
def test_incremental_state_equals_full_dwell(spark, cut_day):
    r, av, a = _data(spark)
    if cut_day is None:
        state = dwell_state(r)
    else:
        cut = datetime(2024, 1, cut_day, 12)
        state = advance_dwell_state(dwell_state(L.time_range(r, "EventTime", hi=cut)),
                                    L.time_range(r, "EventTime", lo=cut, lo_inclusive=False))
    for kw in FILTERS:
        want = rows(dwell_statistics(r, av, a, device_type="Solar", **kw), *STATS)
        got = rows(dwell_statistics_from_state(state, av, a, device_type="Solar", **kw), *STATS)
        assert got == want, kw


def test_an_asset_has_a_run_for_each_stay_in_an_organization(spark):
    _, av, a = _data(spark)
    stays = [(7, 3), (8, 1), (8, 4), (None, 2), (7, 5)]
    data, i = [], 0
    for day, (org, n) in enumerate(stays, 1):
        for k in range(n):
            i += 1
            data.append((i, org, 5, f"2024-01-{day:02d} {k:02d}:30:00", 3.4))
    state = dwell_state(readings(spark, data))
    assert sorted((x.FirstMinute, x.OrganizationId, x.Readings) for x in state.collect())[0][1:] == (7, 3)
    assert [(x.OrganizationId, x.Readings) for x in state.orderBy("FirstMinute").collect()] == [(7, 3), (8, 5), (None, 2), (7, 5)]


def test_organizations_that_share_minutes(spark):
    """Readings of three organizations of one asset within the same minutes, in every order, cut at every point."""
    import itertools

    av = asset_view(spark, [(1, "A1", "t1", 7, "Acme", "Solar", "Active")])
    a = assets(spark, [(1, "A1", "t1", 8, 100)])
    data, i = [], 0
    for minute, orgs in enumerate(itertools.permutations((7, 8, None, 7, 8), 4)):
        for k, org in enumerate(orgs):
            i += 1
            if (i * 7) % 11:
                data.append((i, org, 1, f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:{k * 15:02d}", 3.0 + (i * 3 % 5) / 10))
    r = readings(spark, data)
    cut = datetime(2024, 1, 1, 0, 40, 20)
    states = [dwell_state(r), advance_dwell_state(dwell_state(L.time_range(r, "EventTime", hi=cut)),
                                                  L.time_range(r, "EventTime", lo=cut, lo_inclusive=False))]
    for kw in (dict(), dict(organization_ids=[7, 8]), dict(organization_ids=[7]), dict(exclude_asset_group_id=5)):
        want = rows(dwell_statistics(r, av, a, device_type="Solar", **kw), *STATS)
        for state in states:
            assert rows(dwell_statistics_from_state(state, av, a, device_type="Solar", **kw), *STATS) == want, kw


def test_state_of_no_readings(spark):
    r, av, a = _data(spark)
    empty = r.where("false")
    got = dwell_statistics_from_state(dwell_state(empty), av, a, device_type="Solar").first()
    assert got.TotalYears is None and got.HighPercent == 0.0
    # advancing with nothing new changes nothing
    s = dwell_state(r)
    cols = ("AssetId", "OrganizationId", "Readings", "MinutesHigh", "LastTime", "LastId", "FirstMinute")
    assert rows(advance_dwell_state(s, empty), *cols) == rows(s, *cols)
