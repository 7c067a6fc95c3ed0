from datetime import date, datetime

from fleetvolt.operators import latest as L
from fleetvolt.plans import jobs as J

from helpers import assets, bursts, orgs, readings, rows, ts


def test_tied_times_go_to_larger_id(spark):
    r = readings(spark, [(1, 1, 10, "2024-01-05 10:00:00", 3.5), (2, 1, 10, "2024-01-05 10:00:00", 3.0)])
    out = L.latest_reading(r).collect()
    assert len(out) == 1 and out[0].ReportID == 2 and out[0].Voltage == 3.0


def test_invalid_newest_reading_falls_back(spark):
    r = readings(spark, [(1, 1, 10, "2024-01-01 00:00:00", 3.4), (2, 1, 10, "2024-01-02 00:00:00", 0.0),
                         (3, 1, 10, "2024-01-03 00:00:00", None), (4, 1, 11, "2024-01-03 00:00:00", 2.0)])
    out = rows(L.latest_reading(r), "AssetId", "ReportID")
    assert out == [(10, 1)]  # asset 11 has no valid reading (2.0 is not > 2)


def test_cut_offs_current_midnight_and_legacy_noon(spark):
    r = readings(spark, [(1, 1, 10, "2024-01-04 23:00:00", 3.3), (2, 1, 10, "2024-01-05 00:00:00", 3.3),
                         (3, 1, 10, "2024-01-05 12:00:00", 3.3), (4, 1, 10, "2024-01-05 23:59:00", 3.3)])
    snap = J.daily_snapshot(r, assets(spark, []), orgs(spark, []), date(2024, 1, 5))
    assert [x.ReportID for x in snap.collect()] == [2]          # midnight inclusive, same day excluded
    b = bursts(spark, [(i, "A01", "n", t, "Battery Level 3.30 Power mode High", "Acme", 1)
                       for i, t in [(1, "2024-01-05 00:00:00"), (2, "2024-01-05 12:00:00"), (3, "2024-01-05 23:59:00")]])
    leg = L.legacy_latest(b, "acme", "A0", report_date=date(2024, 1, 5)).collect()
    assert [x.ID for x in leg] == [2]                           # noon inclusive


def test_lookback_month_end(spark):
    b = bursts(spark, [(1, "A01", "n", "2024-02-28 23:59:59", "Battery Level 3.30", "ACME", 1),
                       (2, "A02", "n", "2024-02-29 00:00:00", "Battery Level 3.30", "ACME", 1),
                       (3, "A03", "n", "2023-02-28 00:00:00", "Battery Level 3.30", "ACME", 1)])
    got = rows(L.legacy_latest(b, "Acme", "A0", report_date=date(2024, 6, 29)), "ID")
    assert got == [(2,)]   # 29 Jun - 4 months = 29 Feb
    b2 = bursts(spark, [(1, "A01", "n", "2023-02-28 00:00:00", "Battery Level 3.30", "ACME", 1),
                        (2, "A02", "n", "2023-02-27 23:59:59", "Battery Level 3.30", "ACME", 1)])
    got2 = rows(L.legacy_latest(b2, "acme", "A0", report_date=date(2023, 6, 30)), "ID")
    assert got2 == [(1,)]  # 30 Jun - 4 months = 28 Feb (month end clamps)


def test_legacy_filters(spark):
    b = bursts(spark, [
        (1, "A01", "n", "2024-01-01 00:00:00", "Battery Level 3.30 Power mode High", "acme", 1),
        (2, "A02", "n", "2024-01-01 00:00:00", "Battery Level 0.50 Power mode Low", "ACME", 1),
        (3, "A03", "n", "2024-01-01 00:00:00", "Battery Level 3.30", "ACME", 2),
        (4, "B04", "n", "2024-01-01 00:00:00", "Battery Level 3.30", "ACME", 1),
        (5, "A05", "n", "2024-01-01 00:00:00", "Battery Level 3.30", "Other", 1),
        (6, "A06", "n", "2024-01-01 00:00:00", "no level", "ACME", 1)])
    got = rows(L.legacy_latest(b, "Acme", "A0", report_date=date(2024, 1, 2)), "ID")
    assert got == [(1,)]


def test_enrich_uses_reading_org_and_keeps_unmatched(spark):
    r = readings(spark, [(1, 7, 10, "2024-01-01 00:00:00", 3.4), (2, 8, 99, "2024-01-01 00:00:00", 3.4)])
    a = assets(spark, [(10, "A0001", "truck 1", 5, 1)])
    o = orgs(spark, [(7, "Acme"), (5, "Other")])
    out = {x.AssetId: x for x in L.enrich(L.latest_reading(r), a, o).collect()}
    assert out[10].DeviceID == "A0001" and out[10].DeviceName == "truck 1" and out[10].CustomerName == "Acme"
    assert out[99].DeviceID is None and out[99].CustomerName is None


def test_multi_date_equals_single_date(spark):
    data = []
    i = 0
    for a in range(6):
        for day in range(1, 11):
            for h in (0, 6, 23):
                i += 1
                v = 1.0 if (i % 7 == 0) else 3.0 + (i % 5) / 10
                data.append((i, 1, a if a < 5 else None, f"2024-01-{day:02d} {h:02d}:00:00", v))
    # ties: same time, different id
    data.append((10_001, 1, 0, "2024-01-05 06:00:00", 3.9))
    data.append((10_002, 1, 1, "2024-01-04 06:00:00", 3.9))   # exactly on a 06:00 cut-off
    r = readings(spark, data)
    for dates, hour in (([date(2024, 1, d) for d in (1, 3, 4, 5, 8, 12)], 0),
                        ([date(2024, 1, d) for d in range(2, 10)], 0),
                        ([date(2024, 1, d) for d in range(2, 10)], 6)):
        multi = L.latest_as_of_many(r, dates, hour=hour)
        got = rows(multi, "report_date", "AssetId", "ReportID", "Voltage")
        want = []
        for d in dates:
            one = L.latest_reading(r, datetime(d.year, d.month, d.day, hour))
            want += [(d,) + t for t in rows(one, "AssetId", "ReportID", "Voltage")]
        assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 20


def test_one_row_per_asset_on_test_data(spark):
    from fleetvolt.sources import standin as SI
    r = SI.readings(spark, "/root/testdata/sf0.001")
    snap = L.latest_reading(r)
    assert snap.count() == snap.select("AssetId").distinct().count()


def test_recent_sample_is_top_n(spark):
    b = bursts(spark, [(i, "A01", "n", f"2024-01-{i:02d} 00:00:00", "x", "Acme", 1) for i in range(1, 21)])
    got = [x.ID for x in L.recent_sample(b, "acme", 5).collect()]
    assert got == [20, 19, 18, 17, 16]


def test_flagship_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "PowerMode" in df.columns and "report_date" in df.columns


def test_thousands_of_irregular_moments_in_one_pass(spark):
    import bisect
    import random
    from datetime import datetime, timedelta

    from fleetvolt.operators import latest as L
    random.seed(7)
    start = datetime(2024, 1, 1)
    data = [(i, 1, random.choice([1, 2, 3, None]), start + timedelta(seconds=random.randint(0, 400_000)), random.choice([1.0, 3.0, 3.3])) for i in range(400)]
    data += [(1000 + i, 1, 1, start + timedelta(seconds=777), 3.1) for i in range(3)]
    r = readings(spark, [(i, o, a, str(t), v) for i, o, a, t, v in data])
    moments = sorted({start + timedelta(seconds=random.randint(-1000, 500_000), microseconds=random.randint(0, 3)) for _ in range(5000)} | {data[0][3]})
    got = {(x.as_of, x.AssetId): x.ReportID for x in L.latest_as_of_moments(r, moments).collect()}
    want = {}
    for asset in (1, 2, 3, None):
        own = sorted((t, i) for i, _, a, t, v in data if a == asset and v > 2)
        for m in moments:
            k = bisect.bisect_right(own, (m, 10 ** 9))
            if k:
                want[m, asset] = own[k - 1][1]
    assert got == want
