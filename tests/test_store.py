import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import SectionSpec
from fleetvolt.plans import jobs as J
from fleetvolt.plans import runner as RN
from fleetvolt.sources.exports import export_overflow
from fleetvolt.sources.legacy_files import read_snapshot_files
from fleetvolt.sources.sent_log import append_sent_dates, read_sent_dates
from fleetvolt.sources.store import SnapshotStore

from helpers import asset_view, assets, orgs, readings, rows


def _tables(spark):
    r = readings(spark, [(i, 1, 1 + i % 3, f"2024-01-{1 + i % 9:02d} {i % 24:02d}:00:00", 3.0 + (i % 6) / 10)
                         for i in range(1, 120)])
    a = assets(spark, [(1, "A0006001", "t1", 1, 1), (2, "A0000002", "t2", 1, 1), (3, "C3", "t3", 1, 2)])
    o = orgs(spark, [(1, "Acme")])
    av = asset_view(spark, [(1, "A0006001", "t1", 1, "Acme", "Solar", "Active"),
                            (2, "A0000002", "t2", 1, "Acme", "Solar", "Active"),
                            (3, "C3", "t3", 1, "Acme", "Solar", "Retired")])
    return RN.Tables(r, a, o, av)


def test_store_roundtrip_idempotent(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    d = date(2024, 1, 6)
    first = rows(RN.run_daily_snapshot(t, st, d), "AssetId", "ReportID", "PowerMode")
    direct = rows(J.daily_snapshot(t.readings, t.assets, t.organizations, d), "AssetId", "ReportID", "PowerMode")
    assert first == direct and len(first) == 3
    st.write(J.daily_snapshot(t.readings, t.assets, t.organizations, d), K.SOURCE_CURRENT, [d])
    assert st.read([d], K.SOURCE_CURRENT).count() == 3
    assert rows(st.catalogue()) == [(d, K.SOURCE_CURRENT)]
    # stored snapshot is reused: compute is not called again
    again = st.load_or_compute(d, K.SOURCE_CURRENT, lambda: (_ for _ in ()).throw(AssertionError("recomputed")))
    assert again.count() == 3


def test_backfill_and_weekly(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    RN.run_daily_snapshot(t, st, date(2024, 1, 8))
    done = RN.backfill(t, st, [date(2024, 1, d) for d in range(4, 11)])
    assert date(2024, 1, 8) not in done and len(done) == 6
    per_date = {r.report_date: r.rows for r in st.runs().collect()}
    assert all(v == 3 for v in per_date.values()) and len(per_date) == 7
    for d in (date(2024, 1, 5), date(2024, 1, 9)):
        assert rows(st.read([d]), "AssetId", "ReportID") == \
            rows(J.daily_snapshot(t.readings, t.assets, t.organizations, d), "AssetId", "ReportID")
    log = os.path.join(tmp_dir, "sent")
    specs = [SectionSpec("acme", "acme")]
    trend = RN.run_weekly_trend(t, st, date(2024, 1, 10), specs, "Solar", datetime(2024, 1, 10))
    got = {r.report_date: r.members for r in trend.collect()}
    assert len(got) == 7 and got[date(2024, 1, 10)] == 2   # two active paired devices
    week = RN.week_dates(date(2024, 1, 10))
    RN.log_sent(spark, log, week, recipients=1)            # a trial: nothing is logged
    assert read_sent_dates(spark, log).count() == 0
    RN.log_sent(spark, log, week, recipients=2)
    assert len(read_sent_dates(spark, log).collect()) == 7
    # by the sent log: the days since, and whatever else was not sent
    trend, dates = RN.run_unsent_trend(t, st, date(2024, 1, 12), specs, "Solar", datetime(2024, 1, 12), log)
    assert dates == [date(2024, 1, 11), date(2024, 1, 12)] and trend.count() == 2


def test_early_dates_are_stored_as_empty_snapshots(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    trend = RN.run_weekly_trend(t, st, date(2023, 12, 31), [SectionSpec("acme", "acme")], None, datetime(2024, 1, 1))
    assert {(r.report_date, r.members) for r in trend.collect()} == {(d, 0) for d in RN.week_dates(date(2023, 12, 31))}
    assert all(r.rows == 0 for r in st.runs().collect())
    st.load_or_compute(date(2023, 12, 31), K.SOURCE_CURRENT, lambda: (_ for _ in ()).throw(AssertionError("recomputed")))


def test_an_empty_snapshot_replaces_stored_rows(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    d = date(2024, 1, 6)
    RN.run_daily_snapshot(t, st, d)
    assert st.read([d]).count() == 3
    st.write(J.daily_snapshot(t.readings.where("false"), t.assets, t.organizations, d), K.SOURCE_CURRENT, [d])
    assert st.read([d]).count() == 0 and st.exists(d, K.SOURCE_CURRENT)


def test_sources_keep_their_own_columns(spark, tmp_dir):
    from fleetvolt import schemas
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    d = date(2024, 1, 6)
    leg = spark.createDataFrame([("A1", "n", "c", datetime(2024, 1, 1), "p", 3.3, "High", d)],
                                "DeviceID string, DeviceName string, CustomerName string, EventTimeUTC timestamp_ntz, "
                                "PayloadData string, Voltage double, PowerMode string, report_date date")
    st.write(leg, K.SOURCE_LEGACY, [d])
    RN.run_daily_snapshot(t, st, d)
    assert st.read([d], K.SOURCE_CURRENT).columns == [f.name for f in schemas.SNAPSHOT.fields] + ["report_date", "source"]
    assert st.read([d], K.SOURCE_LEGACY).columns == [f.name for f in schemas.LEGACY_SNAPSHOT.fields] + ["report_date", "source"]
    assert st.read([d], K.SOURCE_CURRENT).count() == 3 and st.read([d], K.SOURCE_LEGACY).count() == 1
    assert RN.run_daily_snapshot(t, st, date(2024, 1, 7), incremental=True).count() == 3


def test_open_snapshot_has_no_upper_bound(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    got = RN.run_open_snapshot(t, st, date(2024, 1, 2))
    assert rows(got, "AssetId", "ReportID") == rows(J.daily_snapshot(t.readings, t.assets, t.organizations, date(2024, 1, 2), open_end=True), "AssetId", "ReportID")
    assert {r.report_date for r in got.collect()} == {date(2024, 1, 2)}


def test_dwell_state_answers_only_for_its_thresholds_and_cut(spark, tmp_dir):
    from fleetvolt.config import PowerBands
    t = _tables(spark)
    path, cut = os.path.join(tmp_dir, "state"), datetime(2024, 1, 8)
    cols = ("TotalYears", "HighPercent", "MediumPercent", "LowPercent", "CriticalPercent")
    for bands in (PowerBands(), PowerBands(high=3.1, medium=3.05, low=3.0)):
        state = RN.run_dwell_state(t, path, cut, bands=bands)
        got = rows(RN.fleet_dwell_from_state(t, state, device_type="Solar"), *cols)
        from fleetvolt.operators import latest as L
        from fleetvolt.operators.dwell import dwell_statistics
        assert got == rows(dwell_statistics(L.time_range(t.readings, "EventTime", hi=cut), t.asset_view, t.assets,
                                            device_type="Solar", bands=bands), *cols)
    with pytest.raises(ValueError):
        RN.run_dwell_state(t, path, cut, prev_cut=cut)
    os.remove(os.path.join(RN._state_dir(path, cut, PowerBands()), "_SUCCESS"))     # a write that was not committed
    assert RN._stored_state(spark, RN._state_dir(path, cut, PowerBands())) is None


def test_missing_column_raises(spark):
    from fleetvolt import schemas
    with pytest.raises(ValueError, match="Voltage"):
        schemas.conform(readings(spark, []).drop("Voltage"), schemas.READINGS)


def test_export_leaves_no_stale_section(spark, tmp_dir):
    schema, out = "section string, ReportID long, Voltage double, DeviceID string", os.path.join(tmp_dir, "export")
    t = spark.createDataFrame([(s, i, 9.0 - i, f"d{i}") for s in "ab" for i in range(5)], schema)
    export_overflow(t, out, limit=3)
    export_overflow(t.where("section = 'a' OR ReportID < 2"), out, limit=3)
    assert [r.section for r in spark.read.option("header", True).csv(out).select("section").distinct().collect()] == ["a"]
    lines = [x for f in sorted(os.listdir(f"{out}/section=a")) if f.endswith(".csv") for x in open(f"{out}/section=a/{f}") if not x.startswith("ReportID")]
    assert [x.split(",")[1] for x in lines] == ["5.0", "6.0", "7.0", "8.0", "9.0"]


def test_sent_log_append_is_idempotent(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    assert read_sent_dates(spark, log).count() == 0          # missing log = empty
    d = spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 1, 6),)], "report_date date")
    assert len(append_sent_dates(spark, log, d).collect()) == 2
    assert len(append_sent_dates(spark, log, d).collect()) == 0
    assert sorted(r.report_date for r in read_sent_dates(spark, log).collect()) == [date(2026, 1, 5), date(2026, 1, 6)]


def test_legacy_snapshot_files(spark, tmp_dir):
    def put(name, secs, header, lines):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(f"### METADATA ###\nquery_time,{secs}\n### DATA ###\n{header}\n" + "\n".join(lines) + "\n")

    cur = "ReportID,OrganizationId,CustomerName,AssetId,DeviceID,DeviceName,EventTimeUTC,Voltage,PowerMode"
    put("latest_batt_5Jan26_smbs.csv", 12.5, cur, ["1,7,Acme,10,A01,t1,2026-01-04 10:00:00,3.31,High",
                                                  "2,7,Acme,11,A02,t2,2026-01-04 11:00:00,,Unknown"])
    put("latest_batt_6Jan26_smbs.csv", 3.0, cur, ["3,7,Acme,10,A01,t1,2026-01-05 10:00:00,3.2,Low"])
    odd = os.path.join(tmp_dir, "odd")
    os.makedirs(odd)
    with open(os.path.join(odd, "latest_batt_6Jan26_debug.csv"), "w") as f:      # first fields that look like the preamble
        f.write("### METADATA ###\nquery_time,1.0\n### DATA ###\nDeviceID,DeviceName,EventTimeUTC,PayloadData,Voltage,PowerMode\n"
                "#7,t1,2026-01-05 10:00:00,p,3.2,Low\n,t2,2026-01-05 10:00:00,p,3.2,Low\n")
    assert rows(read_snapshot_files(spark, odd, K.SOURCE_LEGACY)[0], "DeviceID") == [(None,), ("#7",)]
    leg = "DeviceID,DeviceName,EventTimeUTC,PayloadData,Voltage,PowerMode"
    put("latest_batt_6Jan26_debug.csv", 1.0, leg, ["A01,t1,5/1/2026 10:00,Battery Level 3.20 Power mode Low,3.2,Low"])
    put("latest_batt_7Jan26_debug.csv", 2.0, leg, ["A01,t1,13/1/2026 9:00,Battery Level 3.40,3.4,High"])
    rows_c, runs_c = read_snapshot_files(spark, tmp_dir, K.SOURCE_CURRENT)
    got = rows(rows_c, "report_date", "ReportID", "Voltage", "EventTimeUTC")
    assert got == [(date(2026, 1, 5), 1, 3.31, datetime(2026, 1, 4, 10)), (date(2026, 1, 5), 2, None, datetime(2026, 1, 4, 11)),
                   (date(2026, 1, 6), 3, 3.2, datetime(2026, 1, 5, 10))]
    assert rows(runs_c, "report_date", "query_seconds") == [(date(2026, 1, 5), 12.5), (date(2026, 1, 6), 3.0)]
    rows_l, _ = read_snapshot_files(spark, tmp_dir, K.SOURCE_LEGACY)
    assert rows(rows_l, "report_date", "EventTimeUTC") == [(date(2026, 1, 6), datetime(2026, 1, 5, 10)),
                                                           (date(2026, 1, 7), datetime(2026, 1, 13, 9))]
    # migrate into the parquet store: catalogue, rows and recorded seconds carried over
    st = SnapshotStore(spark, os.path.join(tmp_dir, "store"))
    for _ in range(2):   # idempotent
        runs = st.import_files(tmp_dir)
    assert rows(runs, "report_date", "source", "query_seconds", "rows") == [
        (date(2026, 1, 5), "smbs", 12.5, 2), (date(2026, 1, 6), "debug", 1.0, 1), (date(2026, 1, 6), "smbs", 3.0, 1),
        (date(2026, 1, 7), "debug", 2.0, 1)]
    assert st.read([date(2026, 1, 5)], K.SOURCE_CURRENT).count() == 2


def test_overflow_export(spark, tmp_dir):
    t = spark.createDataFrame([("a", i, 3.0) for i in range(5)] + [("b", 1, 3.0)],
                              "section string, ReportID long, Voltage double").withColumn("DeviceID", F.lit("x"))
    out = os.path.join(tmp_dir, "export")
    export_overflow(t, out, limit=3)
    back = spark.read.option("header", True).csv(out)
    assert rows(back.groupBy("section").count()) == [("a", 5)]


def test_incremental_daily_snapshot_equals_full(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    RN.run_daily_snapshot(t, st, date(2024, 1, 4))
    for d in (5, 6, 9):      # 9: no stored previous day -> full computation
        got = rows(RN.run_daily_snapshot(t, st, date(2024, 1, d), incremental=True),
                   "AssetId", "ReportID", "EventTimeUTC", "Voltage", "PowerMode", "DeviceID", "CustomerName")
        want = rows(J.daily_snapshot(t.readings, t.assets, t.organizations, date(2024, 1, d)),
                    "AssetId", "ReportID", "EventTimeUTC", "Voltage", "PowerMode", "DeviceID", "CustomerName")
        assert got == want, d


def test_incremental_latest_on_test_data(spark):
    from fleetvolt.operators import latest as L
    from fleetvolt.sources import standin as SI
    r = SI.readings(spark, "/root/testdata/sf0.01")
    prev = L.latest_reading(r, datetime(2024, 1, 20))
    inc = L.latest_reading_incremental(prev, r, datetime(2024, 1, 20), datetime(2024, 1, 27))
    full = L.latest_reading(r, datetime(2024, 1, 27))
    cols = ("AssetId", "ReportID", "EventTimeUTC", "Voltage", "OrganizationId")
    assert rows(inc, *cols) == rows(full, *cols)


def test_incremental_backfill_equals_full(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    RN.run_daily_snapshot(t, st, date(2024, 1, 3))
    done = RN.backfill(t, st, [date(2024, 1, d) for d in range(3, 9)], incremental=True)
    assert done == [date(2024, 1, d) for d in range(4, 9)]
    for d in done:
        assert rows(st.read([d]), "AssetId", "ReportID", "PowerMode") == \
            rows(J.daily_snapshot(t.readings, t.assets, t.organizations, d), "AssetId", "ReportID", "PowerMode")


def test_reading_an_empty_store_leaves_the_schemas_alone(spark, tmp_dir):
    from fleetvolt import schemas
    before = [f.name for f in schemas.SNAPSHOT.fields]
    empty = SnapshotStore(spark, os.path.join(tmp_dir, "nothing")).read()
    assert empty.count() == 0 and empty.columns == before + ["report_date", "source"]
    assert [f.name for f in schemas.SNAPSHOT.fields] == before


def test_stored_dwell_state_advances_from_previous_cut(spark, tmp_dir):
    from fleetvolt.operators import latest as L
    from fleetvolt.operators.dwell import dwell_statistics

    t = _tables(spark)
    path = os.path.join(tmp_dir, "dwell_state")
    first, second = datetime(2024, 1, 4, 12), datetime(2024, 1, 8)
    RN.run_dwell_state(t, path, first)
    state = RN.run_dwell_state(t, path, second, prev_cut=first)     # reads only (first, second]
    stats = ("TotalYears", "HighPercent", "MediumPercent", "LowPercent", "CriticalPercent")
    for kw in (dict(), dict(organization_ids=[1]), dict(organization_id=1, exclude_asset_group_id=2)):
        got = rows(RN.fleet_dwell_from_state(t, state, device_type="Solar", **kw), *stats)
        want = rows(dwell_statistics(L.time_range(t.readings, "EventTime", hi=second), t.asset_view, t.assets,
                                     device_type="Solar", **kw), *stats)
        assert got == want, kw
    # a stored state is reused as it is (the readings are not read again)
    again = RN.run_dwell_state(t.__class__(t.readings.where("false"), t.assets, t.organizations, t.asset_view),
                               path, second, prev_cut=first)
    assert again.count() == state.count() == 3      # one row per asset with readings (filters come later)


def test_fleet_dwell_report_from_stored_state(spark, tmp_dir):
    t = _tables(spark)
    path = os.path.join(tmp_dir, "dwell_state")
    full = RN.run_fleet_dwell(t, [1], "Solar")
    cols = ("TotalYears", "HighPercent", "MediumPercent", "LowPercent", "CriticalPercent", "TotalDevices")
    RN.run_dwell_state(t, path, datetime(2024, 1, 5))
    inc = RN.run_fleet_dwell(t, [1], "Solar", state_path=path, cut=datetime(2024, 1, 31),
                             prev_cut=datetime(2024, 1, 5))   # every reading is before the cut
    assert rows(inc.stats, *cols) == rows(full.stats, *cols)
    assert rows(inc.organizations) == rows(full.organizations)
    with pytest.raises(ValueError):
        RN.run_fleet_dwell(t, [1], "Solar", state_path=path)


def test_nothing_is_built_upon_an_open_snapshot(spark, tmp_dir):
    """An open snapshot holds readings beyond its date; incremental forms must not take it for its date's midnight."""
    t = _tables(spark)
    t.readings = readings(spark, [(1, 1, 1, "2024-01-04 08:00:00", 3.1), (2, 1, 1, "2024-01-09 08:00:00", 3.2),
                                  (3, 1, 2, "2024-01-05 08:00:00", 3.3)])
    st = SnapshotStore(spark, tmp_dir)
    RN.run_open_snapshot(t, st, date(2024, 1, 5))
    got = rows(RN.run_daily_snapshot(t, st, date(2024, 1, 6), incremental=True), "AssetId", "ReportID")
    assert got == rows(J.daily_snapshot(t.readings, t.assets, t.organizations, date(2024, 1, 6)), "AssetId", "ReportID") == [(1, 1), (2, 3)]
    other = SnapshotStore(spark, os.path.join(tmp_dir, "other"))
    RN.run_open_snapshot(t, other, date(2024, 1, 5))
    assert RN.backfill(t, other, [date(2024, 1, d) for d in (6, 7, 10)], incremental=True) == [date(2024, 1, d) for d in (6, 7, 10)]
    for d in (6, 7, 10):
        assert rows(other.read([date(2024, 1, d)]), "AssetId", "ReportID") == \
            rows(J.daily_snapshot(t.readings, t.assets, t.organizations, date(2024, 1, d)), "AssetId", "ReportID")
    # both kinds of one date, each with its own rows; a read prefers the dated one
    RN.run_daily_snapshot(t, st, date(2024, 1, 5))
    assert rows(st.read([date(2024, 1, 5)], kind="open"), "ReportID") == [(2,), (3,)]
    assert rows(st.read([date(2024, 1, 5)]), "ReportID") == [(1,)]
    assert st.entry(date(2024, 1, 5), K.SOURCE_CURRENT, "dated").cutoff == datetime(2024, 1, 5)


@pytest.mark.parametrize("step", ["rows", "counts", "publish"])
def test_a_failed_rewrite_leaves_the_stored_snapshot(spark, tmp_dir, monkeypatch, step):
    from fleetvolt.sources import commits

    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    d = date(2024, 1, 6)
    before = rows(RN.run_daily_snapshot(t, st, d), "AssetId", "ReportID")
    snap = J.daily_snapshot(t.readings.where("AssetId = 1"), t.assets, t.organizations, d)
    if step == "rows":
        snap = snap.withColumn("Voltage", F.when(F.col("Voltage") > 0, F.raise_error(F.lit("boom")).cast("double")))
    elif step == "counts":
        stage = SnapshotStore._stage
        monkeypatch.setattr(SnapshotStore, "_stage", lambda self, *a: (stage(self, *a), 1 / 0))
    else:
        monkeypatch.setattr(commits, "create_new", lambda *a: 1 / 0)
    with pytest.raises(Exception):
        st.write(snap, K.SOURCE_CURRENT, [d])
    monkeypatch.undo()
    assert st.exists(d, K.SOURCE_CURRENT) and rows(st.read([d]), "AssetId", "ReportID") == before
    # the next write replaces it, also one that reads the date it replaces; what nobody names can go
    st.write(st.read([d]).drop("source").where("AssetId <> 1"), K.SOURCE_CURRENT, [d])
    assert rows(st.read([d]), "AssetId", "ReportID") == [x for x in before if x[0] != 1]
    assert len(st.vacuum()) >= 1 and st.read([d]).count() == len(before) - 1


def test_two_writers_at_once(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    t = _tables(spark)
    d = date(2024, 1, 6)

    def write(asset):
        SnapshotStore(spark, tmp_dir).write(J.daily_snapshot(t.readings.where(f"AssetId = {asset}"), t.assets, t.organizations, d),
                                            K.SOURCE_CURRENT, [d])
        return asset

    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(write, (1, 2, 3, 1))) == [1, 1, 2, 3]
    st = SnapshotStore(spark, tmp_dir)
    assert sorted(r["commit"] for r in st.log.records().collect()) == [1, 2, 3, 4]
    assert st.read([d]).count() == 1                       # one writer's snapshot, whole


def test_an_incomplete_commit_is_passed_over(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    RN.run_daily_snapshot(t, st, date(2024, 1, 6))
    with open(os.path.join(tmp_dir, "commits", f"{2:012d}.json"), "w") as f:
        f.write('{"report_date": "2024-01-06", "source": "sm')
    assert st.read([date(2024, 1, 6)]).count() == 3 and st.runs().count() == 1
    RN.run_daily_snapshot(t, st, date(2024, 1, 7))
    assert sorted(r.report_date for r in st.runs().collect()) == [date(2024, 1, 6), date(2024, 1, 7)]


def test_late_readings_refresh_exactly_the_touched_dates(spark, tmp_dir):
    t = _tables(spark)
    st = SnapshotStore(spark, tmp_dir)
    dates = [date(2024, 1, d) for d in range(3, 9)]
    RN.backfill(t, st, dates, fingerprint=True)
    assert RN.stale_dates(t, st) == []
    t.readings = t.readings.unionByName(readings(spark, [(900, 1, 3, "2024-01-05 23:59:59", 3.5)]))
    assert RN.stale_dates(t, st) == [date(2024, 1, d) for d in (6, 7, 8)]
    assert RN.refresh(t, st, [date(2024, 1, 7)]) == [date(2024, 1, 7)]
    assert RN.refresh(t, st) == [date(2024, 1, d) for d in (6, 8)] and RN.stale_dates(t, st) == []
    for d in dates:
        assert rows(st.read([d]), "AssetId", "ReportID") == rows(J.daily_snapshot(t.readings, t.assets, t.organizations, d), "AssetId", "ReportID")


def test_daily_report_of_the_open_run_and_of_the_legacy_source(spark, tmp_dir):
    from fleetvolt import schemas

    t = _tables(spark)
    t.bursts = spark.createDataFrame(
        [(1, "A0000009", "t9", datetime(2024, 1, 6, 10), "Battery Level 3.20 Power mode Low", "Acme", 1)], schemas.BURSTS)
    st = SnapshotStore(spark, tmp_dir)
    specs, d, as_of = [SectionSpec("acme", "acme")], date(2024, 1, 6), datetime(2024, 1, 6)
    rep = RN.run_daily_report(t, st, d, specs, "Solar", as_of, open_end=True, preview_limit=None)
    assert st.entry(d, K.SOURCE_CURRENT).kind == "open"
    want = sorted(J.daily_snapshot(t.readings, t.assets, t.organizations, d, open_end=True).where("DeviceID <> 'C3'").collect(),
                  key=lambda r: (r.Voltage, r.DeviceID))
    assert [r.ReportID for r in rep.preview.collect()] == [r.ReportID for r in want if r.PowerMode in K.TABLE_MODES]
    leg = RN.run_daily_report(t, st, d, specs, "Solar", as_of, legacy=("acme", "A0"))
    assert rows(leg.members, "section", "DeviceID", "PowerMode") == [("acme", "A0000009", "Low")]


def test_a_failed_active_lookup_filters_nothing(spark, tmp_dir):
    t = _tables(spark)
    t.asset_view = lambda: spark.read.parquet(os.path.join(tmp_dir, "not_there"))
    st = SnapshotStore(spark, os.path.join(tmp_dir, "store"))
    args = (date(2024, 1, 6), [SectionSpec("acme", "acme")])
    with pytest.warns(RuntimeWarning, match="not filtered"):
        rep = RN.run_daily_report(t, st, *args, "Solar", datetime(2024, 1, 6))
    assert rows(rep.members, "DeviceID") == rows(RN.run_daily_report(t, st, *args, None, datetime(2024, 1, 6)).members, "DeviceID")
    assert rep.members.count() == 3


def test_two_writers_add_each_sent_date_once(spark, tmp_dir):
    from concurrent.futures import ThreadPoolExecutor

    log = os.path.join(tmp_dir, "sent")
    days = spark.createDataFrame([(date(2026, 1, d),) for d in range(1, 9)], "report_date date")
    with ThreadPoolExecutor(3) as pool:
        added = [r.report_date for out in pool.map(lambda _: append_sent_dates(spark, log, days).collect(), range(3)) for r in out]
    assert sorted(added) == [date(2026, 1, d) for d in range(1, 9)]
    assert len(read_sent_dates(spark, log).collect()) == 8


def test_few_of_many_snapshot_files_are_opened(spark, tmp_dir):
    from datetime import timedelta

    from fleetvolt.sources.legacy_files import malformed_lines

    head = ",".join(["ReportID", "OrganizationId", "CustomerName", "AssetId", "DeviceID", "DeviceName", "EventTimeUTC", "Voltage", "PowerMode"])
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(60)]
    for i, d in enumerate(days):
        with open(os.path.join(tmp_dir, f"latest_batt_{d.day}{d:%b%y}_smbs.csv"), "w") as f:
            f.write(f"### METADATA ###\nquery_time,1.0\n### DATA ###\n{head}\n{i},7,Acme,10,A01,t1,2024-01-04 10:00:00,3.31,High\n")
            if i in (3, 30):
                f.write("1,2,3\n" + "9," * 12 + "\n")
    wanted = days[:7]
    found, runs = read_snapshot_files(spark, tmp_dir, K.SOURCE_CURRENT, wanted)
    assert rows(found, "report_date", "ReportID") == [(d, i) for i, d in enumerate(wanted)] and runs.count() == 7
    found.collect()
    assert _metric(found, "numFiles") == 7
    assert rows(malformed_lines(spark, tmp_dir, K.SOURCE_CURRENT), "report_date", "n_lines") == [(days[3], 2), (days[30], 2)]


def _metric(df, name):
    """A metric of the scan that ran last for ``df``."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    while "QueryStage" in leaves.head().getClass().getName():
        leaves = leaves.head().plan().collectLeaves()
    return leaves.head().metrics().apply(name).value()


def test_lookup_of_few_assets_passes_over_row_groups(spark, tmp_dir):
    from fleetvolt.sources import tables

    data = spark.range(200_000).selectExpr("id AS ID", "1 AS OrganizationId", "(id * 7919) % 5000 AS AssetId",
                                           "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 86400) AS EventTime", "3.3D AS Voltage")
    plain, sorted_ = os.path.join(tmp_dir, "plain"), os.path.join(tmp_dir, "sorted")
    tables.write_by_day(data.repartition(4), plain, "EventTime", row_group_bytes=1 << 16)
    tables.write_by_day(data.repartition(4), sorted_, "EventTime", lookup="AssetId", row_group_bytes=1 << 16)
    read = {}
    for path in (plain, sorted_):
        found = tables.readings(spark, path).where(F.col("AssetId").isin(list(range(100, 110))))
        assert len(found.collect()) == 400
        read[path] = _metric(found, "numOutputRows")
    assert read[sorted_] * 5 < read[plain]


def test_a_snapshot_file_is_put_together_from_stored_lines(spark, tmp_dir, monkeypatch):
    """The one task of a file holds no join or window over all partitions, and the rows read are not dealt by their dates."""
    from pyspark.sql.readwriter import DataFrameWriter

    from fleetvolt.plans import registry as R

    t, tables = R._T(spark, tmp_dir), _tables(spark)
    t.readings, t.assets, t.orgs = tables.readings, tables.assets, tables.organizations
    monkeypatch.setattr(R, "_scratch", lambda t, name: os.path.join(tmp_dir, name))
    plans, text = [], DataFrameWriter.text

    def watched(self, path, *args, **kw):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        text(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "text", watched)
    out = R._read_files(t)
    assert len(plans) == len(R.WEEK_DATES) and not any("Join" in p or "Window" in p for p in plans)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2
    want = J.multi_date_snapshot(t.readings, t.assets, t.orgs, R.WEEK_DATES[2:5], R.BANDS)
    cols = ["report_date", "ReportID", "AssetId", "EventTimeUTC", "Voltage", "PowerMode"]
    assert rows(out, *cols) == rows(want, *cols) and out.count() == 9
    assert rows(out.select("query_seconds", "n_lines").distinct()) == [(1.5, 1)]
