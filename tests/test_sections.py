from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetvolt.config import SectionSpec
from fleetvolt.functions.devices import is_numbered_series
from fleetvolt.operators import sections as S

from helpers import rows, snapshot

AS_OF = datetime(2024, 6, 30)
SPECS = [
    SectionSpec("new", "Acme", listed_or_series=True, series_prefix="A0"),
    SectionSpec("cser", "Acme", id_prefix="C", table_modes=("Critical", "Low")),
    SectionSpec("sam", "borealis"),
]


def test_numbered_series_ids(spark):
    df = spark.createDataFrame([(None,), ("A07",), ("A0005999",), ("A0006000",), ("A000600x",), ("6000",), ("A06000",)], "id string")
    got = {r.id: r.s for r in df.select("id", is_numbered_series("id").alias("s")).collect()}
    assert got == {None: False, "A07": False, "A0005999": False, "A0006000": True, "A000600x": False,
                   "6000": True, "A06000": True}


def _snap(spark):
    t = "2024-06-29 00:00:00"
    return snapshot(spark, [
        (1, 1, "ACME", 1, "A0006001", "truck 1", t, 3.1, "Critical"),     # series
        (2, 1, "acme", 2, "A0000001", "A0000001", t, 3.1, "Critical"),    # unpaired
        (3, 1, "Acme", 3, "A0000002", "a0000002", t, 3.2, "Low"),         # case differs -> paired, listed
        (4, 1, "Acme", 4, "A0000003", None, t, 3.2, "Low"),               # NULL name -> dropped
        (5, 1, "Acme", 5, "C123", "box", t, 3.25, "Medium"),
        (6, 2, "Borealis", 6, "X1", "y1", t, 3.4, "High"),
        (7, 2, "Borealis", 7, "X2", "y2", "2024-04-07 00:00:00", 3.1, "Critical"),   # exactly 12 weeks before
        (8, 2, "Borealis", 8, "X3", "y3", "2024-04-06 23:59:59", 3.1, "Critical"),   # one second beyond
        (9, 2, "Borealis", 9, "X4", "y4", "2024-09-22 00:00:00", 3.1, "Critical"),   # 12 weeks after (future)
        (10, 1, "Acme", 10, "A0006002", "t", t, None, "Unknown"),
    ])


def test_membership_rules(spark):
    allow = spark.createDataFrame([("A0000002",), ("A0000002",), ("C123",)], "DeviceID string")
    m = S.assign_sections(_snap(spark), SPECS, AS_OF, timedelta(weeks=12), allow_list=allow)
    got = rows(m, "section", "ReportID")
    assert got == [("cser", 5), ("new", 1), ("new", 10), ("new", 3), ("new", 5), ("sam", 6), ("sam", 7), ("sam", 9)]


def test_active_none_versus_empty(spark):
    empty = spark.createDataFrame([], "DeviceID string")
    some = spark.createDataFrame([("X1",), (None,)], "DeviceID string")
    assert S.assign_sections(_snap(spark), SPECS, AS_OF, timedelta(weeks=12), active=empty).count() == 0
    assert rows(S.assign_sections(_snap(spark), SPECS, AS_OF, timedelta(weeks=12), active=some), "ReportID") == [(6,)]
    assert S.assign_sections(_snap(spark), SPECS, AS_OF, timedelta(weeks=12), active=None).count() == 6


def test_summary_zero_filled_and_counts_sum(spark):
    m = S.assign_sections(_snap(spark), SPECS + [SectionSpec("cobalt", "cobalt")], AS_OF, timedelta(weeks=12))
    s = {r.section: r for r in S.section_mode_summary(m, SPECS + [SectionSpec("cobalt", "cobalt")]).collect()}
    assert s["cobalt"].members == 0 and (s["cobalt"].Critical, s["cobalt"].Low, s["cobalt"].Medium) == (0, 0, 0)
    assert (s["sam"].members, s["sam"].Critical) == (3, 2)
    counts = S.section_mode_counts(m).groupBy("section").agg(F.sum("n").alias("t"))
    assert {r.section: r.t for r in counts.collect()} == {k: v.members for k, v in s.items() if v.members}


def test_shares_denominator_includes_unknown(spark):
    snap = _snap(spark)
    d = S.with_device_sections(snap, SPECS, AS_OF, timedelta(weeks=12))
    sh = {(r.section, r.PowerMode): (r.n, r.total, r.share) for r in S.cohort_shares(d).collect()}
    assert sh[("new", "Critical")] == (1, 2, 50.0)
    assert sh[("new", "High")] == (0, 2, 0.0)
    assert sum(v[2] for k, v in sh.items() if k[0] == "new") == 50.0   # Unknown is not shown


def test_tables_and_preview(spark):
    snap = _snap(spark)
    m = S.assign_sections(snap, SPECS, AS_OF, timedelta(weeks=12))
    t = S.section_tables(m, SPECS)
    assert "AssetId" not in t.columns and "OrganizationId" not in t.columns
    assert rows(t, "section", "ReportID") == [("new", 1), ("sam", 7), ("sam", 9)]   # cser lists Critical/Low only
    p = S.section_preview(t, limit=1)
    assert rows(p, "section", "ReportID", "position", "total_rows") == [("new", 1, 1, 1), ("sam", 7, 1, 2)]
    low = S.low_battery(S.with_device_sections(snap, SPECS, AS_OF, timedelta(weeks=12)), "new")
    assert rows(low, "ReportID") == [(1,)]


def test_preview_nulls_last(spark):
    t = spark.createDataFrame([("s", "a", None), ("s", "b", 3.0), ("s", "c", 2.0)], "section string, DeviceID string, Voltage double")
    got = [r.DeviceID for r in S.section_preview(t, limit=3).orderBy("position").collect()]
    assert got == ["c", "b", "a"]
    from fleetvolt.operators.order import by_voltage
    whole = S.section_preview(t, limit=None)
    assert {r.total_rows for r in whole.collect()} == {3}
    assert [r.DeviceID for r in whole.orderBy("position").collect()] == got
    assert [r.DeviceID for r in by_voltage(whole).collect()] == ["c", "b", "a"]


def test_shares_count_rows_without_name_as_differing(spark):
    snap = snapshot(spark, [
        (1, 1, "Acme", 1, "A0006001", "t1", "2024-06-29 00:00:00", 3.1, "Critical"),
        (2, 1, "Acme", 2, "A0006001", None, "2024-06-29 00:00:00", 3.4, "High"),     # same id, no name
        (3, 1, "Acme", 3, "A0006001", "A0006001", "2024-06-29 00:00:00", 3.4, "High")])  # unpaired
    sh = {r.PowerMode: (r.n, r.total) for r in S.cohort_shares(S.with_device_sections(snap, SPECS[:1], AS_OF, timedelta(weeks=12))).collect()}
    assert sh["Critical"] == (1, 2) and sh["High"] == (1, 2)


def test_customer_match_takes_every_spelling(spark):
    from fleetvolt.functions.text import equals_ignore_case

    df = spark.createDataFrame([("Kiosk",), ("KIOSK",), ("\u212aiosk",), ("kiosx",), (None,)], "c string")
    assert df.where(equals_ignore_case("c", "kiosk")).count() == 3


def test_device_sections_equal_membership_and_scan_once(spark, tmp_dir):
    """Of each row's device: the sections that any of its rows is a member of, under every active filter."""
    _snap(spark).unionByName(snapshot(spark, [(50, 1, "Acme", 1, "A0006001", None, "2024-06-29 00:00:00", 3.1, "Low"),
                                              (51, 1, "Other", 1, "A0006001", "n", "2024-06-29 00:00:00", 3.1, "Low")])).write.parquet(f"{tmp_dir}/s")
    snap = spark.read.parquet(f"{tmp_dir}/s")
    ids = [r.DeviceID for r in snap.select("DeviceID").distinct().collect() if r.DeviceID is not None]
    for active in (None, [], ids[:2], ids):
        a = None if active is None else spark.createDataFrame([(i,) for i in active], "DeviceID string")
        want = {}
        for r in S.assign_sections(snap, SPECS, AS_OF, timedelta(weeks=12), None, a).collect():
            want.setdefault(r.DeviceID, set()).add(r.section)
        d = S.with_device_sections(snap, SPECS, AS_OF, timedelta(weeks=12), None, a)
        got = d.collect()
        assert all(set(r._sections) == want.get(r.DeviceID, set()) for r in got)
        assert len(got) == snap.where("DeviceID IS NOT NULL").count()
    p = S.cohort_shares(S.with_device_sections(snap, SPECS, AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1 and "Join" not in p
