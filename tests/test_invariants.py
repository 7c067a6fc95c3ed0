
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def test_dwell_percents_sum_to_100(spark):
    for name in ("dwell_all", "dwell_by_org_list", "dwell_single_org", "dwell_excluding_group"):
        r = E.queries()[name](spark, SF).first()
        total = r.HighPercent + r.MediumPercent + r.LowPercent + r.CriticalPercent
        assert abs(total - 100.0) <= 0.02 + 1e-9, (name, total)


def test_section_counts_sum_to_members(spark):
    q = E.queries()
    counts = {r.section: r.t for r in q["section_mode_counts"](spark, SF)
              .groupBy("section").agg(F.sum("n").alias("t")).collect()}
    summary = {r.section: r.members for r in q["section_mode_summary"](spark, SF).collect()}
    assert all(summary[s] == counts.get(s, 0) for s in summary)
    assert sum(summary.values()) == q["section_members"](spark, SF).count()


def test_weekly_last_date_equals_daily_report(spark):
    from fleetvolt.plans import registry as R
    q = E.queries()
    weekly = {r.section: (r.members, r.Critical, r.Low, r.Medium)
              for r in q["weekly_trend"](spark, SF).where(F.col("report_date") == F.lit(R.TODAY)).collect()}
    daily = {r.section: (r.members, r.Critical, r.Low, r.Medium) for r in q["daily_section_report"](spark, SF).collect()}
    assert weekly == daily


def test_snapshot_one_row_per_asset_and_multi_date_contains_daily(spark):
    q = E.queries()
    snap = q["daily_snapshot"](spark, SF)
    assert snap.count() == snap.select("AssetId").distinct().count()
    from fleetvolt.plans import registry as R
    multi = q["multi_date_snapshot"](spark, SF).where(F.col("report_date") == F.lit(R.TODAY))
    cols = ["AssetId", "ReportID", "PowerMode"]
    assert sorted(map(tuple, multi.select(cols).collect())) == sorted(map(tuple, snap.select(cols).collect()))
