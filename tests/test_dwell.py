import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.functions.timecalc import minutes_between
from fleetvolt.operators.dwell import dwell_statistics, reading_intervals
from fleetvolt.operators.dwell_segments import asset_segments, minute_segments
from fleetvolt.operators.intervals import with_next_time

from helpers import asset_view, assets, readings, rows


def test_minute_boundaries(spark):
    df = spark.createDataFrame([], "x int").sparkSession.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:59' a, timestamp_ntz'2024-01-01 00:01:01' b, "
        "timestamp_ntz'2024-01-01 00:00:00' c, timestamp_ntz'2024-01-01 00:00:59' d")
    r = df.select(minutes_between("a", "b").alias("ab"), minutes_between("c", "d").alias("cd")).first()
    assert (r.ab, r.cd) == (1, 0)
    old = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:30' a, timestamp_ntz'1970-01-01 00:00:30' b")
    assert old.select(minutes_between("a", "b").alias("m")).first().m == 1


def test_next_time_matches_plain_lead_with_hot_asset(spark):
    data = []
    i = 0
    for a, n in ((1, 400), (2, 7), (3, 1), (None, 5)):
        for k in range(n):
            i += 1
            t = f"2024-01-{1 + (k * 7) % 28:02d} {(k * 5) % 24:02d}:{(k * 13) % 60:02d}:00"
            data.append((i, 1, a, t, 3.0))
    data += [(9001, 1, 1, None, 3.0), (9002, 1, 1, None, 3.1), (9003, 1, 2, "2024-01-01 00:00:00", 3.0),
             (9004, 1, 2, "2024-01-01 00:00:00", 3.0),
             # readings without a time in different id ranges, one without an id either
             (5 * 2 ** 20, 1, 1, None, 3.0), (-7, 1, 1, None, 3.0), (2 ** 40, 1, 3, None, 3.0),
             (None, 1, 1, None, 3.2), (None, 1, 1, "2024-01-02 00:00:00", 3.2)]
    r = readings(spark, data)
    w = Window.partitionBy("AssetId").orderBy(F.col("EventTime").asc_nulls_first(), F.col("ID").asc_nulls_first())
    want = rows(r.withColumn("NextTime", F.lead("EventTime").over(w)), "ID", "NextTime")
    for finest, nesting in ((10_000, (6_000, 1_440)), (1, (7, 60, 1_000_000)), (60_000_000, (60, 24)), (10 ** 15, ())):
        got = rows(with_next_time(r, finest_micros=finest, nesting=nesting), "ID", "NextTime")
        assert got == want, (finest, nesting)


def _crowded(spark, seconds):
    """Asset 1 has 90% of its 20,000 readings within so many seconds, at distinct microseconds; asset 2 has 500."""
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 5, 7, 0)
    step = timedelta(microseconds=seconds * 1_000_000 // 18_000)
    data = [(i, 1, 1, str(start + i * step), 3.0 + i % 5 / 10) for i in range(18_000)]
    data += [(20_000 + i, 1, 1, str(datetime(2024, 1, 6) + timedelta(minutes=17 * i)), 3.3) for i in range(2_000)]
    data += [(30_000 + i, 1, 2, str(datetime(2024, 1, 1) + timedelta(minutes=31 * i)), 3.3) for i in range(500)]
    return readings(spark, data)


@pytest.mark.parametrize("seconds", [3600, 60])
def test_crowded_hour_or_minute_is_spread_over_tasks(spark, seconds):
    r = _crowded(spark, seconds)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = with_next_time(r).groupBy(F.spark_partition_id().alias("p")).count().collect()
        # The rows that each level finds done are partitions of their own in the union: eight to a level.
        levels = {}
        for x in held:
            levels.setdefault(x.p // 8, []).append(x["count"])
        for level in levels.values():
            if sum(level) >= 1000:
                assert max(level) <= 2 * sorted(level)[len(level) // 2]
        cells = minute_segments(r).groupBy(F.spark_partition_id().alias("p")).count().collect()
        sizes = sorted(x["count"] for x in cells)
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    w = Window.partitionBy("AssetId").orderBy("EventTime", "ID")
    assert rows(with_next_time(r), "ID", "NextTime") == rows(r.withColumn("NextTime", F.lead("EventTime").over(w)), "ID", "NextTime")


def test_segments_equal_the_sum_of_intervals(spark):
    import random

    random.seed(4)
    data = []
    for i in range(1500):
        t = None if random.random() < 0.03 else f"2024-0{random.choice('123')}-{random.randint(1, 3):02d} {random.randint(0, 2):02d}:" \
            f"{random.randint(0, 9):02d}:{random.randint(0, 59):02d}.{random.choice(['000000', '000001', '999999'])}"
        data.append((None if random.random() < 0.02 else i, random.choice([1, 2, None]), random.choice([1, 1, 1, 2, 3, None]), t,
                     random.choice([None, 0.0, 3.0, 3.2, 3.25, 3.4, float("nan")])))
    data.append((5000, 1, 9, "2024-01-01 00:00:00", 3.4))            # one reading, no interval
    r = readings(spark, data).where("ID IS NOT NULL OR EventTime IS NULL")
    x = reading_intervals(r).where("AssetId IS NOT NULL")
    want = {m: x.where(F.col("PowerMode") == m).agg(F.coalesce(F.sum("DurationMinutes"), F.lit(0)).alias("s")).first().s for m in K.MODES}
    got = asset_segments(r).agg(*[F.sum(f"Minutes{m}").alias(m) for m in K.MODES]).first().asDict()
    assert got == want


def test_intervals_drop_last_reading(spark):
    r = readings(spark, [(1, 1, 1, "2024-01-01 00:00:00", 3.35), (2, 1, 1, "2024-01-01 01:30:00", 3.2),
                         (3, 1, 1, "2024-01-01 02:00:00", 3.0), (4, 1, 2, "2024-01-01 00:00:00", 3.0)])
    got = rows(reading_intervals(r), "ID", "PowerMode", "DurationMinutes")
    assert got == [(1, "High", 90), (2, "Low", 30)]


def _registry(spark):
    av = asset_view(spark, [(1, "A1", "t1", 7, "Acme", "Solar", "Active"), (2, "A2", "t2", 7, "Acme", "Solar", "Active"),
                            (3, "A3", "t3", 8, "Other", "Solar", "Active"), (4, "A4", "t4", 7, "Acme", "Solar", "Retired")])
    a = assets(spark, [(1, "A1", "t1", 7, 100), (2, "A2", "t2", 7, None), (3, "A3", "t3", 8, 200), (4, "A4", "t4", 7, 100)])
    return av, a


def test_dwell_percentages_and_filters(spark):
    av, a = _registry(spark)
    r = readings(spark, [
        (1, 7, 1, "2024-01-01 00:00:00", 3.35), (2, 7, 1, "2024-01-01 03:00:00", 3.25),
        (3, 7, 1, "2024-01-01 04:00:00", 0.0),
        (4, 7, 2, "2024-01-01 00:00:00", 3.19), (5, 7, 2, "2024-01-01 06:00:00", 3.19),
        (6, 8, 3, "2024-01-01 00:00:00", None), (7, 8, 3, "2024-01-01 02:00:00", 3.3),
        (8, 7, 4, "2024-01-01 00:00:00", 3.3), (9, 7, 4, "2024-01-01 09:00:00", 3.3)])
    s = dwell_statistics(r, av, a, device_type="Solar").first()
    # High 3h, Medium 1h, Low 6h, Critical 2h (NULL voltage) of 12h
    assert (s.HighPercent, s.MediumPercent, s.LowPercent, s.CriticalPercent) == (25.0, 8.33, 50.0, 16.67)
    assert s.TotalYears == 0
    one = dwell_statistics(r, av, a, organization_id=8, device_type="Solar").first()
    assert one.CriticalPercent == 100.0
    lst = dwell_statistics(r, av, a, organization_id=8, organization_ids=[7], device_type="Solar").first()
    assert lst.HighPercent == 30.0      # list wins over single id: 3h of 10h
    empty_list = dwell_statistics(r, av, a, organization_id=8, organization_ids=[], device_type="Solar").first()
    assert empty_list.CriticalPercent == 100.0   # empty list falls through to the single id
    # group exclusion: asset 2 has a NULL group -> excluded; asset 1 group 100 excluded
    ex = dwell_statistics(r, av, a, organization_ids=[7, 8], exclude_asset_group_id=100, device_type="Solar").first()
    assert ex.CriticalPercent == 100.0


def test_dwell_empty_input(spark):
    av, a = _registry(spark)
    r = readings(spark, [])
    s = dwell_statistics(r, av, a, device_type="Solar").first()
    assert s.TotalYears is None
    assert (s.HighPercent, s.MediumPercent, s.LowPercent, s.CriticalPercent) == (0.0, 0.0, 0.0, 0.0)


def test_total_years_rounds_half_up(spark):
    av, a = _registry(spark)
    r = readings(spark, [(1, 7, 1, "2020-01-01 00:00:00", 3.4), (2, 7, 1, "2021-07-02 12:00:00", 3.4)])
    s = dwell_statistics(r, av, a, device_type="Solar").first()
    assert s.TotalYears == 2 and s.HighPercent == 100.0   # 1.5 years (547.5 days) -> 2


def test_hot_asset_is_spread_over_tasks(spark):
    from fleetvolt.operators import intervals

    # one asset with 90% of the rows, over 24 days
    data = [(i, 1, 1, f"2024-01-{1 + i % 24:02d} {i % 24:02d}:{i % 60:02d}:00", 3.0) for i in range(1, 2161)]
    data += [(10_000 + i, 1, 2 + i % 10, f"2024-01-{1 + i % 24:02d} 05:00:00", 3.0) for i in range(240)]
    r = readings(spark, data)
    # AQE would merge these tiny partitions (it merges only partitions under the advisory
    # size, which a hot asset's buckets are not at scale); switch that off to see the spread
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = intervals.with_next_time(r).where("AssetId = 1")
        spread = hot.select(F.spark_partition_id().alias("p")).distinct().count()
        plain = r.repartition("AssetId").where("AssetId = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spread >= 4      # 24 day buckets hashed over 8 shuffle partitions
    assert plain == 1       # what a window partitioned by asset alone would do
