"""Plan shapes that the scale design relies on (checked on the physical plan)."""

from fleetvolt.operators import latest as L
from fleetvolt.operators.intervals import with_next_time
from fleetvolt.sources import standin as SI

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_next_time_keeps_bucket_exchange_on_pre_partitioned_input(spark):
    r = SI.readings(spark, SF).repartition("AssetId")        # as if bucketed by asset
    p = _plan(with_next_time(r))
    assert "hashpartitioning(AssetId" in p and "_b" in p.split("hashpartitioning(AssetId")[1].split(")")[0]


def test_latest_has_partial_top1_before_shuffle(spark):
    p = _plan(L.latest_reading(SI.readings(spark, SF)))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,2.0)]" in p


def test_multi_date_pushes_cutoff_and_has_no_calendar_join(spark):
    from datetime import date
    p = _plan(L.latest_as_of_many(SI.readings(spark, SF), [date(2024, 1, d) for d in range(20, 27)]))
    assert "LessThanOrEqual(ts,2024-01-26T00:00)" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_readings_scan_prunes_columns(spark):
    p = _plan(L.latest_reading(SI.readings(spark, SF)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_day_partitioned_readings_are_pruned(spark, tmp_dir):
    from datetime import date, datetime

    from fleetvolt.sources import tables

    path = f"{tmp_dir}/readings"
    tables.write_by_day(SI.readings(spark, SF), path, "EventTime")
    r = tables.readings(spark, path)
    assert "event_date" in r.columns
    got = L.latest_reading(r, datetime(2024, 1, 10))
    p = _plan(got)
    assert "PartitionFilters: [isnotnull(event_date" in p and "(event_date" in p and "2024-01-10" in p
    want = L.latest_reading(SI.readings(spark, SF), datetime(2024, 1, 10))
    key = lambda x: x.AssetId
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    multi = L.latest_as_of_many(r, [date(2024, 1, 8), date(2024, 1, 9)])
    assert "PartitionFilters: [isnotnull(event_date" in _plan(multi)


def test_customer_match_is_pushed_down(spark, tmp_dir):
    from datetime import date

    from fleetvolt import schemas
    from fleetvolt.functions.text import equals_ignore_case

    df = spark.createDataFrame([("Zeta",), ("ZETA",), ("zeta",), ("zet",), ("Other",), (None,)], "CustomerName string")
    assert sorted(r.CustomerName for r in df.where(equals_ignore_case("CustomerName", "zEtA")).collect()) == \
        ["ZETA", "Zeta", "zeta"]
    path = f"{tmp_dir}/bursts"
    SI.bursts(spark, SF).write.parquet(path)
    b = spark.read.schema(schemas.BURSTS).parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        p = _plan(L.legacy_latest(b, "nation_1", "Customer#", report_date=date(2024, 1, 20)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(CustomerName,NATION_1)" in p and "LessThanOrEqual(CustomerName,nation_1)" in p


def _written(spark, tmp_dir):
    """The stand-in readings as a table of their own (they are a join in the test data)."""
    SI.readings(spark, SF).write.parquet(f"{tmp_dir}/plain")
    return spark.read.parquet(f"{tmp_dir}/plain")


def _final_plan(df) -> str:
    df.collect()
    p = _plan(df)                     # final adaptive plan after the run
    assert "isFinalPlan=true" in p
    return p.split("== Initial Plan ==")[0]


def test_intervals_scan_once_without_broadcast_or_join(spark, tmp_dir):
    p = _final_plan(with_next_time(_written(spark, tmp_dir)))
    assert p.count("FileScan") == 1 and "ReusedExchange" in p and "Join" not in p and "BroadcastExchange" not in p


def test_dwell_scans_readings_once(spark, tmp_dir):
    from fleetvolt.operators.dwell_segments import asset_segments, organization_runs

    r = _written(spark, tmp_dir)
    for build in (asset_segments, organization_runs):
        p = _final_plan(build(r))
        assert p.count("FileScan") == 1 and "Join" not in p
