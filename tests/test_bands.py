from pyspark.sql import functions as F

from fleetvolt.config import PowerBands
from fleetvolt.functions.bands import power_band


def test_band_boundaries_both_definitions(spark):
    df = spark.createDataFrame([(3.30,), (3.22,), (3.18,), (3.31,), (3.0,), (None,)], "v double")
    got = {r.v: (r.ex, r.inc) for r in df.select(
        "v", power_band("v").alias("ex"),
        power_band("v", inclusive=True, null_band="Critical").alias("inc")).collect()}
    assert got[3.30] == ("Medium", "High")
    assert got[3.22] == ("Low", "Medium")
    assert got[3.18] == ("Critical", "Low")
    assert got[3.31] == ("High", "High")
    assert got[3.0] == ("Critical", "Critical")
    assert got[None] == ("Unknown", "Critical")


def test_band_parameters(spark):
    df = spark.createDataFrame([(91.0,), (36.0,), (15.5,), (15.0,)], "v double")
    b = PowerBands(90, 36, 15)
    got = [r.m for r in df.select(power_band(F.col("v"), b).alias("m")).collect()]
    assert got == ["High", "Low", "Low", "Critical"]


def test_band_code_round_trip(spark):
    from fleetvolt.functions.bands import band_name, power_band_code

    df = spark.createDataFrame([(3.30,), (3.22,), (3.18,), (3.31,), (3.0,), (None,), (0.0,)], "v double")
    got = df.select(band_name(power_band_code("v")).alias("a"),
                    power_band("v", inclusive=True, null_band="Critical").alias("b")).collect()
    assert all(r.a == r.b for r in got)
    assert dict(df.select(power_band_code("v").alias("c")).dtypes)["c"] == "tinyint"


def test_nan_is_no_measurement(spark):
    from datetime import datetime

    from fleetvolt.functions.bands import power_band, power_band_code
    from fleetvolt.operators.latest import latest_reading
    from helpers import readings

    nan = float("nan")
    df = spark.createDataFrame([(nan,)], "v double")
    assert df.select(power_band("v"), power_band("v", inclusive=True, null_band="Critical"), power_band_code("v")).first()[:] == ("Unknown", "Critical", 3)
    r = readings(spark, [(1, 1, 1, "2024-01-01 00:00:00", 3.3), (2, 1, 1, "2024-01-02 00:00:00", nan)])
    assert [(x.ReportID, x.EventTimeUTC) for x in latest_reading(r).collect()] == [(1, datetime(2024, 1, 1))]
