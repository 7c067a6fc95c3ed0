from pyspark.sql import functions as F

from fleetvolt.operators import payload as P


def test_payload_cases(spark):
    df = spark.createDataFrame([
        (1, "Battery Level 3.27 Power mode Medium"), (2, "Battery Level 3 Power mode Low"),
        (3, "Battery Level 0 Power mode Critical"), (4, "Battery Level 3.30"),
        (5, "Battery Level 3.10 Power mode Sleep"), (6, None)], "ID long, PayloadData string")
    got = {r.ID: (r.Voltage, r.PayloadMode) for r in P.parse_payload(df).collect()}
    assert got == {1: (3.27, "Medium"), 2: (None, "Low"), 3: (None, "Critical"), 4: (3.30, "None"),
                   5: (3.10, "Sleep"), 6: (None, "None")}
    kept = P.drop_unparsed(P.parse_payload(df))
    assert sorted(r.ID for r in kept.collect()) == [1, 4, 5]
    lq = {r.PayloadMode: r.n_rows for r in P.label_quality(kept).collect()}
    assert lq == {"None": 1, "Sleep": 1}


def _detect(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return P.time_format_choice(df, "t").first().format_index


def test_time_format_detection(spark):
    assert _detect(spark, ["2024-01-05 10:00:00.123456", "2024-01-06 11:00:00.5", None]) == 1
    assert _detect(spark, ["5/1/2024 10:00", "13/1/2024 9:05"]) == 2
    assert _detect(spark, ["5/1/2024 10:00", "1/13/2024 9:05"]) == 3     # one value forces month-first
    assert _detect(spark, ["2024-01-05 10:00:00.1", "5/1/2024 10:00"]) is None   # mixed


def test_parse_time_column(spark):
    df = spark.createDataFrame([("5/1/2024 10:00",), ("1/13/2024 9:05",)], "EventTimeUTC string")
    out = P.parse_time_column(df)
    assert dict(out.dtypes)["EventTimeUTC"] == "timestamp_ntz"
    got = sorted(str(r.EventTimeUTC) for r in out.collect())
    assert got == ["2024-01-13 09:05:00", "2024-05-01 10:00:00"]
    iso = spark.createDataFrame([("2024-01-05 10:00:00",)], "EventTimeUTC string")
    assert str(P.parse_time_column(iso).first().EventTimeUTC) == "2024-01-05 10:00:00"


def test_profile(spark):
    df = spark.createDataFrame([(3.0, "Critical"), (3.5, "High"), (None, "Unknown")], "Voltage double, PowerMode string")
    r = P.voltage_profile(df).first()
    assert (r.n_rows, r.min_voltage, r.max_voltage, r.mean_voltage, r.n_High, r.n_Unknown) == (3, 3.0, 3.5, 3.25, 1, 1)
    assert F is not None


def test_format_detection_agrees_with_trial_parsing(spark):
    """Per value, over the days around month ends and leap years, ambiguous days, fractions and broken texts."""
    texts = [f"{d}/{m}/{y} {t}" for y in ("1900", "2000", "2023", "2024", "0000") for m in (0, 1, 2, 4, 12, 13) for d in (0, 1, 12, 28, 29, 30, 31, 32)
             for t in ("0:0", "23:59", "24:00")]
    texts += ["01/02/2024 03:04", "1/2/24 3:04", "1/2/2024 3:60", "001/2/2024 3:04", " 1/2/2024 3:04", "1/2/2024 3:04 ", "1/2/2024", "", "x"]
    texts += [f"{y}-{m}-{d} 10:11:12.{f}" for y in ("2023", "2024", "0000") for m in ("02", "2", "11", "13") for d in ("28", "29", "30", "31")
              for f in ("1", "123456", "1234567", "")]
    texts += ["2024-01-01 24:00:00.0", "2024-01-01 23:60:00.0", "2024-01-01 23:59:60.0", "2024-01-01 10:11:12", "2024-01-01T10:11:12.5"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    from fleetvolt import constants as K
    from fleetvolt.operators import payload as P
    from pyspark.sql import functions as F
    fits = P._fitting(df, "text", ["i"]).collect()
    tried = df.select("i", *[F.try_to_timestamp("text", F.lit(f)).isNotNull().alias(f"t{k}") for k, f in enumerate(K.TIME_FORMATS)]).collect()
    want = {r.i: (r.t0, r.t1, r.t2) for r in tried}
    odd = {i: texts[i] for i in want if not texts[i].strip() == texts[i] or texts[i].startswith("001")}
    assert {r.i: (r._fits0, r._fits1, r._fits2) for r in fits if r.i not in odd} == {i: w for i, w in want.items() if i not in odd}


def test_format_of_no_values_and_of_nulls(spark):
    from fleetvolt.operators import payload as P
    df = spark.createDataFrame([("a", None), ("b", "5/1/2026 10:00"), ("b", None)], "g string, text string")
    got = {r.g: (r.format_index, r.n_values) for r in P.time_format_choice(df, "text", ["g"]).collect()}
    assert got == {"a": (1, 0), "b": (2, 1)}
