from datetime import date

import pytest
from pyspark.sql import functions as F

from fleetvolt.functions.dates import date_label, display_date, parse_label
from fleetvolt.operators import calendar as C


def test_date_labels(spark):
    df = spark.createDataFrame([("5Jan26",), ("05Jan26",), ("",), ("junk",)], "value string")
    parsed = [r.d for r in df.select(parse_label("value").alias("d")).collect()]
    assert parsed == [date(2026, 1, 5), date(2026, 1, 5), None, None]
    d = spark.createDataFrame([(date(2026, 1, 5),)], "d date")
    r = d.select(date_label("d").alias("a"), display_date("d").alias("b"), display_date("d", False).alias("c")).first()
    assert (r.a, r.b, r.c) == ("5Jan26", "5 Jan 2026", "5 January")


def test_sent_dates_blank_and_duplicates(spark):
    lines = spark.createDataFrame([("5Jan26",), ("",), ("05Jan26",), ("  7Jan26 ",), ("3Jan26",)], "value string")
    got = sorted(r.report_date for r in C.sent_dates(lines).collect())
    assert got == [date(2026, 1, 3), date(2026, 1, 5), date(2026, 1, 7)]
    with pytest.raises(Exception, match="not a date label"):
        C.sent_dates(lines.union(spark.createDataFrame([("31Foo26",)], "value string"))).collect()


def test_snapshot_names_without_a_source(spark):
    names = ["latest_batt_5Jan26.csv", "latest_batt_6Jan26_smbs.csv", "latest_batt_6Jan26.csv", "latest_batt_.csv", "x.csv"]
    cat = C.catalogue_from_files(spark.createDataFrame([(n,) for n in names], "file_name string"))
    assert {(r.report_date, r.source) for r in cat.collect()} == {
        (date(2026, 1, 5), C.UNMARKED), (date(2026, 1, 6), "smbs"), (date(2026, 1, 6), C.UNMARKED)}
    assert {r.report_date: r.read_source for r in C.catalogue_summary(cat).collect()} == {
        date(2026, 1, 5): C.UNMARKED, date(2026, 1, 6): "smbs"}


def _files(spark):
    names = ["latest_batt_5Jan26_smbs.csv", "latest_batt_6Jan26_smbs.csv", "latest_batt_6Jan26_debug.csv",
             "latest_batt_8Jan26_debug.csv", "notes.txt"]
    return C.catalogue_from_files(spark.createDataFrame([(n,) for n in names], "file_name string"))


def test_catalogue_sources(spark):
    cat = _files(spark)
    summ = {r.report_date: (r.has_preferred, r.has_other, r.read_source) for r in C.catalogue_summary(cat).collect()}
    assert summ == {date(2026, 1, 5): (1, 0, "smbs"), date(2026, 1, 6): (1, 1, "smbs"), date(2026, 1, 8): (0, 1, "debug")}


def test_missing_unsent_gaps(spark):
    cat = _files(spark)
    sent = spark.createDataFrame([(date(2026, 1, 4),), (date(2026, 1, 2),)], "report_date date")
    miss = sorted(r.report_date for r in C.missing_since_sent(cat, sent, date(2026, 1, 9)).collect())
    assert miss == [date(2026, 1, 7), date(2026, 1, 9)]
    none_sent = spark.createDataFrame([], "report_date date")
    miss2 = sorted(r.report_date for r in C.missing_since_sent(cat, none_sent, date(2026, 1, 9)).collect())
    assert miss2[0] == date(2026, 1, 2) and date(2026, 1, 5) not in miss2
    uns = sorted(r.report_date for r in C.unsent_dates(cat, sent).collect())
    assert uns == [date(2026, 1, 5), date(2026, 1, 6), date(2026, 1, 8)]
    gaps = {r.report_date: r.gap for r in C.snapshot_gaps(cat, date(2026, 1, 8), days=4).collect()}
    assert gaps == {date(2026, 1, 7): "missing", date(2026, 1, 8): "not_preferred"}


def test_device_list_csv_with_bom_and_crlf(spark, tmp_dir):
    import os

    from fleetvolt.sources.tables import device_list

    p = os.path.join(tmp_dir, "list.csv")
    with open(p, "wb") as f:
        f.write(b"\xef\xbb\xbfDeviceID\r\nA0000310\r\nA0000316\r\nA0000310\r\n\r\n")
    got = sorted(r.DeviceID for r in device_list(spark, p).collect())
    assert got == ["A0000310", "A0000316"]


def test_snapshot_file_names_round_trip(spark):
    from fleetvolt.functions.dates import snapshot_file_name

    d = spark.createDataFrame([(date(2026, 1, 5), "smbs"), (date(2026, 11, 25), "debug")], "d date, s string")
    names = d.select(snapshot_file_name("d", F.col("s")).alias("file_name"))
    assert sorted(r.file_name for r in names.collect()) == ["latest_batt_25Nov26_debug.csv", "latest_batt_5Jan26_smbs.csv"]
    back = sorted(tuple(r) for r in C.catalogue_from_files(names).collect())
    assert back == [(date(2026, 1, 5), "smbs"), (date(2026, 11, 25), "debug")]
