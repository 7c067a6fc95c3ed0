from pyspark.sql import functions as F

from fleetvolt.operators.positions import with_position


def test_positions_of_a_hot_group_with_ties(spark):
    rows = [("hot", i % 7, f"d{i % 50}") for i in range(3000)] + [("cold", i, "x") for i in range(5)] + [(None, 1, "x"), ("hot", None, "last")]
    rows += [("hot", 3, "same")] * 400
    df = spark.createDataFrame(rows, "section string, v int, id string").repartition(7)
    got = with_position(df, [F.col("v").asc_nulls_last(), F.col("id")], ["section"]).collect()
    assert len(got) == len(rows)
    for s in ("hot", "cold", None):
        own = sorted((r for r in got if r.section == s), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(own) + 1))
        key = [(r.v is None, r.v or 0, r.id) for r in own]
        assert key == sorted(key)


def test_no_group_is_one_task(spark):
    df = spark.range(8000).selectExpr("'one' AS section", "id % 3 AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_position(df, [F.col("v")], ["section"])
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2 and sizes[-1] < 5000


def test_no_rows_and_no_groups(spark):
    assert with_position(spark.range(0), [F.col("id")]).count() == 0
    assert [r.position for r in with_position(spark.range(20), [F.col("id").desc()]).orderBy(F.desc("id")).collect()] == list(range(1, 21))
