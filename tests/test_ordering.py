from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import prefix_index

from .conftest import rows


def plain(df, by, order, out="index"):
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    return df.withColumn(out, F.row_number().over(w.orderBy(*order)).cast("bigint"))


def test_a_hot_group_and_null_keys(spark):
    d = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(40)).alias("t"), "id", F.lit("x").alias("n"))
    got = prefix_index(d, ["t", "id"], by=["k"])
    assert got.columns == ["k", "t", "id", "n", "index"]
    assert rows(got) == rows(plain(d, ["k"], ["t", "id"]))


def test_over_all_rows_in_descending_order(spark):
    d = spark.range(1000).select("id", F.pmod(F.xxhash64("id"), F.lit(9)).alias("score"))
    order = [F.col("score").desc(), F.col("id").asc()]
    assert rows(prefix_index(d, order, out="rank")) == rows(plain(d, [], order, "rank"))


def test_no_rows_and_an_old_index(spark):
    assert prefix_index(spark.createDataFrame([], "k string, t long"), ["t"], by=["k"]).collect() == []
    assert rows(prefix_index(spark.range(3).withColumn("index", F.lit("old")), ["id"])) == [(0, 1), (1, 2), (2, 3)]


def test_the_hot_group_is_dealt_out(spark):
    d = spark.range(20_000, numPartitions=8).select(F.lit("one").alias("k"), F.xxhash64("id").alias("t"))
    plan = prefix_index(d, ["t"], by=["k"])
    assert plan.selectExpr("max(index) m", "count(distinct index) n").first() == (20_000, 20_000)
    assert "Window [row_number" not in plan._jdf.queryExecution().toString()
