import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import iso_instant, parse_instant, parse_wall

CASES = [("2015-02-24 11:35:52 -0800",), ("2015-02-24 11:35:52 +0530",), ("garbage",), ("",), (None,),
         ("2015-02-30 11:00:00 -0800",)]


def test_parse_instant_and_wall(spark):
    df = spark.createDataFrame(CASES, "s string")
    got = {r["s"]: (r["i"], r["w"]) for r in df.select(
        "s", parse_instant("s").cast("timestamp_ntz").alias("i"),
        parse_wall("s").cast("timestamp_ntz").alias("w")).collect()}
    assert got["2015-02-24 11:35:52 -0800"] == (dt.datetime(2015, 2, 24, 19, 35, 52), dt.datetime(2015, 2, 24, 11, 35, 52))
    assert got["2015-02-24 11:35:52 +0530"] == (dt.datetime(2015, 2, 24, 6, 5, 52), dt.datetime(2015, 2, 24, 11, 35, 52))
    for bad in ["garbage", "", None, "2015-02-30 11:00:00 -0800"]:
        assert got[bad] == (None, None)


def test_parse_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", "True")
    df = spark.createDataFrame([("x",)], "s string")
    assert df.select(parse_instant("s").alias("t")).first()["t"] is None


def test_iso_instant(spark):
    df = spark.createDataFrame([("2015-02-24 19:35:00 +0000",)], "s string")
    assert df.select(iso_instant(parse_instant("s")).alias("t")).first()["t"] == "2015-02-24T19:35:00Z"
    assert df.select(F.lit(1)).count() == 1
