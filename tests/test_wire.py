from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.sources.wire import decode_json, observe_ingest, skip_bad

GOOD = ('{"tweet_id":"1","airline":"a","airline_sentiment":"negative","text":"t","retweet_count":2,'
        '"tweet_created":"2015-02-24 11:35:52 -0800"}')


def test_decode_flags_junk_null_and_missing_fields(spark):
    df = spark.createDataFrame([(GOOD,), ("junk{",), (None,), ('{"tweet_id":"2"}',)], "value string")
    d = decode_json(df)
    got = sorted((r.tweet_id or "", r.is_bad) for r in d.collect())
    assert got == [("", True), ("", True), ("1", False), ("2", True)]
    obs = Observation("ingest")
    out = skip_bad(d.observe(obs, F.count_if("is_bad").alias("skipped"), F.count_if(~F.col("is_bad")).alias("saved")))
    got = out.collect()
    assert [r.tweet_id for r in got] == ["1"] and got[0].retweet_count == 2
    assert obs.get == {"skipped": 3, "saved": 1}


def test_observe_ingest_is_lazy_and_keeps_rows(spark):
    df = spark.createDataFrame([(GOOD,), ("x",)], "value string")
    assert observe_ingest(decode_json(df)).count() == 2
