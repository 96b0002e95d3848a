import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.metrics import batch_metrics, merge_metrics, speed_metrics, to_wire, windowed_metrics
from tidemark.schemas import METRIC_FIELDS, TWEET

from .conftest import rows


def tw(rows_):
    return [(str(i), a, s, "t", rt, c) for i, (a, s, rt, c) in enumerate(rows_)]


EDGE = tw([
    ("A", "positive", 3, "2015-02-24 11:00:01 -0800"),
    ("A", "negative", None, "2015-02-24 11:00:02 -0800"),
    ("A", "neutral", -4, "2015-02-24 11:00:03 -0800"),
    ("A", "Negative", 1, "2015-02-24 11:00:04 -0800"),    # case: no class
    ("A", "mixed", 2, "2015-02-24 11:00:05 -0800"),       # unknown: total only
    ("A", None, 0, "2015-02-24 11:00:06 -0800"),          # null sentiment: total only
    ("A", "positive", 5, "garbage"),                      # invalid time: dropped
    (None, "positive", 1, "2015-02-24 11:00:07 -0800"),   # null key: own group (batch)
])


def test_batch_rules(spark):
    df = spark.createDataFrame(EDGE, TWEET)
    m = batch_metrics(df)
    assert m.columns == METRIC_FIELDS
    r = {x["airline"]: x for x in m.collect()}
    a = r["A"]
    assert (a.tweet_count, a.positive_count, a.negative_count, a.neutral_count) == (6, 1, 1, 1)
    assert a.positive_ratio == 1 / 6 and a.negative_ratio == 1 / 6
    assert a.avg_retweet == (3 - 4 + 1 + 2 + 0) / 5          # NULL ignored
    assert a.max_retweet == 3
    assert a.tweet_rate == 6 / 60.0
    assert a.window_start == dt.datetime(2015, 2, 24, 11, 0) and a.window_end == dt.datetime(2015, 2, 24, 12, 0)
    assert r[None].tweet_count == 1


def test_speed_rules(spark):
    df = spark.createDataFrame(EDGE, TWEET)
    r = {x["airline"]: x for x in speed_metrics(df).collect()}
    a = r["A"]
    assert a.avg_retweet == (3 + 0 - 4 + 1 + 2 + 0) / 6      # NULL as 0, all rows
    assert a.window_start == dt.datetime(2015, 2, 24, 19, 0)  # instant clock, 1 minute
    neg = spark.createDataFrame(tw([("B", "neutral", -3, "2015-02-24 11:00:01 -0800")]), TWEET)
    assert speed_metrics(neg).first().max_retweet == 0       # max starts at 0
    assert batch_metrics(neg).first().max_retweet == -3


def test_wire_shape(spark):
    df = spark.createDataFrame(EDGE[:1], TWEET)
    w = to_wire(speed_metrics(df)).first()
    assert (w.window_start, w.window_end) == ("2015-02-24T19:00:00Z", "2015-02-24T19:01:00Z")


times = st.integers(min_value=0, max_value=3 * 3600 - 1)
row = st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["positive", "negative", "neutral", "x", None]),
                st.one_of(st.none(), st.integers(-5, 50)), times)


@settings(max_examples=6, deadline=None)
@given(st.lists(row, min_size=1, max_size=40), st.integers(1, 5))
def test_rollup_and_split_properties(spark, data, parts):
    base = dt.datetime(2015, 2, 24, 10, 0)
    recs = [(str(i), a, s, "t", rt, (base + dt.timedelta(seconds=t)).strftime("%Y-%m-%d %H:%M:%S") + " +0000")
            for i, (a, s, rt, t) in enumerate(data)]
    df = spark.createDataFrame(recs, TWEET).repartition(parts)
    direct = windowed_metrics(df, F.try_to_timestamp("tweet_created", F.lit("yyyy-MM-dd HH:mm:ss Z")),
                              "1 hour", "speed")
    rolled = merge_metrics(speed_metrics(df), "1 hour")
    assert rows(direct) == rows(rolled)
    one = spark.createDataFrame(recs, TWEET).coalesce(1)
    assert rows(speed_metrics(df)) == rows(speed_metrics(one))


def test_every_valid_row_in_exactly_one_group(spark):
    from tidemark.functions import parse_wall
    from tidemark.sources.adapters import tweets
    t = tweets(spark, "/root/testdata/sf0.001")
    valid = t.filter(parse_wall("tweet_created").isNotNull()).count()
    for m in (batch_metrics(t), speed_metrics(t)):
        assert m.agg(F.sum("tweet_count")).first()[0] == valid
        assert m.groupBy("airline", "window_start").count().filter("count > 1").count() == 0
