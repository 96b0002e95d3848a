import datetime as dt
import os

from tidemark.operators import alerts as AL

COLS = "tweet_id string, airline string, airline_sentiment string, text string, retweet_count int, " \
       "tweet_created string, created_at timestamp, seq long"


def D(h):
    return dt.datetime(2024, 1, 1, h)


def test_upsert_last_arrival_wins_and_idempotent(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS al LOCATION '{os.path.join(tmp, 'db')}'")
    t = "al.alerts"
    u1 = spark.createDataFrame([("1", "a", "negative", "old", 1, "x", D(1), 1),
                                ("2", "b", "negative", "keep", 2, "x", D(2), 2)], COLS)
    AL.upsert(spark, t, u1, order_cols=("seq",), buckets=4)
    u2 = spark.createDataFrame([("1", "a", "negative", None, 5, "x", D(3), 4),     # newer NULL overwrites
                                ("1", "a", "negative", "older", 9, "x", D(3), 3),  # same batch, earlier
                                ("3", "c", "negative", "new", 0, "x", D(4), 5)], COLS)
    AL.upsert(spark, t, u2, order_cols=("seq",), buckets=4)
    snap = sorted(tuple(r) for r in spark.table(t).drop("bucket").collect())
    AL.upsert(spark, t, u2, order_cols=("seq",), buckets=4)                        # twice equals once
    again = sorted(tuple(r) for r in spark.table(t).drop("bucket").collect())
    assert snap == again
    got = {r.tweet_id: (r.text, r.retweet_count) for r in spark.table(t).collect()}
    assert got == {"1": (None, 5), "2": ("keep", 2), "3": ("new", 0)}


def test_filter_and_finders(spark):
    df = spark.createDataFrame([("1", "a", "negative", "t", 1, "x", D(1), 1),
                                ("2", "a", "Negative", "t", 1, "x", D(2), 2),
                                ("3", "a", None, "t", 1, "x", D(3), 3),
                                ("4", "b", "negative", "t", 1, "x", D(23), 4),
                                ("5", "a", "negative", "t", 1, "x", D(20), 5)], COLS)
    al = AL.alert_filter(df)
    assert sorted(r.tweet_id for r in al.collect()) == ["1", "4", "5"]
    assert [r.tweet_id for r in AL.alerts_by_airline(al, "a").collect()] == ["5", "1"]
    assert [r.tweet_id for r in AL.alerts_recent(al, "a", now="2024-01-02 01:30:00").collect()] == ["5"]
    assert [r.tweet_id for r in AL.alerts_latest(al, 2).collect()] == ["4", "5"]
    assert AL.alerts_airline_sentiment(df, "a", "Negative").count() == 1


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

upd = st.tuples(st.sampled_from(["k1", "k2", "k3", "k4", "k5"]), st.one_of(st.none(), st.sampled_from(["x", "y"])),
                st.integers(0, 9))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(upd, min_size=1, max_size=8), min_size=1, max_size=3))
def test_upsert_matches_brute_force(spark, tmp_path_factory, batches):
    d = str(tmp_path_factory.mktemp("up"))
    db = "up_" + os.path.basename(d).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{d}/db'")
    seq, expected = 0, {}
    for b in batches:
        recs = []
        for key, text, rt in b:
            seq += 1
            recs.append((key, "a", "negative", text, rt, "x", D(1), seq))
            expected[key] = (text, rt)
        AL.upsert(spark, f"{db}.t", spark.createDataFrame(recs, COLS), order_cols=("seq",), buckets=3)
    got = {r.tweet_id: (r.text, r.retweet_count) for r in spark.table(f"{db}.t").collect()}
    assert got == expected


def test_new_keys_append_and_compaction(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS al2 LOCATION '{os.path.join(tmp, 'db')}'")
    t = "al2.alerts"
    AL.upsert(spark, t, spark.createDataFrame([("n0", "a", "negative", "t", 0, "x", D(1), 0)], COLS),
              order_cols=("seq",), buckets=1)
    AL.upsert(spark, t, spark.createDataFrame([("n0", "a", "negative", "new", 9, "x", D(2), 9)], COLS),
              order_cols=("seq",), buckets=1)              # a replacement: the bucket is rewritten
    for i in range(1, 4):                                    # new keys: appended, one file each
        AL.upsert(spark, t, spark.createDataFrame([(f"n{i}", "a", "negative", "t", i, "x", D(1), i)], COLS),
                  order_cols=("seq",), buckets=1)
    assert spark.table(t).select("_metadata.file_path").distinct().count() == 4
    before = sorted(tuple(r) for r in spark.table(t).collect())
    assert len(before) == 4 and dict((r[0], r[3]) for r in before)["n0"] == "new"
    assert AL.compact_buckets(spark, t, max_files=1) == 1
    assert spark.table(t).select("_metadata.file_path").distinct().count() == 1
    assert sorted(tuple(r) for r in spark.table(t).collect()) == before


def test_a_null_key_is_a_key(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS al3 LOCATION '{os.path.join(tmp, 'db')}'")
    for n in range(3):
        AL.upsert(spark, "al3.t", spark.createDataFrame([(None, "a", "negative", f"t{n}", 1, "x", D(1), n)], COLS),
                  order_cols=("seq",), buckets=4)
    assert [(r.tweet_id, r.text) for r in spark.table("al3.t").collect()] == [(None, "t2")]


def test_upsert_leaves_no_scratch_folders(spark, tmp):
    from tidemark.session import ensure_checkpoint_dir
    spark.sql(f"CREATE DATABASE IF NOT EXISTS al4 LOCATION '{os.path.join(tmp, 'db')}'")
    root = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tidemark")
    names = lambda: {f for f in (os.listdir(root) if os.path.isdir(root) else []) if f.startswith(("upsert", "overwrite"))}
    before = names()
    for n in range(2):
        AL.upsert(spark, "al4.t", spark.createDataFrame([("1", "a", "negative", f"t{n}", 1, "x", D(1), n)], COLS),
                  order_cols=("seq",), buckets=4)
    assert names() == before
