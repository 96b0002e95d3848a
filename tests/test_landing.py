import os

from tidemark.sources.landing import normalise, ordered, read_landing

CSV = ('retweet_count,tweet_created,extra,tweet_id,airline,airline_sentiment,text\n'
       '"",2015-02-24 11:35:52 -0800,x,1,007,positive,"hello, world"\n'
       '" 7 ",2015-02-24 11:35:51 -0800,x,2,Delta,negative,"she said ""no"""\n'
       '1.0,2015-02-24 11:35:50 -0800,x,3,Delta,neutral,"two\nlines"\n'
       '-2,2015-02-24 11:35:50 -0800,x,4,Delta,neutral,bad \xff byte\n')


def write(tmp, text):
    """Write the CSV as UTF-8 with one raw 0xFF byte where the text holds \xff."""
    p = os.path.join(tmp, "Tweets.csv")
    with open(p, "wb") as f:
        f.write(b"\xff".join(part.encode("utf-8") for part in text.split("\xff")))
    return p


def test_read_landing_by_name_and_quoting(spark, tmp):
    df = read_landing(spark, write(tmp, CSV))
    assert df.columns == ["tweet_id", "airline", "airline_sentiment", "text", "retweet_count", "tweet_created"]
    r = {x.tweet_id: x for x in df.collect()}
    assert len(r) == 4
    assert r["1"].text == "hello, world" and r["1"].airline == "007"
    assert r["2"].text == 'she said "no"'
    assert r["3"].text == "two\nlines"
    assert "�" in r["4"].text                    # undecodable byte replaced


def test_normalise_retweets(spark, tmp):
    n = {x.tweet_id: x for x in normalise(read_landing(spark, write(tmp, CSV))).collect()}
    assert (n["1"].retweet_count, n["1"].is_bad) == (0, False)
    assert (n["2"].retweet_count, n["2"].is_bad) == (7, False)
    assert (n["3"].retweet_count, n["3"].is_bad) == (None, True)
    assert (n["4"].retweet_count, n["4"].is_bad) == (-2, False)
    nul = spark.createDataFrame([("9", "a", "p", "t", None, "x")], ",".join(
        f"{c} string" for c in ["tweet_id", "airline", "airline_sentiment", "text", "retweet_count", "tweet_created"]))
    assert normalise(nul).first().retweet_count == 0


def test_ordered_text_is_stable(spark, tmp):
    df = normalise(read_landing(spark, write(tmp, CSV)))
    assert [x.tweet_id for x in ordered(df, "text").collect()] == ["3", "4", "2", "1"]
    assert [x.tweet_id for x in ordered(df, "instant").collect()] == ["3", "4", "2", "1"]


def test_missing_column_is_error(spark, tmp):
    import pytest
    p = os.path.join(tmp, "bad.csv")
    with open(p, "w") as f:
        f.write("tweet_id,airline\n1,a\n")
    with pytest.raises(ValueError):
        read_landing(spark, p)


def test_landing_records_drop_bad_and_order(spark, tmp):
    from tidemark.sources.landing import landing_counts, landing_records
    path = write(tmp, CSV)
    assert [x.tweet_id for x in landing_records(spark, path).collect()] == ["4", "2", "1"]
    assert tuple(landing_counts(normalise(read_landing(spark, path))).first()) == (3, 1)


def test_empty_fields_stay_empty_text(spark, tmp):
    p = os.path.join(tmp, "e.csv")
    with open(p, "w") as f:
        f.write("tweet_id,airline,airline_sentiment,text,retweet_count,tweet_created\n1,,\"\",,,t\n")
    r = normalise(read_landing(spark, p)).first()
    assert (r.airline, r.airline_sentiment, r.text, r.retweet_count, r.is_bad) == ("", "", "", 0, False)


def test_ties_keep_file_and_row_order(spark, tmp):
    from tidemark.sources.landing import landing_records
    folder = os.path.join(tmp, "many")
    os.makedirs(folder)
    for k in range(6):   # later files are larger: file packing would read them first
        with open(os.path.join(folder, f"f{k}.csv"), "w") as f:
            f.write("tweet_id,airline,airline_sentiment,text,retweet_count,tweet_created\n")
            f.writelines(f"{k}-{i:03d},a,positive,{'x' * 50 * k},1,same\n" for i in range(5 + 20 * k))
    for multi in (True, False):
        got = [x.tweet_id for x in landing_records(spark, folder, multi_line=multi).collect()]
        assert got == sorted(got) and len(got) == sum(5 + 20 * k for k in range(6))
