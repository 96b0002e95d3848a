import os

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import RAW_LAKE, TWEET
from tidemark.session import folder_exists
from tidemark.sources import lake as LK
from tidemark.sources.ledger import Ledger
from tidemark.sources.lake import append_raw, file_stream, ledger, ledger_audit, read_raw, write_raw
from tidemark.streaming.speed import run_available

from .test_streaming import ARRIVALS, write_files

NOW = "2024-01-01 00:00:00"
ALL = sum(len(b) for b in ARRIVALS)


class HostGone(RuntimeError):
    pass


def stop_at(step, batch):
    def on_step(name, at):
        if (name, at) == (step, batch):
            raise HostGone(name)
    return on_step


def run(spark, src, lake, ck, on_step=None):
    raw = file_stream(spark, src, TWEET, max_files_per_trigger=2)
    run_available(append_raw(raw, lake, ck, now=NOW, trigger={"availableNow": True}, on_step=on_step))


def check(spark, lake):
    got = read_raw(spark, lake)
    assert got.count() == ALL == got.select("tweet_id").distinct().count()
    assert ledger_audit(spark, lake).collect() == []
    assert ledger(spark, lake).entries().agg(F.sum("rows"), F.count("*")).first() == (ALL, 4)


@pytest.mark.parametrize("step,batch", [("begun", 0), ("written", 2), ("moved", 0), ("done", 2)])
def test_a_stop_after_each_step_loses_and_doubles_nothing(spark, tmp, step, batch):
    src, lake, ck = (os.path.join(tmp, x) for x in ("in", "lake", "ck"))
    write_files(src, ARRIVALS)
    write_raw(spark.createDataFrame([], TWEET), lake, now=NOW)
    with pytest.raises(Exception):
        run(spark, src, lake, ck, stop_at(step, batch))
    before = read_raw(spark, lake).count()
    assert before == sum(len(b) for b in ARRIVALS[:2 * (batch + (step == "done"))])    # a reader sees whole batches only
    run(spark, src, lake, ck)
    check(spark, lake)
    assert not [f for f in os.listdir(lake) if f.startswith("_wri")]


@pytest.mark.parametrize("lost", ["first", "all but one"])
def test_a_move_that_stops_between_two_files(spark, tmp, monkeypatch, lost):
    """A store without an atomic rename: some files of the batch arrive, others do not."""
    src, lake, ck = (os.path.join(tmp, x) for x in ("in", "lake", "ck"))
    write_files(src, ARRIVALS)
    whole = LK.move_folder

    def copies_some(spark_, source, target):
        whole(spark_, source, target)
        files = sorted(f for f in os.listdir(target) if f.endswith(".parquet"))
        gone = files[:1] if lost != "all but one" else files[1:] or files
        for f in gone:
            os.remove(os.path.join(target, f))
        raise HostGone("between two files")

    monkeypatch.setattr(LK, "move_folder", copies_some)
    with pytest.raises(Exception):
        run(spark, src, lake, ck)
    monkeypatch.setattr(LK, "move_folder", whole)
    assert read_raw(spark, lake).count() == 0
    run(spark, src, lake, ck)
    check(spark, lake)


def test_uncommitted_files_are_not_even_opened(spark, tmp):
    lake = os.path.join(tmp, "lake")
    write_raw(spark.createDataFrame([("1", "a", "neutral", "t", 1, "x")], TWEET), lake, now=NOW)
    folder = os.path.join(lake, LK.STREAM_FOLDER.format(query="0" * 36, batch=3))
    os.makedirs(folder)
    with open(os.path.join(folder, "part-0.parquet"), "wb") as f:
        f.write(b"no parquet at all")
    strict = spark.read.schema(RAW_LAKE).option("recursiveFileLookup", "true").parquet(lake)
    assert strict.where(LK.committed_files(spark, lake)).count() == 1
    Ledger(spark, f"{lake}/_ledger").done("0" * 36, 2, 0)
    assert strict.where(LK.committed_files(spark, lake)).count() == 1
    Ledger(spark, f"{lake}/_ledger").done("0" * 36, 3, 5)
    with pytest.raises(Exception):
        strict.where(LK.committed_files(spark, lake)).count()
    assert [tuple(r) for r in ledger_audit(spark, lake).collect()] == [("0" * 36, 3, 5, 0)]


def test_entries_fold_and_stay_the_same(spark, tmp, monkeypatch):
    monkeypatch.setattr("tidemark.sources.ledger.FOLD_AT", 15)
    book = Ledger(spark, os.path.join(tmp, "book"))
    assert book.entries().collect() == [] and book.lasts() == {} and book.state("q", 0) is None
    for k in range(20):
        book.begin("q", k)
        assert book.state("q", k) == "begun"
        book.done("q", k, 10 + k, [("f", 10 + k)])
        assert book.state("q", k) == "done"
    book.done("other", 4, 1)
    assert sum(n.endswith(".done") for n in book._names(f"{book.folder}/q")) < 15
    assert sorted((r.batch, r.rows, r.files[0].rows) for r in book.entries().where("writer = 'q'").collect()) == [(k, 10 + k, 10 + k) for k in range(20)]
    assert book.lasts() == {"q": 19, "other": 4} and book.compact("nobody") == 0
    assert folder_exists(spark, f"{book.folder}/q")


# ---------------------------------------------------------------- speed table
def speed_db(spark, tmp, name):
    from tidemark.operators import serving as S
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{os.path.join(tmp, 'db')}'")
    S.create_speed_table(spark, f"{name}.speed")
    return S, f"{name}.speed"


def speed_rows(spark, *days):
    from .test_serving import METRICS_TABLE, T, metric
    rows = [metric(k, T(11, d), T(11, d + 1)) for d in days for k in "ab"]
    return spark.createDataFrame(rows, METRICS_TABLE)


@pytest.mark.parametrize("step", ["begin", "half", "append", "done"])
def test_speed_append_that_is_cut_off(spark, tmp, monkeypatch, step):
    S, table = speed_db(spark, tmp, f"cut_{step}")
    assert S.append_speed(speed_rows(spark, 1), table, 0, writer="q")
    whole, put = S.append_rows, Ledger.done

    def gone(*_):
        raise HostGone(step)

    def half(df, t):
        whole(df.filter("airline = 'a'"), t)
        gone()

    def append(df, t):
        whole(df, t)
        gone()

    if step == "done":
        monkeypatch.setattr(Ledger, "done", lambda *a: (put(*a), gone()))
    else:
        monkeypatch.setattr(S, "append_rows", {"begin": gone, "half": half, "append": append}[step])
    with pytest.raises(HostGone):
        S.append_speed(speed_rows(spark, 1, 2, 3), table, 1, writer="q")
    monkeypatch.setattr(S, "append_rows", whole)
    monkeypatch.setattr(Ledger, "done", put)
    assert S.committed_speed(spark, table).count() == (8 if step == "done" else 2)      # readers see whole batches
    assert S.append_speed(speed_rows(spark, 1, 2, 3), table, 1, writer="q") is (step != "done")
    assert S.append_speed(speed_rows(spark, 1, 2, 3), table, 1, writer="q") is False
    assert spark.table(table).count() == 8 == S.committed_speed(spark, table).count()
    assert {(r.batch, r.rows) for r in S.speed_ledger(spark, table).entries().collect()} == {(0, 2), (1, 6)}


def test_rows_of_a_release_without_ledger_are_known(spark, tmp):
    S, table = speed_db(spark, tmp, "old_release")
    rows = S.with_window_date(speed_rows(spark, 1)).selectExpr("*", "current_timestamp() AS created_at", "'q' AS writer", "3L AS batch_id")
    S.append_rows(rows, table)
    assert S.append_speed(speed_rows(spark, 1), table, 3, writer="q") is False
    assert S.append_speed(speed_rows(spark, 2), table, 4, writer="q") is True
    assert S.committed_speed(spark, table).count() == 4
