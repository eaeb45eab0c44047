"""Streams that run anew after each arrival: state that forgets, waits that end, tables that a later run finds again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.plans import registry
from gleaner.session import setting, shared_folder
from gleaner.streaming import seen, windows

DAY = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp"


def slices(spark, *rows):
    return [spark.createDataFrame([(k, None if d is None else DAY + timedelta(days=d)) for k, d in part], SCHEMA) for part in rows]


def test_silent_keys_leave_the_state_and_are_new_again(spark):
    """a comes daily, b after 31 days, c after exactly 30, d twice at once, e a little late within one arrival; nulls don't count."""
    parts = slices(spark, [("a", 0), ("b", 0), ("c", 0), ("d", 0), ("d", 0), (None, 0), ("x", None)], [("a", 20), ("e", 20), ("e", 19)], [("a", 29), ("c", 30), ("b", 31)], [("a", 62)], [("a", 63), ("c", 100)])
    place = f"{shared_folder(spark)}/streams/first-seen-test"
    with setting(spark, *seen.STORE):
        got = windows.reruns(parts, lambda rows: seen.first_seen(rows, "ts", "k"), place).collect()
        state = spark.read.format("statestore").option("path", f"{place}/state").option("stateVarName", "last").load().select("key.who").distinct().collect()
    days = sorted((r["k"], (r["first_seen"] - DAY).days) for r in got)
    assert days == [("a", 0), ("a", 62), ("b", 0), ("b", 31), ("c", 0), ("c", 100), ("d", 0), ("e", 19)]
    assert {r["who"] for r in state} == {"c"}


def test_waits_end_at_the_watermark(spark):
    """Matches as they come, unmatched rows once their wait is over, none twice."""
    at = lambda *days: [DAY + timedelta(days=d) for d in days]
    rows = [("a", "l", 0.0, 1), ("a", "r", 0.5, 11), ("b", "l", 0.0, 2), ("a", "r", 2.0, 12), ("c", "r", 3.0, 13), ("c", "l", 3.0, 3), ("c", "l", 2.0, 4)], [("z", "l", 40.0, None), ("y", "r", 40.0, None)]
    parts = [spark.createDataFrame([(k, s, at(d)[0], i) for k, s, d, i in part], "k string, side string, ts timestamp, i int") for part in rows]

    def query(x):
        a = x.where("side = 'l'").select("k", F.col("ts").alias("ta"), F.col("i").alias("a"))
        b = x.where("side = 'r'").select("k", F.col("ts").alias("tb"), F.col("i").alias("b"))
        return windows.matched(a, b, "k", "ta", "tb", "1 day", "left_outer")

    out = windows.reruns(parts, query).where("a is not null").select("a", "b").collect()
    assert sorted(out, key=repr) == sorted([(1, 11), (2, None), (3, 13), (4, 13)], key=repr)


def test_a_later_run_finds_the_state_table(spark, tmp_path):
    """The same place called again goes on from its last whole table; a table without a mark doesn't count."""
    rows, place = f"{tmp_path}/in", f"file://{tmp_path}/state"

    def merge(state, batch):
        return state.union(batch.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).groupBy("k").agg(F.sum("n").alias("n"))

    def run():
        return {r["k"]: r["n"] for r in windows.upserted(spark.readStream.schema(SCHEMA).parquet(rows), merge, "k string, n long", place).collect()}

    slices(spark, [("a", 0), ("b", 0)])[0].write.mode("append").parquet(rows)
    assert run() == {"a": 1, "b": 1}
    (tmp_path / "state/table/9").mkdir()
    slices(spark, [("a", 1), ("a", 1)])[0].write.mode("append").parquet(rows)
    assert run() == {"a": 3, "b": 1}
    assert run() == {"a": 3, "b": 1}


def test_complete_results_go_on(spark, tmp_path):
    rows, place = f"{tmp_path}/in", f"file://{tmp_path}/q"
    count = lambda: {r["k"]: r["n"] for r in windows.settled(spark.readStream.schema(SCHEMA).parquet(rows).groupBy("k").agg(F.count(F.lit(1)).alias("n")), at=place).collect()}
    slices(spark, [("a", 0)])[0].write.mode("append").parquet(rows)
    assert count() == {"a": 1}
    slices(spark, [("a", 1), ("b", 1)])[0].write.mode("append").parquet(rows)
    assert count() == {"a": 2, "b": 1}


def test_no_slice(spark):
    with pytest.raises(ValueError):
        windows.reruns([], lambda rows: rows)


def test_debuts_of_batches_equal_the_timers(spark):
    """The same keys from a table of last times, without a call per key: a comes daily, c after exactly 30 days, e late within one arrival;
    the last slice has a row behind the watermark. The table forgets as the state does."""
    parts = slices(spark, [("a", 0), ("b", 0), ("c", 0), ("d", 0), ("d", 0), (None, 0), ("x", None)], [("a", 20), ("e", 20), ("e", 19)], [("a", 29), ("c", 30), ("b", 31)], [("a", 62)], [("a", 63), ("c", 100)], [("f", 97), ("g", 98)])
    place = f"{shared_folder(spark)}/streams/debuts-test"
    out = windows.reruns(parts, lambda rows: rows, place, lambda rows, at: seen.debuts(rows, "ts", "k", at))
    days = sorted((r["k"], (r["first_seen"] - DAY).days) for r in out.collect())
    assert days == [("a", 0), ("a", 62), ("b", 0), ("b", 31), ("c", 0), ("c", 100), ("d", 0), ("e", 19), ("g", 98)]
    state = spark.read.parquet(windows.tables(spark, f"{place}/table")[5]).collect()
    assert sorted((r["who"], (r["last"] - DAY).days) for r in state) == [("c", 100), ("g", 98)]


def test_streamed_debuts_call_no_python_per_key(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(seen, "first_seen", None)
    got = registry.queries()["streamed_debuts"](spark, sf_dir)
    assert got.count() == got.distinct().count() > 0
