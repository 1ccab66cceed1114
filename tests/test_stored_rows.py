"""Rows are stored, read and made blocks of without being dealt anew more than they must."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import sequences as SQ
from panelkit.session import shared_path
from panelkit.sources import readers as RD
from panelkit.sources import sinks as SK


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    return [(s, dt.date(2001, 1, 1) + dt.timedelta(days=i), rng.choice([None, rng.uniform(-1, 1)]), float(i)) for s, n in sizes.items() for i in range(n)]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(rows_of({"a": 300, "b": 40, "c": 1}), "symbol string, trade_date date, x double, y double").repartition(4)


def test_rows_are_stored_from_where_they_lie(spark, table):
    """The rows of one symbol in four tasks: four files, nothing shuffled to one."""
    path = shared_path(spark, "where-they-lie")
    SK.write_features(table.where("symbol = 'a'"), path, buckets=4)
    assert len(glob.glob(f"{path.removeprefix('file:')}/run=0/*/*.parquet")) == 4
    assert RD.load_features(spark, path).count() == 300


def test_a_table_of_one_run_is_joined_to_nothing(spark, table):
    path = shared_path(spark, "one-run")
    SK.write_features(table, path, buckets=4)
    got = RD.load_features(spark, path, min_rows=0)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.exceptAll(table).count() == 0 and got.count() == 341


def test_gates_of_several_runs(spark, table):
    """Of a symbol the latest run counts, and only its rows say whether there are enough."""
    path = shared_path(spark, "runs")
    SK.write_features(table, path, buckets=4)
    SK.write_features(table.where("symbol = 'a' AND trade_date < '2001-01-06'"), path, run=1, buckets=4)
    SK.write_features(table.where("symbol = 'c'").withColumn("symbol", F.lit(None).cast("string")), path, run=2, buckets=4)
    for least, want in ((0, {"a": 5, "b": 40, "c": 1}), (1, {"a": 5, "b": 40}), (5, {"b": 40}), (40, {})):
        assert {r["symbol"]: r["count"] for r in RD.load_features(spark, path, least).groupBy("symbol").count().collect()} == want


def test_blocks_of_short_and_long_keys(spark, monkeypatch):
    """Lists and numbered rows give the same blocks, beside each other too."""
    df = spark.createDataFrame(rows_of({"long": 700, "edge": 128, "short": 65, "one": 1}), "symbol string, trade_date date, x double, y double").repartition(3)
    got = {}
    for short in (0, 100, 2048):
        monkeypatch.setattr(SQ, "SHORT", short)
        blocks = SQ.dense_blocks(df, ["x"], ["y"], rows=64)
        got[short] = sorted(map(tuple, blocks.collect()))
        assert blocks.columns == ["symbol", "block", "first", "n", "halo", "len", "dates", "nulls", "x", "y"]
    assert got[0] == got[100] == got[2048] and len(got[0]) == 11 + 2 + 2 + 1


def test_short_keys_are_sent_once(spark):
    df = spark.createDataFrame(rows_of({"a": 300, "b": 40}), "symbol string, trade_date date, x double, y double").repartition(3)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = SQ.dense_blocks(df, ["x"], ["y"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
