"""Incremental feature runs over a file stream."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from panelkit.plans.features import feature_table
from panelkit.sources import fixtures as X
from panelkit.sources import readers as RD
from panelkit.streaming.incremental import run_incremental

OPTIONS = {"with_features": False}  # prices and labels: enough to tell rows, and quick


@pytest.fixture()
def base(spark):
    return os.path.join(spark.conf.get("spark.checkpoint.dir"), f"stream-{uuid.uuid4().hex}")


def rows(df):
    return {(r["symbol"], r["trade_date"]): r["resultclass4"] for r in df.collect()}


def test_later_bars_and_split_histories(spark, sf, base):
    """Half of every history, then the rest, then the same again: as if all had come at once."""
    feed, sink = os.path.join(base, "feed"), os.path.join(base, "features")
    raw, ib = X.raw_bars(spark, sf), X.index_bars(spark, sf)
    middle = str(raw.select(F.percentile_approx(F.unix_date(F.col("date").cast("date")), 0.6).alias("d")).select(F.date_from_unix_date("d")).first()[0])
    early = F.col("date") < middle
    raw.filter(early).write.parquet(os.path.join(feed, "batch1"))
    run_incremental(spark, os.path.join(feed, "*"), raw.schema, ib, sink, buckets=4, min_clean=100, **OPTIONS)
    assert rows(RD.load_features(spark, sink)) == rows(feature_table(raw.filter(early), ib, min_clean=100, **OPTIONS))
    raw.filter(~early).write.parquet(os.path.join(feed, "batch2"))
    whole = rows(feature_table(raw, ib, min_clean=100, **OPTIONS))
    run_incremental(spark, os.path.join(feed, "*"), raw.schema, ib, sink, buckets=4, min_clean=100, **OPTIONS)
    assert rows(RD.load_features(spark, sink)) == whole
    raw.filter(early).write.parquet(os.path.join(feed, "batch3"))  # nothing new
    run_incremental(spark, os.path.join(feed, "*"), raw.schema, ib, sink, buckets=4, min_clean=100, **OPTIONS)
    assert rows(RD.load_features(spark, sink)) == whole
