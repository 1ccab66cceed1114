"""Queries that want a few of the stored columns derive and store these alone, with the same rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import sequences as SQ
from panelkit.plans import features as FT
from panelkit.plans import queries as Q


@pytest.fixture(scope="module")
def feed(spark):
    rng, rows, index = random.Random(5), [], []
    for s in ("600001", "000002"):
        for i in range(340):
            p = [rng.uniform(90, 110) for _ in range(3)]
            rows.append((s, str(dt.date(1995, 1, 1) + dt.timedelta(days=i)), *[f"{v:.2f}" for v in (p[0], p[1], min(p), max(p))], "1.5", str(rng.randint(1, 9) * 100000),
                         "1000.0", "12.0", "1.5", "2.5", "3.0", "0"))
    for i in range(340):
        if i % 50:
            p = [rng.randint(200000, 300000) for _ in range(2)]
            index.append(("sh.000001", dt.date(1995, 1, 1) + dt.timedelta(days=i), p[0], max(p), min(p), p[1], 1000 * rng.randint(1, 99), 5))
    raw = spark.createDataFrame(rows, "symbol string, date string, close string, open string, low string, high string, turn string, volume string, amount string, "
                                "peTTM string, pbMRQ string, psTTM string, pcfNcfTTM string, isST string")
    return raw, spark.createDataFrame(index, "index_code string, trade_date date, open_c long, high_c long, low_c long, close_c long, volume long, amount_c long")


def test_wanted_columns_are_those_of_the_whole_table(feed):
    whole = FT.feature_table(*feed).cache()
    for columns, labels in (([], []), (["close", "v5"], ["resultclass4"]), (["obv", "beta"], []), (["dif", "sar"], ["resultbuy7"]),
                            (["zsr5", "zsv5_20_d", "everypb"], ["resultrelclass10"])):
        got = FT.feature_table(*feed, columns=columns, labels=labels)
        assert got.columns == ["symbol", "trade_date", *[c for c in FT.FEATURE_COLUMNS if c in columns], *labels]
        want = whole.select(*[F.col(f"`{c}`") for c in got.columns])
        assert got.count() == want.count() == 440 and got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        FT.feature_table(*feed, columns=["nothing"])
    whole.unpersist()


def test_trainers_queries_store_their_columns_only(spark, sf):
    Q.clean_up(spark)
    Q.q_chrono_split(spark, sf).count()
    Q.q_union_predictions(spark, sf).count()
    (_, _, a, b), (_, _, c, d) = Q._STORES
    assert ((a, b), (c, d)) == (((), ()), (("r20",), ()))
    assert set(spark.read.parquet(Q._STORES[next(iter(Q._STORES))]).columns) == {"symbol", "trade_date", "run", "bucket"}
    Q.blocks(spark, sf, ["r20"], ())  # held already
    assert len(Q._STORES) == len(Q._BLOCKS) == 2


def test_nulls_of_a_flag_are_those_of_the_features(spark):
    rows = [("s", dt.date(2001, 1, 1) + dt.timedelta(days=i), None if i in (3, 150) else 1.0, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "symbol string, trade_date date, a double, b double")
    wide = SQ.dense_blocks(df, ["a", "b"], rows=64)
    flag = SQ.dense_blocks(df.withColumn("gap", SQ.any_null(["a", "b"])), [], rows=64, flag="gap")
    assert set(flag.columns) == set(wide.columns) - {"a", "b"}
    assert wide.select(*flag.columns).exceptAll(flag).count() == 0 and flag.count() == wide.count() == 4
    assert SQ.null_symbols(flag).collect() == SQ.null_symbols(wide).collect()


def test_edges_of_short_and_hot_keys(spark, monkeypatch):
    """Ranked and selected keys side by side: the exact percentiles, ties and NULLs included."""
    from panelkit.operators import labels as L
    rng = random.Random(9)
    rows = [(k, None if rng.random() < .1 else round(rng.uniform(-1, 1), d)) for k, n, d in (("hot", 4000, 4), ("ties", 900, 1), ("short", 60, 6), ("one", 1, 3)) for _ in range(n)]
    rows += [("one", 0.5), ("none", None)]
    df = spark.createDataFrame(rows, "symbol string, x double").repartition(5)
    want = {r[0]: r[1] for r in df.where("x IS NOT NULL").groupBy("symbol").agg(F.expr("percentile(x, array(.1, .2, .3, .4, .5, .6, .7, .8, .9))")).collect()}
    for crowded in (100_000, 1000, 50):
        monkeypatch.setattr(L, "CROWDED", crowded)
        got = {r["symbol"]: r["edges"] for r in L.quantile_edges(df, "x").collect()}
        assert got.keys() == want.keys() == {"hot", "ties", "short", "one"}
        assert all(abs(a - b) <= 5.1e-4 for k in want for a, b in zip(got[k], want[k], strict=True))
    monkeypatch.setattr(L, "CROWDED", 100_000)
    plain = {r["symbol"]: r["edges"] for r in L.quantile_edges(df, "x").collect()}
    assert plain == got


def test_no_copies_after_a_last_segment(spark):
    """A known size leaves no rows in a segment that has none of its own; without it, the home rows are the same."""
    from panelkit.plans import segments as G
    df = spark.range(1, 1001).selectExpr("'s' AS symbol", "id AS _grn", "1000L AS _n")
    a, b = G.segment(df, 900, back=900, fwd=900), G.segment(df, 900, back=900, fwd=900, size="_n")
    assert {r[0] for r in a.select("_seg").distinct().collect()} == {0, 1, 2} and {r[0] for r in b.select("_seg").distinct().collect()} == {0, 1}
    assert a.filter("_seg < 2").exceptAll(b).count() == 0 and a.filter("_home").exceptAll(b.filter("_home")).count() == 0


def test_bars_sort_after_the_shuffle_only(spark, sf):
    """The lines are sent as they are: no partial aggregation, so no sort, before the exchange."""
    from panelkit.sources import fixtures as X
    plan = X.bars(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):]


def test_sums_do_not_grow_with_partitions(spark, monkeypatch):
    """M1 sends a bounded number of matrices, one label each, however many partitions the data have."""
    from panelkit.operators import models as MD
    df = spark.createDataFrame([([float(i % 7), float(i % 5)], float(i), 1.0) for i in range(400)], "x array<double>, y double, z double").repartition(50)
    read = MD.from_vectors(["y", "z"])
    for weights, parts in ((None, 4), ([[0.0] * 3] * 2, 4)):
        sums, n = MD._sums(df, read, 2, weights, 1e-4, 4)
        assert n == parts and sums.count() == parts * MD.STRIPS
