"""The wide window stages: rounding without decimals, shared terms evaluated once, no method too large to compile."""

import datetime as dt

from pyspark.sql import functions as F

from panelkit import session
from panelkit.functions import sql as E
from panelkit.functions import whole
from panelkit.operators import indicators as T
from panelkit.operators import labels as L
from panelkit.plans import queries as Q


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _bars(spark, n=40):
    rows = [("s", dt.date(2001, 1, 1) + dt.timedelta(days=i), 100 + i % 7, 120 + i % 5, 90 - i % 3, 105 - i % 4, 100000 * (1 + i % 6)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, open_c long, high_c long, low_c long, close_c long, volume long")


def test_whole_is_round(spark):
    """Halves away from zero, their neighbours, large, infinite and missing numbers: the values of round."""
    xs = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 0.5000000000000001, 1e15 + 0.5, 4503599627370497.5, 2.0 ** 60, -1e300,
          float("inf"), float("-inf"), None, 123456.5, 0.1 + 0.2]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", F.round("x").alias("a"), whole("x").alias("b"), F.expr(E.whole("x")).alias("c"))
    assert all(r.a == r.b == r.c for r in df.collect())
    nan = spark.range(1).select(F.isnan(whole(F.lit(float("nan")))).alias("n")).first()
    assert nan.n


def test_no_decimal_text_in_results(spark):
    df = spark.range(5).selectExpr("id", "id / 7.0D AS x")
    assert "round(" not in _plan(Q.out(df, ["x"], key=["id"]))


def test_extremes_of_a_label_are_evaluated_once(spark):
    plan = _plan(L.label_columns(_bars(spark)))
    assert plan.count("greatest(") == plan.count("least(") == len(L.HORIZONS)


def test_cci_makes_no_lists(spark):
    """The mean deviation by terms: the plain definition, and no list a row."""
    df = T.indicator_features(_bars(spark).withColumns(T.no_offsets())).select("trade_date", "cci")
    assert "collect_list" not in _plan(df) and "aggregate(" not in _plan(df).lower()
    tp = [r.high_c + r.low_c + r.close_c for r in _bars(spark).orderBy("trade_date").collect()]
    for i, r in enumerate(df.orderBy("trade_date").collect()):
        if i < 13:
            assert r.cci is None
            continue
        last, mean = tp[i - 13:i + 1], sum(tp[i - 13:i + 1]) / 14
        dev = sum(abs(x - mean) for x in last) / 14
        assert abs(r.cci - 0.004 * (tp[i] - mean) / (0.015 * dev)) < 1e-9


def test_methods_too_large_to_compile_are_not_used(spark, sf):
    key = session.METHOD_LIMIT
    spark.conf.unset(key)
    Q.bars(spark, sf)
    assert spark.conf.get(key) == "8000"
    spark.conf.set(key, "9000")
    session.compiled_methods(spark)
    assert spark.conf.get(key) == "9000"
    spark.conf.set(key, "8000")
