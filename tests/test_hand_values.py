"""Values worked out by hand from the published definitions, independent of the code and of the SQL."""

import datetime as dt
import math

import pytest

from panelkit.operators import index as I
from panelkit.operators import indicators as T
from panelkit.operators import labels as L
from panelkit.operators import stock as S

DAY = dt.date(2000, 1, 1)


def bars(spark, closes, spread=(0, 100, 100)):
    """Bars whose open, high and low lie at fixed distances (cents) below, above and below the close."""
    o, h, lo = spread
    rows = [("A", DAY + dt.timedelta(days=i), c - o, c + h, c - lo, c, 1_000_000, 2.0e6, 10.0, 10.0, 2.0, 4.0, 20.0, 0.0) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, open_c long, high_c long, low_c long, close_c long, volume long, amount double, "
                                       "turn double, peTTM double, pbMRQ double, psTTM double, pcfNcfTTM double, isST double")


def last(df):
    return df.orderBy("trade_date").collect()[-1]


def test_valuation(spark):
    r = last(S.valuation_features(bars(spark, [10_000])))
    quarter = 0.637 * math.pi / 4  # 0.637 atan(1)
    assert r["everyprofit"] == pytest.approx(quarter)  # 10 / 10
    assert r["turn"] == pytest.approx(quarter)  # (10 / 10) ** 0.2
    assert r["everypb"] == pytest.approx(quarter)  # 2 / 2
    assert r["eversale"] == pytest.approx(quarter)  # 2 / sqrt(4)
    assert r["evermoney"] == pytest.approx(quarter)  # 20 / 20
    # ln(1e-8 * 100 * 1e6 / 10) = ln(0.1)
    assert r["flowmkt"] == pytest.approx(0.637 * math.atan(math.log(0.1)))


def test_price_volume(spark):
    r = last(S.price_volume_features(bars(spark, [10_000] * 4 + [10_100])))
    assert r["pctChg"] == pytest.approx(8 * 0.01)
    assert r["avg_price"] == pytest.approx(2.0 / 1.01)  # 2 million / (0.01 + 1 million)
    assert r["sma5"] == pytest.approx(100.2)
    assert r["highratio"] == pytest.approx(10 * 102 / 100 - 10.2)
    assert r["lowratio"] == pytest.approx(10 * 100 / 100 - 9.8)
    assert r["openratio"] == pytest.approx(20 * 101 / 100 - 20)


def test_indicators_of_a_straight_line(spark):
    n, r = 40, None
    r = last(T.indicator_features(bars(spark, [10_000 + 100 * i for i in range(n)], (50, 100, 100))))
    close = 100.0 + (n - 1)
    assert r["linearreg"] == pytest.approx(0.6366 * math.atan(0.1 * close - 1))  # the line itself
    assert r["lineangle"] == pytest.approx(0.6366 * math.atan(0.1 * 45))  # slope 1
    assert r["TSF"] == pytest.approx(0.6366 * math.atan(2 * (close + 1)))
    assert r["lineintercept"] == pytest.approx(0.6366 * math.atan(0.05 * (close - 13)))
    assert r["correl"] == pytest.approx(0.0)  # correlation 1: 3 - 3
    assert r["var"] == pytest.approx(0.6366 * math.atan(30 * 2))  # of five consecutive integers
    assert r["stddev"] == pytest.approx(math.sqrt(2) ** 0.25 - 1)
    assert (r["arup"], r["ardown"], r["arosc"]) == (1.0, -1.0, 1.0)  # the high is today's, the low 14 days old
    assert r["bop"] == pytest.approx(0.5 / 2)
    assert r["wma"] == pytest.approx(0.6366 * math.atan(0.1 * math.sqrt(close - 29 / 3)))  # weighted age (n - 1) / 3
    assert r["trima"] == pytest.approx(0.6366 * math.atan(0.1 * math.sqrt(close - 14.5)))
    assert r["apo"] == pytest.approx(1.0)  # 0.5 * (age 12.5 - age 5.5) is 3.5, clipped
    assert r["obv"] == pytest.approx(0.6366 * math.atan(0.001 * n))
    assert r["roc"] == pytest.approx(close / (close - 12) - 1)
    assert r["upratio"] == 1.0


def test_beta_of_equal_returns_is_one(spark):
    df = bars(spark, [10_000, 10_100, 9_900, 10_300, 10_050, 10_200, 10_150], (0, 0, 0))
    assert last(T.indicator_features(df))["beta"] == pytest.approx(0.6366 * math.atan(1))


def test_labels(spark):
    r = L.label_columns(bars(spark, [10_000, 9_000, 12_000, 11_000, 10_500])).orderBy("trade_date").first()
    assert (r["result2"], r["resultmax2"], r["resultmin2"]) == pytest.approx((0.2, 0.2, -0.1))
    assert r["resultrel2"] == pytest.approx(0.1)
    # next four days between 90 and 120: 100 is within the lower 2/5 but not the lower third's... 90 + 30 / 3 = 100 is not above 100
    assert r["resultbuy4"] == 4


def test_index(spark):
    rows = [("sh.000001", DAY + dt.timedelta(days=i), 300_000 + 3_000 * i, 300_000 + 3_000 * i, 300_000 + 3_000 * i, 10 ** 6) for i in range(6)]
    ib = spark.createDataFrame(rows, "index_code string, trade_date date, close_c long, high_c long, low_c long, volume long")
    r = last(I.index_features(ib))
    assert r["szpctchg1"] == pytest.approx(18 * 3150 / 3120 - 18)
    assert r["zsr5"] == pytest.approx(10 * 3150 / 3090 - 10)
    assert r["zsv5"] == pytest.approx(0.6366 * math.atan(0.2 * 10 * 1e6 / (0.1 + 1e6)))
