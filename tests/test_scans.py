"""The native block scans against the plain kernels, on histories of several blocks."""

import datetime as dt
import random

import pytest

import plain_kernels as K
from panelkit.operators import recurrences as R

LENGTHS = {"A": 2_950, "B": 1_000, "C": 95, "D": 35, "E": 17, "F": 7, "G": 1}


def history(symbol, n):
    rng = random.Random(symbol)
    rows, close = [], 5_000
    for i in range(n):
        if i % 400 < 350:  # else flat days, on which ADX has no reading at first
            close = max(100, close + rng.randint(-120, 121))
        high, low = close + (rng.randint(0, 80) if i % 400 < 340 else 0), close - (rng.randint(0, 80) if i % 400 < 340 else 0)
        rows.append((symbol, dt.date(1990, 1, 1) + dt.timedelta(days=i), high, low, close, rng.randint(0, 10 ** 7)))
    return rows


@pytest.fixture(scope="module")
def panel():
    return {s: history(s, n) for s, n in LENGTHS.items()}


@pytest.fixture(scope="module")
def bars(spark, panel):
    rows = [r for h in panel.values() for r in h]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, trade_date date, high_c long, low_c long, close_c long, volume long")


def close_to(got, want):
    assert len(got) == len(want)
    for i, (g, w) in enumerate(zip(got, want)):
        assert (g is None) == (w is None) and (g is None or abs(g - w) <= 1e-9 * max(1.0, abs(w))), (i, g, w)


def test_linear_columns(bars, panel):
    got = {}
    for r in R.linear_columns(bars).orderBy("symbol", "trade_date").collect():
        got.setdefault(r["symbol"], []).append(r)
    for s, rows in panel.items():
        _, _, h, lo, c, v = zip(*rows)
        dif, dea, hist = K.macd(list(c))
        adx, adxr = K.adx(list(h), list(lo), list(c))
        want = {"_dif": dif, "_dea": dea, "_hist": hist, "_tema": K.tema(list(c)), "_t3": K.t3(list(c)), "_natr": K.natr(list(h), list(lo), list(c)),
                "_adosc": K.adosc(list(h), list(lo), list(c), list(v)), "_adx": adx, "_adxr": adxr}
        for name, values in want.items():
            close_to([r[name] for r in got[s]], values)


def test_lowpass(bars, panel):
    got = {}
    for r in R.lowpass_filter(bars).orderBy("symbol", "trade_date").collect():
        got.setdefault(r["symbol"], []).append(r)
    for s, rows in panel.items():
        x = [r[4] / 100.0 for r in rows]
        close_to([r["lowpass"] for r in got[s]], K.lowpass(x))
        cut = K.lowpass(x[:-10]) + [None] * min(10, len(x)) if len(x) > 10 else [None] * len(x)
        close_to([r["lowpass_cut"] for r in got[s]], cut)


@pytest.mark.parametrize("rows", [2, 7, 20_000])
def test_stop(spark, bars, panel, rows):
    """Random walks with ties and outside bars, in one segment and in many."""
    got = {}
    for r in R.stop_column(bars, rows=rows).orderBy("symbol", "trade_date").collect():
        got.setdefault(r["symbol"], []).append(r["_sar"])
    for s, h in panel.items():
        assert got[s] == [None if x is None else x / 100.0 for x in K.sar([r[2] for r in h], [r[3] for r in h])]
    rng, rows_, want = random.Random(6), [], {}
    for i in range(150):
        n = rng.randint(1, 40)
        mid = [rng.randint(0, 6) for _ in range(n)]
        h = [(f"s{i}", dt.date(2000, 1, 1) + dt.timedelta(days=k), m + rng.randint(0, 3), m - rng.randint(0, 3)) for k, m in enumerate(mid)]
        rows_ += h
        want[f"s{i}"] = [None if x is None else x / 100.0 for x in K.sar([r[2] for r in h], [r[3] for r in h])]
    got = {}
    df = spark.createDataFrame(rows_, "symbol string, trade_date date, high_c long, low_c long").repartition(5)
    for r in R.stop_column(df, rows=rows).orderBy("symbol", "trade_date").collect():
        got.setdefault(r["symbol"], []).append(r["_sar"])
    assert got == want


def test_nothing_runs_python(bars):
    for df, deal in ((R.recurrence_features(bars), "_seg"), (R.stop_column(bars), "_part")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Pandas" not in plan and "Python" not in plan
        assert "hashpartitioning(symbol" in plan and deal in plan
