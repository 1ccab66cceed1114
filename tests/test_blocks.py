"""Dense blocks (D1-D6, P14, M1) against plain windows, and the plans that read them."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import models as MD
from panelkit.operators import sequences as SQ
from panelkit.session import shared_path

FIELDS = ["20_min", "b", "c"]


@pytest.fixture(scope="module")
def panel():
    rng, rows = random.Random(3), {}
    for s, n in (("long", 700), ("short", 130), ("tiny", 7), ("edge", 11), ("late", 300), ("early", 300)):
        rows[s] = [[dt.date(2001, 1, 1) + dt.timedelta(days=i), *[round(rng.uniform(-1, 1), 3) if rng.random() < .9 else 0.0 for _ in FIELDS], rng.randint(0, 9)] for i in range(n)]
    rows["late"][295][2] = None  # in predict and test windows only
    rows["early"][20][3] = None  # in training windows
    rows["long"][650][1] = None
    return rows


@pytest.fixture(scope="module")
def blocks(spark, panel):
    rows = [(s, *r) for s, h in panel.items() for r in h]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "symbol string, trade_date date, `20_min` double, b double, c double, y long")
    path = shared_path(spark, "test-blocks")
    return SQ.store_blocks(SQ.dense_blocks(df, FIELDS, ["y"], back=49, rows=64), path, path.rsplit("/", 1)[1].replace("-", "_"), buckets=4)


def windows(h, seq, r):
    return [(k, h[k:k + seq], h[k + seq]) for k in range(0, len(h) - seq, r)]


def splits(n, predict=10, test=90):
    return ["predict" if n - i <= predict else "test" if n - i <= predict + test else "train" for i in range(n)]


@pytest.mark.parametrize("seq,r", [(10, 1), (50, 1), (10, 3)])
def test_windows_labels_and_splits(blocks, panel, seq, r):
    got = {(x["symbol"], x["end_date"]): x for x in SQ.window_ends(blocks, seq, r, last=["b"], labels=["y"]).collect()}
    count = 0
    for s, h in panel.items():
        ws = windows(h, seq, r)
        for (k, rows, after), split in zip(ws, splits(len(ws))):
            x = got[s, rows[-1][0]]
            null = any(v is None for row in rows for v in row[1:4])
            assert (x["k"], x["split"], x["b"], x["y"], x["has_null"]) == (k, split, rows[-1][2], after[4] * 0.1, null)
            count += 1
    assert len(got) == count


@pytest.mark.parametrize("seq,r", [(10, 1), (50, 1), (10, 3)])
def test_symbols_with_a_null_in_a_training_window(blocks, panel, seq, r):
    want = {}
    for s, h in panel.items():
        ws = windows(h, seq, r)
        if ws:
            want[s] = int(any(v is None for (_, rows, _), split in zip(ws, splits(len(ws))) if split == "train" for row in rows for v in row[1:4]))
    got = {x["symbol"]: x["rejected"] for x in SQ.null_symbols(blocks, seq, r).collect()}
    assert got == want and (r > 1 or want["early"] == 1) and want["late"] == 0
    left = {x["symbol"] for x in SQ.reject_null_symbols(blocks, seq, r).select("symbol").distinct().collect()}
    assert left == {s for s in panel if not want.get(s)}


def test_rows_of_windows_and_norms(blocks, panel):
    plain = {(x["symbol"], x["end_date"], x["pos"]): x for x in SQ.sequence_windows(blocks, FIELDS, 10).collect()}
    normed = {(x["symbol"], x["end_date"], x["pos"]): x for x in SQ.first_row_norm(blocks, FIELDS, 10.0, 10).collect()}
    digests = {(x["symbol"], x["end_date"]): x for x in SQ.window_digest(blocks, FIELDS, 10, scale=10.0).collect()}
    sums = {(x["symbol"], x["end_date"]): x for x in SQ.window_digest(blocks, FIELDS, 10).collect()}
    for s, h in panel.items():
        for _, rows, _ in windows(h, 10, 1):
            end = rows[-1][0]
            for i, c in enumerate(FIELDS, 1):
                first = rows[0][i]
                want = [None if x[i] is None or not first else 10.0 * x[i] / first - 10.0 for x in rows]
                assert [plain[s, end, p][c] for p in range(10)] == [x[i] for x in rows]
                assert [normed[s, end, p][c] for p in range(10)] == want
                total = None if None in want else sum(((p + 1) * v for p, v in enumerate(want[1:], 1)), want[0])
                assert digests[s, end][c] == total or abs(digests[s, end][c] - total) < 1e-9
                have = [(p + 1) * x[i] for p, x in enumerate(rows) if x[i] is not None]
                assert abs(sums[s, end][c] - sum(have)) < 1e-9
            assert [plain[s, end, p]["trade_date"] for p in range(10)] == [x[0] for x in rows]


def test_stored_blocks_hold_the_table_about_once(blocks, panel):
    rows = sum(map(len, panel.values()))
    held = blocks.select(F.sum(F.size("dates"))).first()[0]
    assert rows < held < rows * (64 + 50) / 64 + 7


def test_no_exchange_on_symbol_after_the_scan(spark, blocks):
    plans = {"windows": SQ.window_ends(blocks, 10, labels=["y"]), "rows": SQ.sequence_windows(blocks, FIELDS), "digest": SQ.window_digest(blocks, FIELDS, 10),
             "nulls": SQ.null_symbols(blocks), "gate": SQ.reject_null_symbols(blocks),
             "panel": SQ.window_ends(SQ.reject_null_symbols(blocks)).groupBy("symbol", "split").count()}
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in plans.items():
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_unions_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, "old")], "s string, n int, split string")
    assert {tuple(r) for r in SQ.union_splits(test=a, predict=b).select("n", "s", "split").collect()} == {(1, "x", "test"), (2, "y", "predict")}


def outliers(n=600):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 2))
    y = 3 * x[:, 0] - x[:, 1] + 0.5 + rng.normal(scale=0.05, size=n)
    y[: n // 5] += 40  # a fifth is far off, to one side
    return x, y


def test_absolute_error_is_not_squared_error(spark):
    """With outliers the absolute fit stays at the line, as a plain solver's does; the squared one leaves it."""
    x, y = outliers()
    rows = [([float(v) for v in r], float(t), None if i == 7 else float(t) * 2) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x array<double>, y double, z double").repartition(5)
    model = MD.fit(df, ["y", "z"], rounds=80, tolerance=1e-7)
    keep = np.arange(len(x)) != 7
    z, t = np.hstack([x[keep], np.ones((keep.sum(), 1))]), y[keep]
    w = np.linalg.lstsq(z, t, rcond=None)[0]
    for _ in range(300):  # plain reweighting
        s = 1 / np.maximum(np.abs(t - z @ w), 1e-6)
        w = np.linalg.solve(z.T @ (z * s[:, None]), z.T @ (t * s))
    best = np.abs(t - z @ w).mean()
    assert model["rows"] == len(t) and abs(model["error"][0] - best) < 1e-3 * best and abs(model["error"][1] - 2 * best) < 2e-3 * best
    assert np.allclose(model["weights"][0], w, atol=0.02)
    squared = MD.fit(df, ["y", "z"], loss="squared")
    assert abs(squared["weights"][0][2] - 0.5) > 5 and abs(model["weights"][0][2] - 0.5) < 0.1


def test_sums_are_added_in_a_tree(spark, monkeypatch):
    x, y = outliers(300)
    df = spark.createDataFrame([([float(v) for v in r], float(t)) for r, t in zip(x, y)], "x array<double>, y double").repartition(11)
    want = MD.fit(df.coalesce(1), ["y"], loss="squared")
    monkeypatch.setattr(MD, "FAN_IN", 3)
    assert np.allclose(MD.fit(df, ["y"], loss="squared")["weights"], want["weights"])


def test_fit_and_score_on_blocks_are_those_on_vectors(blocks):
    data = MD.vectors(blocks, FIELDS, ["y"], 10)
    one = MD.fit(data.filter("split = 'train'"), ["y"], loss="squared")
    two = MD.fit(blocks, ["y"], MD.from_blocks(FIELDS, ["y"], 10), loss="squared")
    assert one["rows"] == two["rows"] and np.allclose(one["weights"], two["weights"], atol=1e-8)
    a = {(r["symbol"], r["end_date"]): r["p_y"] for r in MD.score(one, data).collect()}
    b = {(r["symbol"], r["end_date"]): r["p_y"] for r in MD.score_blocks(one, blocks, FIELDS, 10).collect()}
    assert a.keys() == b.keys() and all((a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) < 1e-8) for k in a)
    assert any(v is None for v in a.values())
