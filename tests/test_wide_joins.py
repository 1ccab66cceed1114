"""wide rows stay where the windows left them; what is joined to them comes to them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import labels as L
from panelkit.plans import features as FT
from panelkit.plans import segments as G

KEY = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_small_tables(spark):
    usual = spark.conf.get(KEY)
    spark.conf.set(KEY, "-1")
    yield
    spark.conf.set(KEY, usual)


@pytest.fixture(scope="module")
def feed(spark):
    rng, rows, index = random.Random(3), [], []
    for s in ("600001", "000002"):
        for i in range(340):
            p = [rng.uniform(90, 110) for _ in range(3)]
            rows.append((s, str(dt.date(1995, 1, 1) + dt.timedelta(days=i)), *[f"{v:.2f}" for v in (p[0], p[1], min(p), max(p))], "1.5", str(rng.randint(1, 9) * 100000),
                         "1000.0", "12.0", "1.5", "2.5", "3.0", "0"))
    for i in range(340):
        p = [rng.randint(200000, 300000) for _ in range(2)]
        index.append(("sh.000001", dt.date(1995, 1, 1) + dt.timedelta(days=i), p[0], max(p), min(p), p[1], 1000 * rng.randint(1, 99), 5))
    raw = spark.createDataFrame(rows, "symbol string, date string, close string, open string, low string, high string, turn string, volume string, amount string, "
                                "peTTM string, pbMRQ string, psTTM string, pcfNcfTTM string, isST string")
    return raw, spark.createDataFrame(index, "index_code string, trade_date date, open_c long, high_c long, low_c long, close_c long, volume long, amount_c long")


def test_no_exchange_of_wide_rows(feed, no_small_tables):
    """However large the tables joined to them are: above the last window nothing is dealt anew."""
    plan = FT.feature_table(*feed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.index("Window [")]


def test_groups_share_window_operators(feed):
    """As many window operators after the segments' exchange as the longest group has stages."""
    plan = FT.feature_table(*feed)._jdf.queryExecution().executedPlan().toString()
    wide = plan[:plan.index("Exchange hashpartitioning(symbol")]
    assert 0 < wide.count("Window [") <= 7


def test_edges_by_lists(spark, monkeypatch):
    """Lists and selection give the same edges; a key without values has none, and so no class."""
    rng = random.Random(4)
    rows = [(s, None if rng.random() < .2 or s == "none" else rng.choice([-0.0, 0.0, rng.uniform(-1, 1)]), None if s == "half" else rng.uniform(-1, 1)) for s, n in (("long", 900), ("half", 40), ("none", 5), ("one", 1)) for _ in range(n)]
    df = spark.createDataFrame(rows, "symbol string, result4 double, resultrel4 double").repartition(3)
    lists = {r["symbol"]: r.asDict() for r in L.edge_table(df, (4,)).collect()}
    assert lists["none"]["_e_result4"] is None and lists["half"]["_e_resultrel4"] is None
    monkeypatch.setattr(L, "CROWDED", 30)
    assert {r["symbol"]: r.asDict() for r in L.edge_table(df, (4,)).collect()} == lists
    late = df.where("symbol = 'none'").select("symbol", F.lit(0.5).alias("result4"), "resultrel4")
    assert [r[0] for r in L.class_columns(late, L.edge_table(df, (4,)), (4,)).select("resultclass4").distinct().collect()] == [None]


def test_home_segments(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 21)] + [("b", i) for i in range(1, 12)], "symbol string, _grn long")
    assert sorted(map(tuple, G.home_segments(df, 10).collect())) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_edges_of_symbols_with_one_and_several_segments(spark):
    """Ranked where the label window left them, or brought together: the same edges, one row a segment."""
    rng, rows = random.Random(6), []
    for s, n in (("long", 45), ("short", 20), ("none", 3)):
        rows += [(s, i + 1, i // 20, dt.date(2001, 1, 1) + dt.timedelta(days=i), None if s == "none" else rng.uniform(-1, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, _grn long, _seg long, trade_date date, result4 double").repartition(3)
    got = {(r["symbol"], r["_seg"]): r["_e_result4"] for r in FT.segment_edges(df.select("symbol", "_grn"), df.drop("_grn"), [4], [""], 20).collect()}
    whole = {r["symbol"]: r["_e_result4"] for r in L.edge_table(df, [4], kinds=[""]).collect()}
    assert got == {("long", 0): whole["long"], ("long", 1): whole["long"], ("long", 2): whole["long"], ("short", 0): whole["short"], ("none", 0): None}
    pct = F.percentile("result4", F.array(*[F.lit(i / 10) for i in range(1, 10)]))
    assert whole["long"] == df.where("symbol = 'long'").agg(F.transform(pct, lambda e: F.bround(e, 3))).first()[0]


def test_gates_that_leave_nothing_out_join_nothing(feed):
    from panelkit.operators import clean as C
    plan = C.gated_bars(feed[0])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert C.gated_bars(feed[0], min_clean=340).count() == 0 and C.gated_bars(feed[0].where("symbol = '000002' OR date < '1995-02-01'"), 50, 300).count() == 340


def test_lengths_come_to_the_segments(feed, no_small_tables):
    """rows around segments learn how many their symbol has without being dealt by symbol."""
    import re
    bars = FT.numbered_bars(feed[0])
    plan = FT.bar_features(bars, feed[1], labels=(), around=(49, 1))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Join \[symbol#\d+\], \[symbol#\d+\]", plan)
    assert "Exchange" not in plan[:plan.index("Window [")]
