"""Properties from the test strategy: split sizes, join row counts, edge
cases of the bin assignment and the suspension gate."""

from pyspark.sql import functions as F

from panelkit.operators import clean as C
from panelkit.operators import index as I
from panelkit.operators import labels as L
from panelkit.plans.queries import q_chrono_split
from panelkit.sources import fixtures as X


def test_split_sizes(spark, sf):
    s = q_chrono_split(spark, sf)
    counts = {(r["symbol"], r["split"]): r["count"] for r in s.groupBy("symbol", "split").count().collect()}
    symbols = {k[0] for k in counts}
    for sym in symbols:
        assert counts[(sym, "predict")] == 10
        assert counts[(sym, "test")] == 90
        assert counts.get((sym, "train"), 0) > 0


def test_index_join_preserves_rows(spark, sf):
    c = C.clean_bars(X.raw_bars(spark, sf))
    e = I.enrich(c, I.segmented_features(X.index_bars(spark, sf)))
    assert e.count() == c.count()
    # missing index days give NULL features, never dropped rows
    assert e.filter(F.col("szpctchg1").isNull()).count() > 0


def test_duplicate_edges_leave_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.1,), (None,)], "x double")
    edges = F.array(*[F.lit(v) for v in (0.0, 0.0, 0.05, 0.05, 0.05, 0.1, 0.1, 0.1, 0.2)])
    got = [r[0] for r in df.select(L.bin_code("x", edges)).collect()]
    assert got == [2, 5, 8, None]


def test_suspended_and_blank_volume_dropped(spark, sf):
    raw = X.raw_bars(spark, sf)
    assert raw.filter((F.col("volume") == "0") | (F.col("volume") == "")).count() > 0
    c = C.clean_bars(raw)
    assert c.filter(F.col("volume") <= 0).count() == 0
    assert c.filter(F.col("psTTM") <= 0).count() == 0


def test_missing_fields_lose_no_bar(spark, sf):
    raw = X.raw_bars(spark, sf)
    none = raw.withColumn("peTTM", F.lit(None).cast("string")).withColumn("turn", F.lit("")).withColumn("pbMRQ", F.lit("n/a"))
    assert C.clean_bars(none).count() == C.clean_bars(raw).count()
    assert C.clean_bars(raw.withColumn("volume", F.lit(None).cast("string"))).count() == raw.filter("CAST(psTTM AS DOUBLE) > 0").count()
    row = C.unreadable_fields(none).filter("field = 'pbMRQ'").first()
    assert (row["n_null"], row["n_blank"], row["n_unreadable"]) == (0, 0, raw.count())


def test_beta_of_a_zero_price_is_defined(spark, sf):
    from panelkit.operators import indicators as T
    c = C.clean_bars(X.raw_bars(spark, sf))
    zero = c.withColumn("low_c", F.when(F.dayofmonth("trade_date") == 3, F.lit(0)).otherwise(F.col("low_c")).cast("bigint"))
    assert T.indicator_features(zero).filter("beta IS NOT NULL").count() > 0


def _walk(spark, symbols=3, n=700):
    import datetime as dt
    import random
    rng, rows = random.Random(31), []
    for s in range(symbols):
        rows += [(f"s{s}", dt.date(2000, 1, 1) + dt.timedelta(days=i), rng.randint(0, 40) if i != 300 else None) for i in range(n - 100 * s)]
    return rows, spark.createDataFrame(rows, "symbol string, trade_date date, x int").repartition(4)


def test_extremes_of_any_window_length(spark):
    """W5, W14 and W15 by doubling, on segments, against plain lists; no arrays in the plan."""
    from panelkit.operators import windows as W
    from panelkit.plans import segments as G
    from panelkit.plans.queries import sw
    rows, df = _walk(spark)
    by = {}
    for s, d, x in rows:
        by.setdefault(s, []).append(x)
    t = G.segment(G.row_numbers(df), 300, back=251, fwd=0).withColumn("rn", F.col("_grn"))
    for n in (1, 10, 64, 250):
        a = W.prior_extrema(t, {"hi": ("x", n, "max"), "lo": ("x", n, "min")}, sw())
        a = W.low_day(W.high_day(a, "x", n, sw(), "hd"), "x", n, sw(), "ld")
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan and "array" not in plan.replace("array_", "")
        for r in a.filter("_home").collect():
            x, i = by[r["symbol"]], r["rn"] - 1
            before, now = x[max(0, i - n):i], x[max(0, i - n + 1):i + 1]
            full = len(before) == n and None not in before
            assert (r["hi"], r["lo"]) == ((max(before), min(before)) if full else (None, None))
            full = len(now) == n and None not in now
            assert (r["hd"], r["ld"]) == ((n - now.index(max(now)), n - now.index(min(now))) if full else (None, None))


def test_rank_in_windows_of_any_length(spark):
    """W12 on segments against plain lists."""
    from panelkit.operators import windows as W
    from panelkit.plans import segments as G
    rows, df = _walk(spark, symbols=2)
    by = {}
    for s, d, x in rows:
        by.setdefault(s, []).append((d, x))
    t = G.segment(G.row_numbers(df), 300, back=250, fwd=0)
    for n in (1, 10, 250):
        got = {(r["symbol"], r["trade_date"]): r["rank"] for r in W.ts_rank(t, "x", n, "rank").collect()}
        assert len(got) == len(rows)
        for s, h in by.items():
            for i, (d, x) in enumerate(h):
                now = [v for _, v in h[max(0, i - n + 1):i + 1]]
                if len(now) < n or None in now:
                    assert got[s, d] is None
                    continue
                rank = lambda v: sum(u < v for u in now) + (now.count(v) + 1) / 2
                assert abs(got[s, d] - rank(x) / rank(max(now))) < 1e-12


def test_edges_by_selection_with_ties_and_crowded_buckets(spark, monkeypatch):
    """Exact percentiles where one value is a third of all, values crowd in one bucket, and buckets are divided."""
    import random
    rng, rows = random.Random(5), []
    for i in range(3_000):
        rows += [("crowd", 0.5 + rng.random() / 1e5), ("ties", rng.choice([0.0, 0.0, rng.uniform(-3, 3), None])), ("wide", rng.gauss(0, 1e3))]
    rows += [("one", 0.25), ("none", None), ("two", -1.0), ("two", 1.0)]
    df = spark.createDataFrame(rows, "symbol string, v double").repartition(4).persist()
    pct = F.percentile("v", F.array(*[F.lit(i / 10) for i in range(1, 10)]))
    want = {r["symbol"]: r["a"] for r in df.filter("v IS NOT NULL").groupBy("symbol").agg(F.transform(pct, lambda e: F.bround(e, 3)).alias("a")).collect()}
    for crowded in (100_000, 20):
        monkeypatch.setattr(L, "CROWDED", crowded)
        got = {r["symbol"]: r["edges"] for r in L.quantile_edges(df, "v").collect()}
        assert got == want
    df.unpersist()
