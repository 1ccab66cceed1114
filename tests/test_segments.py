"""Segmented execution: results do not depend on where the cuts fall, and no task gathers a symbol."""

import datetime as dt
import re

from pyspark.sql import functions as F

from panelkit.operators import clean as C
from panelkit.operators import indicators as T
from panelkit.operators import labels as L
from panelkit.operators import stock as S
from panelkit.plans import features as FT
from panelkit.plans import segments as G
from panelkit.sources import fixtures as X

KEY = ["symbol", "trade_date"]
UNBOUNDED = {"adline", "obv"}  # running sums from the first row: segments add the totals before them


def _same(a, b, cols):
    """All columns compared in one job: mismatches per column must be 0."""
    j = a.alias("a").join(b.alias("b"), KEY)
    diffs = j.select(F.count(F.lit(1)).alias("_rows"), *[
        F.sum(F.when(F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")), 0).otherwise(1)).alias(c)
        for c in cols]).first().asDict()
    assert diffs.pop("_rows") == a.count() == b.count()
    assert {k: v for k, v in diffs.items() if v} == {}


def test_global_row_numbers(spark, sf):
    from pyspark.sql import Window
    c = C.clean_bars(X.raw_bars(spark, sf))
    g = G.row_numbers(c)
    rn = c.withColumn("rn", F.row_number().over(Window.partitionBy("symbol").orderBy("trade_date")))
    j = g.join(rn, KEY)
    assert j.count() == c.count() and j.filter(F.col("_grn") != F.col("rn")).count() == 0


def test_segments_match_plain_plan(spark, sf):
    c = C.clean_bars(X.raw_bars(spark, sf))

    def stage(d, ws):
        d = T.indicator_features(d, ws=ws)
        d = S.price_volume_features(d, ws=ws)
        return L.label_columns(d, ws=ws)
    plain = stage(c, "PARTITION BY symbol ORDER BY trade_date")
    seg = G.segmented(c, stage, seg_rows=150)
    cols = [x for x in plain.columns if x not in KEY and x not in UNBOUNDED]
    _same(plain.select(*KEY, *[F.col(f"`{x}`") for x in cols]),
          seg.select(*KEY, *[F.col(f"`{x}`") for x in cols]), cols)


def test_feature_table_is_the_same_for_every_segment_length(spark, sf):
    raw, ib = X.raw_bars(spark, sf), X.index_bars(spark, sf)
    one = FT.feature_table(raw, ib)
    many = FT.feature_table(raw, ib, seg_rows=150)
    _same(one, many, FT.FEATURE_COLUMNS + FT.LABEL_COLUMNS)


def test_quantile_edges_are_the_exact_percentiles(spark, sf):
    lab = L.label_columns(C.clean_bars(X.raw_bars(spark, sf)), horizons=(4,))
    pct = F.percentile("result4", F.array(*[F.lit(i / 10) for i in range(1, 10)]))
    a = lab.groupBy("symbol").agg(F.transform(pct, lambda e: F.bround(e, 3)).alias("a"))
    j = a.join(L.quantile_edges(lab, "result4", name="b"), "symbol")
    assert j.count() == 10 and j.filter(F.col("a") != F.col("b")).count() == 0


def hot_feed(spark, n=9_000):
    """One symbol with nine tenths of all bars, two with the rest, from 1962 on."""
    rows = []
    for s, k in (("000001", n), ("600002", n // 18), ("600003", n // 18)):
        for i in range(k):
            p = 100 + (i * 37 % 101) / 10 + i % 7
            rows.append((s, str(dt.date(1962, 1, 1) + dt.timedelta(days=i)), *[f"{x:.2f}" for x in (p, p - 1, p - 2, p + 3)], "1.5", str(1_000 + i % 500), "1000", "5", "2", "3", "4", "0"))
    return spark.createDataFrame(rows, "symbol string, date string, close string, open string, low string, high string, turn string, volume string, amount string, "
                                       "peTTM string, pbMRQ string, psTTM string, pcfNcfTTM string, isST string").repartition(8)


def index_of(spark, code, n=9_000):
    rows = [(code, dt.date(1962, 1, 1) + dt.timedelta(days=i), 300_000 + i, 300_100 + i, 299_900 + i, 300_000 + i * 3 % 1_000, 10 ** 6 + i, 10 ** 9) for i in range(n)]
    return spark.createDataFrame(rows, "index_code string, trade_date date, open_c long, high_c long, low_c long, close_c long, volume long, amount_c long")


def test_hot_symbol_is_never_one_task(spark):
    """Windows are dealt by (symbol, segment); apart from the stop's two price columns nothing is dealt by symbol alone."""
    table = FT.feature_table(hot_feed(spark), index_of(spark, "sh.000001"), seg_rows=1_000)
    plan = table._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]\n", plan)
    assert windows
    for partition, order in windows:  # a window over all of a key reads a table of its blocks' counts only
        assert re.search(r"_seg#|_blk#|_b#", partition) or re.match(r"_seg#|_blk#|_b#", order) or not order or "_which" in partition, (partition, order)
    many = FT.feature_table(hot_feed(spark), index_of(spark, "sh.000001"), seg_rows=4_000)
    cols = ["r80", "120_max", "obv", "adline", "dif", "tema", "adx", "sar", "resultclass4", "resultrelclass10", "zsr80", "zsv9_50_d"]
    _same(table.select(*KEY, *[F.col(f"`{c}`") for c in cols]), many.select(*KEY, *[F.col(f"`{c}`") for c in cols]), cols)


def test_old_bars_keep_their_index_features(spark):
    from panelkit.operators import index as I
    stock = spark.createDataFrame([("A", dt.date(1962, 1, 1) + dt.timedelta(days=i), 100 + i) for i in range(300)], "symbol string, trade_date date, close_c long")
    two = index_of(spark, "sh.000001", 300).unionByName(index_of(spark, "sz.399001", 300))
    got = I.enrich(stock, I.segmented_features(two))
    assert got.count() == 300 and got.filter("szpctchg1 IS NOT NULL").count() == 299
