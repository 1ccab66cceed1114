"""Spark-side properties of the feature plans."""

from pyspark.sql import functions as F

from panelkit.functions import win
from panelkit.operators import clean as C
from panelkit.operators import indicators as T
from panelkit.operators import labels as L
from panelkit.operators import stock as S
from panelkit.plans import features as FT
from panelkit.plans.queries import q_feature_table
from panelkit.sources import fixtures as X

KEY = ["symbol", "trade_date"]


def test_fixture_counts(spark, sf):
    assert X.bars(spark, sf).count() == 5334
    assert X.symbols(spark, sf).count() == 10


def test_no_lookahead(spark, sf):
    """Features at t ignore rows after t; labels must not."""
    c = C.clean_bars(X.raw_bars(spark, sf))
    w = win()
    last = c.groupBy("symbol").agg(F.max("trade_date").alias("_last"))
    cut = c.join(last, "symbol").filter(F.datediff("_last", "trade_date") > 60).drop("_last")
    cols = ["r5", "80_d", "v9_50_d", "120_max"]
    icol = ["wma", "correl", "cci_d", "beta"]

    def feats(df):
        return T.indicator_features(S.price_volume_features(df, w), w).select(*KEY, *cols, *icol)
    full, part = feats(c), feats(cut)
    j = full.alias("f").join(part.alias("p"), KEY)
    bad = j.select(*[F.sum(F.when(F.col(f"f.`{c}`").eqNullSafe(F.col(f"p.`{c}`")), 0).otherwise(1)).alias(c)
                     for c in cols + icol]).first().asDict()
    assert {k: v for k, v in bad.items() if v} == {}
    lab_full = L.label_columns(c, w=w).select(*KEY, "result10")
    lab_cut = L.label_columns(cut, w=w).select(*KEY, "result10")
    diff = lab_full.join(lab_cut, KEY).filter(~lab_full["result10"].eqNullSafe(lab_cut["result10"])).count()
    assert diff > 0


def test_feature_table_shape_and_ranges(spark, sf):
    ft = q_feature_table(spark, sf)
    assert len(ft.columns) == 2 + 138 + 11
    rows = ft.count()
    assert rows > 0
    clipped = ["pctChg", "r5", "20_max", "dif", "natr", "correl", "adx", "zsr5", "hist_d"]
    agg = ft.select(*[F.max(F.abs(F.col(f"`{c}`"))).alias(c) for c in clipped]).first()
    assert all(v is None or v <= 1.0 for v in agg)
    cls = ft.select(F.min("resultclass4"), F.max("resultclass4")).first()
    assert 0 <= cls[0] and cls[1] <= 9


def test_lineitem_is_read_once_a_side(spark, sf):
    """The bars and the index are derived once, written numbered, and read from there by every branch of the plan."""
    ft = FT.feature_table(X.raw_bars(spark, sf), X.index_bars(spark, sf))
    plan = ft._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "Relation [" in plan


def test_index_rows_never_multiply(spark, sf):
    from panelkit.operators import index as I
    c = C.clean_bars(X.raw_bars(spark, sf))
    ib = X.index_bars(spark, sf)
    two = ib.unionByName(ib.withColumn("index_code", F.lit("sz.399001")))
    assert I.enrich(c, I.segmented_features(two)).count() == c.count()
