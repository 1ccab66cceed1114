"""the wide table is stored once, as blocks cut from the segments that it is derived in."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import sequences as SQ
from panelkit.plans import features as FT
from panelkit.plans import queries as Q
from panelkit.plans import segments as G
from panelkit.session import cut
from panelkit.sources import fixtures as X

FIELDS = ["a", "b"]


@pytest.fixture(scope="module")
def rows():
    rng, got = random.Random(7), {}
    for s, n in (("long", 1500), ("short", 130), ("tiny", 2), ("edge", 400)):
        got[s] = [(s, dt.date(2001, 1, 1) + dt.timedelta(days=i), *[rng.choice([None, 0.0, rng.uniform(-1, 1)]) if rng.random() < .2 else rng.uniform(-1, 1) for _ in FIELDS]) for i in range(n)]
    return got


@pytest.fixture(scope="module")
def panel(spark, rows):
    flat = [r for h in rows.values() for r in h]
    random.Random(1).shuffle(flat)
    return spark.createDataFrame(flat, "symbol string, trade_date date, a double, b double")


def in_segments(df, size):
    """Rows in segments with 49 rows before and one after, as ``bar_features`` gives them."""
    lens = df.groupBy("symbol").agg(F.count("*").alias("_len"))
    return G.segment(G.row_numbers(df), size, back=49, fwd=1).withColumn("_no", F.col("_grn")).join(lens, "symbol")


def digests(blocks, forms):
    return sorted((tuple(r) for r in SQ.window_digests(blocks, FIELDS, forms).collect()), key=lambda r: r[:3])


def test_blocks_cut_from_segments(spark, panel, rows):
    """One segment gives the dense blocks themselves; several give the same windows, each once."""
    names = ["symbol", "first", "n", "halo", "len", "dates", "nulls", *FIELDS]
    dense = SQ.dense_blocks(panel, FIELDS, rows=64)
    whole = SQ.segment_blocks(in_segments(panel, 20_000), FIELDS, rows=64)
    assert sorted(map(tuple, whole.select(*names).collect())) == sorted(map(tuple, dense.select(*names).collect()))
    forms = {10: (10, None), 50: (50, None), 1: (10, 1.0), 7: (10, 10.0)}
    many = digests(SQ.segment_blocks(in_segments(panel, 150), FIELDS, rows=64), forms)
    assert many == digests(dense, forms)
    assert len(many) == sum(max(0, len(h) - seq) for h in rows.values() for seq, _ in forms.values())


def test_blocks_over_small_arrow_batches(spark, panel):
    """A segment that comes in several batches is one segment."""
    key, forms = "spark.sql.execution.arrow.maxRecordsPerBatch", {10: (10, None), 1: (10, 1.0)}
    want, old = digests(SQ.dense_blocks(panel, FIELDS, rows=64), forms), spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        assert digests(SQ.segment_blocks(in_segments(panel, 300), FIELDS, rows=64), forms) == want
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("seq,scale,r", [(10, None, 1), (50, None, 3), (10, 10.0, 3), (10, 1.0, 1)])
def test_digests_against_lists(panel, rows, seq, scale, r):
    """Places added in order, bit for bit."""
    want = {}
    for s, h in rows.items():
        for k in range(0, len(h) - seq, r):
            sums = []
            for c in (2, 3):
                x, total = [row[c] for row in h[k:k + seq]], None
                if scale is None:
                    terms = None if all(v is None for v in x) else [(p + 1) * (v or 0.0) for p, v in enumerate(x)]
                else:
                    terms = None if not x[0] or None in x else [(p + 1) * (scale * v / x[0] - scale) for p, v in enumerate(x)]
                for t in terms or []:
                    total = t if total is None else total + t
                sums.append(total)
            want[s, h[k + seq - 1][1]] = tuple(sums)
    got = {(x["symbol"], x["end_date"]): (x["a"], x["b"]) for x in SQ.window_digest(SQ.dense_blocks(panel, FIELDS, rows=64), FIELDS, seq, scale, r).collect()}
    assert got == want


def test_features_around_segments(spark, sf):
    """Rows around a segment's own have the features of the whole table, the running sums too."""
    bars, index = FT.numbered_bars(X.raw_bars(spark, sf)), cut(X.index_bars(spark, sf), "index-feed")
    names = ["close", "obv", "adline", "r80", "120_max", "trima", "beta"]
    whole = FT.bar_features(bars, index, labels=(), columns=names)
    part = FT.bar_features(bars, index, labels=(), columns=names, around=(49, 1), seg_rows=200)
    assert part.where("NOT _home").count() > 0
    both = part.alias("p").join(whole.alias("w"), ["symbol", "trade_date"])
    # running sums of decimals are exact; the rest ends in one division
    differs = " OR ".join(f"NOT (round(p.`{c}`, 9) <=> round(w.`{c}`, 9))" for c in names)
    assert both.count() == part.count() and both.where(differs).count() == 0
    assert part.where("_home").count() == whole.count()
    with pytest.raises(ValueError):
        FT.bar_features(bars, index, around=(49, 1))


def test_wide_queries_store_once(spark, sf, monkeypatch):
    """No copy of the wide table beside the blocks, and one scan of these for both forms."""
    tables, derived, derive = [], [], FT.bar_features
    monkeypatch.setattr(Q, "store", lambda *a, **k: tables.append(a))
    monkeypatch.setattr(FT, "bar_features", lambda bars, *a, **k: derived.append(bars) or derive(bars, *a, **k))
    Q.clean_up(spark)
    for name in ("sequence_all", "sequence_norm"):
        plan = Q.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert len(derived) == 1 and not tables
