"""The full feature table: 138 features + 11 labels per (symbol, date).

Plan shape (see ``explain``): the gated bars are numbered and written once.
The parabolic stop runs on segments of them, recurrences on blocks;
then one exchange on (symbol, segment) and one sort serve every window stage:
labels, indicators and stock features.  What is joined to the wide rows finds them
there: the decile edges (ranked label values) as one row per segment, and the index
calendar, one row a day, which is sent to all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import CENTS
from panelkit.functions import sql as E
from panelkit.operators import clean as C
from panelkit.operators import index as I
from panelkit.operators import indicators as T
from panelkit.operators import labels as L
from panelkit.operators import recurrences as R
from panelkit.operators import stock as S
from panelkit.plans import segments as G
from panelkit.session import compiled_methods, cut

# The reference's stored column set (fixed values), in its order.
BASE_COLUMNS = ["close", "open", "low", "high", "turn", "isST", "flowmkt", "everyprofit",
                "everypb", "eversale", "evermoney"]
INDEX_COLUMNS = ["szpctchg1", "szpctchg2", "szpctchg4", "szpctchg8", "szpctchg15", "szpctchg30",
                 "zs20_min", "zs60_min", "zs120_min", "zs20_max", "zs60_max", "zs120_max",
                 "zs5_d", "zs10_d", "zs20_d", "zs40_d", "zs80_d",
                 "zsr5", "zsr10", "zsr20", "zsr40", "zsr80",
                 "zsr5_20_d", "zsr10_40_d", "zsr20_80_d", "zsr5_20", "zsr10_40", "zsr20_80", "zsr5_40",
                 "zsv3_9", "zsv5_20", "zsv9_50",
                 "zsv5_d", "zsv10_d", "zsv20_d", "zsv40_d", "zsv80_d",
                 "zsv3_9_d", "zsv5_20_d", "zsv9_50_d",
                 "zsv5", "zsv10", "zsv20", "zsv40", "zsv80",
                 "zsdif", "zsdea", "zshist_d", "zshist"]
STOCK_COLUMNS = ["pctChg", "pctChg2", "pctChg4", "pctChg8", "pctChg15", "pctChg30",
                 "20_min", "60_min", "120_min", "20_max", "60_max", "120_max",
                 "5_d", "10_d", "20_d", "40_d", "80_d", "r5", "r10", "r20", "r40", "r80",
                 "r5_20_d", "r10_40_d", "r20_80_d", "r5_20", "r10_40", "r20_80", "r5_40",
                 "v5", "v10", "v20", "v40", "v80", "v3_9", "v5_20", "v9_50",
                 "v5_d", "v10_d", "v20_d", "v40_d", "v80_d", "v3_9_d", "v5_20_d", "v9_50_d",
                 "dif", "dea", "hist", "hist_d", "highratio", "lowratio", "openratio",
                 "tema", "trima", "wma", "t3", "natr", "adline", "adosc", "obv",
                 "beta", "correl", "linearreg", "lineangle", "var", "TSF", "lineintercept", "stddev",
                 "sar", "adx", "adxr", "apo", "ardown", "arup", "arosc", "bop", "cci", "cci_d"]
FEATURE_COLUMNS = BASE_COLUMNS + INDEX_COLUMNS + STOCK_COLUMNS
LABEL_COLUMNS = list(L.LABEL_COLUMNS)
WARMUP_ROWS = 120


def index_table(index_bars: DataFrame) -> DataFrame:
    """Index-calendar features (I1-I11, raw I12 ratios, I13), one row per day; the numbered bars and the table are written once."""
    bars = cut(G.row_numbers(index_bars, "index_code"), "index-bars")
    return cut(R.index_macd(I.segmented_features(bars, keep=("close_c", "_grn")), passthrough=True).drop("_grn"), "index-days")


def numbered_bars(raw: DataFrame, min_raw: int = 50, min_clean: int = 300) -> DataFrame:
    """The feed's bars through P2-P8 with their numbers per symbol (``_grn``), written once."""
    compiled_methods(raw.sparkSession)
    return cut(G.row_numbers(C.gated_bars(raw, min_raw, min_clean)), "numbered-bars")


def feature_table(raw: DataFrame, index_bars: DataFrame, index_code: str = I.INDEX_CODE,
                  min_raw: int = 50, min_clean: int = 300, warmup: int = WARMUP_ROWS,
                  horizons=L.HORIZONS, labels=None, r: int = 1, edges_until=None,
                  with_features: bool = True, seg_rows: int = G.SEG_ROWS, columns=None) -> DataFrame:
    """Raw feed strings + index bars -> the stored feature table.

    P2-P8 cleaning and gates, recurrences, V1-V6, T plain windows, F1-F18, L1-L6, J1 + I1-I13, P9 warm-up trim,
    P10/P11 column drops.

    ``horizons``: label horizons; ``r``: bars per day; ``labels``: names of the stored labels (any of L1-L6 for
    these horizons; default: buy scores and classes); ``edges_until``: class edges from bars up to that date only;
    ``with_features=False``: prices and labels alone, untrimmed (the reference's no-feature path); ``columns``: the
    features wanted (default: all), for which only the stages that they need are run.  The rows are the same.

    One plan at every size: bars are numbered once and written; window stages run on segments of ``seg_rows`` rows
    with halos, recurrences on blocks, so no task holds a symbol, and results do not depend on where a cut falls.
    """
    return bar_features(numbered_bars(raw, min_raw, min_clean), index_bars, index_code, warmup, horizons, labels, r, edges_until,
                        with_features, seg_rows, columns)


def segment_edges(bars: DataFrame, values: DataFrame, horizons, kinds, seg_rows: int) -> DataFrame:
    """The class edges of ``values`` (in their segments) with a row per symbol and segment.

    A symbol of one segment is ranked where the label window left its values; others have theirs brought together."""
    long = cut(bars.groupBy("symbol").agg(F.count("*").alias("_n")).filter(F.col("_n") > min(seg_rows, L.CROWDED)), "long-symbols")
    lists = {f"_e_{s}": s for s in L.sources(horizons, kinds)}
    if long.isEmpty():
        return L.listed_edges(values, ["symbol", "_seg"], lists, L.N_CLASSES)
    few, many = (values.join(F.broadcast(long.select("symbol")), "symbol", how) for how in ("left_anti", "left_semi"))
    of_long = L.edge_table(cut(many.drop("_seg"), "label-values"), horizons, kinds=kinds, sizes=long)
    homes = G.home_segments(bars, seg_rows).join(F.broadcast(long.select("symbol")), "symbol", "left_semi")
    return L.listed_edges(few, ["symbol", "_seg"], lists, L.N_CLASSES).unionByName(of_long.join(homes, "symbol"))


def bar_features(bars: DataFrame, index_bars: DataFrame, index_code: str = I.INDEX_CODE, warmup: int = WARMUP_ROWS,
                 horizons=L.HORIZONS, labels=None, r: int = 1, edges_until=None, with_features: bool = True,
                 seg_rows: int = G.SEG_ROWS, columns=None, around: tuple[int, int] | None = None) -> DataFrame:
    """``feature_table`` from numbered bars, which may be those of some symbols: a symbol's rows depend on no other's.

    ``around``: the rows in their segments, each with so many rows before and after its own, as ``_seg``, ``_home``,
    ``_no`` (number of the symbol's row after the warm-up) and ``_len`` (how many it has); without labels.
    """
    compiled_methods(bars.sparkSession)
    labels = list(L.label_columns_of(horizons) if labels is None else labels)
    wanted = [n for n in FEATURE_COLUMNS if columns is None or n in columns]
    if columns is not None and len(wanted) < len(set(columns)):
        raise ValueError(f"no features: {sorted(set(columns) - set(wanted))}")
    needs = set(wanted).intersection
    ahead = max(horizons) * r
    ws = G.SEG_WS
    fwd = max(G.HALO_FWD, ahead)
    if around is not None and (labels or not with_features or around[1] > fwd):
        raise ValueError("rows around a segment have features alone, and no more after it than the segment holds")
    classes = [(k, h) for k in ("", "rel") for h in horizons if f"result{k}class{h}" in labels]
    kinds, classed_at = [k for k in ("", "rel") if k in dict(classes)], [h for h in horizons if h in {h for _, h in classes}]
    edges = None
    if classes:
        closes = G.segment(bars.select("symbol", "trade_date", "_grn", "close_c"), seg_rows, back=0, fwd=fwd)
        values = L.label_columns(closes, horizons, r, ws=ws).filter("_home").select("symbol", "_seg", "trade_date", *L.sources(classed_at, kinds))
        # a row for each segment: rows are joined to it where they lie, wide as they are then
        edges = cut(segment_edges(bars, values if edges_until is None else values.filter(F.col("trade_date") <= F.lit(edges_until)), classed_at, kinds, seg_rows), "label-edges")

    def classify(df):
        return L.class_columns(df, edges, classed_at, ["symbol", "_seg"], kinds) if classes else df

    prices = {p: F.col(f"{p}_c") / CENTS for p in ("close", "open", "low", "high")}
    if not with_features:
        plain = L.label_columns(G.segment(bars, seg_rows, back=0, fwd=fwd), horizons, r, ws=ws).filter("_home")
        return classify(plain).select("symbol", "trade_date", *[v.alias(k) for k, v in prices.items()], *[F.col(n) for n in labels])
    which = [g for g, names in R.FINALS.items() if needs(names)]
    finals = {k: v for k, v in R.recurrence_finals().items() if needs([k])}
    rec = R.recurrence_columns(bars, which) if which else bars
    rec = rec.select(*bars.columns, *[v.alias(f"_final_{k}") for k, v in finals.items()])
    back, early = G.HALO_BACK, None
    if around is not None:
        back, early = G.HALO_BACK + around[0], f"_grn <= _seg * {seg_rows}L"
    t = G.segment(S.valuation_features(rec), seg_rows, back=back, fwd=fwd)
    if around is not None:  # as a row per segment, where the rows go anyway
        t = t.join(G.home_segments(bars, seg_rows, more=[(F.count("*") - warmup).alias("_len")]), ["symbol", "_seg"])
    groups = [[{"_day_before": I.day_before(ws)}]] if needs(INDEX_COLUMNS) else []
    if needs(T.columns()):
        if needs(T.RUNNING):
            t = t.join(T.segment_offsets(bars, seg_rows), ["symbol", "_seg"], "left")
        else:
            t = t.withColumns(T.no_offsets())
        groups.append(T.indicator_stages(ws, "_home", early))
    if needs(S.price_volume_exprs()[3]):
        first, extremes, means, ratios = S.price_volume_exprs(ws)
        groups.append([first, *extremes, means, ratios])
    if labels:
        groups.append(L.label_stages(horizons, r, ws))
    t = E.staged(t, groups)
    kept, cols = F.col("_home"), [F.col("symbol"), F.col("trade_date")]
    if around is not None:
        start = F.col("_seg") * seg_rows
        kept = (F.col("_grn") > start - around[0]) & (F.col("_grn") <= start + seg_rows + around[1])
        cols += [F.col("_seg"), F.col("_home"), (F.col("_grn") - warmup).alias("_no"), F.col("_len")]
    t = classify(t.filter(kept & (F.col("_grn") > warmup)))
    if needs(INDEX_COLUMNS):
        t = I.enrich(t, index_table(index_bars), index_code=index_code, before="_day_before")
    for n in wanted:
        cols.append(prices[n].alias(n) if n in prices else F.col(f"_final_{n}").alias(n) if n in finals else F.col(n))
    return t.select(*cols, *[F.col(n) for n in labels])
