"""Market-index features (I1-I12) and the stock <- index enrichment.

Index features are computed on the index's own calendar (window per
``index_code``), then those of one index code are left-joined to stock rows on
the trade date.  I12's day-over-day changes are taken *after* the join, on the
stock's own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from panelkit.functions import CENTS, sq, win
from panelkit.functions import sql as E
from panelkit.plans import segments as G

# The index feature constants.
RET = {"szpctchg2": (19, 2, 2), "szpctchg4": (10, 2, 4), "szpctchg8": (10, 4, 8),
       "szpctchg15": (8, 5, 15), "szpctchg30": (6, 10, 30)}
SLOPE_K = {5: 20, 10: 40, 20: 60, 40: 80, 80: 100}
DEV_K = {5: 10, 10: 8, 20: 6, 40: 6, 80: 4}
CROSS = {"zsr5_20": (5, 20), "zsr10_40": (10, 40), "zsr20_80": (20, 80), "zsr5_40": (5, 40)}
CROSS_D = {"zsr5_20": 10, "zsr10_40": 20, "zsr20_80": 20}
VOL_D_K = {5: 0.2, 10: 0.1, 20: 0.2, 40: 0.2, 80: 0.2}
VOL_CROSS = {"zsv3_9": (3, 9), "zsv5_20": (5, 20), "zsv9_50": (9, 50)}
EXTREMA_NS = (20, 60, 120)
WI = "PARTITION BY index_code ORDER BY trade_date"
INDEX_CODE = "sh.000001"  # the index that stocks are joined to unless another is asked for

INDEX_LEVEL_COLS = (["szpctchg1", *RET]
                    + [f"zs{n}_min" for n in EXTREMA_NS] + [f"zs{n}_max" for n in EXTREMA_NS]
                    + [f"zs{n}_d" for n in SLOPE_K] + [f"zsr{n}" for n in DEV_K]
                    + [f"{k}_d" for k in CROSS_D] + list(CROSS)
                    + [f"zsv{n}_d" for n in VOL_D_K] + [f"zsv{n}" for n in VOL_D_K])
JOINED_COLS = [*VOL_CROSS, *[f"{k}_d" for k in VOL_CROSS]]


def index_features(ib: DataFrame, w: WindowSpec | None = None, ws: str = WI,
                   keep=()) -> DataFrame:
    """I1-I11 plus the raw I12 ratios (``_raw_zsv3_9`` ...), one row per index day."""
    st1 = {"rn": E.over("row_number()", ws), "_cs": E.running_sum("close_c", ws),
           "_cv": E.running_sum("volume", ws),
           **{f"_lag{n}": f"({E.lag('close_c', n, ws)} / 100.0D)" for n in (1, 2, 4, 8, 15, 30)}}
    ext = {}
    for n in EXTREMA_NS:
        ext[f"_max{n}"] = f"((CASE WHEN rn >= {n + 1} THEN {E.over('max(high_c)', ws, E.rows(-n, -1))} END) / 100.0D)"
        ext[f"_min{n}"] = f"((CASE WHEN rn >= {n + 1} THEN {E.over('min(low_c)', ws, E.rows(-n, -1))} END) / 100.0D)"
    st2 = {**{f"_sma{n}": f"({E.prefix_sum('_cs', n, ws)} / {E.d(CENTS * n)})" for n in (2, 4, 5, 10, 20, 40, 80)},
           **{f"_vm{n}": f"({E.prefix_sum('_cv', n, ws)} / {E.d(n)})" for n in (3, 5, 9, 10, 20, 40, 50, 80)}}
    close = E.price("close_c")
    vol = "CAST(volume AS DOUBLE)"
    f = {"szpctchg1": f"{E.sdiv('18.0D * ' + close, '_lag1')} - 18.0D"}
    for name, (k, m, n) in RET.items():
        f[name] = f"{E.sdiv(f'{E.d(k)} * _sma{m}', f'_lag{n}')} - {E.d(k)}"
    for n in EXTREMA_NS:
        f[f"zs{n}_min"] = E.clip(f"{E.sdiv('2.0D * ' + close, f'_min{n}')} - 2.0D")
    for n in EXTREMA_NS:
        f[f"zs{n}_max"] = E.clip(f"{E.sdiv('4.0D * ' + close, f'_max{n}')} - 4.0D")
    for n, k in SLOPE_K.items():
        prev = E.lag(f"_sma{n}", 1, ws)
        f[f"zs{n}_d"] = E.clip(E.sdiv(f"{E.d(k)} * (_sma{n} - {prev})", prev))
    for n, k in DEV_K.items():
        f[f"zsr{n}"] = E.clip(f"{E.sdiv(f'{E.d(k)} * {close}', f'_sma{n}')} - {E.d(k)}")
    raws = {name: f"({E.sdiv(f'4.0D * _sma{a}', f'_sma{b}')} - 4.0D)" for name, (a, b) in CROSS.items()}
    for name, k in CROSS_D.items():
        f[f"{name}_d"] = E.clip(f"{E.d(k)} * ({raws[name]} - {E.lag(raws[name], 1, ws)})")
    for name, raw in raws.items():
        f[name] = E.clip(raw)
    for n, k in VOL_D_K.items():
        raw = f"((10.0D * {vol}) / (0.1D + _vm{n}))"
        f[f"zsv{n}_d"] = E.sq(f"{E.d(k)} * ({raw} - {E.lag(raw, 1, ws)})")
    for n in VOL_D_K:
        f[f"zsv{n}"] = E.sq(f"0.2D * ((10.0D * {vol}) / (0.1D + _vm{n}))")
    for name, (a, b) in VOL_CROSS.items():
        f[f"_raw_{name}"] = f"((10.0D * _vm{a}) / (0.1D + _vm{b}))"
    t = ib.selectExpr("*", *E.alias(st1)).selectExpr("*", *E.alias(ext)).selectExpr("*", *E.alias(st2))
    return t.selectExpr("index_code", "trade_date", *keep, *E.alias(f))


def segmented_features(ib: DataFrame, keep=()) -> DataFrame:
    """``index_features`` on halo segments of the index calendar, so that no task holds a whole history."""
    seg = G.segment(ib if "_grn" in ib.columns else G.row_numbers(ib, "index_code"), G.SEG_ROWS)
    return index_features(seg, ws=G.spec("index_code"), keep=(*keep, "_home")).filter("_home").drop("_home")


def day_before(ws: str) -> str:
    """The date of a stock's row before, which ``enrich`` looks up: taken where other windows run."""
    return E.lag("trade_date", 1, ws)


def enrich(stock: DataFrame, idx: DataFrame, index_code: str = INDEX_CODE, w: WindowSpec | None = None, before: str | None = None) -> DataFrame:
    """J1 + I12: left equi-join of one index's features onto stock rows by date.

    Missing index days give NULL features (pandas NaN).  No date range is applied here.  I12's changes take the ratio
    of the stock's row before, by its date (``before``: the column with ``day_before``, if there is one), so no window
    runs over the joined rows.  One index has a row a trading day, whatever the number of stocks: that calendar is sent
    to the stock rows, which stay where they are.  ``idx`` is read twice.
    """
    kept = [c for c in stock.columns if c != before]
    if before is None:
        before = "_day_before"
        stock = stock.withColumn(before, F.lag("trade_date", 1).over(w or win()))
    days = idx.filter(F.col("index_code") == index_code).drop("index_code")
    earlier = days.select(F.col("trade_date").alias(before), *[F.col(f"_raw_{n}").alias(f"_before_{n}") for n in VOL_CROSS])
    j = stock.join(F.broadcast(days), "trade_date", "left").join(F.broadcast(earlier), before, "left")
    extra = []
    for name in VOL_CROSS:
        raw = F.col(f"_raw_{name}")
        extra += [sq(F.lit(2.0) * (raw - F.col(f"_before_{name}"))).alias(f"{name}_d"), sq(F.lit(0.2) * raw).alias(name)]
    levels = [c for c in days.columns if c != "trade_date" and not c.startswith("_raw_")]
    return j.select(*map(E.q, kept), *map(E.q, levels), *extra)
