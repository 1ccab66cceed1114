"""Stock-level valuation and price/volume features.

Plan shape: staged ``selectExpr``s over one window spec.  Stage 1 takes the
row number, running sums of integer cents/shares, close lags and the bounded
min/max frames; stage 2 turns running sums into rolling means with one offset
lookup each; stage 3 builds every ratio and its day-over-day change (a lag of
an expression of stage-2 columns).  All three stages share the exchange and
sort of the first, and none re-aggregates a sliding buffer for sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec

from panelkit.functions import CENTS
from panelkit.functions import sql as E

# Window lengths and scale factors of the stock features.
SMA_NS = (5, 10, 20, 40, 80)
EXTREMA_NS = (20, 60, 120)
SLOPE_K = {5: 20, 10: 40, 20: 60, 40: 80, 80: 100}
DEV_K = {5: 6, 10: 4, 20: 4, 40: 3, 80: 2}
CROSS = {"r5_20": (5, 20, 3), "r10_40": (10, 40, 2), "r20_80": (20, 80, 2), "r5_40": (5, 40, 2)}
CROSS_D = {"r5_20": 10, "r10_40": 20, "r20_80": 20}
RET_K = {"pctChg2": (5, 2), "pctChg4": (4, 5), "pctChg8": (2, 8), "pctChg15": (2, 15),
         "pctChg30": (2, 15)}
VOL_NS = (5, 10, 20, 40, 80)
VOL_CROSS = {"v3_9": (3, 9), "v5_20": (5, 20), "v9_50": (9, 50)}
VOLUME_SCALE = 1e6


def valuation_exprs() -> dict:
    """V1-V6 as SQL expressions over the clean bar columns."""
    close = E.price("close_c")
    flow = E.sdiv(f"1.0E-8D * {close} * CAST(volume AS DOUBLE)", "turn")
    return {
        "flowmkt": E.sq7(f"(CASE WHEN {flow} > 0 THEN ln({flow}) END)"),
        "everyprofit": E.sq7(E.sdiv("10.0D", "peTTM")),
        "turn": E.sq7("(CASE WHEN turn / 10.0D >= 0 THEN pow(turn / 10.0D, 0.2D) END)"),
        "everypb": E.sq7(E.sdiv("2.0D", "pbMRQ")),
        "eversale": E.sq7(E.sdiv("2.0D", "(CASE WHEN psTTM >= 0 THEN sqrt(psTTM) END)")),
        "evermoney": E.sq7(E.sdiv("20.0D", "pcfNcfTTM")),
    }


def valuation_features(df: DataFrame) -> DataFrame:
    """V1-V6 (+P5): valuation squashes; ``turn`` is replaced in place.

    Division by zero gives NULL, then 0 from the fill (the reference gets
    inf and a saturated arctan; documented deviation).
    """
    new = valuation_exprs()
    keep = [E.q(c) for c in df.columns if c not in new]
    return df.selectExpr(*keep, *[f"coalesce({v}, 0.0D) AS {k}" for k, v in new.items()])


def price_volume_exprs(ws: str = E.WS):
    """The three expression stages of F1-F18 (scratch names start with ``_``)."""
    lags = sorted({1} | {n for _, n in RET_K.values()})
    st1 = {"rn": E.over("row_number()", ws),
           "_cs_close": E.running_sum("close_c", ws),
           "_cs_vol": E.running_sum("volume", ws),
           **{f"_lag{n}": f"(CAST({E.lag('close_c', n, ws)} AS DOUBLE) / 100.0D)" for n in lags}}
    # prior 20-row extrema from a frame; 60 and 120 rows are composed from
    # them with offsets (max is idempotent), so each row visits 20 rows, not 200
    st1b = {"_close": E.price("close_c"),
            "_max20_c": f"(CASE WHEN rn >= 21 THEN {E.over('max(high_c)', ws, E.rows(-20, -1))} END)",
            "_min20_c": f"(CASE WHEN rn >= 21 THEN {E.over('min(low_c)', ws, E.rows(-20, -1))} END)"}
    st1c = {}
    for fn, c in (("greatest", "_max"), ("least", "_min")):
        st1c[f"{c}60_c"] = (f"(CASE WHEN rn >= 61 THEN {fn}({c}20_c, {E.lag(c + '20_c', 20, ws)}, "
                            f"{E.lag(c + '20_c', 40, ws)}) END)")
    st1d = {}
    for fn, c in (("greatest", "_max"), ("least", "_min")):
        st1d[f"{c}120_c"] = f"(CASE WHEN rn >= 121 THEN {fn}({c}60_c, {E.lag(c + '60_c', 60, ws)}) END)"
    st1b_all = [st1b, st1c, st1d]
    vns = sorted(set(VOL_NS) | {a for a, _ in VOL_CROSS.values()} | {b for _, b in VOL_CROSS.values()})
    st2 = {**{f"sma{n}": f"({E.prefix_sum('_cs_close', n, ws)} / {E.d(CENTS * n)})" for n in SMA_NS},
           **{f"_vm{n}": f"({E.prefix_sum('_cs_vol', n, ws)} / {E.d(VOLUME_SCALE * n)})" for n in vns}}
    close, lag1 = "_close", "_lag1"
    vol = f"(CAST(volume AS DOUBLE) / {E.d(VOLUME_SCALE)})"
    amt = f"(amount / {E.d(VOLUME_SCALE)})"
    f = {"preclose": lag1,
         "pctChg": E.clip(E.sdiv(f"8.0D * ({close} - {lag1})", lag1))}
    for name, (k, n) in RET_K.items():
        f[name] = E.clip(f"{E.d(k)} * {E.sdiv(close, f'_lag{n}')} - {E.d(k)}")
    f["avg_price"] = f"{amt} / (0.01D + {vol})"
    for n in EXTREMA_NS:
        mx, mn = f"(CAST(_max{n}_c AS DOUBLE) / 100.0D)", f"(CAST(_min{n}_c AS DOUBLE) / 100.0D)"
        f[f"max{n}"] = mx
        f[f"min{n}"] = mn
        f[f"{n}_min"] = E.clip(f"{E.sdiv(close, mn)} - 0.9D")
        f[f"{n}_max"] = E.clip(f"{E.sdiv(f'2.0D * {close}', mx)} - 2.0D")
    for n, k in SLOPE_K.items():
        prev = E.lag(f"sma{n}", 1, ws)
        f[f"{n}_d"] = E.clip(E.sdiv(f"{E.d(k)} * (sma{n} - {prev})", prev))
    for n, k in DEV_K.items():
        f[f"r{n}"] = E.clip(f"{E.sdiv(f'{E.d(k)} * {close}', f'sma{n}')} - {E.d(k)}")
    for name, (a, b, k) in CROSS.items():
        raw = f"({E.sdiv(f'{E.d(k)} * sma{a}', f'sma{b}')} - {E.d(k)})"
        if name in CROSS_D:
            f[f"{name}_d"] = E.clip(f"{E.d(CROSS_D[name])} * ({raw} - {E.lag(raw, 1, ws)})")
        f[name] = E.clip(raw)
    f["day_price"] = E.sdiv(f"0.5D * ({E.price('open_c')} + {close})", vol)
    for n in VOL_NS:
        raw = f"((10.0D * {vol}) / (0.1D + _vm{n}))"
        f[f"v{n}_d"] = E.sq(f"0.1D * ({raw} - {E.lag(raw, 1, ws)})")
        f[f"v{n}"] = E.sq(f"0.1D * {raw}")
    for name, (a, b) in VOL_CROSS.items():
        raw = f"((10.0D * _vm{a}) / (0.1D + _vm{b}))"
        f[f"{name}_d"] = E.sq(f"({raw} - {E.lag(raw, 1, ws)})")
        f[name] = E.sq(f"0.1D * {raw}")
    f["highratio"] = E.clip(f"{E.sdiv('10.0D * ' + E.price('high_c'), lag1)} - 10.2D")
    f["lowratio"] = E.clip(f"{E.sdiv('10.0D * ' + E.price('low_c'), lag1)} - 9.8D")
    f["openratio"] = E.clip(f"{E.sdiv('20.0D * ' + E.price('open_c'), lag1)} - 20.0D")
    f["volume"] = vol
    f["amount"] = amt
    return st1, st1b_all, st2, f


def price_volume_features(df: DataFrame, w: WindowSpec | None = None, ws: str = E.WS) -> DataFrame:
    """F1-F18 on clean bars (integer cents, whole shares).

    Input needs ``symbol, trade_date, open_c, high_c, low_c, close_c, volume,
    amount``.  Output keeps the P10 intermediates.  ``volume``/``amount`` come out scaled to millions.
    """
    st1, st1b_all, st2, f = price_volume_exprs(ws)
    s = df.selectExpr("*", *E.alias(st1))
    for stage in st1b_all:
        s = s.selectExpr("*", *E.alias(stage))
    s = s.selectExpr("*", *E.alias(st2))
    scratch = {c for c in (*st1, *[k for st in st1b_all for k in st], *st2) if c.startswith("_") or c == "rn"}
    keep = [E.q(c) for c in s.columns if c not in scratch and c not in f]
    return s.selectExpr(*keep, *E.alias(f))
