"""Technical indicators that are plain windows.

Definitions are the published ones of the indicator library the reference
calls.  Sums run on integer cents / whole shares (exact in any order) taken
from running sums plus one offset lookup, so a 30-row regression costs O(1)
per row.  Each indicator ends in one division, which every engine rounds the
same way.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelkit.functions import CENTS
from panelkit.functions import sql as E
from panelkit.plans import segments as G

VOLUME_SCALE = 1e6
# Indicator periods.
TRIMA_N, WMA_N, BETA_N, CORREL_N, LINREG_N, VAR_N = 30, 30, 5, 30, 14, 5
APO_FAST, APO_SLOW, AROON_N, CCI_N, ARBR_N = 12, 26, 14, 14, 26
HELPER_CCI_N, EVM_N, FORCE_N, ROC_N, UPRATIO_N = 20, 14, 13, 12, 20


def trima_weights(n: int):
    """Triangular weights of the period: 1..n/2, n/2..1 (n even)."""
    return [min(k + 1, n - k) for k in range(n)]


def _weighted_lags(x: str, weights, ws: str) -> str:
    """sum_k weights[k] * x[t-k], left to right (integer inputs stay exact)."""
    return "(" + " + ".join(f"{x if k == 0 else E.lag(x, k, ws)} * {wt}" for k, wt in enumerate(weights)) + ")"


def indicator_stages(ws: str = E.WS, home: str | None = None, before: str | None = None):
    """Expression stages: (row number + previous close, running sums,
    window sums, indicators, second-stage indicators)."""
    st0 = {"rn": E.over("row_number()", ws), "_pc": E.lag("close_c", 1, ws)}
    tp3 = "(high_c + low_c + close_c)"
    vol = f"(CAST(volume AS DOUBLE) / {E.d(VOLUME_SCALE)})"
    ad_term = (f"CAST(CASE WHEN high_c - low_c <> 0 THEN CAST((close_c - low_c) - (high_c - close_c) AS DOUBLE)"
               f" / (high_c - low_c) * {vol} ELSE 0.0D END AS DECIMAL(38,12))")
    obv_term = ("CASE WHEN _pc IS NULL THEN volume WHEN close_c > _pc THEN volume "
                "WHEN close_c < _pc THEN -volume ELSE 0 END")
    sums = {"_s_c": "close_c", "_s_jc": "rn * close_c", "_s_c2": "close_c * close_c",
            "_s_h": "high_c", "_s_l": "low_c", "_s_h2": "high_c * high_c", "_s_l2": "low_c * low_c",
            "_s_hl": "high_c * low_c", "_s_tp": tp3, "_s_tp2": f"{tp3} * {tp3}",
            "_s_ho": "high_c - open_c", "_s_ol": "open_c - low_c", "_s_rng": "high_c - low_c",
            "_s_up": "CASE WHEN close_c > open_c THEN 1 ELSE 0 END", "_obv": obv_term, "_ad": ad_term}
    sums["_s_hpc"] = "high_c - _pc"
    sums["_s_pcl"] = "_pc - low_c"
    st1 = {k: E.running_sum(v, ws) for k, v in sums.items()}
    if home is not None:
        # segmented plan: the two running sums from the first row count home
        # rows only and add the totals of all earlier segments (``_off_*``)
        st1["_obv"] = f"(_off_obv + {E.running_sum(f'CASE WHEN {home} THEN {obv_term} ELSE 0 END', ws)})"
        # (37,12) operands keep the sum at scale 12 (a 38-digit sum would lose a digit)
        run_ad = E.running_sum(f"CASE WHEN {home} THEN {ad_term} ELSE 0 END", ws)
        st1["_ad"] = f"(CAST(_off_ad AS DECIMAL(37,12)) + CAST({run_ad} AS DECIMAL(37,12)))"
    if before is not None:
        # rows around the home rows count too: from the segment's first row, less what comes before its home rows
        def since(term, kind):
            early = E.over(f"sum(CASE WHEN {before} THEN {term} ELSE 0 END)", ws, "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")
            return f"(CAST({E.running_sum(term, ws)} AS {kind}) - CAST({early} AS {kind}))"
        st1["_obv"] = f"(_off_obv + {since(obv_term, 'BIGINT')})"
        st1["_ad"] = f"(CAST(_off_ad AS DECIMAL(37,12)) + {since(ad_term, 'DECIMAL(36,12)')})"

    def wsum(x, n):
        return E.prefix_sum(x, n, ws)
    st2 = {"_sh30": wsum("_s_h", CORREL_N), "_sl30": wsum("_s_l", CORREL_N),
           "_shl30": wsum("_s_hl", CORREL_N), "_sh2_30": wsum("_s_h2", CORREL_N),
           "_sl2_30": wsum("_s_l2", CORREL_N), "_sy14": wsum("_s_c", LINREG_N),
           "_sjy14": wsum("_s_jc", LINREG_N), "_sc5": wsum("_s_c", VAR_N), "_sc2_5": wsum("_s_c2", VAR_N),
           "_sc12": wsum("_s_c", APO_FAST), "_sc26": wsum("_s_c", APO_SLOW),
           "_stp14": wsum("_s_tp", CCI_N),
           "_hi15": E.over("max(named_struct('v', high_c, 'at', rn))", ws, E.rows(-AROON_N, 0)),
           "_lo15": E.over("min(named_struct('v', low_c, 'at', -rn))", ws, E.rows(-AROON_N, 0)),
           "_sho26": wsum("_s_ho", ARBR_N), "_sol26": wsum("_s_ol", ARBR_N), "_srng26": wsum("_s_rng", ARBR_N),
           "_stp20": wsum("_s_tp", HELPER_CCI_N), "_stp2_20": wsum("_s_tp2", HELPER_CCI_N),
           "_sup20": wsum("_s_up", UPRATIO_N),
           "_s15": wsum("_s_c", TRIMA_N // 2),
           "_swjc": wsum("_s_jc", WMA_N), "_swc": wsum("_s_c", WMA_N)}
    # TRIMA(30) = SMA16(SMA15): its weighted sum is a 16-row sum of 15-row sums
    # the mean deviation's sum term by term: a list per row would be made and read again
    devs = [f"abs({CCI_N} * {tp3 if k == 0 else E.lag(tp3, k, ws)} - _stp14)" for k in range(CCI_N)]
    st2b = {"_p15": E.running_sum("_s15", ws), "_dev14": "(" + " + ".join(devs) + ")"}
    close = E.price("close_c")
    f = {}
    tw = trima_weights(TRIMA_N)
    trima_sum = f"(_p15 - coalesce({E.lag('_p15', TRIMA_N // 2 + 1, ws)}, 0))"
    trima = f"(CASE WHEN rn >= {TRIMA_N} THEN {trima_sum} / {E.d(sum(tw) * CENTS)} END)"
    f["trima"] = E.sq(f"0.1D * (CASE WHEN {trima} >= 0 THEN sqrt({trima}) END)")
    ww = [WMA_N - k for k in range(WMA_N)]
    # sum_k (n-k) x[t-k] = sum_j (j - (t-n)) x_j over the window = S(jx) - (t-n) S(x)
    wma_sum = f"(_swjc - (rn - {WMA_N}) * _swc)"
    wma = f"(CASE WHEN rn >= {WMA_N} THEN {wma_sum} / {E.d(sum(ww) * CENTS)} END)"
    f["wma"] = E.sq(f"0.1D * (CASE WHEN {wma} >= 0 THEN sqrt({wma}) END)")
    f["adline"] = E.sq("0.005D * CAST(_ad AS DOUBLE) - 0.5D")
    f["obv"] = E.sq(f"0.001D * (_obv / {E.d(VOLUME_SCALE)})")
    n = CORREL_N
    cov = f"({n} * _shl30 - _sh30 * _sl30)"
    vh = f"CAST({n} * _sh2_30 - _sh30 * _sh30 AS DOUBLE)"
    vl = f"CAST({n} * _sl2_30 - _sl30 * _sl30 AS DOUBLE)"
    corr = (f"(CASE WHEN {vh} * {vl} > 0 THEN CAST({cov} AS DOUBLE) / sqrt({vh} * {vl}) "
            f"WHEN rn >= {n} THEN 0.0D END)")
    f["correl"] = E.clip(f"-3.0D * {corr} + 3.0D")
    n = LINREG_N
    sx, sxx = n * (n - 1) // 2, n * (n - 1) * (2 * n - 1) // 6
    s_iy = "(rn * _sy14 - _sjy14)"
    m = f"(({n} * {s_iy} - {sx} * _sy14) / {E.d((sx * sx - n * sxx) * CENTS)})"
    b = f"((_sy14 / 100.0D - {m} * {E.d(sx)}) / {E.d(n)})"
    f["linearreg"] = E.sq(f"0.1D * ({b} + {m} * {E.d(n - 1)}) - 1.0D")
    f["lineangle"] = E.sq(f"0.1D * (atan({m}) * {E.d(180.0 / math.pi)})")
    f["TSF"] = E.sq(f"2.0D * ({b} + {m} * {E.d(n)})")
    f["lineintercept"] = E.sq(f"0.05D * {b}")
    var = f"(({VAR_N} * _sc2_5 - _sc5 * _sc5) / {E.d(VAR_N * VAR_N * CENTS * CENTS)})"
    f["var"] = E.sq(f"30.0D * {var}")
    sd = f"(CASE WHEN {var} >= 0 THEN sqrt({var}) END)"
    f["stddev"] = E.clip(f"(CASE WHEN {sd} >= 0 THEN pow({sd}, 0.25D) END) - 1.0D")
    apo = f"(_sc12 / {E.d(APO_FAST * CENTS)} - _sc26 / {E.d(APO_SLOW * CENTS)})"
    f["apo"] = E.clip(f"0.5D * {apo}")
    since_hi, since_lo = "(rn - _hi15.at)", "(rn + _lo15.at)"  # the latest of equals
    up = f"(CASE WHEN rn >= {AROON_N + 1} THEN 100.0D * ({AROON_N} - {since_hi}) / {E.d(AROON_N)} END)"
    dn = f"(CASE WHEN rn >= {AROON_N + 1} THEN 100.0D * ({AROON_N} - {since_lo}) / {E.d(AROON_N)} END)"
    f["ardown"] = f"0.02D * {dn} - 1.0D"
    f["arup"] = f"0.02D * {up} - 1.0D"
    f["arosc"] = f"0.01D * ({up} - {dn})"
    f["bop"] = "(CASE WHEN high_c - low_c <> 0 THEN CAST(close_c - open_c AS DOUBLE) / (high_c - low_c) ELSE 0.0D END)"
    n = CCI_N
    f["cci"] = (f"0.004D * (CASE WHEN rn >= {n} THEN (CASE WHEN _dev14 <> 0 THEN "
                f"CAST({n} * ({n} * {tp3} - _stp14) AS DOUBLE) / (0.015D * _dev14) ELSE 0.0D END) END)")
    f["ar"] = f"{E.sdiv('_sho26 / 100.0D', '1.0D + _sol26 / 100.0D')} - 1.0D"
    f["cr"] = "(_srng26 - _srng26) / 200.0D - 1.0D"
    n = HELPER_CCI_N
    std = f"sqrt(({n} * _stp2_20 - _stp20 * _stp20) / {E.d(n * (n - 1))})"
    f["cci_helper"] = E.sdiv(f"({n} * {tp3} - _stp20) / {E.d(n)}", f"0.015D * {std}")
    f["force_index"] = f"({close} - {E.lag('close_c', FORCE_N, ws)} / 100.0D) * {vol}"
    lc = f"({E.lag('close_c', ROC_N, ws)} / 100.0D)"
    f["roc"] = E.sdiv(f"{close} - {lc}", lc)
    f["sunup"] = "CASE WHEN close_c > open_c THEN 1 ELSE 0 END"
    f["upratio"] = f"_sup20 / {E.d(UPRATIO_N)}"
    hl = "((high_c + low_c) / 100.0D)"
    r = "(CASE WHEN (high_c - low_c) / 100.0D = 0 THEN 0.0001D ELSE (high_c - low_c) / 100.0D END)"
    hi1, lo1 = E.lag("high_c", 1, ws), E.lag("low_c", 1, ws)
    st4 = {"_hpc": "high_c - _pc", "_pcl": "_pc - low_c",
           # a zero price has no return: 0, as for a flat day
           "_xr": f"CASE WHEN {hi1} IS NULL THEN NULL ELSE coalesce({E.sdiv(f'high_c - {hi1}', hi1)}, 0.0D) END",
           "_yr": f"CASE WHEN {lo1} IS NULL THEN NULL ELSE coalesce({E.sdiv(f'low_c - {lo1}', lo1)}, 0.0D) END",
           "_evm": E.sdiv(f"0.5D * ({hl} - {E.lag(hl, 1, ws)})", f"{vol} / {r}")}

    def lagsum(x, k):
        return _weighted_lags(x, [1] * k, ws)
    g = {}
    n = ARBR_N
    g["br"] = (f"(CASE WHEN rn >= {n + 1} THEN "
               f"{E.sdiv(E.prefix_sum('_s_hpc', n, ws) + ' / 100.0D', '1.0D + ' + E.prefix_sum('_s_pcl', n, ws) + ' / 100.0D')} - 1.0D END)")
    n = BETA_N

    def lg(x, k):
        return x if k == 0 else E.lag(x, k, ws)
    sxs, sys_ = lagsum("_xr", n), lagsum("_yr", n)
    sxx_ = "(" + " + ".join(f"{lg('_xr', k)} * {lg('_xr', k)}" for k in range(n)) + ")"
    sxy_ = "(" + " + ".join(f"{lg('_xr', k)} * {lg('_yr', k)}" for k in range(n)) + ")"
    den = f"({E.d(n)} * {sxx_} - {sxs} * {sxs})"
    g["beta"] = E.sq(f"(CASE WHEN rn >= {n + 1} THEN (CASE WHEN {den} <> 0 THEN "
                     f"({E.d(n)} * {sxy_} - {sxs} * {sys_}) / {den} ELSE 0.0D END) END)")
    g["evm"] = f"-({lagsum('_evm', EVM_N)} / {E.d(EVM_N)})"
    g["cci_d"] = E.sq7(E.sdiv(f"cci - {E.lag('cci', 1, ws)}", f"0.1D + {E.lag('cci', 1, ws)}"))
    return st0, st1, st2, st2b, f, st4, g


RUNNING = ("obv", "adline")  # run from a symbol's first row


def columns() -> list[str]:
    """The indicators of ``indicator_features``."""
    stages = indicator_stages()
    return [*stages[4], *stages[6]]


def no_offsets() -> dict:
    """Stand-ins for ``segment_offsets`` where none of ``RUNNING`` is wanted."""
    return {"_off_obv": F.lit(0).cast("bigint"), "_off_ad": F.lit(0).cast("decimal(38,0)")}


def running_terms() -> dict:
    """Per-row increments of the two running sums from a symbol's first row."""
    vol = f"(CAST(volume AS DOUBLE) / {E.d(VOLUME_SCALE)})"
    return {
        "obv": ("CASE WHEN _pc IS NULL THEN volume WHEN close_c > _pc THEN volume "
                "WHEN close_c < _pc THEN -volume ELSE 0 END"),
        "ad": (f"CAST(CASE WHEN high_c - low_c <> 0 THEN CAST((close_c - low_c) - (high_c - close_c) AS DOUBLE)"
               f" / (high_c - low_c) * {vol} ELSE 0.0D END AS DECIMAL(38,12))"),
    }


def segment_offsets(numbered: DataFrame, seg_rows: int, key: str = "symbol") -> DataFrame:
    """(key, _seg, _off_obv, _off_ad): totals of the running-sum increments over all earlier segments (exact:
    integers and decimals), from bars with ``_grn``; one small row per key and segment."""
    ws, terms = G.spec(key), running_terms()
    narrow = numbered.select(key, "trade_date", "_grn", "high_c", "low_c", "close_c", "volume")
    t = G.segment(narrow, seg_rows).selectExpr("*", f"{E.lag('close_c', 1, ws)} AS _pc")
    tot = (t.filter("_home").groupBy(key, "_seg")
           .agg(*[F.sum(F.expr(v)).alias(f"_tot_{k}") for k, v in terms.items()]))
    before = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    return tot.select(key, "_seg", *[F.coalesce(F.sum(f"_tot_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in terms])


def indicator_features(df: DataFrame, w: WindowSpec | None = None, ws: str = E.WS,
                       home: str | None = None, before: str | None = None) -> DataFrame:
    """All plain-window indicators of ``trans_features`` plus the helpers.

    Input: clean bars with ``open_c, high_c, low_c, close_c, volume``.  On a
    segmented frame pass ``home`` and add ``segment_offsets`` first; with ``before``
    (whether a row comes before the home rows) the rows around these are right too.
    """
    st0, st1, st2, st2b, f, st4, g = indicator_stages(ws, home, before)
    t = df
    for stage in (st0, st1, st2, st2b, f, st4, g):
        t = t.selectExpr("*", *E.alias(stage))
    scratch = [c for stage in (st0, st1, st2, st2b, st4) for c in stage]
    return t.drop(*scratch, "_off_obv", "_off_ad")
