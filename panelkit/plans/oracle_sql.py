"""DuckDB oracle SQL for every registered query (see ``oracle_base``).

Rolling sums here use plain sliding frames (the Spark side uses running sums
plus an offset), so the two engines reach the same numbers by different plans.
"""

from __future__ import annotations

from panelkit.plans.oracle_base import with_base

WS = "PARTITION BY symbol ORDER BY trade_date"
KEY = "symbol, trade_date"


def frame(a: int, b: int, ws: str = WS) -> str:
    def side(k):
        if k == 0:
            return "CURRENT ROW"
        return f"{-k} PRECEDING" if k < 0 else f"{k} FOLLOWING"
    return f"({ws} ROWS BETWEEN {side(a)} AND {side(b)})"


def lag(x: str, n: int = 1, ws: str = WS) -> str:
    return f"lag({x}, {n}) OVER ({ws})"


def lead(x: str, n: int = 1, ws: str = WS) -> str:
    return f"lead({x}, {n}) OVER ({ws})"


def clip(x: str) -> str:
    return f"(CASE WHEN ({x}) > 1 THEN 1.0 WHEN ({x}) < -1 THEN -1.0 ELSE ({x}) END)"


def sdiv(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


def sq(x: str) -> str:
    return f"(0.6366 * atan({x}))"


def sq7(x: str) -> str:
    return f"(0.637 * atan({x}))"


def r6(x: str) -> str:
    return f"(round(({x}) * 1000000.0) / 1000000.0 + 0.0)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def roll_mean(x: str, n: int, scale: float, ws: str = WS) -> str:
    fr = frame(-(n - 1), 0, ws)
    return f"(CASE WHEN count(*) OVER {fr} = {n} THEN {dbl(f'sum({x}) OVER {fr}')} / {scale * n!r} END)"


def prior_ext(fn: str, x: str, n: int, ws: str = WS, rn: str = "rn") -> str:
    return f"(CASE WHEN {rn} >= {n + 1} THEN {fn}({x}) OVER {frame(-n, -1, ws)} END)"


def fwd_ext(fn: str, x: str, k: int, ws: str = WS) -> str:
    fr = frame(1, k, ws)
    return f"(CASE WHEN count({x}) OVER {fr} = {k} THEN {fn}({x}) OVER {fr} END)"


def select_out(src: str, cols, types=None, key: str = KEY) -> str:
    """``SELECT key, r6(col)...`` — ``types`` maps non-double columns to None."""
    types = types or {}
    parts = []
    for c in cols:
        quoted = f'"{c}"'
        parts.append(quoted if c in types else f"{r6(quoted)} AS {quoted}")
    return f"SELECT {key}, {', '.join(parts)} FROM {src}"


# ------------------------------------------------------------ stock chain

def stock_ctes(src: str = "clean") -> str:
    """CTEs ``st1``..``stock_feat`` from ``clean`` (F1-F18), mirroring the Spark stages."""
    ext = []
    for n in (20, 60, 120):
        ext.append(f"{prior_ext('max', 'high_c', n)} AS _max{n}_c")
        ext.append(f"{prior_ext('min', 'low_c', n)} AS _min{n}_c")
    lags = ", ".join(f"{lag('close_c', n)} / 100.0 AS _lag{n}" for n in (1, 2, 5, 8, 15))
    st1 = f"""st1 AS (
  SELECT *, CAST(close_c AS DOUBLE) / 100 AS _close, {lags}
  FROM (SELECT *, row_number() OVER ({WS}) AS rn FROM {src})),
st1b AS (SELECT *, {', '.join(ext)} FROM st1)"""
    smas = ", ".join(f"{roll_mean('close_c', n, 100.0)} AS sma{n}" for n in (5, 10, 20, 40, 80))
    vms = ", ".join(f"{roll_mean('volume', n, 1e6)} AS _vm{n}" for n in (3, 5, 9, 10, 20, 40, 50, 80))
    st2 = f"st2 AS (SELECT *, {smas}, {vms} FROM st1b)"
    close, lag1 = "_close", "_lag1"
    vol = "(CAST(volume AS DOUBLE) / 1000000.0)"
    f = {}
    f["preclose"] = lag1
    f["pctChg"] = clip(sdiv(f"8.0 * ({close} - {lag1})", lag1))
    for name, (k, n) in {"pctChg2": (5, 2), "pctChg4": (4, 5), "pctChg8": (2, 8),
                         "pctChg15": (2, 15), "pctChg30": (2, 15)}.items():
        f[name] = clip(f"{k}.0 * {sdiv(close, f'_lag{n}')} - {k}.0")
    f["avg_price"] = f"(amount / 1000000.0) / (0.01 + {vol})"
    for n in (20, 60, 120):
        f[f"max{n}"] = f"CAST(_max{n}_c AS DOUBLE) / 100"
        f[f"min{n}"] = f"CAST(_min{n}_c AS DOUBLE) / 100"
        f[f"{n}_min"] = clip(f"{sdiv(close, f'(CAST(_min{n}_c AS DOUBLE) / 100)')} - 0.9")
        f[f"{n}_max"] = clip(f"{sdiv(f'2.0 * {close}', f'(CAST(_max{n}_c AS DOUBLE) / 100)')} - 2.0")
    for n, k in {5: 20, 10: 40, 20: 60, 40: 80, 80: 100}.items():
        prev = lag(f"sma{n}")
        f[f"{n}_d"] = clip(sdiv(f"{k}.0 * (sma{n} - {prev})", prev))
    for n, k in {5: 6, 10: 4, 20: 4, 40: 3, 80: 2}.items():
        f[f"r{n}"] = clip(f"{sdiv(f'{k}.0 * {close}', f'sma{n}')} - {k}.0")
    cross = {"r5_20": (5, 20, 3), "r10_40": (10, 40, 2), "r20_80": (20, 80, 2), "r5_40": (5, 40, 2)}
    cross_d = {"r5_20": 10, "r10_40": 20, "r20_80": 20}
    for name, (a, b, k) in cross.items():
        raw = f"({sdiv(f'{k}.0 * sma{a}', f'sma{b}')} - {k}.0)"
        if name in cross_d:
            f[f"{name}_d"] = clip(f"{cross_d[name]}.0 * ({raw} - {lag(raw)})")
        f[name] = clip(raw)
    f["day_price"] = sdiv(f"0.5 * ((CAST(open_c AS DOUBLE) / 100) + {close})", vol)
    for n in (5, 10, 20, 40, 80):
        raw = f"((10.0 * {vol}) / (0.1 + _vm{n}))"
        f[f"v{n}_d"] = sq(f"0.1 * ({raw} - {lag(raw)})")
        f[f"v{n}"] = sq(f"0.1 * {raw}")
    for name, (a, b) in {"v3_9": (3, 9), "v5_20": (5, 20), "v9_50": (9, 50)}.items():
        raw = f"((10.0 * _vm{a}) / (0.1 + _vm{b}))"
        f[f"{name}_d"] = sq(f"({raw} - {lag(raw)})")
        f[name] = sq(f"0.1 * {raw}")
    f["highratio"] = clip(f"{sdiv('10.0 * (CAST(high_c AS DOUBLE) / 100)', lag1)} - 10.2")
    f["lowratio"] = clip(f"{sdiv('10.0 * (CAST(low_c AS DOUBLE) / 100)', lag1)} - 9.8")
    f["openratio"] = clip(f"{sdiv('20.0 * (CAST(open_c AS DOUBLE) / 100)', lag1)} - 20.0")
    feats = ", ".join(f'{v} AS "{k}"' for k, v in f.items() if k not in ("volume", "amount"))
    st3 = f"""stock_feat AS (
  SELECT * EXCLUDE (volume, amount), {vol} AS volume, amount / 1000000.0 AS amount, {feats}
  FROM st2)"""
    return ",\n".join([st1, st2, st3])


def label_fwd_return(h: int) -> str:
    close = "(CAST(close_c AS DOUBLE) / 100)"
    return f"({sdiv(f'CAST({lead('close_c', h)} AS DOUBLE) / 100', close)} - 1.0)"


def class_sql(src: str, value: str, out: str, key: str = "symbol") -> str:
    """Per-key decile class of ``value`` (A1 + A2), as a SELECT over ``src``."""
    probs = ", ".join(repr(i / 10) for i in range(1, 10))
    return f"""SELECT s.*, CASE WHEN s.{value} IS NULL THEN NULL ELSE
        CAST(len(list_filter(e.edges, lambda x: x <= s.{value})) AS BIGINT) END AS {out}
  FROM {src} s LEFT JOIN (
    SELECT {key}, list_transform(quantile_cont({value}, [{probs}]), lambda x: round_even(x, 3)) AS edges
    FROM {src} WHERE {value} IS NOT NULL GROUP BY {key}) e USING ({key})"""


# ------------------------------------------------------------ queries

def _scan_bars():
    cols = "open_c, high_c, low_c, close_c, CASE WHEN _q % 29 = 0 THEN 0 ELSE volume END AS volume, CAST(amount_c AS DOUBLE) / 100 AS amount, turn, peTTM, pbMRQ, psTTM, pcfNcfTTM, CAST(isST AS DOUBLE) AS isST"
    return with_base(f"SELECT {KEY}, {cols} FROM bars WHERE trade_date BETWEEN DATE '1993-01-01' AND DATE '1996-12-31'")


def _clean_bars():
    return with_base(select_out("clean", ["open_c", "high_c", "low_c", "close_c", "volume", "turn",
                                          "amount", "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST"],
                                types={c: None for c in ("open_c", "high_c", "low_c", "close_c", "volume")}))


def _rolling_mean():
    ns = (2, 3, 4, 5, 9, 10, 20, 40, 50, 80)
    cols = ", ".join(f"{r6(roll_mean('close_c', n, 100.0))} AS ma{n}" for n in ns)
    return with_base(f"SELECT {KEY}, {cols} FROM clean")


def _ma_class():
    body = f"""SELECT {KEY}, {r6('sma5')} AS sma5, {r6('r5')} AS r5, {r6('result4')} AS result4, resultclass4
  FROM ({class_sql('lab', 'result4', 'resultclass4')})"""
    extra = stock_ctes() + f""",
lab AS (SELECT {KEY}, r5, sma5, {label_fwd_return(4)} AS result4 FROM stock_feat)"""
    return with_base(body, extra)


STOCK_GROUPS = {
    "stock_returns": ["preclose", "pctChg", "pctChg2", "pctChg4", "pctChg8", "pctChg15", "pctChg30"],
    "stock_volume": ["volume", "amount", "avg_price", "day_price", "v5", "v10", "v20", "v40", "v80",
                     "v3_9", "v5_20", "v9_50", "v5_d", "v10_d", "v20_d", "v40_d", "v80_d",
                     "v3_9_d", "v5_20_d", "v9_50_d"],
    "stock_range": ["max20", "max60", "max120", "min20", "min60", "min120", "20_min", "60_min",
                    "120_min", "20_max", "60_max", "120_max"],
    "stock_ma_slope": ["sma5", "sma10", "sma20", "sma40", "sma80", "5_d", "10_d", "20_d", "40_d", "80_d"],
    "stock_ma_dev": ["r5", "r10", "r20", "r40", "r80"],
    "stock_ma_cross": ["r5_20", "r10_40", "r20_80", "r5_40", "r5_20_d", "r10_40_d", "r20_80_d"],
    "stock_gap": ["highratio", "lowratio", "openratio"],
}


def _stock_group(cols):
    return lambda: with_base(select_out("stock_feat", cols), stock_ctes())


def valuation_sql(src: str = "clean") -> str:
    close = "(CAST(close_c AS DOUBLE) / 100)"
    flow = sdiv(f"1e-8 * {close} * CAST(volume AS DOUBLE)", "turn")
    v = {
        "flowmkt": sq7(f"(CASE WHEN {flow} > 0 THEN ln({flow}) END)"),
        "everyprofit": sq7(sdiv("10.0", "peTTM")),
        "turn": sq7("(CASE WHEN turn / 10.0 >= 0 THEN pow(turn / 10.0, 0.2) END)"),
        "everypb": sq7(sdiv("2.0", "pbMRQ")),
        "eversale": sq7(sdiv("2.0", "(CASE WHEN psTTM >= 0 THEN sqrt(psTTM) END)")),
        "evermoney": sq7(sdiv("20.0", "pcfNcfTTM")),
    }
    cols = ", ".join(f"coalesce({e}, 0.0) AS {k}" for k, e in v.items())
    return f"SELECT * EXCLUDE (turn), {cols} FROM {src}"


def _valuation():
    cols = ["flowmkt", "everyprofit", "turn", "everypb", "eversale", "evermoney"]
    return with_base(select_out("val", cols), f"val AS ({valuation_sql()})")


CLOSES = "closes AS (SELECT *, CAST(close_c AS DOUBLE) / 100 AS close FROM clean)"


def _w(body: str, extra: str = "") -> str:
    return with_base(body, CLOSES + ("," + extra if extra else ""))


def _w_lag():
    return _w(f"SELECT {KEY}, {r6(lag('close', 1))} AS lag1, {r6(lag('close', 5))} AS lag5, "
              f"{lag('volume', 1)} AS vol_lag1 FROM closes")


def _w_lead():
    return _w(f"SELECT {KEY}, {r6(lead('close', 1))} AS lead1, {r6(lead('close', 10))} AS lead10 FROM closes")


def _w_diff():
    return _w(f"SELECT {KEY}, {r6('close - ' + lag('close', 1))} AS diff1, "
              f"{r6('close - ' + lag('close', 5))} AS diff5 FROM closes")


def _rolling_extrema():
    cols = []
    for n in (20, 60, 120):
        cols.append(f"{r6(dbl(prior_ext('max', 'high_c', n)) + ' / 100')} AS max{n}")
        cols.append(f"{r6(dbl(prior_ext('min', 'low_c', n)) + ' / 100')} AS min{n}")
    return _w(f"SELECT {KEY}, {', '.join(cols)} FROM (SELECT *, row_number() OVER ({WS}) AS rn FROM closes)")


def _forward_extrema():
    cols = []
    for k in (2, 4, 7, 10):
        cols.append(f"{r6(dbl(fwd_ext('max', 'close_c', k)) + ' / 100')} AS fmax{k}")
        cols.append(f"{r6(dbl(fwd_ext('min', 'close_c', k)) + ' / 100')} AS fmin{k}")
    return _w(f"SELECT {KEY}, {', '.join(cols)} FROM closes")


def _centered_mean():
    fr = frame(-4, 5)
    return _w(f"SELECT {KEY}, {r6(f'CASE WHEN count(close) OVER {fr} = 10 THEN avg(close) OVER {fr} END')} AS cmean10 FROM closes")


def _w_rolling_sum():
    fr = frame(-25, 0)
    return _w(f"""SELECT {KEY},
  CAST(CASE WHEN count(*) OVER {fr} = 26 THEN sum(volume) OVER {fr} END AS BIGINT) AS vol_sum26,
  {r6(f'CASE WHEN count(*) OVER {fr} = 26 THEN CAST(sum(high_c - open_c) OVER {fr} AS DOUBLE) / 100 END')} AS ho_sum26
FROM closes""")


def _clip_values():
    return _w(f"SELECT {KEY}, {r6(clip('50.0 * (' + sdiv('close', lag('close')) + ' - 1.0)'))} AS clipped FROM closes")


def _squash():
    ret = f"({sdiv('close', lag('close'))} - 1.0)"
    return _w(f"SELECT {KEY}, {r6(sq('10.0 * ' + ret))} AS sq_ret, {r6(sq7('10.0 * ' + ret))} AS sq7_ret, "
              f"{r6('1.0 / (1.0 + exp(0.001 * (CAST(volume AS DOUBLE) / 1000000.0)))')} AS logistic_vol FROM closes")


def _arr(expr_fn, name):
    def f():
        fr = frame(-9, 0)
        return _w(f"""SELECT {KEY}, {expr_fn()} AS {name}
FROM (SELECT *, list(close_c) OVER {fr} AS a FROM closes)""")
    return f


def _ts_rank_expr():
    def rank_of(v):
        return (f"(len(list_filter(a, lambda z: z < {v})) + "
                f"(len(list_filter(a, lambda z: z = {v})) + 1) / 2.0)")
    return r6(f"CASE WHEN len(a) = 10 THEN {rank_of('a[-1]')} / {rank_of('list_max(a)')} END")


def _high_day_expr():
    return "CASE WHEN len(a) = 10 THEN CAST(10 - list_position(a, list_max(a)) + 1 AS BIGINT) END"


def _low_day_expr():
    return "CASE WHEN len(a) = 10 THEN CAST(10 - list_position(a, list_min(a)) + 1 AS BIGINT) END"


def _decay_linear():
    terms = " + ".join(("close" if k == 0 else lag("close", k)) + f" * {10 - k}.0" for k in range(10))
    return _w(f"SELECT {KEY}, {r6(f'({terms}) / 55.0')} AS decay10 FROM closes")


# ------------------------------------------------------------ index, J1

WI = "PARTITION BY index_code ORDER BY trade_date"
IKEY = "index_code, trade_date"
INDEX_GROUPS = {
    "index_returns": ["szpctchg1", "szpctchg2", "szpctchg4", "szpctchg8", "szpctchg15", "szpctchg30"],
    "index_range": ["zs20_min", "zs60_min", "zs120_min", "zs20_max", "zs60_max", "zs120_max"],
    "index_ma": ["zs5_d", "zs10_d", "zs20_d", "zs40_d", "zs80_d", "zsr5", "zsr10", "zsr20", "zsr40",
                 "zsr80", "zsr5_20_d", "zsr10_40_d", "zsr20_80_d", "zsr5_20", "zsr10_40", "zsr20_80",
                 "zsr5_40"],
    "index_volume": ["zsv5_d", "zsv10_d", "zsv20_d", "zsv40_d", "zsv80_d", "zsv5", "zsv10", "zsv20",
                     "zsv40", "zsv80"],
}
INDEX_LEVEL = [c for g in INDEX_GROUPS.values() for c in g]


def index_ctes() -> str:
    lags = ", ".join(f"CAST({lag('close_c', n, WI)} AS DOUBLE) / 100 AS _lag{n}" for n in (1, 2, 4, 8, 15, 30))
    ext = []
    for n in (20, 60, 120):
        ext.append(f"CAST({prior_ext('max', 'high_c', n, WI)} AS DOUBLE) / 100 AS _max{n}")
        ext.append(f"CAST({prior_ext('min', 'low_c', n, WI)} AS DOUBLE) / 100 AS _min{n}")
    smas = ", ".join(f"{roll_mean('close_c', n, 100.0, WI)} AS _sma{n}" for n in (2, 4, 5, 10, 20, 40, 80))
    vms = ", ".join(f"{roll_mean('volume', n, 1.0, WI)} AS _vm{n}" for n in (3, 5, 9, 10, 20, 40, 50, 80))
    close = "(CAST(close_c AS DOUBLE) / 100)"
    vol = "CAST(volume AS DOUBLE)"
    f = {"szpctchg1": f"{sdiv(f'18.0 * {close}', '_lag1')} - 18.0"}
    for name, (k, m, n) in {"szpctchg2": (19, 2, 2), "szpctchg4": (10, 2, 4), "szpctchg8": (10, 4, 8),
                            "szpctchg15": (8, 5, 15), "szpctchg30": (6, 10, 30)}.items():
        f[name] = f"{sdiv(f'{k}.0 * _sma{m}', f'_lag{n}')} - {k}.0"
    for n in (20, 60, 120):
        f[f"zs{n}_min"] = clip(f"{sdiv(f'2.0 * {close}', f'_min{n}')} - 2.0")
    for n in (20, 60, 120):
        f[f"zs{n}_max"] = clip(f"{sdiv(f'4.0 * {close}', f'_max{n}')} - 4.0")
    for n, k in {5: 20, 10: 40, 20: 60, 40: 80, 80: 100}.items():
        prev = lag(f"_sma{n}", 1, WI)
        f[f"zs{n}_d"] = clip(sdiv(f"{k}.0 * (_sma{n} - {prev})", prev))
    for n, k in {5: 10, 10: 8, 20: 6, 40: 6, 80: 4}.items():
        f[f"zsr{n}"] = clip(f"{sdiv(f'{k}.0 * {close}', f'_sma{n}')} - {k}.0")
    raws = {name: f"({sdiv(f'4.0 * _sma{a}', f'_sma{b}')} - 4.0)" for name, (a, b) in
            {"zsr5_20": (5, 20), "zsr10_40": (10, 40), "zsr20_80": (20, 80), "zsr5_40": (5, 40)}.items()}
    for name, k in {"zsr5_20": 10, "zsr10_40": 20, "zsr20_80": 20}.items():
        f[f"{name}_d"] = clip(f"{k}.0 * ({raws[name]} - {lag(raws[name], 1, WI)})")
    for name, raw in raws.items():
        f[name] = clip(raw)
    for n, k in {5: 0.2, 10: 0.1, 20: 0.2, 40: 0.2, 80: 0.2}.items():
        raw = f"((10.0 * {vol}) / (0.1 + _vm{n}))"
        f[f"zsv{n}_d"] = sq(f"{k} * ({raw} - {lag(raw, 1, WI)})")
    for n in (5, 10, 20, 40, 80):
        raw = f"((10.0 * {vol}) / (0.1 + _vm{n}))"
        f[f"zsv{n}"] = sq(f"0.2 * {raw}")
    for name, (a, b) in {"zsv3_9": (3, 9), "zsv5_20": (5, 20), "zsv9_50": (9, 50)}.items():
        f[f"_raw_{name}"] = f"((10.0 * _vm{a}) / (0.1 + _vm{b}))"
    feats = ", ".join(f"{v} AS {k}" for k, v in f.items())
    return f"""ix1 AS (
  SELECT index_code, trade_date, close_c, high_c, low_c, volume, {lags}
  FROM (SELECT *, row_number() OVER ({WI}) AS rn FROM index_bars)),
ix1b AS (SELECT *, {', '.join(ext)} FROM (SELECT *, row_number() OVER ({WI}) AS rn FROM ix1)),
ix2 AS (SELECT *, {smas}, {vms} FROM ix1b),
index_feat AS (SELECT index_code, trade_date, {feats} FROM ix2)"""


def _index_group(cols):
    return lambda: with_base(select_out("index_feat", cols, key=IKEY), index_ctes())


def _scan_index():
    return with_base(f"SELECT {IKEY}, open_c, high_c, low_c, close_c, volume, amount_c FROM index_bars "
                     f"WHERE trade_date >= DATE '1990-01-01'")


def enrich_ctes(src: str = "clean") -> str:
    joined = []
    for name in ("zsv3_9", "zsv5_20", "zsv9_50"):
        raw = f"_raw_{name}"
        joined.append(f"{sq(f'2.0 * ({raw} - {lag(raw)})')} AS {name}_d")
        joined.append(f"{sq(f'0.2 * {raw}')} AS {name}")
    return index_ctes() + f""",
enriched AS (
  SELECT s.*, {', '.join('i.' + c for c in INDEX_LEVEL)}, {', '.join(joined)}
  FROM {src} s LEFT JOIN index_feat i USING (trade_date))"""


def _index_enrich():
    return with_base(select_out("enriched", INDEX_LEVEL), enrich_ctes())


def _index_volume_joined():
    cols = ["zsv3_9", "zsv5_20", "zsv9_50", "zsv3_9_d", "zsv5_20_d", "zsv9_50_d"]
    return with_base(select_out("enriched", cols), enrich_ctes())


# ------------------------------------------------------------ labels

HORIZONS = (2, 4, 7, 10)


def labels_cte(src: str = "clean", name: str = "labeled", horizons=HORIZONS) -> str:
    close = "(CAST(close_c AS DOUBLE) / 100)"
    cols = []
    for h in horizons:
        remax = f"(CAST({fwd_ext('max', 'close_c', h)} AS DOUBLE) / 100)"
        remin = f"(CAST({fwd_ext('min', 'close_c', h)} AS DOUBLE) / 100)"
        mx = f"({sdiv(remax, close)} - 1.0)"
        mn = f"({sdiv(remin, close)} - 1.0)"
        cols += [f"{label_fwd_return(h)} AS result{h}", f"{mx} AS resultmax{h}",
                 f"{mn} AS resultmin{h}", f"({mx} + {mn}) AS resultrel{h}"]
        if h > 2:
            rng = f"({remax} - {remin})"

            def b(cond):
                return f"CAST(coalesce({cond}, false) AS INTEGER)"
            sig = (f"({b(f'{close} < {remin} + {rng} / 5.0')} * 2 + {b(f'{close} < {remin} + {rng} / 3.0')} * 2"
                   f" - {b(f'{close} > {remax} - {rng} / 3.0')} * 2 - {b(f'{close} > {remax} - {rng} / 5.0')} * 2)")
            score = (f"4 + {b(sdiv(rng, close) + ' > 0.03')} * {sig}"
                     f" + {b(sdiv(rng, close) + ' > 0.05')} * {b(f'{close} < {remin} + {rng} / 5.0')}")
            cols.append(f"CAST({score} AS BIGINT) AS resultbuy{h}")
    return f"{name} AS (SELECT *, {', '.join(cols)} FROM {src})"


def classes_cte(src: str = "labeled", name: str = "classed", key: str = "symbol", horizons=HORIZONS, seen: str = "TRUE") -> str:
    probs = ", ".join(repr(i / 10) for i in range(1, 10))
    aggs, outs = [], []
    for h in horizons:
        for v in (f"result{h}", f"resultrel{h}"):
            aggs.append(f"list_transform(quantile_cont({v}, [{probs}]), lambda x: round_even(x, 3)) AS e_{v}")
        outs.append(f"CASE WHEN s.result{h} IS NULL THEN NULL ELSE CAST(len(list_filter(e.e_result{h}, "
                    f"lambda x: x <= s.result{h})) AS BIGINT) END AS resultclass{h}")
        outs.append(f"CASE WHEN s.resultrel{h} IS NULL THEN NULL ELSE CAST(len(list_filter(e.e_resultrel{h}, "
                    f"lambda x: x <= s.resultrel{h})) AS BIGINT) END AS resultrelclass{h}")
    return f"""{name} AS (
  SELECT s.*, {', '.join(outs)}
  FROM {src} s LEFT JOIN (SELECT {key}, {', '.join(aggs)} FROM {src} WHERE {seen} GROUP BY {key}) e USING ({key}))"""


def _labels_q(cols, ints=(), classes=False):
    def f():
        extra = labels_cte() + ("," + classes_cte() if classes else "")
        src = "classed" if classes else "labeled"
        return with_base(select_out(src, cols, types={c: None for c in ints}), extra)
    return f


LABEL_COLUMNS = (["resultbuy4", "resultbuy7", "resultbuy10"]
                 + [f"result{k}class{h}" for h in HORIZONS for k in ("", "rel")])


def _quantile_edges():
    probs = ", ".join(repr(i / 10) for i in range(1, 10))
    cols = ", ".join(f"{r6(f'e[{i}]')} AS edge{i}" for i in range(1, 10))
    return with_base(f"""SELECT symbol, {cols} FROM (
  SELECT symbol, list_transform(quantile_cont(result4, [{probs}]), lambda x: round_even(x, 3)) AS e
  FROM labeled WHERE result4 IS NOT NULL GROUP BY symbol)""", labels_cte())


def _quantile_class():
    body = f"SELECT {KEY}, {r6('r20')} AS r20, r20_class FROM ({class_sql('f', 'r20', 'r20_class')})"
    return with_base(body, stock_ctes() + f",\nf AS (SELECT {KEY}, r20 FROM stock_feat)")


def _label_matrix():
    cols = ", ".join(f"{r6(f'CAST({c} AS DOUBLE) * 0.1')} AS {c}" for c in LABEL_COLUMNS)
    return with_base(f"SELECT {KEY}, {cols} FROM classed", labels_cte() + "," + classes_cte())


# ------------------------------------------------------------ indicators

def fsum(x: str, n: int) -> str:
    """Exact frame sum over the last n rows, NULL until full."""
    fr = frame(-(n - 1), 0)
    return f"(CASE WHEN rn >= {n} THEN sum({x}) OVER {fr} END)"


def lagsum(x: str, n: int) -> str:
    return "(" + " + ".join(x if k == 0 else lag(x, k) for k in range(n)) + ")"


def indicator_ctes(src: str = "clean") -> str:
    close = "(CAST(close_c AS DOUBLE) / 100)"
    vol = "(CAST(volume AS DOUBLE) / 1000000.0)"
    f = {}
    tw = [min(k + 1, 30 - k) for k in range(30)]
    wsum = " + ".join(("close_c" if k == 0 else lag("close_c", k)) + f" * {wt}" for k, wt in enumerate(tw))
    f["trima"] = sq(f"0.1 * (CASE WHEN rn >= 30 THEN sqrt(CAST({wsum} AS DOUBLE) / {float(sum(tw)) * 100!r}) END)")
    ww = [30 - k for k in range(30)]
    wsum = " + ".join(("close_c" if k == 0 else lag("close_c", k)) + f" * {wt}" for k, wt in enumerate(ww))
    f["wma"] = sq(f"0.1 * (CASE WHEN rn >= 30 THEN sqrt(CAST({wsum} AS DOUBLE) / {float(sum(ww)) * 100!r}) END)")
    run = f"({WS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ad_term = ("CAST(CASE WHEN high_c - low_c <> 0 THEN CAST((close_c - low_c) - (high_c - close_c) AS DOUBLE)"
               f" / (high_c - low_c) * {vol} ELSE 0.0 END AS DECIMAL(38,12))")
    f["adline"] = sq(f"0.005 * CAST(sum({ad_term}) OVER {run} AS DOUBLE) - 0.5")
    pc = "_pc"
    obv_term = (f"(CASE WHEN {pc} IS NULL THEN volume WHEN close_c > {pc} THEN volume "
                f"WHEN close_c < {pc} THEN -volume ELSE 0 END)")
    f["obv"] = sq(f"0.001 * (CAST(sum({obv_term}) OVER {run} AS DOUBLE) / 1000000.0)")
    n = 30
    sh, sl = fsum("high_c", n), fsum("low_c", n)
    cov = f"({n} * {fsum('high_c * low_c', n)} - {sh} * {sl})"
    vh = f"CAST({n} * {fsum('high_c * high_c', n)} - {sh} * {sh} AS DOUBLE)"
    vl = f"CAST({n} * {fsum('low_c * low_c', n)} - {sl} * {sl} AS DOUBLE)"
    corr = (f"(CASE WHEN {vh} * {vl} > 0 THEN CAST({cov} AS DOUBLE) / sqrt({vh} * {vl}) "
            f"WHEN rn >= {n} THEN 0.0 END)")
    f["correl"] = clip(f"-3.0 * {corr} + 3.0")
    n = 14
    sx, sxx = n * (n - 1) // 2, n * (n - 1) * (2 * n - 1) // 6
    div = sx * sx - n * sxx
    s_y = fsum("close_c", n)
    s_iy = f"(rn * {s_y} - {fsum('rn * close_c', n)})"
    m = f"(CAST({n} * {s_iy} - {sx} * {s_y} AS DOUBLE) / {div * 100.0!r})"
    b = f"((CAST({s_y} AS DOUBLE) / 100 - {m} * {float(sx)!r}) / {float(n)!r})"
    f["linearreg"] = sq(f"0.1 * ({b} + {m} * 13.0) - 1.0")
    f["lineangle"] = sq(f"0.1 * (atan({m}) * (180.0 / pi()))")
    f["TSF"] = sq(f"2.0 * ({b} + {m} * 14.0)")
    f["lineintercept"] = sq(f"0.05 * {b}")
    n = 5
    sc = fsum("close_c", n)
    var = f"(CAST({n} * {fsum('close_c * close_c', n)} - {sc} * {sc} AS DOUBLE) / 250000.0)"
    f["var"] = sq(f"30.0 * {var}")
    f["stddev"] = clip(f"(CASE WHEN sqrt({var}) >= 0 THEN pow(sqrt({var}), 0.25) END) - 1.0")
    apo = f"(CAST({fsum('close_c', 12)} AS DOUBLE) / 1200.0 - CAST({fsum('close_c', 26)} AS DOUBLE) / 2600.0)"
    f["apo"] = clip(f"0.5 * {apo}")
    fr = frame(-14, 0)
    up = f"(CASE WHEN rn >= 15 THEN 100.0 * (14 - (list_position(list_reverse(list(high_c) OVER {fr}), max(high_c) OVER {fr}) - 1)) / 14.0 END)"
    dn = f"(CASE WHEN rn >= 15 THEN 100.0 * (14 - (list_position(list_reverse(list(low_c) OVER {fr}), min(low_c) OVER {fr}) - 1)) / 14.0 END)"
    f["ardown"] = f"0.02 * {dn} - 1.0"
    f["arup"] = f"0.02 * {up} - 1.0"
    f["arosc"] = f"0.01 * ({up} - {dn})"
    f["bop"] = "(CASE WHEN high_c - low_c <> 0 THEN CAST(close_c - open_c AS DOUBLE) / (high_c - low_c) ELSE 0.0 END)"
    n = 14
    tp = "(high_c + low_c + close_c)"
    s_tp = fsum(tp, n)
    dev = f"list_sum(list_transform(list({tp}) OVER {frame(-13, 0)}, lambda v: abs({n} * v - {s_tp})))"
    f["cci"] = (f"0.004 * (CASE WHEN rn >= {n} THEN (CASE WHEN {dev} <> 0 THEN "
                f"CAST({n} * ({n} * {tp} - {s_tp}) AS DOUBLE) / (0.015 * {dev}) ELSE 0.0 END) END)")
    n = 26
    s_ho = f"CAST({fsum('high_c - open_c', n)} AS DOUBLE) / 100"
    s_ol = f"1.0 + CAST({fsum('open_c - low_c', n)} AS DOUBLE) / 100"
    f["ar"] = f"{sdiv(s_ho, s_ol)} - 1.0"
    f["cr"] = f"CAST({fsum('high_c - low_c', n)} - {fsum('high_c - low_c', n)} AS DOUBLE) / 200.0 - 1.0"
    n = 20
    s_n = fsum(tp, n)
    var_num = f"({n} * {fsum(tp + ' * ' + tp, n)} - {s_n} * {s_n})"
    std = f"sqrt({var_num} / {float(n * (n - 1))!r})"
    f["cci_helper"] = sdiv(f"({n} * {tp} - {s_n}) / {float(n)!r}", f"0.015 * {std}")
    f["force_index"] = f"({close} - CAST({lag('close_c', 13)} AS DOUBLE) / 100) * {vol}"
    lc12 = f"(CAST({lag('close_c', 12)} AS DOUBLE) / 100)"
    f["roc"] = sdiv(f"{close} - {lc12}", lc12)
    f["sunup"] = "(CASE WHEN close_c > open_c THEN 1 ELSE 0 END)"
    f["upratio"] = f"({fsum('CASE WHEN close_c > open_c THEN 1 ELSE 0 END', 20)} / 20.0)"
    feats = ", ".join(f"{v} AS {k}" for k, v in f.items())
    hl = "(CAST(high_c + low_c AS DOUBLE) / 100)"
    r = "(CASE WHEN CAST(high_c - low_c AS DOUBLE) / 100 = 0 THEN 0.0001 ELSE CAST(high_c - low_c AS DOUBLE) / 100 END)"
    evm = sdiv(f"0.5 * ({hl} - {lag(hl)})", f"{vol} / {r}")
    hi_l, lo_l = lag("high_c"), lag("low_c")
    t1 = f"""ind1 AS (
  SELECT *, {feats},
    high_c - {pc} AS _hpc, {pc} - low_c AS _pcl,
    CASE WHEN {hi_l} IS NULL THEN NULL WHEN {hi_l} = 0 THEN 0.0 ELSE CAST(high_c - {hi_l} AS DOUBLE) / {hi_l} END AS _xr,
    CASE WHEN {lo_l} IS NULL THEN NULL WHEN {lo_l} = 0 THEN 0.0 ELSE CAST(low_c - {lo_l} AS DOUBLE) / {lo_l} END AS _yr,
    {evm} AS _evm
  FROM (SELECT *, row_number() OVER ({WS}) AS rn, {lag('close_c')} AS _pc FROM {src}))"""
    n = 26
    g = {}
    s_hpc = f"CAST({lagsum('_hpc', n)} AS DOUBLE) / 100"
    s_pcl = f"1.0 + CAST({lagsum('_pcl', n)} AS DOUBLE) / 100"
    g["br"] = f"(CASE WHEN rn >= {n + 1} THEN {sdiv(s_hpc, s_pcl)} - 1.0 END)"
    n = 5

    def lx(k):
        return "_xr" if k == 0 else lag("_xr", k)

    def ly(k):
        return "_yr" if k == 0 else lag("_yr", k)
    sxs, sys_ = lagsum("_xr", n), lagsum("_yr", n)
    sxx_ = "(" + " + ".join(f"{lx(k)} * {lx(k)}" for k in range(n)) + ")"
    sxy_ = "(" + " + ".join(f"{lx(k)} * {ly(k)}" for k in range(n)) + ")"
    den = f"(5.0 * {sxx_} - {sxs} * {sxs})"
    beta = f"(CASE WHEN rn >= 6 THEN (CASE WHEN {den} <> 0 THEN (5.0 * {sxy_} - {sxs} * {sys_}) / {den} ELSE 0.0 END) END)"
    g["beta"] = sq(beta)
    g["evm"] = f"-({lagsum('_evm', 14)} / 14.0)"
    g["cci_d"] = sq7(sdiv(f"cci - {lag('cci')}", f"0.1 + {lag('cci')}"))
    t2 = f"indicators AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in g.items())} FROM ind1)"
    return t1 + ",\n" + t2


IND_MAIN = ["trima", "wma", "adline", "obv", "beta", "correl", "linearreg", "lineangle", "var",
            "TSF", "lineintercept", "stddev", "apo", "ardown", "arup", "arosc", "bop", "cci", "cci_d"]
IND_GROUPS = {
    "trima": ["trima"], "wma": ["wma"], "adline": ["adline"], "obv": ["obv"], "beta": ["beta"],
    "correl": ["correl"], "linreg": ["linearreg", "lineangle", "TSF", "lineintercept"],
    "var_std": ["var", "stddev"], "apo": ["apo"], "aroon": ["ardown", "arup", "arosc"], "bop": ["bop"],
    "cci": ["cci", "cci_d"], "arbr": ["ar", "br", "cr"], "helper_cci": ["cci_helper"], "evm": ["evm"],
    "force_index": ["force_index"], "roc": ["roc"], "up_ratio": ["sunup", "upratio"],
}


def _ind_group(cols):
    return lambda: with_base(select_out("indicators", cols, types={"sunup": None}), indicator_ctes())


SQL = {
    "scan_bars": _scan_bars,
    "clean_bars": _clean_bars,
    "rolling_mean": _rolling_mean,
    "ma_class": _ma_class,
    "valuation_features": _valuation,
    **{k: _stock_group(v) for k, v in STOCK_GROUPS.items()},
    "w_lag": _w_lag,
    "w_lead": _w_lead,
    "w_diff": _w_diff,
    "rolling_extrema": _rolling_extrema,
    "forward_extrema": _forward_extrema,
    "centered_mean": _centered_mean,
    "w_rolling_sum": _w_rolling_sum,
    "clip_values": _clip_values,
    "squash": _squash,
    "ts_rank": _arr(_ts_rank_expr, "ts_rank10"),
    "decay_linear": _decay_linear,
    "high_day": _arr(_high_day_expr, "high_day10"),
    "low_day": _arr(_low_day_expr, "low_day10"),
    "scan_index": _scan_index,
    **{k: _index_group(v) for k, v in INDEX_GROUPS.items()},
    "index_enrich": _index_enrich,
    "index_volume_joined": _index_volume_joined,
    "label_return": _labels_q([f"result{h}" for h in HORIZONS]),
    "label_extrema": _labels_q([f"{p}{h}" for h in HORIZONS for p in ("resultmax", "resultmin", "resultrel")]),
    "label_buy_score": _labels_q([f"resultbuy{h}" for h in (4, 7, 10)], ints=[f"resultbuy{h}" for h in (4, 7, 10)]),
    "label_return_class": _labels_q([f"resultclass{h}" for h in HORIZONS],
                                    ints=[f"resultclass{h}" for h in HORIZONS], classes=True),
    "label_skew_class": _labels_q([f"resultrelclass{h}" for h in HORIZONS],
                                  ints=[f"resultrelclass{h}" for h in HORIZONS], classes=True),
    "quantile_edges": _quantile_edges,
    "quantile_class": _quantile_class,
    "label_matrix": _label_matrix,
    **{k: _ind_group(v) for k, v in IND_GROUPS.items()},
}


# ------------------------------------------------------------ S*, P*, O*, A4

PREFIX = "CASE WHEN starts_with(symbol, '6') THEN 'sh.' || symbol ELSE 'sz.' || symbol END"


def _p_change():
    prev = f"(CAST({lag('close_c')} AS DOUBLE) / 100)"
    pc = sdiv(f"10.0 * ((CAST(close_c AS DOUBLE) / 100) - {prev})", prev)
    return with_base(f"SELECT {KEY}, {r6(pc)} AS p_change FROM bars WHERE volume > 0")


def _scan_unadjusted():
    px = ", ".join(f"{r6(f'CAST({p}_c AS DOUBLE) / 100')} AS {p}" for p in ("open", "high", "low", "close"))
    return with_base(f"""SELECT {KEY}, {PREFIX} AS code, {px},
  {r6(f"CAST({lag('close_c')} AS DOUBLE) / 100")} AS preclose, volume,
  {r6('CAST(amount_c AS DOUBLE) / 100')} AS amount FROM bars""")


SIMPLE = {
    "symbol_master": f"SELECT symbol, {PREFIX} AS code FROM symbols ORDER BY symbol",
    "exchange_prefix": f"SELECT symbol, {PREFIX} AS code FROM (SELECT DISTINCT symbol FROM clean)",
    "incremental_symbols": "SELECT symbol FROM symbols WHERE symbol NOT IN (SELECT symbol FROM stored_symbols)",
    "symbols_present": f"SELECT {KEY}, close_c FROM clean WHERE symbol IN (SELECT symbol FROM stored_symbols)",
    "exclude_board": "SELECT symbol FROM symbols WHERE substr(symbol, 1, 3) <> '688'",
    "min_history": """SELECT symbol, count(*) AS n_rows FROM clean
  WHERE symbol IN (SELECT symbol FROM raw_bars GROUP BY symbol HAVING count(*) > 50)
  GROUP BY symbol HAVING count(*) > 450""",
    "symbol_counts": "SELECT symbol, count(*) AS n_rows FROM clean GROUP BY symbol",
    "warmup_trim": f"SELECT {KEY}, close_c FROM (SELECT *, row_number() OVER ({WS}) AS rn FROM clean) WHERE rn > 120",
    "stride_sample": f"SELECT {KEY}, close_c FROM (SELECT *, row_number() OVER ({WS}) AS rn FROM clean) WHERE (rn - 1) % 3 = 0",
    "first_symbols": "SELECT symbol FROM symbols ORDER BY symbol LIMIT 2",
    "tail_rows": f"""SELECT {KEY}, close_c FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS back FROM clean) WHERE back <= 100""",
    "symbol_chunks": """SELECT symbol, CAST(floor((row_number() OVER (ORDER BY symbol) - 1) / 1000) AS BIGINT) AS chunk
  FROM (SELECT DISTINCT symbol FROM clean)""",
}


def _simple(sql):
    return lambda: with_base(sql)


def _relative_labels():
    wi = "PARTITION BY index_code ORDER BY trade_date"
    ic = "(CAST(close_c AS DOUBLE) / 100)"
    szs = []
    for n in (1, 2, 4, 8, 15, 30):
        prev = f"(CAST({lag('close_c', n, wi)} AS DOUBLE) / 100)"
        szs.append(f"({sdiv('40.0 * ' + ic, prev)} - 40.0) AS szpctchg{n}")
    idx_fwd = sdiv(f"CAST({lead('close_c', 5, wi)} AS DOUBLE) / 100", ic)
    fwd = sdiv(f"CAST({lead('close_c', 5)} AS DOUBLE) / 100", ic)
    amount = "0.25 * (CAST(open_c + close_c + high_c + low_c AS DOUBLE) / 100.0) * volume"
    extra = f"""ix AS (SELECT trade_date, {idx_fwd} AS _idx_fwd, {', '.join(szs)} FROM index_bars),
rl AS (SELECT c.*, {amount} AS amount2, {fwd} AS _fwd FROM clean c),
rj AS (SELECT rl.*, rl._fwd - ix._idx_fwd AS result, ix.* EXCLUDE (trade_date, _idx_fwd)
       FROM rl LEFT JOIN ix USING (trade_date))"""
    cols = ["amount", "result", *[f"szpctchg{n}" for n in (1, 2, 4, 8, 15, 30)]]
    body = f"""SELECT {KEY}, {', '.join(f'{r6(c)} AS {c}' for c in cols)}, resultclass
FROM ({class_sql('(SELECT * EXCLUDE (amount) RENAME (amount2 AS amount) FROM rj)', 'result', 'resultclass')})
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in cols)} AND resultclass IS NOT NULL"""
    return with_base(body, extra)


# ------------------------------------------------------------ D*, U*, E*

def dlit(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


SEQ_COLUMNS = ["close", "open", "low", "high", "zsr5", "r5", "r20", "v5"]


def seq_ctes(columns=tuple(SEQ_COLUMNS)) -> str:
    """sb (rows of the stored table), ends, win and splits of windows of 10 rows."""
    from panelkit.plans.oracle_full import feature_table_sql
    return f"""sb0 AS (SELECT * FROM ({feature_table_sql([*columns, *LABEL_COLUMNS])}) ft),
sb AS (SELECT *, row_number() OVER ({WS}) AS n2, lead(trade_date) OVER ({WS}) AS nxt,
              {", ".join(f"CAST({lead(c)} AS DOUBLE) * 0.1 AS y_{c}" for c in LABEL_COLUMNS)} FROM sb0),
ends AS (SELECT *, trade_date AS end_date FROM sb WHERE n2 >= 10 AND nxt IS NOT NULL),
splits AS (SELECT *, CASE WHEN back <= 10 THEN 'predict' WHEN back <= 100 THEN 'test' ELSE 'train' END AS split
           FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY end_date DESC) AS back FROM ends)),
win AS (SELECT e.symbol, e.end_date, e.split, CAST(b.n2 - (e.n2 - 9) AS BIGINT) AS pos, b.* EXCLUDE (symbol)
        FROM splits e JOIN sb b ON b.symbol = e.symbol AND b.n2 BETWEEN e.n2 - 9 AND e.n2)"""


SKEY = "symbol, end_date, pos"


def _seq(body):
    return lambda: with_base(body, seq_ctes())


def _sequence_all():
    from panelkit.plans.oracle_full import feature_table_sql, stored_columns
    names = stored_columns()
    parts = []
    for seq in (10, 50):
        # sum over the window of (place + 1) x value = sum of (n2 - first + 1) x value
        fr = frame(-(seq - 1), 0)
        cols = ", ".join(f'{r6(f"""sum(n2 * "{c}") OVER {fr} - (n2 - {seq}) * sum("{c}") OVER {fr}""")} AS "{c}"' for c in names)
        parts.append(f"SELECT * EXCLUDE (n2, nxt) FROM (SELECT symbol, trade_date AS end_date, {seq} AS seq, n2, nxt, {cols} FROM s1) WHERE n2 >= {seq} AND nxt IS NOT NULL")
    return (f"WITH s0 AS (SELECT * FROM ({feature_table_sql()}) ft), s1 AS (SELECT *, row_number() OVER ({WS}) AS n2, lead(trade_date) OVER ({WS}) AS nxt FROM s0) "
            + " UNION ALL ".join(parts))


def _fit_predict():
    from panelkit.plans.oracle_full import stored_columns
    names = stored_columns()
    null = " OR ".join(f'"{c}" IS NULL' for c in names)
    pairs = ", ".join(f"('{c}', y_{c})" for c in LABEL_COLUMNS)
    return with_base(f"""SELECT s.symbol, s.end_date, s.split, u.label, {r6('u.truth')} AS truth, CAST(NOT nulls AS INTEGER) AS predicted
FROM (SELECT s.*, f.nulls FROM splits s JOIN (SELECT symbol, trade_date, bool_or({null}) OVER {frame(-9, 0)} AS nulls FROM sb) f
        ON f.symbol = s.symbol AND f.trade_date = s.end_date) s, LATERAL (VALUES {pairs.replace('y_', 's.y_')}) u(label, truth)
WHERE s.split <> 'train'""", seq_ctes(names))


def _fit_constant():
    whole = " AND ".join(f"y_{c} IS NOT NULL" for c in LABEL_COLUMNS)
    pairs = ", ".join(f"('{c}', s.y_{c})" for c in LABEL_COLUMNS)
    return with_base(f"""SELECT label, CAST(round(100 * avg(abs(y - m))) AS BIGINT) AS error_percent, count(*) AS n_windows
FROM (SELECT label, y, median(y) OVER (PARTITION BY label) AS m FROM (SELECT u.label, u.y FROM (SELECT s.* FROM splits s JOIN win w ON w.symbol = s.symbol AND w.end_date = s.end_date WHERE w.pos = 0 AND s.split = 'train' AND {whole.replace('y_', 's.y_')}
       AND NOT EXISTS (SELECT 1 FROM sb x WHERE x.symbol = s.symbol AND x.n2 BETWEEN s.n2 - 9 AND s.n2 AND x.close IS NULL)) s, LATERAL (VALUES {pairs}) u(label, y)) t)
GROUP BY label""", seq_ctes())


def first_in_window(c: str) -> str:
    return f"first_value({c}) OVER (PARTITION BY symbol, end_date ORDER BY pos)"


def _anchor_sql() -> str:
    fc = first_in_window("close")
    cols = ", ".join(f"{r6(f'10.0 * {p} / (0.01 + {fc}) - 10.0')} AS {p}" for p in ("close", "open", "high", "low"))
    return f"SELECT {SKEY}, trade_date, {cols} FROM win"


def _norm_rows_sql() -> str:
    cols = ", ".join(f"{r6(f'1.0 * {c} / NULLIF({first_in_window(c)}, 0) - 1.0')} AS {c}" for c in ("close", "v5"))
    return f"SELECT {SKEY}, trade_date, {cols} FROM win"


def _sequence_norm():
    """Every stored column at both scales: the ten places' terms added in order, from lags."""
    from panelkit.plans.oracle_full import feature_table_sql, stored_columns
    names = stored_columns()

    def back(c, k):
        return f'lag("{c}", {k}) OVER ({WS})' if k else f'"{c}"'

    lags = ", ".join(f'{back(c, k)} AS "{c}_{k}"' for c in names for k in range(10))
    parts = []
    for scale in ("1", "10"):
        cols = []
        for c in names:
            terms = [f'{p + 1} * ({scale}.0::DOUBLE * "{c}_{9 - p}" / NULLIF("{c}_9", 0) - {scale}.0::DOUBLE)' for p in range(10)]
            cols.append(f'{r6(" + ".join(terms))} AS "{c}"')
        parts.append(f"SELECT symbol, trade_date AS end_date, {scale} AS scale, {', '.join(cols)} FROM s2 WHERE n2 >= 10 AND nxt IS NOT NULL")
    return (f"WITH s0 AS (SELECT * FROM ({feature_table_sql()}) ft), s2 AS (SELECT symbol, trade_date, row_number() OVER ({WS}) AS n2, lead(trade_date) OVER ({WS}) AS nxt, {lags} FROM s0) "
            + " UNION ALL ".join(parts))


def _all_features(body):
    """A query on the sequence CTEs over every stored column."""
    def sql():
        from panelkit.plans.oracle_full import stored_columns
        names = stored_columns()
        null = " OR ".join(f'"{c}" IS NULL' for c in names)
        rejected = f"SELECT symbol, CAST(max(CASE WHEN split = 'train' AND ({null}) THEN 1 ELSE 0 END) AS INTEGER) AS rejected FROM win GROUP BY symbol"
        return with_base(body.format(rejected=rejected), seq_ctes(names))
    return sql


COLLECTED = """SELECT symbol, split, count(*) AS n_windows FROM splits
WHERE symbol IN (SELECT symbol FROM stored_symbols)
  AND symbol IN (SELECT symbol FROM sb0 GROUP BY symbol HAVING count(*) > 300)
  AND symbol NOT IN (SELECT symbol FROM ({rejected}) WHERE rejected = 1)
GROUP BY symbol, split"""
SEQ_SQL = {
    "sequence_windows": f"SELECT {SKEY}, trade_date, {r6('close')} AS close, {r6('r5')} AS r5, {r6('v5')} AS v5 FROM win",
    "sequence_anchor": _anchor_sql(),
    "sequence_norm_rows": _norm_rows_sql(),
    "sequence_labels": f"SELECT symbol, end_date, {r6('y_resultclass4')} AS label FROM ends",
    "chrono_split": "SELECT symbol, end_date, split FROM splits",
    "union_windows": f"SELECT symbol, end_date, split, {r6('close')} AS close, {r6('y_resultclass4')} AS label FROM splits",
    "union_predictions": f"SELECT symbol, end_date, split, {r6('0.5 + 0.4 * r20')} AS prediction FROM splits WHERE split IN ('test', 'predict')",
}


def metrics_ctes() -> str:
    """ev (thresholded test windows, one row per label) and mets (one row per label)."""
    t1 = dlit(0.75 * 0.7)
    pairs = ", ".join(f"('{c}', s.y_{c})" for c in LABEL_COLUMNS)

    def ratio(a, b):
        return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"
    return seq_ctes() + f""",
el AS (SELECT s.symbol, s.end_date, 0.5 + 0.4 * s.r20 AS prediction, u.label, u.truth
       FROM splits s, LATERAL (VALUES {pairs}) u(label, truth) WHERE s.split = 'test'),
ev AS (SELECT *, CAST(prediction > 0.7 AS INTEGER) AS p1, CAST(truth > {t1} AS INTEGER) AS t1
       FROM el WHERE prediction IS NOT NULL AND truth IS NOT NULL),
agg AS (SELECT label, count(*) AS n, avg(abs(prediction - truth)) AS mae,
               avg((prediction - truth) * (prediction - truth)) AS mse,
               sum(p1) AS np1, sum(t1) AS nt1, sum(p1 * t1) AS b1, sum((1 - p1) * (1 - t1)) AS b0 FROM ev GROUP BY label),
mets AS (
  SELECT *, sqrt(mse) AS rmse,
    ({ratio("b1", "nt1")} * pres1 + {ratio("b0", "n - nt1")} * pres0) / (pres1 + pres0) AS ref_precision,
    ({ratio("b1", "np1")} * pres1 + {ratio("b0", "n - np1")} * pres0) / (pres1 + pres0) AS precision,
    (np1 * {ratio("2.0 * b1", "np1 + nt1")} + (n - np1) * {ratio("2.0 * b0", "(n - np1) + (n - nt1)")}) / n AS ref_f1_weighted,
    (nt1 * {ratio("2.0 * b1", "np1 + nt1")} + (n - nt1) * {ratio("2.0 * b0", "(n - np1) + (n - nt1)")}) / n AS f1_weighted,
    CASE WHEN np1 > 0 THEN b1 / np1 END AS topacc
  FROM (SELECT *, CAST(np1 + nt1 > 0 AS INTEGER) AS pres1, CAST((n - np1) + (n - nt1) > 0 AS INTEGER) AS pres0 FROM agg))"""


def _eval(cols):
    sel = ", ".join(c if c == "n" else f"{r6(c)} AS {c}" for c in cols)
    return lambda: with_base(f"SELECT label, {sel} FROM mets", metrics_ctes())


def series_ctes() -> str:
    return stock_ctes() + ",\n" + labels_cte("stock_feat") + ",\n" + classes_cte() + f""",
eb AS (SELECT symbol, trade_date, CAST(close_c AS DOUBLE) / 100 AS close, 0.5 + 0.4 * r20 AS prediction,
              CAST(resultclass4 AS DOUBLE) * 0.1 AS truth FROM classed)"""


def _series_long():
    fr = frame(-4, 5)
    cm = f"CASE WHEN count(close) OVER {fr} = 10 THEN avg(close) OVER {fr} END"
    parts = [f"SELECT {KEY}, '{c}' AS series, {r6(c)} AS value FROM eb2" for c in ("close", "cmean10", "prediction", "truth")]
    return with_base(" UNION ALL ".join(parts), series_ctes() + f",\neb2 AS (SELECT *, {cm} AS cmean10 FROM eb)")


def _eval_threshold():
    return with_base("SELECT symbol, end_date, label, p1 AS pred_class, t1 AS true_class FROM ev", metrics_ctes())


EVAL_SQL = {
    "eval_mae": _eval(["n", "mae"]),
    "eval_rmse": _eval(["rmse"]),
    "eval_confusion": _eval(["ref_precision", "precision", "ref_f1_weighted", "f1_weighted"]),
    "eval_topacc": _eval(["topacc"]),
    "eval_threshold": _eval_threshold,
    "series_long": _series_long,
}


# ------------------------------------------------------------ feeds with missing fields

def missing_ctes() -> str:
    gone = {"peTTM": 31, "volume": 43, "low": 41, "high": 47, "psTTM": 53}
    cols = []
    for c in ("close", "open", "low", "high", "turn", "volume", "amount", "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST"):
        e = f"r.{c}"
        if c in gone:
            e = f"CASE WHEN b._q % {gone[c]} = 0 THEN NULL ELSE {e} END"
        if c == "pbMRQ":
            e = f"CASE WHEN b._q % 37 = 0 THEN '' ELSE {e} END"
        if c == "turn":
            e = f"CASE WHEN b._q % 59 = 0 THEN 'n/a' ELSE {e} END"
        cols.append(f"{e} AS {c}")

    def num(c):
        return f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0)"
    return f"""raw_missing AS (SELECT r.symbol, r.date, {", ".join(cols)} FROM raw_bars r JOIN bars b ON b.symbol = r.symbol AND CAST(b.trade_date AS VARCHAR) = r.date),
clean_missing AS (
  SELECT * FROM (
    SELECT symbol, CAST(date AS DATE) AS trade_date, {", ".join(f"CAST(round({num(p)} * 100) AS BIGINT) AS {p}_c" for p in ("open", "high", "low", "close"))},
           CAST({num("volume")} AS BIGINT) AS volume, {", ".join(f"{num(c)} AS {c}" for c in ("turn", "amount", "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST"))}
    FROM raw_missing WHERE volume IS NULL OR volume NOT IN ('0', '')) WHERE psTTM > 0)"""


def _unreadable():
    fields = ("close", "open", "low", "high", "turn", "volume", "amount", "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST")
    return with_base(" UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS n_null, count(*) FILTER ({c} = '') AS n_blank, "
        f"count(*) FILTER ({c} <> '' AND TRY_CAST({c} AS DOUBLE) IS NULL) AS n_unreadable FROM raw_missing" for c in fields), missing_ctes())


def _clean_index():
    return with_base(f"""SELECT {IKEY}, open_c, high_c, low_c, close_c, volume, {r6("CAST(amount_c AS DOUBLE) / 100")} AS amount FROM index_bars
WHERE (trade_date - DATE '1970-01-01') % 53 <> 0 AND (trade_date - DATE '1970-01-01') % 59 <> 0 AND volume <> 0
  AND (SELECT count(*) FROM index_bars) > 50""")


GATED = """gated AS (
  SELECT * FROM clean
  WHERE symbol IN (SELECT symbol FROM raw_bars GROUP BY symbol HAVING count(*) > 50)
    AND symbol IN (SELECT symbol FROM clean GROUP BY symbol HAVING count(*) > 300))"""


def _labels_h69():
    h = (2, 4, 6, 9)
    names = [f"resultbuy{i}" for i in h if i > 2] + [f"result{k}class{i}" for i in h for k in ("", "rel")]
    doubles = [f"result{m}{i}" for i in h for m in ("max", "min")]
    sel = ", ".join([*names, *[f"{r6(c)} AS {c}" for c in doubles]])
    return with_base(f"SELECT {KEY}, CAST(close_c AS DOUBLE) / 100 AS close, {sel} FROM classed",
                     ",\n".join([GATED, labels_cte("gated", horizons=h), classes_cte(horizons=h)]))


def _labels_train_edges():
    return with_base(f"SELECT {KEY}, {', '.join(LABEL_COLUMNS)} FROM classed",
                     ",\n".join([GATED, labels_cte("gated"), classes_cte(seen="trade_date <= DATE '1996-06-30'")]))


def _feature_sink():
    from panelkit.plans.oracle_full import feature_table_sql
    return f"""WITH ft AS (SELECT * FROM ({feature_table_sql(["close"])}) x), st AS ({with_base("SELECT symbol FROM stored_symbols")})
SELECT symbol, count(*) AS n_rows, CASE WHEN symbol IN (SELECT symbol FROM st) THEN 0 ELSE 1 END AS run, count(*) AS n_stored FROM ft GROUP BY symbol"""


def _feature_catalog():
    from panelkit.plans.oracle_full import feature_table_sql, stored_columns
    ints = set(LABEL_COLUMNS)
    names = [*stored_columns(), *LABEL_COLUMNS]
    parts = [f"""SELECT {i + 2} AS position, '{c}' AS name, '{"bigint" if c in ints else "double"}' AS dtype, count("{c}") AS non_null FROM ft""" for i, c in enumerate(names)]
    return f"WITH ft AS (SELECT * FROM ({feature_table_sql()}) x) " + " UNION ALL ".join(parts)


MORE_SQL = {
    "clean_bars_missing": lambda: with_base(select_out("clean_missing", ["open_c", "high_c", "low_c", "close_c", "volume", "turn", "amount", "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST"],
                                                       types={c: None for c in ("open_c", "high_c", "low_c", "close_c", "volume")}), missing_ctes()),
    "unreadable_fields": _unreadable,
    "valuation_missing": lambda: with_base(select_out("val", ["flowmkt", "everyprofit", "turn", "everypb", "eversale", "evermoney"]), missing_ctes() + f", val AS ({valuation_sql('clean_missing')})"),
    "beta_missing": lambda: with_base(select_out("indicators", ["beta"]), missing_ctes() + ", " + indicator_ctes("clean_missing")),
    "clean_index": _clean_index,
    "labels_h69": _labels_h69,
    "labels_train_edges": _labels_train_edges,
    "feature_sink": _feature_sink,
    "feature_catalog": _feature_catalog,
    "sequence_all": _sequence_all,
    "sequence_norm": _sequence_norm,
    "reject_null_symbols": _all_features("{rejected}"),
    "collect_panel": _all_features(COLLECTED),
    "fit_predict": _fit_predict,
    "fit_constant": _fit_constant,
}


def oracle() -> dict[str, str]:
    from panelkit.plans import oracle_full, oracle_recur
    from panelkit.plans.features import STOCK_COLUMNS
    merged = {"feature_table": oracle_full.feature_table_sql,
              "export_dataset": oracle_full.feature_table_sql,
              "load_features": oracle_full.load_features_sql,
              "stock_features": lambda: oracle_full.feature_table_sql(["close", "open", "low", "high", *STOCK_COLUMNS]),**SQL, **oracle_recur.SQL, "p_change": _p_change, "scan_unadjusted": _scan_unadjusted,
              "relative_labels": _relative_labels, **{k: _simple(v) for k, v in SIMPLE.items()},
              **{k: _seq(v) for k, v in SEQ_SQL.items()}, **EVAL_SQL, **MORE_SQL}
    return {k: v() for k, v in merged.items()}
