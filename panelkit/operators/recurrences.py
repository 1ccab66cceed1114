"""Recurrence indicators.

The linear ones are native block scans.  For ``y = a * y[-1] + u`` the value
is ``a^p * sum(u * a^-p)`` over the rows so far, one running sum in Spark.
Histories are cut into blocks of ``BLOCK`` rows that also hold the ``HALO``
rows before them: a start value of any kind weighs ``a^HALO`` there, below
1e-25 for every period used, beyond what a double can hold, so a block needs
nothing from the blocks before its halo and no task holds a whole history.
Chains (the average of an average) are one scan after the other on the same
sorted blocks.  Seeds lie in a history's first rows, which the first blocks
see whole.

The parabolic stop (T18) is a scan of running extremes and of steps between two
phases, which compose over segments (``stop_column``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import clip1, sq
from panelkit.functions import sql as E
from panelkit.plans import segments as G

# Periods of the recurrence indicators.
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
TEMA_N, T3_N, NATR_N, ADX_N = 30, 5, 14, 14
ADOSC_FAST, ADOSC_SLOW = 3, 10
LOWPASS_WN, LOWPASS_PAD = 0.1, 6
VOLUME_SCALE = 1e6
TINY = 1e-8  # the library's zero test

# Rows of a block and of its halo.  Powers run over +-BLOCK rows: 0.5^-900 still fits a double.
BLOCK = HALO = 900
CUT = 10  # T34: bars left out of the refitted filter


def _k(n: int) -> float:
    return 2.0 / (n + 1)


def lowpass_coefficients(wn: float = LOWPASS_WN):
    """First-order Butterworth low-pass by the bilinear transform (fs = 2):
    returns (b0, b1, a1) for ``y = b0*x + b1*x[-1] - a1*y[-1]``."""
    warped = 4.0 * math.tan(math.pi * wn / 2.0)
    b0 = warped / (4.0 + warped)
    a1 = (warped - 4.0) / (4.0 + warped)
    return b0, b0, a1


# ---------------------------------------------------------------- block scans


def block_spec(key: str) -> str:
    return f"PARTITION BY {key}, _seg ORDER BY trade_date"


def blocks(df: DataFrame, key: str, fwd: int = 0, size: str | None = None) -> DataFrame:
    """Rows dealt to blocks with halos; adds ``_grn`` (row of the key), ``_seg``, ``_home`` and ``_p``, the
    place in the block counted from its middle.  ``size``: the column with the key's number of rows, if there is one."""
    numbered = df if "_grn" in df.columns else G.row_numbers(df, key)
    cut = G.segment(numbered, BLOCK, back=HALO, fwd=fwd, size=size)
    return cut.selectExpr("*", f"CAST({E.over('row_number()', block_spec(key))} - {BLOCK} AS DOUBLE) AS _p")


def scan(u: str, a: float, ws: str, p: str = "_p") -> str:
    """``y = a * y[-1] + u``, from 0 before the block's first row."""
    return f"(pow({E.d(a)}, {p}) * {E.running_sum(f'({u}) * pow({E.d(a)}, -{p})', ws)})"


def seeded(x: str, seed: str, row: int, k: float) -> str:
    """The inputs of an average with weight ``k`` that starts with ``seed`` at the key's ``row``.

    Where a block starts later, its first value stands in for what came before.
    """
    return (f"CASE WHEN _grn < {row} THEN 0.0D WHEN _grn = {row} THEN {seed} "
            f"WHEN _p = {E.d(1 - BLOCK)} THEN {x} ELSE {E.d(k)} * ({x}) END")


def _mean(total: str, n: int, ws: str, scale: float = 1.0) -> str:
    """Mean of the last ``n`` rows from a running sum."""
    return f"(({total} - coalesce({E.lag(total, n, ws)}, 0)) / {E.d(n * scale)})"


def _ema(x: str, seed: str, row: int, n: int, ws: str) -> str:
    return scan(seeded(x, seed, row, _k(n)), 1.0 - _k(n), ws)


def _wilder(x: str, seed: str, row: int, n: int, ws: str, k: float | None = None) -> str:
    return scan(seeded(x, seed, row, 1.0 / n if k is None else k), 1.0 - 1.0 / n, ws)


def _shown(x: str, row: int) -> str:
    return f"CASE WHEN _grn >= {row} THEN {x} END"


def _macd(ws):
    c, s = E.price("close_c"), MACD_SLOW
    return [
        {"_cs": E.running_sum("close_c", ws)},
        {"_f": _ema(c, _mean("_cs", MACD_FAST, ws, 100.0), s, MACD_FAST, ws), "_s": _ema(c, _mean("_cs", MACD_SLOW, ws, 100.0), s, MACD_SLOW, ws)},
        {"_d": _shown("_f - _s", s)},
        {"_ds": E.running_sum("_d", ws)},
        {"_g": _ema("_d", _mean("_ds", MACD_SIGNAL, ws), s + MACD_SIGNAL - 1, MACD_SIGNAL, ws)},
        {"_dif": _shown("_d", s + MACD_SIGNAL - 1), "_dea": _shown("_g", s + MACD_SIGNAL - 1), "_hist": _shown("_d - _g", s + MACD_SIGNAL - 1)},
        {"_hist_chg": f"_hist - {E.lag('_hist', 1, ws)}"},
    ]


def _triple(ws, n, names, out, row, combine):
    """Three averages in a chain, each seeded by the mean of its input's first ``n`` values."""
    a, b, c = names
    first = [n, 2 * n - 1, 3 * n - 2]
    return [
        {f"{a}s": E.running_sum("close_c", ws)},
        {a: _ema(E.price("close_c"), _mean(f"{a}s", n, ws, 100.0), first[0], n, ws)},
        {f"{b}s": E.running_sum(_shown(a, first[0]), ws)},
        {b: _ema(a, _mean(f"{b}s", n, ws), first[1], n, ws)},
        {f"{c}s": E.running_sum(_shown(b, first[1]), ws)},
        {c: _ema(b, _mean(f"{c}s", n, ws), first[2], n, ws)},
        {out: _shown(combine, row)},
    ]


def _tema(ws):
    return _triple(ws, TEMA_N, ("_e1", "_e2", "_e3"), "_tema", 3 * TEMA_N - 2, "_e3 + (3.0D * _e1 - 3.0D * _e2)")


def _t3(ws):
    return _triple(ws, T3_N, ("_t1", "_t2", "_t3c"), "_t3", 6 * (T3_N - 1) + 1, "_t3c")


def _true_range(ws):
    pc = E.lag("close_c", 1, ws)
    return f"CASE WHEN {pc} IS NOT NULL THEN CAST(greatest(high_c - low_c, abs(high_c - {pc}), abs(low_c - {pc})) AS DOUBLE) END"


def _natr(ws):
    n = NATR_N
    return [
        {"_tr": _true_range(ws)},
        {"_trs": E.running_sum("_tr", ws)},
        {"_atr": _wilder("coalesce(_tr, 0.0D)", f"_trs / {E.d(n)}", n + 1, n, ws)},
        {"_natr": _shown("CASE WHEN close_c <> 0 THEN _atr / close_c * 100.0D ELSE 0.0D END", n + 1)},
    ]


def _adosc(ws):
    """The line may start anywhere: a constant shifts both averages alike."""
    term = (f"CASE WHEN high_c - low_c > 0 THEN CAST((close_c - low_c) - (high_c - close_c) AS DOUBLE) / (high_c - low_c)"
            f" * (volume / {E.d(VOLUME_SCALE)}) ELSE 0.0D END")
    return [
        {"_line": E.running_sum(term, ws)},
        {"_af": _ema("_line", "_line", 1, ADOSC_FAST, ws), "_as": _ema("_line", "_line", 1, ADOSC_SLOW, ws)},
        {"_adosc": _shown("_af - _as", ADOSC_SLOW)},
    ]


def _adx(ws):
    n = ADX_N
    up, down = f"(high_c - {E.lag('high_c', 1, ws)})", f"({E.lag('low_c', 1, ws)} - low_c)"
    sums = {x: _wilder(f"coalesce({x}0, 0.0D)", f"{x}t", n, n, ws, k=1.0) for x in ("_pdm", "_mdm", "_wtr")}
    total = "(100.0D * (_mdm / _wtr) + 100.0D * (_pdm / _wtr))"
    zero = f"abs(_wtr) < {E.d(TINY)}"
    return [
        {"_pdm0": f"CAST(CASE WHEN {up} > 0 AND {up} > {down} THEN {up} ELSE 0 END AS DOUBLE)",
         "_mdm0": f"CAST(CASE WHEN {down} > 0 AND {up} < {down} THEN {down} ELSE 0 END AS DOUBLE)", "_wtr0": _true_range(ws)},
        {f"{x}t": E.running_sum(f"{x}0", ws) for x in ("_pdm", "_mdm", "_wtr")},
        sums,
        {"_dx": f"CASE WHEN _grn <= {n} OR {zero} THEN NULL WHEN abs({total}) < {E.d(TINY)} THEN NULL "
                f"ELSE 100.0D * (abs(100.0D * (_mdm / _wtr) - 100.0D * (_pdm / _wtr)) / {total}) END"},
        # a day without a reading leaves the average as it is: the scan's place counts readings only
        {"_dxs": E.running_sum("_dx", ws), "_q": f"CAST({E.over('count(_dx)', ws, E.rows('u', 0))} - {BLOCK} AS DOUBLE)"},
        {"_dxa": scan(f"CASE WHEN _grn < {2 * n} THEN 0.0D WHEN _grn = {2 * n} THEN coalesce(_dxs, 0.0D) / {E.d(n)} WHEN _dx IS NULL THEN 0.0D "
                      f"WHEN _q = {E.d(1 - BLOCK)} THEN _dx ELSE _dx / {E.d(n)} END", 1.0 - 1.0 / n, ws, "_q")},
        {"_adx": _shown("_dxa", 2 * n)},
        {"_adxr": _shown(f"(_adx + {E.lag('_adx', n - 1, ws)}) / 2.0D", 3 * n - 1)},
    ]


#: By group: the stages and the raw columns they give.
GROUPS = {
    "macd": (_macd, ["_dif", "_dea", "_hist", "_hist_chg"]), "tema": (_tema, ["_tema"]), "t3": (_t3, ["_t3"]),
    "natr": (_natr, ["_natr"]), "adosc": (_adosc, ["_adosc"]), "adx": (_adx, ["_adx", "_adxr"]),
}
RAW_COLUMNS = ["_dif", "_dea", "_hist", "_hist_chg", "_tema", "_t3", "_natr", "_adosc", "_adx", "_adxr", "_sar"]


def linear_columns(df: DataFrame, which=tuple(GROUPS), key: str = "symbol") -> DataFrame:
    """``df`` with the raw columns of the wanted groups: one exchange to (key, block), one sort, scans on it."""
    ws = block_spec(key)
    t = blocks(df, key)
    stages = [GROUPS[g][0](ws) for g in which]
    for i in range(max(map(len, stages))):  # the groups' i-th stages share one projection
        t = t.selectExpr("*", *E.alias({k: v for s in stages if i < len(s) for k, v in s[i].items()}))
    out = [c for g in which for c in GROUPS[g][1]]
    return t.filter("_home").select(*df.columns, *out)


# ---------------------------------------------------------------- the stop


def stop_column(df: DataFrame, key: str = "symbol", rows: int = G.SEG_ROWS, part: str = "_part") -> DataFrame:
    """``df`` with the parabolic stop, acceleration 0 (``_sar``, from the key's second row on).

    Without acceleration the stop of a long phase stays at the lowest low so far and that of a short phase at the
    highest high so far: a phase begins where the price passes the extreme of all rows before, so each new extreme
    point is one of the whole history.  A row that only passes the low makes the phase short, one that only passes
    the high makes it long, one that does both turns it round, others leave it.  Running extremes and such steps
    compose, so segments of ``rows`` rows are scanned apart: what a segment needs of those before it are two
    extremes and one phase, from tables of one row a segment.  (Of the first row only the start's stop counts.)
    ``part``: what a segment's number is called.
    """
    ws = f"PARTITION BY {key}, {part} ORDER BY trade_date"
    so_far, before = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    earlier = f"OVER (PARTITION BY {key} ORDER BY {part} {before})"
    numbered = df if "_grn" in df.columns else G.row_numbers(df, key)
    t = numbered.withColumn(part, F.floor((F.col("_grn") - 1) / rows).cast("long"))
    down, up = f"low_c - {E.lead('low_c', 1, ws)}", f"{E.lead('high_c', 1, ws)} - high_c"
    t = t.selectExpr("*", f"CASE WHEN _grn = 1 THEN CAST(NOT coalesce({down} > 0 AND {up} < {down}, false) AS INT) END AS _start")
    t = t.selectExpr("*", "CASE WHEN _start = 0 THEN NULL ELSE low_c END AS _low", "CASE WHEN _start = 1 THEN NULL ELSE high_c END AS _high")
    reach = t.groupBy(key, part).agg(F.min("_low").alias("_lo"), F.max("_high").alias("_hi"))
    reach = reach.selectExpr(key, part, f"min(_lo) {earlier} AS _lo0", f"max(_hi) {earlier} AS _hi0")
    t = t.join(reach, [key, part])
    t = t.selectExpr("*", f"least(_lo0, min(_low) OVER ({ws} {before})) AS _floor", f"greatest(_hi0, max(_high) OVER ({ws} {before})) AS _roof")
    t = t.selectExpr("*", "_start IS NULL AND coalesce(low_c <= _floor, true) AS _falls", "_start IS NULL AND coalesce(high_c >= _roof, true) AS _rises")
    t = t.selectExpr("*", "CASE WHEN _start IS NOT NULL THEN _start WHEN _rises AND NOT _falls THEN 1 WHEN _falls AND NOT _rises THEN 0 END AS _set", "CAST(_falls AND _rises AS INT) AS _turn")
    t = t.selectExpr("*", f"sum(_turn) OVER ({ws} {so_far}) AS _turns")
    t = t.selectExpr("*", f"last(_set, true) OVER ({ws} {so_far}) AS _phase", f"coalesce(last(CASE WHEN _set IS NOT NULL THEN _turns END, true) OVER ({ws} {so_far}), 0) AS _done")
    ends = t.groupBy(key, part).agg(F.max_by(F.struct("_phase", (F.col("_turns") - F.col("_done")).alias("n")), "_grn").alias("e"))
    ends = ends.selectExpr(key, part, "e._phase AS _phase", "e.n AS n", f"coalesce(sum(e.n) {earlier}, 0) AS c")
    ends = ends.selectExpr(key, part, f"pmod(last(_phase, true) {earlier} + c - last(CASE WHEN _phase IS NOT NULL THEN c END, true) {earlier}, 2) AS _phase0")
    t = t.join(ends, [key, part])
    t = t.selectExpr("*", "pmod(coalesce(_phase, _phase0) + _turns - _done, 2) AS _is_long")
    was = f"coalesce({E.lag('_is_long', 1, ws)}, _phase0)"
    stop = (f"CASE WHEN _grn = 1 THEN NULL WHEN {was} = 1 THEN CASE WHEN _falls THEN greatest(_roof, high_c) ELSE _floor END "
            "WHEN _rises THEN least(_floor, low_c) ELSE _roof END")
    return t.selectExpr(*map(E.q, df.columns), f"{stop} / 100.0D AS _sar")


def recurrence_columns(df: DataFrame, which=(*GROUPS, "sar"), key: str = "symbol") -> DataFrame:
    """Append the raw outputs of the wanted groups to every bar.  The stop goes first, with all columns of the bars, so
    that nothing is joined to the wider rows; the two small tables that it needs read two prices."""
    linear = [g for g in which if g != "sar"]
    out = stop_column(df, key, part="_seg") if "sar" in which else df
    return linear_columns(out, linear, key) if linear else out


def recurrence_finals() -> dict:
    """Scaled / clipped features from the raw recurrence columns (projections only)."""
    hist = F.col("_hist")
    return {
        "dif": clip1(F.lit(0.7) * F.col("_dif")),
        "dea": clip1(F.lit(0.7) * F.col("_dea")),
        "hist_d": clip1(F.lit(4.0) * F.col("_hist_chg")),
        "hist": clip1(hist),
        "tema": sq(F.lit(0.1) * F.sqrt(F.col("_tema"))),
        "t3": sq(F.lit(0.1) * F.sqrt(F.col("_t3"))),
        "natr": clip1(F.lit(-0.2) + F.lit(0.1) * F.col("_natr")),
        "adosc": sq(F.lit(0.1) * F.col("_adosc")),
        "sar": sq(F.lit(0.1) * F.col("_sar")),
        "adx": clip1(F.lit(0.015) * F.col("_adx")),
        "adxr": clip1(F.lit(0.015) * F.col("_adxr")),
    }


#: By group: its final features.
FINALS = {"macd": ["dif", "dea", "hist_d", "hist"], "tema": ["tema"], "t3": ["t3"], "natr": ["natr"], "adosc": ["adosc"], "sar": ["sar"], "adx": ["adx", "adxr"]}
RECURRENCE_COLUMNS = ["dif", "dea", "hist_d", "hist", "tema", "t3", "natr", "adosc", "sar", "adx", "adxr"]


def recurrence_features(df: DataFrame, which=tuple(FINALS), key: str = "symbol") -> DataFrame:
    """The wanted groups' final (scaled, clipped) features beside the columns of ``df``; nothing else is computed."""
    r, finals = recurrence_columns(df, which, key), recurrence_finals()
    return r.select(*df.columns, *[finals[c].alias(c) for g in which for c in FINALS[g]])


def index_macd(ib: DataFrame, passthrough: bool = False) -> DataFrame:
    """MACD of the index close on the index calendar, scaled and clipped.

    With ``passthrough`` every input column but the close is kept, so the index bars are derived once."""
    src = ib if passthrough else ib.select("index_code", "trade_date", "close_c")
    keep = [c for c in src.columns if c != "close_c"]
    return linear_columns(src, ("macd",), "index_code").select(
        *keep,
        clip1(F.lit(0.01) * F.col("_dif")).alias("zsdif"),
        clip1(F.lit(0.01) * F.col("_dea")).alias("zsdea"),
        clip1(F.lit(0.1) * F.col("_hist_chg")).alias("zshist_d"),
        clip1(F.lit(0.02) * F.col("_hist")).alias("zshist"))


# ---------------------------------------------------------------- zero-phase low-pass


def _filtered(x: str, before: str) -> str:
    """The filter's inputs from its series and the value before."""
    b0, b1, _ = lowpass_coefficients()
    return f"({E.d(b0)} * {x} + {E.d(b1)} * {before})"


def _through(values: list[str]) -> str:
    """The filter's last output over a short list of expressions, started at rest on the first."""
    _, _, a1 = lowpass_coefficients()
    y = values[0]
    for before, x in zip(values, values[1:]):
        y = f"({_filtered(x, before)} + {E.d(-a1)} * {y})"
    return y


def lowpass_filter(df: DataFrame, key: str = "symbol") -> DataFrame:
    """T33 + T34: zero-phase low-pass of close per key, and the same filter refitted without the last ``CUT`` bars
    (``lowpass_cut``, NULL on those bars).

    Forward and backward scans over blocks with halos on both sides.  The odd extension at either end is six
    values, whose effect is an expression of the end's seven bars.  NULL for histories of six bars or fewer.
    """
    a = -lowpass_coefficients()[2]
    pad, ws = LOWPASS_PAD, block_spec(key)
    back_ws = f"PARTITION BY {key}, _seg ORDER BY trade_date DESC"
    bars = df.select(key, "trade_date", "_grn", "close_c") if "_grn" in df.columns else G.row_numbers(df.select(key, "trade_date", "close_c"), key)
    sizes = bars.groupBy(key).agg(F.count("*").alias("_n"))
    t = blocks(bars.join(sizes, key), key, fwd=HALO, size="_n")
    x = E.price("close_c")
    t = t.selectExpr("*", f"{x} AS close")
    lead, lag = (lambda c, k: E.lead(c, k, ws)), (lambda c, k: E.lag(c, k, ws))
    head = _through([*[f"(2.0D * close - {lead('close', i)})" for i in range(pad, 0, -1)], "close"])
    t = t.selectExpr("*", f"{head} AS _head", f"{lag('close', 1)} AS _before")
    u = (f"CASE WHEN _grn = 1 THEN _head WHEN _p = {E.d(1 - BLOCK)} THEN close ELSE {_filtered('close', '_before')} END")
    t = t.selectExpr("*", f"{scan(u, a, ws)} AS _fwd")
    t = t.selectExpr("*", f"{lead('_fwd', 1)} AS _next", *[f"(2.0D * close - {lag('close', i)}) AS _x{i}" for i in range(1, pad + 1)])
    # at an end: the forward filter goes on over the extension, the backward one comes back
    t = t.selectExpr("*", f"{_filtered('_x1', 'close')} + {E.d(a)} * _fwd AS _f1")
    for i in range(2, pad + 1):
        t = t.selectExpr("*", f"{_filtered(f'_x{i}', f'_x{i - 1}')} + {E.d(a)} * _f{i - 1} AS _f{i}")
    t = t.selectExpr("*", f"{_through([*[f'_f{i}' for i in range(pad, 0, -1)], '_fwd'])} AS _tail")
    t = t.selectExpr("*", f"CAST({E.over('row_number()', back_ws)} - {BLOCK} AS DOUBLE) AS _bp")
    for name, last in (("lowpass", "_n"), ("lowpass_cut", f"(_n - {CUT})")):
        u = (f"CASE WHEN _grn > {last} THEN 0.0D WHEN _grn = {last} THEN _tail WHEN _bp = {E.d(1 - BLOCK)} THEN _fwd "
             f"ELSE {_filtered('_fwd', '_next')} END")
        t = t.selectExpr("*", f"CASE WHEN {last} > {pad} AND _grn <= {last} THEN {scan(u, a, back_ws, '_bp')} END AS {name}")
    return t.filter("_home").select(key, "trade_date", "close", "lowpass", "lowpass_cut")
