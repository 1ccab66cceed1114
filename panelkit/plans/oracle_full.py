"""DuckDB oracle of the full feature table (flagship): every per-group CTE
chain over one gated source, joined on (symbol, trade_date), trimmed."""

from __future__ import annotations

from panelkit.plans import oracle_recur as RC
from panelkit.plans.oracle_base import with_base
from panelkit.plans.oracle_sql import (LABEL_COLUMNS, classes_cte, clip, enrich_ctes, indicator_ctes, labels_cte, r6,
                                       sq, stock_ctes, valuation_sql)

# The stored columns in their order, stated here for themselves so that a lost or misplaced one shows.
STORED = """
close open low high turn isST flowmkt everyprofit everypb eversale evermoney szpctchg1 szpctchg2 szpctchg4 szpctchg8 szpctchg15 szpctchg30 zs20_min
zs60_min zs120_min zs20_max zs60_max zs120_max zs5_d zs10_d zs20_d zs40_d zs80_d zsr5 zsr10 zsr20 zsr40 zsr80 zsr5_20_d zsr10_40_d zsr20_80_d zsr5_20
zsr10_40 zsr20_80 zsr5_40 zsv3_9 zsv5_20 zsv9_50 zsv5_d zsv10_d zsv20_d zsv40_d zsv80_d zsv3_9_d zsv5_20_d zsv9_50_d zsv5 zsv10 zsv20 zsv40 zsv80
zsdif zsdea zshist_d zshist pctChg pctChg2 pctChg4 pctChg8 pctChg15 pctChg30 20_min 60_min 120_min 20_max 60_max 120_max 5_d 10_d 20_d 40_d 80_d r5
r10 r20 r40 r80 r5_20_d r10_40_d r20_80_d r5_20 r10_40 r20_80 r5_40 v5 v10 v20 v40 v80 v3_9 v5_20 v9_50 v5_d v10_d v20_d v40_d v80_d v3_9_d v5_20_d
v9_50_d dif dea hist hist_d highratio lowratio openratio tema trima wma t3 natr adline adosc obv beta correl linearreg lineangle var TSF lineintercept
stddev sar adx adxr apo ardown arup arosc bop cci cci_d
""".split()

WI = "PARTITION BY index_code ORDER BY trade_date"
PRICES = ("close", "open", "low", "high")
VALUATION = ["turn", "flowmkt", "everyprofit", "everypb", "eversale", "evermoney"]
IND = ["trima", "wma", "adline", "obv", "beta", "correl", "linearreg", "lineangle", "var", "TSF",
       "lineintercept", "stddev", "apo", "ardown", "arup", "arosc", "bop", "cci", "cci_d"]
REC = ["dif", "dea", "hist", "hist_d", "tema", "t3", "natr", "adosc", "sar", "adx", "adxr"]
IMACD = ["zsdif", "zsdea", "zshist_d", "zshist"]


def stored_columns() -> list[str]:
    return list(STORED)


def feature_table_sql(columns=None) -> str:
    gated = """gated AS (
  SELECT * FROM clean
  WHERE symbol IN (SELECT symbol FROM raw_bars GROUP BY symbol HAVING count(*) > 50)
    AND symbol IN (SELECT symbol FROM clean GROUP BY symbol HAVING count(*) > 300))"""
    rbi = """rbi AS (SELECT *, row_number() OVER (PARTITION BY index_code ORDER BY trade_date) AS rn,
         count(*) OVER (PARTITION BY index_code) AS n FROM index_bars)"""
    im = f"""im AS (
  SELECT trade_date, {clip('0.01 * _dif')} AS zsdif, {clip('0.01 * _dea')} AS zsdea,
         {clip(f'0.1 * (_hist - lag(_hist) OVER ({WI}))')} AS zshist_d, {clip('0.02 * _hist')} AS zshist
  FROM mi_raw)"""
    rec = f"""rec AS (
  SELECT r.symbol, r.trade_date, r.rn,
    {clip('0.7 * m._dif')} AS dif, {clip('0.7 * m._dea')} AS dea, {clip('m._hist')} AS hist,
    {clip('4.0 * (m._hist - lag(m._hist) OVER (PARTITION BY r.symbol ORDER BY r.trade_date))')} AS hist_d,
    {sq('0.1 * sqrt(te._tema)')} AS tema,
    {sq('0.1 * sqrt(CASE WHEN r.rn >= 25 THEN t3.e END)')} AS t3,
    {clip('-0.2 + 0.1 * (CASE WHEN r.close_c <> 0 THEN (na.atr / r.close_c) * 100.0 ELSE 0.0 END)')} AS natr,
    {sq('0.1 * (CASE WHEN r.rn >= 10 THEN ao.fast - ao.slow END)')} AS adosc,
    {sq('0.1 * (CAST(sr.out AS DOUBLE) / 100)')} AS sar,
    {clip('0.015 * ax._adx')} AS adx, {clip('0.015 * ax._adxr')} AS adxr
  FROM rb r
  LEFT JOIN m_raw m ON m.symbol = r.symbol AND m.rn = r.rn
  LEFT JOIN tema_raw te ON te.symbol = r.symbol AND te.rn = r.rn
  LEFT JOIN t3_e3 t3 ON t3.symbol = r.symbol AND t3.rn = r.rn
  LEFT JOIN n_atr na ON na.symbol = r.symbol AND na.rn = r.rn
  LEFT JOIN ao ON ao.symbol = r.symbol AND ao.rn = r.rn
  LEFT JOIN s_r sr ON sr.symbol = r.symbol AND sr.rn = r.rn
  LEFT JOIN adx_raw ax ON ax.symbol = r.symbol AND ax.rn = r.rn)"""
    ctes = ",\n".join([
        gated, f"val AS ({valuation_sql('gated')})", stock_ctes("gated"), indicator_ctes("gated"),
        labels_cte("gated"), classes_cte(), enrich_ctes("gated"),
        RC.rb_cte("gated"), RC.macd_ctes(), RC._tema_ctes(), RC._t3_ctes(), RC._natr_ctes(),
        RC._adosc_ctes(), RC._adx_ctes(), RC._sar_ctes(),
        rbi, RC.macd_ctes("index_code", rb="rbi", p="mi"), im, rec])
    src = {}
    for c in PRICES:
        src[c] = f"CAST(g.{c}_c AS DOUBLE) / 100"
    for c in VALUATION:
        src[c] = f"v.{c}"
    src["isST"] = "g.isST"
    for c in IMACD:
        src[c] = f"i.{c}"
    for c in IND:
        src[c] = f'ind."{c}"'
    for c in REC:
        src[c] = f"rc.{c}"
    sel = []
    wanted = set(columns) if columns is not None else None
    for c in STORED:
        if wanted is not None and c not in wanted:
            continue
        expr = src.get(c, f'e."{c}"' if c.startswith(("szpct", "zs")) else f's."{c}"')
        sel.append(f'{r6(expr)} AS "{c}"')
    for c in LABEL_COLUMNS:
        if wanted is None or c in wanted:
            sel.append(f'cl."{c}" AS "{c}"')
    body = f"""SELECT g.symbol, g.trade_date, {', '.join(sel)}
FROM rec rc
JOIN gated g ON g.symbol = rc.symbol AND g.trade_date = rc.trade_date
JOIN val v ON v.symbol = g.symbol AND v.trade_date = g.trade_date
JOIN stock_feat s ON s.symbol = g.symbol AND s.trade_date = g.trade_date
JOIN indicators ind ON ind.symbol = g.symbol AND ind.trade_date = g.trade_date
JOIN classed cl ON cl.symbol = g.symbol AND cl.trade_date = g.trade_date
JOIN enriched e ON e.symbol = g.symbol AND e.trade_date = g.trade_date
LEFT JOIN im i ON i.trade_date = g.trade_date
WHERE rc.rn > 120"""
    return with_base(body, ctes, recursive=True)


def load_features_sql() -> str:
    """S9 on top of the full table: row gate, close, labels x 0.1."""
    ys = ", ".join(f'{r6(f"CAST({c} AS DOUBLE) * 0.1")} AS y_{c}' for c in LABEL_COLUMNS)
    return f"""SELECT symbol, trade_date, close, {ys}
FROM ({feature_table_sql()}) ft
WHERE symbol IN (SELECT symbol FROM ({feature_table_sql()}) x GROUP BY symbol HAVING count(*) > 1)"""
