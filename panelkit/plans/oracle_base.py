"""DuckDB SQL for the fixture views (the oracle side of every check).

The oracle sees only the driver's raw parquet views, so each oracle query
inlines the bar derivation as CTEs.  Written independently of the Spark code;
both follow FIXTURES.md.
"""

from __future__ import annotations

ORDER5 = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice"


def _agg(order: str) -> str:
    return f"""
    first(p ORDER BY {order}) AS first_p, last(p ORDER BY {order}) AS last_p,
    max(p) AS max_p, min(p) AS min_p, sum(q) AS qq, sum(p * q) AS pq,
    sum(tx) AS stx, sum(dc) AS sdc, max(is_r) AS any_r"""


def _ohlc(f: int) -> str:
    open_ = "(CASE WHEN qq % 13 = 0 THEN last_p ELSE first_p + qq % 21 - 10 END)"
    return f"""
    CAST({f} * {open_} AS BIGINT) AS open_c,
    CAST({f} * (greatest({open_}, last_p, max_p) + qq % 13) AS BIGINT) AS high_c,
    CAST({f} * (least({open_}, last_p, min_p) - (CASE WHEN qq % 13 = 0 THEN 0 ELSE qq % 11 END)) AS BIGINT) AS low_c,
    CAST({f} * last_p AS BIGINT) AS close_c,
    CAST(100000 * (qq - 1) AS BIGINT) AS volume,
    CAST(1000 * pq AS BIGINT) AS amount_c"""


def _pstr(c: str) -> str:
    return f"CAST(CAST({c} AS DOUBLE) / 100 AS VARCHAR)"


def _num(c: str) -> str:
    return f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0)"


BASE_CTES = f"""
lines AS (
  SELECT l_suppkey AS suppkey, CAST(l_shipdate AS DATE) AS trade_date,
         CAST(10000 + floor(floor(l_extendedprice) / 100) AS BIGINT) AS p,
         CAST(l_quantity AS BIGINT) AS q,
         CAST(round(l_tax * 100) AS BIGINT) AS tx,
         CAST(round(l_discount * 100) AS BIGINT) AS dc,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_r,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
  FROM lineitem),
bar_agg AS (
  SELECT suppkey, trade_date, {_agg(ORDER5)} FROM lines GROUP BY suppkey, trade_date),
bars AS (
  SELECT lpad(CAST(suppkey + 600000 * (suppkey % 2) + 88000 * CAST(suppkey % 10 = 1 AS BIGINT) AS VARCHAR), 6, '0') AS symbol,
         trade_date, {_ohlc(1)},
         CAST(2 * qq + 10 AS DOUBLE) / 100 AS turn,
         CAST(5 * stx - 4 AS DOUBLE) AS peTTM,
         CAST(sdc + 5 AS DOUBLE) / 10 AS pbMRQ,
         CAST(sdc - 1 AS DOUBLE) / 2 AS psTTM,
         CAST(3 * stx - 7 AS DOUBLE) AS pcfNcfTTM,
         CAST(any_r AS INTEGER) AS isST, qq AS _q, suppkey
  FROM bar_agg),
index_agg AS (
  SELECT trade_date, {_agg(ORDER5 + ", suppkey")} FROM lines GROUP BY trade_date),
index_bars AS (
  SELECT 'sh.000001' AS index_code, trade_date, {_ohlc(30)}
  FROM index_agg WHERE (trade_date - DATE '1970-01-01') % 97 <> 0),
raw_bars AS (
  SELECT symbol, CAST(trade_date AS VARCHAR) AS date,
         {_pstr('close_c')} AS close, {_pstr('open_c')} AS open,
         {_pstr('low_c')} AS low, {_pstr('high_c')} AS high,
         CAST(turn AS VARCHAR) AS turn,
         CASE WHEN _q % 29 = 0 THEN '' ELSE CAST(volume AS VARCHAR) END AS volume,
         {_pstr('amount_c')} AS amount,
         CAST(peTTM AS VARCHAR) AS peTTM, CAST(pbMRQ AS VARCHAR) AS pbMRQ,
         CAST(psTTM AS VARCHAR) AS psTTM, CAST(pcfNcfTTM AS VARCHAR) AS pcfNcfTTM,
         CAST(isST AS VARCHAR) AS isST
  FROM bars),
parsed AS (
  SELECT symbol, CAST(date AS DATE) AS trade_date,
         CAST(round({_num('open')} * 100) AS BIGINT) AS open_c,
         CAST(round({_num('high')} * 100) AS BIGINT) AS high_c,
         CAST(round({_num('low')} * 100) AS BIGINT) AS low_c,
         CAST(round({_num('close')} * 100) AS BIGINT) AS close_c,
         CAST({_num('volume')} AS BIGINT) AS volume,
         {_num('turn')} AS turn, {_num('amount')} AS amount,
         {_num('peTTM')} AS peTTM, {_num('pbMRQ')} AS pbMRQ, {_num('psTTM')} AS psTTM,
         {_num('pcfNcfTTM')} AS pcfNcfTTM, {_num('isST')} AS isST
  FROM raw_bars WHERE volume IS NULL OR volume NOT IN ('0', '')),
clean AS (
  SELECT * FROM parsed
  WHERE psTTM > 0 AND COLUMNS(*) IS NOT NULL),
symbols AS (
  SELECT DISTINCT lpad(CAST(l_suppkey + 600000 * (l_suppkey % 2) + 88000 * CAST(l_suppkey % 10 = 1 AS BIGINT) AS VARCHAR), 6, '0') AS symbol,
         l_suppkey AS suppkey
  FROM lineitem),
stored_symbols AS (SELECT symbol FROM symbols WHERE suppkey % 3 <> 0)"""


def with_base(body: str, extra: str = "", recursive: bool = False) -> str:
    ctes = BASE_CTES + (",\n" + extra if extra else "")
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"
