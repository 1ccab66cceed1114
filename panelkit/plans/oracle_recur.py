"""DuckDB oracles for the recurrence indicators: recursive CTEs stepping on
the row number, all symbols in parallel, with the same seeds and the same
operation order as the Spark kernels.
"""

from __future__ import annotations

import math

from panelkit.plans.oracle_base import with_base
from panelkit.plans.oracle_sql import clip, r6, sq

WS = "PARTITION BY symbol ORDER BY trade_date"


def dlit(x: float) -> str:
    """A double literal parsed from its shortest repr (exactly Python's float)."""
    return f"CAST('{x!r}' AS DOUBLE)"


def _k(n):
    return dlit(2.0 / (n + 1))


def _k1(n):
    return dlit(1.0 - 2.0 / (n + 1))


def rb_cte(src="clean", key="symbol"):
    return f"""rb AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY trade_date) AS rn,
         count(*) OVER (PARTITION BY {key}) AS n FROM {src})"""


def _x(t="b"):
    return f"(CAST({t}.close_c AS DOUBLE) / 100)"


def macd_ctes(key="symbol", rb="rb", p="m"):
    kf, ks, k9 = _k(12), _k(26), _k(9)
    return f"""{p}_seed AS (
  SELECT {key}, CAST(sum(close_c) FILTER (WHERE rn BETWEEN 15 AND 26) AS DOUBLE) / 1200.0 AS fast,
         CAST(sum(close_c) FILTER (WHERE rn <= 26) AS DOUBLE) / 2600.0 AS slow
  FROM {rb} GROUP BY {key} HAVING max(rn) >= 34),
{p}_ema AS (
  SELECT {key}, 26 AS rn, fast, slow FROM {p}_seed
  UNION ALL
  SELECT e.{key}, b.rn, (({_x()} - e.fast) * {kf}) + e.fast, (({_x()} - e.slow) * {ks}) + e.slow
  FROM {p}_ema e JOIN {rb} b ON b.{key} = e.{key} AND b.rn = e.rn + 1),
{p}_dif AS (SELECT {key}, rn, fast - slow AS dif FROM {p}_ema),
{p}_sig AS (
  SELECT {key}, 34 AS rn, list_reduce(list(dif ORDER BY rn), lambda a, c: a + c) / 9.0 AS dea
  FROM {p}_dif WHERE rn <= 34 GROUP BY {key}
  UNION ALL
  SELECT s.{key}, d.rn, ((d.dif - s.dea) * {k9}) + s.dea
  FROM {p}_sig s JOIN {p}_dif d ON d.{key} = s.{key} AND d.rn = s.rn + 1),
{p}_raw AS (
  SELECT b.*, CASE WHEN s.dea IS NOT NULL THEN d.dif END AS _dif, s.dea AS _dea, d.dif - s.dea AS _hist
  FROM {rb} b LEFT JOIN {p}_dif d USING ({key}, rn) LEFT JOIN {p}_sig s USING ({key}, rn))"""


def _macd():
    h = "_hist"
    body = f"""SELECT symbol, trade_date, {r6(clip('0.7 * _dif'))} AS dif, {r6(clip('0.7 * _dea'))} AS dea,
  {r6(clip(f'4.0 * ({h} - lag({h}) OVER ({WS}))'))} AS hist_d, {r6(clip(h))} AS hist FROM macd_raw"""
    return with_base(body.replace("FROM macd_raw", "FROM m_raw"), rb_cte() + ",\n" + macd_ctes(), recursive=True)


def _index_macd():
    h = "_hist"
    wi = "PARTITION BY index_code ORDER BY trade_date"
    body = f"""SELECT index_code, trade_date, {r6(clip('0.01 * _dif'))} AS zsdif, {r6(clip('0.01 * _dea'))} AS zsdea,
  {r6(clip(f'0.1 * ({h} - lag({h}) OVER ({wi}))'))} AS zshist_d, {r6(clip('0.02 * ' + h))} AS zshist FROM macd_raw"""
    return with_base(body.replace("FROM macd_raw", "FROM m_raw"),
                     rb_cte("index_bars", "index_code") + ",\n" + macd_ctes("index_code"), recursive=True)


def _ema_chain(name, src, col, seed_rn, k):
    """EMA of a float series ``src.col`` seeded at ``seed_rn`` with the
    sequential mean of the 30 values ending there."""
    return f"""{name} AS (
  SELECT symbol, {seed_rn} AS rn, list_reduce(list({col} ORDER BY rn), lambda a, c: a + c) / 30.0 AS e
  FROM {src} WHERE rn <= {seed_rn} GROUP BY symbol HAVING count(*) = 30
  UNION ALL
  SELECT p.symbol, x.rn, ((x.{col} - p.e) * {k}) + p.e
  FROM {name} p JOIN {src} x ON x.symbol = p.symbol AND x.rn = p.rn + 1)"""


def _tema_ctes():
    k = _k(30)
    return f"""t_e1 AS (
  SELECT symbol, 30 AS rn, CAST(sum(close_c) AS DOUBLE) / 3000.0 AS e FROM rb WHERE rn <= 30
  GROUP BY symbol HAVING count(*) = 30
  UNION ALL
  SELECT p.symbol, b.rn, (({_x()} - p.e) * {k}) + p.e FROM t_e1 p JOIN rb b ON b.symbol = p.symbol AND b.rn = p.rn + 1),
{_ema_chain('t_e2', 't_e1', 'e', 59, k)},
{_ema_chain('t_e3', 't_e2', 'e', 88, k)},
tema_raw AS (
  SELECT symbol, rn, e3.e + ((3.0 * e1.e) - (3.0 * e2.e)) AS _tema
  FROM t_e3 e3 JOIN t_e2 e2 USING (symbol, rn) JOIN t_e1 e1 USING (symbol, rn))"""


def _tema():
    ctes = rb_cte() + ",\n" + _tema_ctes()
    body = f"""SELECT symbol, trade_date, {r6(sq('0.1 * sqrt(_tema)'))} AS tema
FROM rb LEFT JOIN tema_raw USING (symbol, rn)"""
    return with_base(body, ctes, recursive=True)


def _t3_ctes():
    k, k1 = _k(5), _k1(5)
    return f"""t3_e1 AS (
  SELECT symbol, 5 AS rn, CAST(sum(close_c) AS DOUBLE) / 500.0 AS e FROM rb WHERE rn <= 5
  GROUP BY symbol HAVING count(*) = 5 AND max(n) >= 25
  UNION ALL
  SELECT p.symbol, b.rn, ({k} * {_x()}) + ({k1} * p.e) FROM t3_e1 p JOIN rb b ON b.symbol = p.symbol AND b.rn = p.rn + 1),
t3_e2 AS (
  SELECT symbol, 9 AS rn, list_reduce(list(e ORDER BY rn), lambda a, c: a + c) / 5 AS e
  FROM t3_e1 WHERE rn <= 9 GROUP BY symbol HAVING count(*) = 5
  UNION ALL
  SELECT p.symbol, x.rn, ({k} * x.e) + ({k1} * p.e) FROM t3_e2 p JOIN t3_e1 x ON x.symbol = p.symbol AND x.rn = p.rn + 1),
t3_e3 AS (
  SELECT symbol, 13 AS rn, list_reduce(list(e ORDER BY rn), lambda a, c: a + c) / 5 AS e
  FROM t3_e2 WHERE rn <= 13 GROUP BY symbol HAVING count(*) = 5
  UNION ALL
  SELECT p.symbol, x.rn, ({k} * x.e) + ({k1} * p.e) FROM t3_e3 p JOIN t3_e2 x ON x.symbol = p.symbol AND x.rn = p.rn + 1)"""


def _t3():
    ctes = rb_cte() + ",\n" + _t3_ctes()
    body = f"""SELECT symbol, trade_date, {r6(sq('0.1 * sqrt(CASE WHEN rn >= 25 THEN e END)'))} AS t3
FROM rb LEFT JOIN t3_e3 USING (symbol, rn)"""
    return with_base(body, ctes, recursive=True)


def _natr_ctes():
    return f"""n_tr AS (
  SELECT symbol, rn, close_c, greatest(high_c - low_c, abs(high_c - pc), abs(low_c - pc)) AS tr
  FROM (SELECT *, lag(close_c) OVER ({WS}) AS pc FROM rb)),
n_atr AS (
  SELECT symbol, 15 AS rn, CAST(sum(tr) AS DOUBLE) / 14.0 AS atr FROM n_tr WHERE rn BETWEEN 2 AND 15
  GROUP BY symbol HAVING count(*) = 14
  UNION ALL
  SELECT a.symbol, t.rn, ((a.atr * 13) + t.tr) / 14.0 FROM n_atr a JOIN n_tr t ON t.symbol = a.symbol AND t.rn = a.rn + 1)"""


def _natr():
    ctes = rb_cte() + ",\n" + _natr_ctes()
    natr = "(CASE WHEN close_c <> 0 THEN (atr / close_c) * 100.0 ELSE 0.0 END)"
    body = f"""SELECT symbol, trade_date, {r6(clip(f'-0.2 + 0.1 * {natr}'))} AS natr
FROM rb LEFT JOIN n_atr USING (symbol, rn)"""
    return with_base(body, ctes, recursive=True)


def _adosc_ctes():
    kf, ks, kf1, ks1 = _k(3), _k(10), _k1(3), _k1(10)
    term = ("CASE WHEN high_c - low_c > 0 THEN CAST((close_c - low_c) - (high_c - close_c) AS DOUBLE) / (high_c - low_c)"
            " * (CAST(volume AS DOUBLE) / 1000000.0) ELSE 0.0 END")
    return f"""ao_t AS (SELECT symbol, rn, {term} AS term FROM rb),
ao AS (
  SELECT symbol, 1 AS rn, CAST(term AS DOUBLE) AS ad, CAST(term AS DOUBLE) AS fast,
         CAST(term AS DOUBLE) AS slow FROM ao_t WHERE rn = 1
  UNION ALL
  SELECT a.symbol, t.rn, a.ad + t.term, ({kf} * (a.ad + t.term)) + ({kf1} * a.fast),
         ({ks} * (a.ad + t.term)) + ({ks1} * a.slow)
  FROM ao a JOIN ao_t t ON t.symbol = a.symbol AND t.rn = a.rn + 1)"""


def _adosc():
    ctes = rb_cte() + ",\n" + _adosc_ctes()
    body = f"""SELECT symbol, trade_date, {r6(sq('0.1 * (CASE WHEN rn >= 10 THEN fast - slow END)'))} AS adosc
FROM rb LEFT JOIN ao USING (symbol, rn)"""
    return with_base(body, ctes, recursive=True)


def _adx_ctes():
    tiny = "1e-8"
    return f"""x_b AS (
  SELECT symbol, rn,
    CASE WHEN dl > 0 AND dh < dl THEN 0 WHEN dh > 0 AND dh > dl THEN dh ELSE 0 END AS dp,
    CASE WHEN dl > 0 AND dh < dl THEN dl ELSE 0 END AS dm,
    greatest(high_c - low_c, abs(high_c - pc), abs(low_c - pc)) AS tr
  FROM (SELECT *, high_c - lag(high_c) OVER ({WS}) AS dh, lag(low_c) OVER ({WS}) - low_c AS dl,
               lag(close_c) OVER ({WS}) AS pc FROM rb)),
x_r AS (
  SELECT symbol, rn, CAST(dp AS DOUBLE) AS pdm, CAST(dm AS DOUBLE) AS mdm, CAST(tr AS DOUBLE) AS tr,
         CAST(0 AS DOUBLE) AS sum_dx, CAST(NULL AS DOUBLE) AS adx
  FROM x_b WHERE rn = 2
  UNION ALL
  SELECT symbol, rn, pdm, mdm, tr,
    CASE WHEN rn BETWEEN 15 AND 28 THEN sum_dx + coalesce(dx, 0.0) ELSE sum_dx END,
    CASE WHEN rn = 28 THEN (sum_dx + coalesce(dx, 0.0)) / 14
         WHEN rn > 28 THEN (CASE WHEN dx IS NULL THEN adx ELSE ((adx * 13) + dx) / 14 END) END
  FROM (
    SELECT *, CASE WHEN rn >= 15 AND NOT (tr > -{tiny} AND tr < {tiny}) AND NOT (s > -{tiny} AND s < {tiny})
                   THEN 100.0 * (abs(mdi - pdi) / s) END AS dx
    FROM (
      SELECT *, mdi + pdi AS s FROM (
        SELECT *, 100.0 * (mdm / NULLIF(tr, 0)) AS mdi, 100.0 * (pdm / NULLIF(tr, 0)) AS pdi FROM (
          SELECT r.symbol, b.rn,
            CASE WHEN b.rn <= 14 THEN r.pdm + b.dp ELSE (r.pdm - (r.pdm / 14)) + b.dp END AS pdm,
            CASE WHEN b.rn <= 14 THEN r.mdm + b.dm ELSE (r.mdm - (r.mdm / 14)) + b.dm END AS mdm,
            CASE WHEN b.rn <= 14 THEN r.tr + b.tr ELSE (r.tr - (r.tr / 14)) + b.tr END AS tr,
            r.sum_dx, r.adx
          FROM x_r r JOIN x_b b ON b.symbol = r.symbol AND b.rn = r.rn + 1))))),
adx_raw AS (
  SELECT symbol, rn, adx AS _adx,
         CASE WHEN rn >= 41 THEN (adx + lag(adx, 13) OVER (PARTITION BY symbol ORDER BY rn)) / 2.0 END AS _adxr
  FROM x_r)"""


def _adx():
    ctes = rb_cte() + ",\n" + _adx_ctes()
    body = f"""SELECT symbol, trade_date, {r6(clip('0.015 * _adx'))} AS adx, {r6(clip('0.015 * _adxr'))} AS adxr
FROM rb LEFT JOIN adx_raw USING (symbol, rn)"""
    return with_base(body, ctes, recursive=True)


def _sar_ctes():
    def step(is_long, stop, ep, pl, ph, nl, nh):
        sw_l = f"({is_long} AND {nl} <= {stop})"
        sw_s = f"((NOT {is_long}) AND {nh} >= {stop})"
        out = (f"CASE WHEN {sw_l} THEN greatest({ep}, {ph}, {nh}) WHEN {sw_s} THEN least({ep}, {pl}, {nl}) "
               f"ELSE {stop} END")
        new_long = f"CASE WHEN {sw_l} THEN false WHEN {sw_s} THEN true ELSE {is_long} END"
        new_ep = (f"CASE WHEN {sw_l} THEN {nl} WHEN {sw_s} THEN {nh} WHEN {is_long} THEN greatest({ep}, {nh}) "
                  f"ELSE least({ep}, {nl}) END")
        new_stop = (f"CASE WHEN {sw_l} OR {sw_s} THEN {out} WHEN {is_long} THEN least({stop}, {pl}, {nl}) "
                    f"ELSE greatest({stop}, {ph}, {nh}) END")
        return new_long, new_stop, new_ep, out
    nl_, ns_, ne_, out_ = step("r.is_long", "r.stop", "r.ep", "r.lo", "r.hi", "b.low_c", "b.high_c")
    return f"""s_init AS (
  SELECT a.symbol, NOT ((a.low_c - b.low_c) > 0 AND (b.high_c - a.high_c) < (a.low_c - b.low_c)) AS is_long,
         a.low_c AS l0, a.high_c AS h0, b.low_c AS l1, b.high_c AS h1
  FROM rb a JOIN rb b ON a.symbol = b.symbol AND a.rn = 1 AND b.rn = 2),
s_r AS (
  SELECT symbol, 1 AS rn, is_long, CASE WHEN is_long THEN l0 ELSE h0 END AS stop,
         CASE WHEN is_long THEN h1 ELSE l1 END AS ep, l1 AS lo, h1 AS hi, CAST(NULL AS BIGINT) AS out
  FROM s_init
  UNION ALL
  SELECT r.symbol, b.rn, {nl_}, {ns_}, {ne_}, b.low_c, b.high_c, {out_}
  FROM s_r r JOIN rb b ON b.symbol = r.symbol AND b.rn = r.rn + 1)"""


def _sar():
    ctes = rb_cte() + ",\n" + _sar_ctes()
    body = f"""SELECT symbol, trade_date, {r6(sq('0.1 * (CAST(out AS DOUBLE) / 100)'))} AS sar
FROM rb LEFT JOIN s_r USING (symbol, rn)"""
    return with_base(body, ctes, recursive=True)


def _lowpass_coeffs():
    warped = 4.0 * math.tan(math.pi * 0.1 / 2.0)
    b0 = warped / (4.0 + warped)
    a1 = (warped - 4.0) / (4.0 + warped)
    return b0, b0, a1


def lowpass_ctes():
    b0, b1, a1 = _lowpass_coeffs()
    c0 = 1.0 - b0
    B0, B1, A1, C0 = dlit(b0), dlit(b1), dlit(a1), dlit(c0)
    return rb_cte() + f""",
lp_all AS (SELECT symbol, rn, count(*) OVER (PARTITION BY symbol) AS n, CAST(close_c AS DOUBLE) / 100 AS x FROM rb),
lp_s AS (
  SELECT symbol, 0 AS v, rn, n, x FROM lp_all
  UNION ALL
  SELECT symbol, 1 AS v, rn, n - 10 AS n, x FROM lp_all WHERE rn <= n - 10),
lp_ext AS (
  SELECT symbol, v, n, rn + 6 AS e, x FROM lp_s WHERE n > 6
  UNION ALL
  SELECT a.symbol, a.v, a.n, 8 - b.rn AS e, (2.0 * a.x) - b.x FROM lp_s a JOIN lp_s b
    ON a.symbol = b.symbol AND a.v = b.v AND a.rn = 1 AND b.rn BETWEEN 2 AND 7 WHERE a.n > 6
  UNION ALL
  SELECT a.symbol, a.v, a.n, a.n + 6 + (a.n - b.rn) AS e, (2.0 * a.x) - b.x FROM lp_s a JOIN lp_s b
    ON a.symbol = b.symbol AND a.v = b.v AND a.rn = a.n AND b.rn BETWEEN a.n - 6 AND a.n - 1 WHERE a.n > 6),
lp_f AS (
  SELECT symbol, v, n, e, y, ({B1} * x) - ({A1} * y) AS z FROM (
    SELECT symbol, v, n, e, x, ({B0} * x) + ({C0} * x) AS y FROM lp_ext WHERE e = 1)
  UNION ALL
  SELECT symbol, v, n, e, y, ({B1} * x) - ({A1} * y) FROM (
    SELECT p.symbol, p.v, p.n, q.e, q.x, ({B0} * q.x) + p.z AS y
    FROM lp_f p JOIN lp_ext q ON q.symbol = p.symbol AND q.v = p.v AND q.e = p.e + 1)),
lp_b AS (
  SELECT symbol, v, n, e, y, ({B1} * x) - ({A1} * y) AS z FROM (
    SELECT symbol, v, n, e, y AS x, ({B0} * y) + ({C0} * y) AS y FROM lp_f WHERE e = n + 12)
  UNION ALL
  SELECT symbol, v, n, e, y, ({B1} * x) - ({A1} * y) FROM (
    SELECT p.symbol, p.v, p.n, q.e, q.y AS x, ({B0} * q.y) + p.z AS y
    FROM lp_b p JOIN lp_f q ON q.symbol = p.symbol AND q.v = p.v AND q.e = p.e - 1)),
lp_out AS (
  SELECT b.symbol, b.trade_date, CAST(b.close_c AS DOUBLE) / 100 AS close, f.y AS lowpass, c.y AS lowpass_cut
  FROM rb b
  LEFT JOIN (SELECT symbol, e - 6 AS rn, y FROM lp_b WHERE v = 0 AND e BETWEEN 7 AND n + 6) f USING (symbol, rn)
  LEFT JOIN (SELECT symbol, e - 6 AS rn, y FROM lp_b WHERE v = 1 AND e BETWEEN 7 AND n + 6) c USING (symbol, rn))"""


def _lowpass_filter():
    fr = f"({WS} ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING)"
    body = f"""SELECT symbol, trade_date, {r6('close')} AS close, {r6('lowpass')} AS lowpass,
  {r6(f'CASE WHEN count(close) OVER {fr} = 10 THEN avg(close) OVER {fr} END')} AS cmean10 FROM lp_out"""
    return with_base(body, lowpass_ctes(), recursive=True)


def _filter_revision():
    body = f"""SELECT symbol, trade_date, {r6('lowpass')} AS lowpass, {r6('lowpass_cut')} AS lowpass_cut,
  {r6('abs(lowpass - lowpass_cut)')} AS revision FROM lp_out WHERE lowpass_cut IS NOT NULL"""
    return with_base(body, lowpass_ctes(), recursive=True)


SQL = {
    "macd": _macd,
    "index_macd": _index_macd,
    "tema": _tema,
    "t3": _t3,
    "natr": _natr,
    "adosc": _adosc,
    "adx": _adx,
    "sar": _sar,
    "lowpass_filter": _lowpass_filter,
    "filter_revision": _filter_revision,
}
