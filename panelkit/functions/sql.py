"""Spark SQL expression-string builders for the wide feature stages.

A stage of ~100 window features is one ``selectExpr`` call: the driver sends
the expression text once and Catalyst parses it JVM-side, instead of one
driver round trip per ``Column`` operator.  The resulting plan is the same as
the equivalent ``Column`` code.  Double literals carry the ``D`` suffix so no
decimal arithmetic sneaks in.
"""

from __future__ import annotations

WS = "PARTITION BY symbol ORDER BY trade_date"


def d(x: float) -> str:
    """A double literal."""
    return f"{float(x)!r}D"


def q(name: str) -> str:
    """Quote an identifier (feature names such as ``20_min``)."""
    return f"`{name}`"


def over(fn: str, ws: str = WS, frame: str | None = None) -> str:
    return f"{fn} OVER ({ws}{' ' + frame if frame else ''})"


def rows(a, b) -> str:
    def side(k):
        if k == "u":
            return "UNBOUNDED PRECEDING"
        if k == 0:
            return "CURRENT ROW"
        return f"{-k} PRECEDING" if k < 0 else f"{k} FOLLOWING"
    return f"ROWS BETWEEN {side(a)} AND {side(b)}"


def lag(x: str, n: int = 1, ws: str = WS) -> str:
    return f"lag({x}, {n}) OVER ({ws})"


def lead(x: str, n: int = 1, ws: str = WS) -> str:
    return f"lead({x}, {n}) OVER ({ws})"


def clip(x: str) -> str:
    return f"(CASE WHEN ({x}) > 1.0D THEN 1.0D WHEN ({x}) < -1.0D THEN -1.0D ELSE ({x}) END)"


def sdiv(a: str, b: str) -> str:
    """a / b, NULL when b = 0 (ANSI-safe)."""
    return f"(({a}) / NULLIF({b}, 0))"


def sq(x: str) -> str:
    return f"(0.6366D * atan({x}))"


def sq7(x: str) -> str:
    return f"(0.637D * atan({x}))"


def price(c: str) -> str:
    """Integer cents to currency."""
    return f"(CAST({c} AS DOUBLE) / 100.0D)"


def prefix_sum(prefix: str, n: int, ws: str = WS, rn: str = "rn") -> str:
    """Sum of the last n rows from a running-sum column; NULL until full."""
    return f"(CASE WHEN {rn} >= {n} THEN {prefix} - coalesce({lag(prefix, n, ws)}, 0) END)"


def running_sum(x: str, ws: str = WS) -> str:
    return over(f"sum({x})", ws, rows("u", 0))


def whole(x: str) -> str:
    """Nearest whole number as a double, halves away from zero (same rule as ``columns.whole``)."""
    return f"(CASE WHEN abs({x} - rint({x})) = 0.5D THEN {x} + signum({x}) * 0.5D ELSE rint({x}) END)"


def r6(x: str) -> str:
    """Round to 6 places via the scaled double (same rule as ``columns.r6``)."""
    return f"({whole(f'(({x}) * 1000000.0D)')} / 1000000.0D + 0.0D)"


def alias(exprs: dict) -> list[str]:
    return [f"{v} AS {q(k)}" for k, v in exprs.items()]


def staged(df, groups):
    """The stages (name -> expression) of several groups, each on the columns of the one before, ending together: the
    groups' n-th last stages share one projection, so rows pass as many window operators as the longest group has.

    A stage's names replace those of ``df``; the expressions beside it still see these."""
    deepest = max(map(len, groups), default=0)
    for k in range(deepest, 0, -1):
        stage = {n: x for g in groups if len(g) >= k for n, x in g[-k].items()}
        df = df.selectExpr(*[q(c) for c in df.columns if c not in stage], *alias(stage))
    return df
