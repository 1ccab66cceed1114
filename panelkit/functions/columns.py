"""Column builders shared by every operator.

All builders are plain ``pyspark.sql.functions`` expressions, so they stay in
whole-stage codegen.  Missing values are NULL, never NaN: every denominator
goes through ``sdiv`` and every comparison that feeds arithmetic through
``coalesce(..., false)``.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed values (must equal the reference's constants): the two arctan squash
# factors, the clip bounds and the price scale of the fixture bars.
SQ = 0.6366
SQ7 = 0.637
CLIP_LO, CLIP_HI = -1.0, 1.0
CENTS = 100.0

__all__ = [
    "SQ", "SQ7", "CENTS", "col", "clip1", "sq", "sq7", "sdiv", "whole", "r6", "win",
    "rolling_sum_prefix", "rolling_frame", "diff",
]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def win(keys=("symbol",), order="trade_date") -> WindowSpec:
    """The panel window: one partition per key, ordered by time."""
    return Window.partitionBy(*keys).orderBy(order)


def clip1(x, lo: float = CLIP_LO, hi: float = CLIP_HI) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (Spark's least/greatest skip NULLs)."""
    x = col(x)
    return F.when(x > hi, F.lit(hi)).when(x < lo, F.lit(lo)).otherwise(x)


def sq(x) -> Column:
    return F.lit(SQ) * F.atan(col(x))


def sq7(x) -> Column:
    return F.lit(SQ7) * F.atan(col(x))


def sdiv(a, b) -> Column:
    """a / b with b = 0 -> NULL (ANSI-safe, mirrors NULLIF in the oracle)."""
    b = col(b)
    return col(a) / F.when(b != 0, b)


def whole(x) -> Column:
    """Nearest whole number as a double, halves away from zero: the values of ``round(x)``, which takes every double
    to a decimal by its text and back.  ``x - rint(x)`` is exact, so halves are found exactly."""
    x = col(x)
    return F.when(F.abs(x - F.rint(x)) == 0.5, x + F.signum(x) * 0.5).otherwise(F.rint(x))


def r6(x) -> Column:
    """Round to 6 places for cross-engine hashing.

    Scales first and rounds the scaled double to an integer, so every engine
    rounds the same binary value (no decimal-string ties); ``+ 0.0`` folds
    -0.0 into 0.0.
    """
    return whole(col(x) * 1e6) / 1e6 + F.lit(0.0)


def diff(x, w: WindowSpec, n: int = 1) -> Column:
    x = col(x)
    return x - F.lag(x, n).over(w)


def rolling_sum_prefix(prefix: str, n: int, w: WindowSpec, rn: str = "rn") -> Column:
    """Sum of the last ``n`` rows from a running (prefix) sum column.

    ``S_t - S_{t-n}`` costs one offset lookup per row, where a sliding frame
    re-aggregates all ``n`` rows.  Exact for integer inputs (cents, shares).
    NULL until the window is full, like pandas ``rolling(n)``.
    """
    s = F.col(prefix)
    return F.when(F.col(rn) >= n, s - F.coalesce(F.lag(s, n).over(w), F.lit(0)))


def rolling_frame(fn, x, w: WindowSpec, start: int, end: int, rn: str = "rn",
                  need: int | None = None) -> Column:
    """``fn`` over rows ``start..end`` (relative), NULL unless the frame is full.

    Only for non-invertible aggregates (min/max/collect); sums use prefixes.
    Backward frames are guarded by the row number, forward ones by a count.
    """
    frame = w.rowsBetween(start, end)
    n = end - start + 1
    if end <= 0:
        first_needed = -start + 1  # row number of the first row with a full frame
        return F.when(F.col(rn) >= first_needed, fn(col(x)).over(frame))
    need = need or n
    return F.when(F.count(col(x)).over(frame) == need, fn(col(x)).over(frame))
