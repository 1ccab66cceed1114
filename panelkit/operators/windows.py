"""Window primitives W1-W16 on the bar panel.

All of them run over one window spec ``partitionBy(symbol).orderBy(date)``,
so a chain of them costs one exchange and one sort.  Sums use running
(prefix) sums plus an offset lookup, min/max use bounded frames, and every
result is NULL until its window is full (pandas ``rolling`` semantics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelkit.functions import col, rolling_frame, rolling_sum_prefix, win


def lag(x, n: int, w: WindowSpec) -> Column:
    """``shift(n)``."""
    return F.lag(col(x), n).over(w)


def lead(x, n: int, w: WindowSpec) -> Column:
    """``shift(-n)``."""
    return F.lead(col(x), n).over(w)


def rolling_means(df: DataFrame, x: str, ns, scale: float = 1.0, prefix: str = "ma",
                  w: WindowSpec | None = None) -> DataFrame:
    """Rolling means of an integer column (cents, shares) via one prefix sum.

    ``scale`` converts units once, at the final division (cents -> price).
    """
    w = w or win()
    cs = f"_cs_{x}"
    out = df.withColumn(cs, F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.select(*out.columns, *[
        (rolling_sum_prefix(cs, n, w) / (scale * n)).alias(f"{prefix}{n}") for n in ns
    ]).drop(cs)


def extremes(df: DataFrame, bases: dict, wanted: dict, w: WindowSpec) -> DataFrame:
    """Extremes of the last n rows for any n, by doubling: the best of 2k rows is the better of the best of k rows and
    that of the k rows before, and two overlapping runs of a power of two make up n rows.

    bases: name -> (value, F.greatest or F.least); wanted: column -> (base, n), n > 0.  So a row costs log n lags of
    one value each, whatever n is, and bases share their levels.  A struct (value, place) finds where an extreme
    lies.  Values of windows that are not full yet, and of those that hold a NULL, are for the caller to leave out.
    """
    most = {b: max(n for base, n in wanted.values() if base == b) for b in bases}
    best = {b: how for b, (_, how) in bases.items()}
    t = df.select("*", *[v.alias(f"_{b}_1") for b, (v, _) in bases.items()])
    made, k = [f"_{b}_1" for b in bases], 1
    while 2 * k <= max(most.values()):
        new = [b for b in bases if most[b] >= 2 * k]
        t = t.select("*", *[best[b](F.col(f"_{b}_{k}"), F.lag(f"_{b}_{k}", k).over(w)).alias(f"_{b}_{2 * k}") for b in new])
        made += [f"_{b}_{2 * k}" for b in new]
        k *= 2
    out = []
    for name, (b, n) in wanted.items():
        p = 1 << n.bit_length() - 1
        x = F.col(f"_{b}_{p}")
        out.append((x if p == n else best[b](x, F.lag(x, n - p).over(w))).alias(name))
    return t.select("*", *out).drop(*made)


def _whole(x, n: int, w: WindowSpec, rn: str) -> Column:
    """Whether the last ``n`` rows are there and have no NULL."""
    gap = F.last(F.when(col(x).isNull(), F.col(rn)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.col(rn) - n >= F.coalesce(gap, F.lit(0))


def prior_extrema(df: DataFrame, wanted: dict, w: WindowSpec, rn: str = "rn") -> DataFrame:
    """``rolling(n).max().shift()``, rows t-n..t-1, today excluded.  wanted: column -> (x, n, "max" or "min")."""
    bases = {f"{x}_{kind}": (F.col(x), F.greatest if kind == "max" else F.least) for x, _, kind in wanted.values()}
    t = extremes(df, bases, {f"_{c}": (f"{x}_{kind}", n) for c, (x, n, kind) in wanted.items()}, w)
    t = t.select("*", *[_whole(x, n, w, rn).alias(f"_w{c}") for c, (x, n, _) in wanted.items()])
    shown = [F.when(F.lag(f"_w{c}", 1).over(w), F.lag(f"_{c}", 1).over(w)).alias(c) for c in wanted]
    return t.select(*df.columns, *shown)


def forward_extrema(x: str, k: int, w: WindowSpec, fn=F.max) -> Column:
    """``rolling(k).max().shift(-k)``: rows t+1..t+k."""
    return rolling_frame(fn, x, w, 1, k)


def centered_mean(x: str, w: WindowSpec, n: int = 10) -> Column:
    """``rolling(n).mean().shift(-n/2)``: rows t-n/2+1..t+n/2."""
    h = n // 2
    frame = w.rowsBetween(-(n - h - 1), h)
    return F.when(F.count(col(x)).over(frame) == n, F.avg(col(x)).over(frame))


def rank_counts(x, n: int):
    """For each window of the last n values: how many are below its newest value, how many equal it, how many are its
    greatest.  Rows are taken in blocks of n: a window is the end of the block before and the beginning of its own, so
    one comparison of the two blocks' values serves n windows.  0 where the window is not full.
    """
    import numpy as np
    out, later, sooner = np.zeros((3, len(x)), np.int64), np.triu(np.ones((n, n), bool), 1), np.tri(n, dtype=bool)
    for at in range(0, len(x), n):
        own = x[at:at + n]
        before = x[at - n:at] if at else np.full(n, np.nan)
        values = np.concatenate([np.broadcast_to(before, (len(own), n)), np.broadcast_to(own, (len(own), len(own)))], 1)
        inside = np.concatenate([later[:len(own)], sooner[:len(own), :len(own)]], 1) & ~np.isnan(values)
        newest, top = own[:, None], np.where(inside, values, -np.inf).max(1, keepdims=True)
        out[:, at:at + n] = [(inside & m).sum(1) for m in (values < newest, values == newest, values == top)]
        out[:, at:at + n][:, inside.sum(1) < n] = 0
    return out


def ts_rank(df: DataFrame, x: str, n: int, name: str, key: str = "symbol") -> DataFrame:
    """Key, trade_date and the average rank of the newest value in its window / the greatest rank.

    ``df``: bars in halo segments; a segment is what one group holds.  Ranks are 1..n with ties averaged, so the
    greatest is n less the half of what ties with it.  NULL until the window is full, and where it holds a NULL.
    """
    kind = dict(df.dtypes)[key]

    def run(group):
        import numpy as np
        import pyarrow as pa
        group = group.sort_by("trade_date")
        below, equal, top = rank_counts(group.column(x).to_numpy().astype(float), n)
        with np.errstate(invalid="ignore", divide="ignore"):
            rank = (below + (equal + 1) / 2.0) / ((n - top) + (top + 1) / 2.0)
        got = pa.table({key: group.column(key), "trade_date": group.column("trade_date"), name: pa.array(rank, mask=equal == 0)})
        return got.filter(group.column("_home"))

    return df.select(key, "_seg", "_home", "trade_date", x).groupBy(key, "_seg").applyInArrow(run, f"{key} {kind}, trade_date date, {name} double")


def decay_linear(x: str, n: int, w: WindowSpec) -> Column:
    """Weights 1..n over the window (newest heaviest), normalised."""
    terms = [(col(x) if k == 0 else F.lag(col(x), k).over(w)) * float(n - k) for k in range(n)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / float(n * (n + 1) / 2)


def _day(df: DataFrame, x: str, n: int, w: WindowSpec, name: str, value: Column, how, rn: str) -> DataFrame:
    t = extremes(df, {"day": (value, how)}, {"_place": ("day", n)}, w)
    place = F.abs(F.col("_place")["at"])
    return t.select(*df.columns, F.when(_whole(x, n, w, rn), F.col(rn) - place + 1).cast("bigint").alias(name))


def high_day(df: DataFrame, x: str, n: int, w: WindowSpec, name: str, rn: str = "rn") -> DataFrame:
    """``n - argmax`` (first maximum wins; 1 = today)."""
    return _day(df, x, n, w, name, F.struct(col(x).alias("v"), (-F.col(rn)).alias("at")), F.greatest, rn)


def low_day(df: DataFrame, x: str, n: int, w: WindowSpec, name: str, rn: str = "rn") -> DataFrame:
    """``n - argmin`` (first minimum wins)."""
    return _day(df, x, n, w, name, F.struct(col(x).alias("v"), F.col(rn).alias("at")), F.least, rn)


def logistic(x, use: bool = True) -> Column:
    """Decreasing logistic ``1/(1+exp(0.001x))`` or identity."""
    x = col(x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(0.001) * x)) if use else x
