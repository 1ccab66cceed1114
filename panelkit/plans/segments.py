"""Segmented execution of bounded-lookback window stages (hot symbols).

A per-symbol window puts a symbol's whole history in one task.  For daily
bars that is bounded by the calendar; for a symbol holding a large share of
all rows (intraday bars, very long histories) it is not.  Every stock,
indicator and label window here looks back at most ``HALO_BACK`` rows and
ahead at most ``HALO_FWD`` rows, so a history can be cut into segments of
``seg_rows`` rows, each carrying copies of its neighbours' edge rows (halos):

1. ``row_numbers``: the global row number per symbol without a per-symbol
   task — counts per (symbol, month) are a partial aggregation, their running
   offsets a window over that small table, and rows are numbered inside
   their (symbol, month) block.
2. ``segment``: each row goes to its home segment, the last ``back`` rows of
   a segment also to the next one, the first ``fwd`` rows also to the
   previous one (``explode`` of at most three segment numbers).
3. ``segmented``: the stage runs over ``PARTITION BY symbol, _seg``; only
   home rows are kept.  Results equal the unsegmented plan row for row
   (tested), because every frame of a home row lies inside its segment.

Running sums from a symbol's first row (OBV, A/D line) add the totals of all
earlier segments (``indicators.segment_offsets``); linear recurrences run on
blocks of their own (``recurrences``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Longest lookback of any bounded stage (prior 120-row extrema need row 121)
# and longest lookahead (10-day labels).
HALO_BACK = 121
HALO_FWD = 10
SEG_ROWS = 20_000  # of a segment, at every size
SEG_WS = "PARTITION BY symbol, _seg ORDER BY trade_date"


def spec(key: str) -> str:
    """The window of a segment."""
    return f"PARTITION BY {key}, _seg ORDER BY trade_date"



def row_numbers(df: DataFrame, key: str = "symbol", order: str = "trade_date",
                name: str = "_grn") -> DataFrame:
    """1-based row number per ``key`` in ``order``, computed block-wise."""
    b = df.withColumn("_blk", F.year(order) * 12 + F.month(order))
    counts = b.groupBy(key, "_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(key, "_blk", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    local = b.withColumn("_loc", F.row_number().over(Window.partitionBy(key, "_blk").orderBy(order)))
    return (local.join(offs, [key, "_blk"])
            .withColumn(name, F.col("_off") + F.col("_loc")).drop("_blk", "_off", "_loc"))


def segment(df: DataFrame, seg_rows: int, back: int = HALO_BACK, fwd: int = HALO_FWD,
            grn: str = "_grn", size: str | None = None) -> DataFrame:
    """Home segment plus halo copies; adds ``_seg`` (long) and ``_home`` (bool).

    ``size``: the column with the key's number of rows, if known; its last segment then has no copies after it."""
    if seg_rows < max(back, fwd):
        raise ValueError("segments must be at least as long as the halos")
    pos = (F.col(grn) - 1) % seg_rows
    seg = F.floor((F.col(grn) - 1) / seg_rows).cast("long")

    more = F.lit(True) if size is None else (seg + 1) * seg_rows < F.col(size)
    first = F.when((pos < fwd) & (seg > 0), seg - 1).otherwise(seg)
    last = F.when((pos >= seg_rows - back) & more, seg + 1).otherwise(seg)
    t = df.select("*", F.explode(F.sequence(first, last)).alias("_seg"))
    return t.select("*", (F.col("_seg") == seg).alias("_home"))


def home_segments(numbered: DataFrame, seg_rows: int, key: str = "symbol", grn: str = "_grn", more=()) -> DataFrame:
    """(key, _seg, ``more``): the segments that have home rows, from a partial aggregation; ``more``: further aggregates
    of the key."""
    last = numbered.groupBy(key).agg(F.floor((F.max(grn) - 1) / seg_rows).cast("long").alias("_last"), *more)
    return last.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("_seg")).drop("_last")


def segmented(df: DataFrame, stage, seg_rows: int, back: int = HALO_BACK,
              fwd: int = HALO_FWD) -> DataFrame:
    """Run ``stage(frame, ws)`` per (symbol, segment); keep home rows only."""
    s = segment(row_numbers(df), seg_rows, back, fwd)
    out = stage(s, SEG_WS)
    return out.filter(F.col("_home")).drop("_seg", "_home", "_grn")
