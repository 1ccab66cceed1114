"""Projections, filters and gates on the bar panel.

Filters run *before* any window: a dropped row closes the gap, so lags and
rolling windows count surviving rows, exactly as the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import whole
from panelkit.session import cut


PRICE_FIELDS = ("open", "high", "low", "close")
VALUE_FIELDS = ("turn", "amount", "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST")
# Fixed value: the board whose codes start with these characters is excluded.
EXCLUDED_BOARD = "688"


def exchange_prefix(df: DataFrame, code: str = "symbol", out: str = "bs_code") -> DataFrame:
    """P1: 'sh.' + code when it starts with 6, else 'sz.' + code."""
    c = F.col(code)
    return df.withColumn(out, F.when(c.startswith("6"), F.concat(F.lit("sh."), c))
                         .otherwise(F.concat(F.lit("sz."), c)))


def traded():
    """The day was no suspension (volume '0' or '' as a string; a missing volume is none of these)."""
    return F.coalesce(~F.col("volume").isin("0", ""), F.lit(True))


def fill_missing(raw: DataFrame, key=("symbol", "date")) -> DataFrame:
    """P5, first fill: a NULL field of the feed becomes '0' before any gate, as in the reference.

    So a bar without a valuation field stays (with 0), one without a volume counts as traded with volume 0, and one
    without a price has price 0, which every ratio guards against.
    """
    return raw.select(*[F.col(c) if c in key or c.startswith("_") else F.coalesce(F.col(c), F.lit("0")).alias(c) for c in raw.columns])


def unreadable_fields(raw: DataFrame, key=("symbol", "date")) -> DataFrame:
    """field, n_null, n_blank, n_unreadable: what the feed lacks, one partial aggregation."""
    fields = [c for c in raw.columns if c not in key]
    one = [F.struct(F.lit(c).alias("field"), F.col(c).alias("v")) for c in fields]
    v = F.col("v")
    return (raw.select(F.explode(F.array(*one)).alias("x")).select("x.field", "x.v").groupBy("field")
            .agg(F.count_if(v.isNull()).alias("n_null"), F.count_if(v == "").alias("n_blank"),
                 F.count_if((v != "") & v.try_cast("double").isNull()).alias("n_unreadable")))


def typed_bars(raw: DataFrame) -> DataFrame:
    """P2-P4, P6 as a flag: every row of the feed, filled and cast, with ``_ok`` for those that pass the gates.

    ``volume`` of '0' or '' is a suspension; the comparison happens on the string, before the cast.  Prices come
    back as integer cents so that all later window sums are exact.  A blank or unreadable field other than volume
    counts as missing, thus 0 (``unreadable_fields`` reports them); only a bar without symbol or date is incomplete.
    """
    raw = fill_missing(raw.withColumn("_traded", traded()))

    def num(c):
        return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))

    t = raw.select(
        "symbol", *[c for c in raw.columns if c.startswith("_") and c != "_traded"],
        F.col("date").try_cast("date").alias("trade_date"),
        *[whole(num(c) * 100).cast("bigint").alias(f"{c}_c") for c in PRICE_FIELDS],
        num("volume").cast("bigint").alias("volume"),
        *[num(c).alias(c) for c in VALUE_FIELDS],
        F.col("_traded").alias("_ok"))
    return t.withColumn("_ok", F.col("_ok") & (F.col("psTTM") > 0) & F.col("symbol").isNotNull() & F.col("trade_date").isNotNull())


def clean_bars(raw: DataFrame) -> DataFrame:
    """S1 + P2-P6: raw feed strings to typed, gated bars."""
    return typed_bars(raw).filter("_ok").drop("_ok")


def clean_index(raw: DataFrame, min_raw: int = 50) -> DataFrame:
    """The index feed's strings to typed bars: filled, without days of volume '0' or '', and only for index
    codes with more than ``min_raw`` feed rows."""
    t = fill_missing(raw.filter(traded()), ("index_code", "date"))

    def num(c):
        return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))

    big = raw.groupBy("index_code").agg(F.count("*").alias("n")).filter(F.col("n") > min_raw).select("index_code")
    typed = t.select(
        "index_code", F.col("date").try_cast("date").alias("trade_date"),
        *[whole(num(c) * 100).cast("bigint").alias(f"{c}_c") for c in PRICE_FIELDS],
        num("volume").cast("bigint").alias("volume"), num("amount").alias("amount"))
    return typed.filter("trade_date IS NOT NULL").join(big, "index_code", "left_semi")


def gated_bars(raw: DataFrame, min_raw: int = 50, min_clean: int = 300) -> DataFrame:
    """S1 + P2-P8: clean bars of the symbols with more than ``min_raw`` feed rows and ``min_clean`` clean ones.

    The typed feed is written once; the counts are a partial aggregation of it, not a window, so filters and casts
    come before any shuffle and a hot symbol is never gathered.  Where the gates leave no symbol out, the bars are joined
    to nothing.
    """
    typed = cut(typed_bars(raw), "typed-bars")
    n = typed.filter("symbol IS NOT NULL").groupBy("symbol").agg(F.count("*").alias("n_raw"), F.count_if("_ok").alias("n_clean"))
    out = cut(n.filter((F.col("n_raw") <= min_raw) | (F.col("n_clean") <= min_clean)).select("symbol"), "left-out")
    clean = typed.filter("_ok").drop("_ok")
    return clean if out.isEmpty() else clean.join(out, "symbol", "left_anti")


def history_counts(df: DataFrame, key: str = "symbol") -> DataFrame:
    """A4: rows per key as a partial aggregation (map-side combine)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def min_history(clean: DataFrame, min_clean: int = 300, key: str = "symbol") -> DataFrame:
    """Keep keys with more than ``min_clean`` rows: counts by partial aggregation, then a semi join."""
    n = history_counts(clean, key).filter(F.col("n_rows") > min_clean).select(key)
    return clean.join(n, key, "left_semi")


def warmup_trim(numbered: DataFrame, rows: int = 120) -> DataFrame:
    """Drop the first ``rows`` bars of each symbol (indicator warm-up); bars with their numbers ``_grn``."""
    return numbered.filter(F.col("_grn") > rows)


def tail_rows(numbered: DataFrame, rows: int, key: str = "symbol") -> DataFrame:
    """The last ``rows`` bars of each symbol; counts are a partial aggregation."""
    n = numbered.groupBy(key).agg(F.count("*").alias("_n"))
    return numbered.join(n, key).filter(F.col("_grn") > F.col("_n") - rows).drop("_n")


def exclude_board(df: DataFrame, key: str = "symbol", board: str = EXCLUDED_BOARD) -> DataFrame:
    """Drop symbols of the excluded board (first three characters)."""
    return df.filter(~F.substring(key, 1, 3).eqNullSafe(board))


def symbols_present(df: DataFrame, stored: DataFrame, key: str = "symbol") -> DataFrame:
    """Only symbols that have stored data (left-semi join)."""
    return df.join(stored.select(key), key, "left_semi")


def symbols_missing(df: DataFrame, stored: DataFrame, key: str = "symbol") -> DataFrame:
    """Symbols not yet stored, for incremental runs (left-anti join)."""
    return df.join(stored.select(key), key, "left_anti")


def stride_sample(numbered: DataFrame, r: int) -> DataFrame:
    """Every ``r``-th bar per symbol, starting with the first; bars with their numbers ``_grn``."""
    return numbered.filter((F.col("_grn") - 1) % r == 0)


def approx_amount(df: DataFrame) -> DataFrame:
    """Turnover approximated as mean of OHLC times volume (in currency)."""
    ohlc = (F.col("open_c") + F.col("close_c") + F.col("high_c") + F.col("low_c")) / 100.0
    return df.withColumn("amount", F.lit(0.25) * ohlc * F.col("volume"))



def global_index(df: DataFrame, order: str, name: str = "idx") -> DataFrame:
    """0-based position of each row in the order of a string column across the whole frame.

    Rows are blocked by the column's first characters, so a row's block is a function of its value; rows are
    numbered inside their block, and the counts of the blocks before it (a small table) are added.
    """
    t = df.withColumn("_blk", F.substring(order, 1, 4))
    counts = t.groupBy("_blk").agg(F.count("*").alias("_cnt"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_blk", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    local = t.withColumn("_loc", F.row_number().over(Window.partitionBy("_blk").orderBy(order)) - 1)
    return local.join(offsets, "_blk").withColumn(name, F.col("_off") + F.col("_loc")).drop("_blk", "_loc", "_off")


def symbol_chunks(symbols: DataFrame, size: int = 1000, key: str = "symbol") -> DataFrame:
    """Chunk id of each symbol in code order (chunks of ``size``)."""
    return global_index(symbols.select(key).distinct(), key).select(
        key, F.floor(F.col("idx") / size).cast("bigint").alias("chunk"))
