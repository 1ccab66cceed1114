"""Bar panels derived from the driver's read-only tables.

The reference reads daily bars from a market-data feed.  Here the feed is a
file scan, and the test bars are derived from ``lineitem`` (one symbol per
supplier, one bar per supplier and ship date; see FIXTURES.md).  Lines are
shuffled once on the bar key (index bars: after a partial aggregation), so the
derivation scales with ``lineitem``; first and last price of a day are
aggregates over an ordering struct, which Spark sorts per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import whole

# Fixed values of the fixture derivation (FIXTURES.md §2-§4).
BASE_CENTS = 10000
INDEX_CODE = "sh.000001"
INDEX_PRICE_FACTOR = 30
INDEX_DROP_MODULUS = 97
BLANK_VOLUME_MODULUS = 29
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, extra_order=(), together=()) -> DataFrame:
    """The lines with what bars are made of; rows with equal ``together`` in one partition, if given."""
    li = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("suppkey"), F.col("l_shipdate").cast("date").alias("trade_date"),
        *dict.fromkeys([*LINE_ORDER, *extra_order, "l_tax", "l_discount", "l_returnflag"]))
    if together:
        li = li.repartition(*together)
    return li.select(
        "suppkey", "trade_date",
        (F.lit(BASE_CENTS) + F.floor(F.floor("l_extendedprice") / 100)).cast("bigint").alias("p"),
        F.col("l_quantity").cast("bigint").alias("q"),
        whole(F.col("l_tax") * 100).cast("bigint").alias("tx"),
        whole(F.col("l_discount") * 100).cast("bigint").alias("dc"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_r"),
        F.struct(*LINE_ORDER, *extra_order).alias("ord"),
    )


def _bar_aggs():
    return [
        F.min_by("p", "ord").alias("first_p"),
        F.max_by("p", "ord").alias("last_p"),
        F.max("p").alias("max_p"),
        F.min("p").alias("min_p"),
        F.sum("q").alias("qq"),
        F.sum(F.col("p") * F.col("q")).alias("pq"),
        F.sum("tx").alias("stx"),
        F.sum("dc").alias("sdc"),
        F.max("is_r").alias("any_r"),
    ]


def _ohlc(factor: int = 1):
    q = F.col("qq")
    close = F.col("last_p")
    open_ = F.when(q % 13 == 0, close).otherwise(F.col("first_p") + q % 21 - 10)
    high = F.greatest(open_, close, F.col("max_p")) + q % 13
    low = F.least(open_, close, F.col("min_p")) - F.when(q % 13 == 0, F.lit(0)).otherwise(q % 11)
    return [
        (open_ * factor).cast("bigint").alias("open_c"),
        (high * factor).cast("bigint").alias("high_c"),
        (low * factor).cast("bigint").alias("low_c"),
        (close * factor).cast("bigint").alias("close_c"),
        (F.lit(100000) * (q - 1)).cast("bigint").alias("volume"),
        (F.lit(1000) * F.col("pq")).cast("bigint").alias("amount_c"),
    ]


def symbol_of(suppkey) -> "F.Column":
    k = F.col(suppkey) if isinstance(suppkey, str) else suppkey
    code = k + 600000 * (k % 2) + 88000 * (k % 10 == 1).cast("bigint")
    return F.lpad(code.cast("string"), 6, "0")


def bars(spark: SparkSession, sf_dir: str, with_suppkey: bool = False) -> DataFrame:
    """Typed daily bars ``(symbol, trade_date, open_c .. isST)``; prices in cents.

    A bar has hardly more than one line, so nothing is gained by sums before the shuffle, which would sort every line
    (the ordering structs do not fit a hash table) and send two structs for each.  The lines go as they are."""
    key = ["suppkey", "trade_date"]
    agg = _lines(spark, sf_dir, together=key).groupBy(*key).agg(*_bar_aggs())
    q = F.col("qq")
    cols = [symbol_of("suppkey").alias("symbol"), "trade_date", *_ohlc(),
            ((q * 2 + 10).cast("double") / 100.0).alias("turn"),
            (F.col("stx") * 5 - 4).cast("double").alias("peTTM"),
            ((F.col("sdc") + 5).cast("double") / 10.0).alias("pbMRQ"),
            ((F.col("sdc") - 1).cast("double") / 2.0).alias("psTTM"),
            (F.col("stx") * 3 - 7).cast("double").alias("pcfNcfTTM"),
            F.col("any_r").cast("int").alias("isST"),
            q.alias("_q")]
    if with_suppkey:
        cols.append("suppkey")
    return agg.select(*cols)


def index_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market index bars: all lines of a day, prices x30, some days removed."""
    agg = (_lines(spark, sf_dir, extra_order=("l_suppkey",))
           .groupBy("trade_date").agg(*_bar_aggs()))
    return (agg.filter(F.unix_date("trade_date") % INDEX_DROP_MODULUS != 0)
            .select(F.lit(INDEX_CODE).alias("index_code"), "trade_date",
                    *_ohlc(INDEX_PRICE_FACTOR)))


def _num_str(c):
    return F.col(c).cast("string")


def _price_str(c):
    return (F.col(c) / 100.0).cast("string")


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as the reference receives it: every field a string."""
    b = bars(spark, sf_dir)
    vol = F.when(F.col("_q") % BLANK_VOLUME_MODULUS == 0, F.lit("")).otherwise(_num_str("volume"))
    return b.select(
        "symbol",
        F.col("trade_date").cast("string").alias("date"),
        _price_str("close_c").alias("close"),
        _price_str("open_c").alias("open"),
        _price_str("low_c").alias("low"),
        _price_str("high_c").alias("high"),
        _num_str("turn").alias("turn"),
        vol.alias("volume"),
        _price_str("amount_c").alias("amount"),
        *[_num_str(c).alias(c) for c in ("peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST")],
    )


def raw_bars_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with fields missing: NULL and blank valuations, NULL volumes and NULL (so zero) prices."""
    b = bars(spark, sf_dir).select("symbol", F.col("trade_date").cast("string").alias("date"), "_q")
    q = F.col("_q")
    gone = {"peTTM": q % 31 == 0, "volume": q % 43 == 0, "low": q % 41 == 0, "high": q % 47 == 0, "psTTM": q % 53 == 0}
    raw = raw_bars(spark, sf_dir).join(b, ["symbol", "date"])
    blank = {"pbMRQ": F.when(q % 37 == 0, F.lit("")).otherwise(F.col("pbMRQ")), "turn": F.when(q % 59 == 0, F.lit("n/a")).otherwise(F.col("turn"))}
    cols = {c: F.when(~g, F.col(c)) for c, g in gone.items()} | blank
    return raw.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in raw.columns if c != "_q"])


def raw_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index feed as strings, with days of blank and of zero volume."""
    day = F.unix_date("trade_date")
    vol = F.when(day % 53 == 0, F.lit("")).when(day % 59 == 0, F.lit("0")).otherwise(_num_str("volume"))
    return index_bars(spark, sf_dir).select("index_code", F.col("trade_date").cast("string").alias("date"),
                                            *[_price_str(f"{p}_c").alias(p) for p in ("open", "high", "low", "close")],
                                            vol.alias("volume"), _price_str("amount_c").alias("amount"))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol master: one row per supplier key that ever traded."""
    li = _table(spark, sf_dir, "lineitem").select("l_suppkey").distinct()
    return li.select(symbol_of("l_suppkey").alias("symbol"), F.col("l_suppkey").alias("suppkey"))


def stored_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols whose features are already stored (a fixed subset)."""
    return symbols(spark, sf_dir).filter(F.col("suppkey") % 3 != 0).select("symbol")
