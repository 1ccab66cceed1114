"""File scans of bar feeds and stored features.

The reference pulls bars from a remote market-data client; here the feed is a
file dataset.  Column list and date range are pushed into the scan (Parquet
``ReadSchema`` / ``PushedFilters``); price adjustment is a column of the feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.session import cut

# The feeds' field lists (stock, index, simple, unadjusted).
STOCK_FIELDS = ["date", "close", "open", "preclose", "low", "high", "turn", "volume", "amount",
                "peTTM", "pbMRQ", "psTTM", "pcfNcfTTM", "isST"]
INDEX_FIELDS = ["date", "open", "high", "low", "close", "preclose", "volume", "amount", "pctChg"]
SIMPLE_FIELDS = ["date", "code", "open", "high", "low", "close", "volume", "amount"]
UNADJUSTED_FIELDS = ["date", "code", "open", "high", "low", "close", "preclose", "volume", "amount"]
ADJUST_FIELD = "adjustflag"


def string_schema(fields, key: str = "symbol") -> StructType:
    """All-string schema of a raw feed (the reference receives strings)."""
    return StructType([StructField(key, StringType())] + [StructField(f, StringType()) for f in fields])


def read_feed(spark: SparkSession, path: str, fields=STOCK_FIELDS, fmt: str = "parquet",
              start: str | None = None, end: str | None = None, adjust: str | None = None,
              key: str = "symbol") -> DataFrame:
    """Scan a raw feed with its fixed field list; the date range (and adjustment) become pushed-down
    filters.  Asking for an adjustment of a feed that has none recorded is an error."""
    extra = [] if adjust is None else [ADJUST_FIELD]
    if fmt == "csv":
        df = spark.read.schema(string_schema([*fields, *extra], key)).option("header", "true").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if adjust is not None:
        if ADJUST_FIELD not in df.columns:
            raise ValueError(f"the feed at {path} has no {ADJUST_FIELD}")
        df = df.filter(F.col(ADJUST_FIELD) == adjust)
    if start is not None:
        df = df.filter(F.col("date") >= start)
    if end is not None:
        df = df.filter(F.col("date") <= end)
    return df.select(key, *fields)


def load_features(spark: SparkSession, path: str, min_rows: int = 1, min_cols: int = 0) -> DataFrame:
    """Stored features with the trainers' gates.

    Of each symbol the rows of its latest run count.  Too few columns is an error (the reference returns nothing
    then).  What a gate leaves out is found from counts per symbol and run, which read no other column; where that is
    nothing, as in a table of one run, no row is joined to anything.
    """
    df = spark.read.parquet(path)
    own = [c for c in df.columns if "run" not in df.columns or c not in ("run", "bucket")]
    check_columns(own, min_cols)
    parts = ["symbol", "run"] if "run" in df.columns else ["symbol"]
    n = df.filter("symbol IS NOT NULL").groupBy(*parts).agg(F.count("*").alias("_n"))
    kept = F.col("_n") > min_rows
    if "run" in parts:
        kept &= F.col("run") == F.max("run").over(Window.partitionBy("symbol"))
    out = cut(n.select(*parts, kept.alias("_kept")).filter("NOT _kept").drop("_kept"), "left-out")
    df = df.filter("symbol IS NOT NULL")
    return (df if out.isEmpty() else df.join(out, parts, "left_anti")).select(*[f"`{c}`" for c in own])


def check_columns(columns, min_cols: int) -> None:
    """S9's gate on the number of a table's columns."""
    if len(columns) <= min_cols:
        raise ValueError(f"{len(columns)} columns stored; more than {min_cols} are asked for")
