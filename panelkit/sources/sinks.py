"""Feature sinks.

One Parquet dataset replaces one CSV per symbol: rows are hash-bucketed by
symbol so a symbol's history lands in one directory, and an incremental run
processes only symbols not yet stored (left-anti join), which fixes the
reference's never-true skip check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.clean import symbols_missing


# A feature has about as many values as rows: looking each up in a dictionary costs more than it saves.
PLAIN = {"parquet.enable.dictionary": "false", "compression": "zstd"}


def bucket_of(key: str = "symbol", buckets: int = 64):
    return F.pmod(F.hash(F.col(key)), F.lit(buckets)).alias("bucket")


def write_features(df: DataFrame, path: str, run: int = 0, buckets: int = 64) -> None:
    """Store one run's feature rows, under the run's number and a symbol bucket.

    A run replaces what an earlier, maybe broken-off, attempt of the same number has left, and nothing else;
    readers take each symbol's latest run.  Rows are stored from where they lie, a file per task and bucket: the feature
    stages leave those of a symbol's segment together, and dealing rows of all columns anew would gain no fewer files.
    """
    (df.withColumn("bucket", bucket_of("symbol", buckets))
       .write.mode("overwrite").options(**PLAIN).partitionBy("bucket").parquet(f"{path.rstrip('/')}/run={run}"))


def stored_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbols already present in a stored feature dataset (reads one column)."""
    return spark.read.parquet(path).select("symbol").distinct()


def incremental(features: DataFrame, stored: DataFrame) -> DataFrame:
    """Only symbols that are not stored yet."""
    return symbols_missing(features, stored)


def write_symbol_master(symbols: DataFrame, path: str) -> None:
    """The symbol master, sorted by code."""
    symbols.orderBy("symbol").write.mode("overwrite").option("header", "true").csv(path)


def export_dataset(df: DataFrame, path: str, max_records: int = 1_000_000) -> None:
    """Compressed export (zstd Parquet, bounded file size)."""
    (df.write.mode("overwrite").option("compression", "zstd")
       .option("maxRecordsPerFile", max_records).parquet(path))


def feature_catalog(df: DataFrame, key=("symbol", "trade_date")) -> DataFrame:
    """One row per stored column with its position, type and non-null
    count — computed from the data in one pass, replacing the header file."""
    cols = [c for c in df.columns if c not in key]
    counts = df.select(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    long = counts.unpivot([], cols, "name", "non_null")
    pos = {c: i for i, c in enumerate(df.columns)}
    types = dict(df.dtypes)
    mapping = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(pos[c]))])
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.select(mapping[F.col("name")].alias("position"), "name",
                       tmap[F.col("name")].alias("dtype"), "non_null")
