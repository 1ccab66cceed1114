"""S7 incremental runs as a stream: new feed files -> features of the symbols they concern.

The reference walks the symbol list and skips symbols whose output exists.
Here new feed files arrive in a directory.  Each micro-batch (``foreachBatch``)
stores its bars under its number, takes all stored bars of the symbols it
brought (a feature row depends on the whole history, which may come in many
batches), computes their feature rows and stores those under the same number.
Readers take each symbol's latest run.  A batch that is run again, after a
failure or a restart, replaces its own files only, so nothing is lost or
doubled.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.plans.features import feature_table
from panelkit.session import checkpoint_dir
from panelkit.sources import sinks


def known_bars(spark: SparkSession, store: str, fields, up_to: int) -> DataFrame:
    """The stored bars up to a batch, one row per symbol and date: that of the latest batch."""
    rows = spark.read.parquet(store).filter(F.col("batch") <= up_to)
    latest = Window.partitionBy("symbol", "date").orderBy(F.col("batch").desc())
    return rows.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").select(*fields)


def run_incremental(spark: SparkSession, feed_dir: str, feed_schema: StructType,
                    index_bars: DataFrame, sink: str, checkpoint: str | None = None,
                    buckets: int = 64, **table_options):
    """Process every feed file not seen before (``availableNow``), then stop.

    Feature rows go to ``sink``, bars to ``sink`` + "-bars"."""
    base = sink.rstrip("/")
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/incremental-{os.path.basename(base)}"
    bars = f"{base}-bars"

    def batch(df: DataFrame, epoch_id: int) -> None:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if df.isEmpty():
                return
            df.write.mode("overwrite").parquet(f"{bars}/batch={epoch_id}")
            touched = df.select("symbol").distinct()
            history = known_bars(spark, bars, df.columns, epoch_id).join(touched, "symbol", "left_semi")
            sinks.write_features(feature_table(history, index_bars, **table_options), base, run=epoch_id, buckets=buckets)
        finally:
            df.unpersist()

    q = (spark.readStream.schema(feed_schema).parquet(feed_dir)
         .writeStream.foreachBatch(batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
