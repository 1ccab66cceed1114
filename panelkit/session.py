"""Session helpers for tests, bench and the CLI.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "panelkit") -> SparkSession:
    """The running session, or a new one.  Only what neither the caller nor the environment sets is filled in."""
    b = SparkSession.builder.appName(app)
    active = SparkSession.getActiveSession()
    if active is None:
        conf = SparkConf()
        if master or not conf.contains("spark.master"):
            b = b.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        wanted = {**_DEFAULTS, "spark.driver.memory": os.environ.get("PANELKIT_DRIVER_MEM", "8g"), "spark.sql.shuffle.partitions": "8"}
        for k, v in wanted.items():
            if not conf.contains(k):
                b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage (``spark.checkpoint.dir``), read from the session.

    Where it is unset, a local session (tests) gets a scratch folder of its own; on a cluster that is an error, as
    executors would each write to their own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="panelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> None:
    """Let a stage whose generated method is over 8,000 bytes run operator by operator.

    The JVM never compiles such a method: the projections of the wide window stages would be interpreted, row by row.
    What the session sets itself stays."""
    if spark.conf.get(METHOD_LIMIT, None) is None:
        spark.conf.set(METHOD_LIMIT, "8000")


_made: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/panelkit/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back, so that several readers derive it once
    and a lost executor costs nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession, keep=()) -> None:
    """Delete what ``cut`` and the stores of this process have written, but for ``keep``.  Results that were made from
    them must have been read or stored by then; a query makes its tables anew."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in _made if p not in keep]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        _made.remove(path)
