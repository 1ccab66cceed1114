"""Helpers shared by the operators of this package.

Conventions for all of them: only the named columns are read, so extra columns
(also ones named like an output) never clash; a null text counts as empty.
"""

from __future__ import annotations

import gc
import os
import sys
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import checkpoint_dir

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The folder that driver and executors share (``spark.checkpoint.dir``).  Where it is unset, a local session gets a
#: scratch folder; on a cluster that is an error.
shared_dir = checkpoint_dir


_scopes: dict[str, list[str]] = {}
_scope = ["queries"]


@contextmanager
def scope(name: str):
    """Tables that are written inside belong to ``name``, so that ``sweep`` finds them."""
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut the lineage: write to the shared folder, read the table again.

    Unlike a cache, the files outlive any executor, so a lost one costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/panelkit-llm/{name}-{uuid.uuid4().hex}"
    _scopes.setdefault(_scope[-1], []).append(path)
    writer = df.write.mode("errorifexists")
    for k, v in options.items():
        writer = writer.option(k, v)
    usual = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, "1000")  # texts are long: batches of the usual length would take much memory
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, usual)
    got = spark.read.schema(df.schema).parquet(path)
    got.written_path = path
    return got


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def clean_up(spark: SparkSession) -> None:
    """Delete all tables that queries of this package have written; for when their results have been stored or read."""
    sweep(spark, *list(_scopes))


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, [t.written_path])


def sweep(spark: SparkSession, *names: str) -> None:
    """Delete all tables of these scopes; whatever was made from them must be stored by now."""
    for n in names:
        _delete(spark, _scopes.pop(n, []))


def release(spark: SparkSession) -> None:
    """Ask for what lets Spark drop the shuffle files of finished work: it does so when the driver collects its
    garbage, and the JVM's only goes once Python's is gone.  Nothing depends on it but the room on disk."""
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` has not got."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written, so that no later change of the input's partitions moves it; its column."""
    name = fresh(df, "__row")
    return written(df.withColumn(name, F.monotonically_increasing_id()), "numbered", compression="zstd"), name


def worker_state() -> dict:
    """A dictionary that lives as long as the Python process: tables loaded once per worker, not per task."""
    return sys.__dict__.setdefault("_panelkit_llm_state", {})


def tokenizer_path(name: str, folder: str | None = None) -> str:
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def slim_texts(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the text, null as empty."""
    return df.select(*[F.col(c) for c in keep], F.coalesce(F.col("text"), F.lit("")).alias("text"))


def map_rows(df: DataFrame, rows, schema: str) -> DataFrame:
    """``rows(iterator of tuples) -> iterator of tuples`` over every partition, in Arrow batches of bounded size."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    out: StructType = _parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches):
        import pyarrow as pa

        def tuples():
            for b in batches:
                step = 256  # Python objects of only so many rows at once
                for at in range(0, b.num_rows, step):
                    yield from zip(*(c.to_pylist() for c in b.slice(at, step).columns))

        held, size = [], 0
        for row in rows(tuples()):
            held.append(row)
            size += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(held) >= 4096 or size > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], schema=arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], schema=arrow)

    return df.mapInArrow(run, out)
