"""Operator 5, sharding by sampled splitters.  Law: ``bytes``, shards of near equal size.

Records are put in one order (hash of the text, hash of the doc_id, hash of the
row number), in which equal texts are neighbours.  A size-weighted sample of
keys gives quantile boundaries, which cut the order into ranges; exact counts
then find overfull ranges.  In these, keys with many rows, again by exact
counts, get a range of their own, which is subdivided by the doc_id's hash, and
there a doc_id with many rows by the row's; other overfull ranges by the key.  Prefix sums over the exact bytes of the cells give every
record its place, and the shards are cut at the exact quantiles of the bytes.
Where a small group of equal texts would be cut, the cut moves to the group's
nearer end; a group too large for that is cut, as the law demands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.common import table, written

RANGES = 256
SAMPLES = 16 * RANGES  # expected size of the sample of keys
CELL_ROWS = 100_000  # of a cell at most, about; cells are what one task sorts
GROUP_SLACK = 0.005  # of a shard: a group of equal texts up to this size is not cut
BITS = 52  # of a key: a double holds it exactly


def _hash52(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c), 1, BITS // 4), 16, 10).cast("long")


def records(df: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, key, tie, row, mix: all that sharding needs to know of a document.  Null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tie = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return df.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), _hash52(text).alias("key"), _hash52(tie).alias("tie"), F.monotonically_increasing_id().alias("row")).withColumn("mix", F.shiftrightunsigned(F.xxhash64("row"), 64 - BITS))


def splitters(recs: DataFrame, total: int) -> list[int]:
    """Boundaries of the ranges: quantiles of a size-weighted sample of about SAMPLES keys.

    Rows are drawn by their number, so that repeated ones
    are not drawn all at once.
    """
    rate = SAMPLES / max(total, 1)
    u = F.pmod(F.xxhash64("row"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = recs.where(u < F.col("size") * rate).select("key", F.greatest(F.lit(1.0), F.col("size") * rate).alias("weight")).collect()
    drawn.sort()
    step, at, bounds = sum(w for _, w in drawn) / RANGES, 0.0, {0}
    for key, weight in drawn:
        before, at = at, at + weight
        if step and int(at / step) > int(before / step):
            bounds.add(key)
    return sorted(bounds)


def _ranged(recs: DataFrame, bounds: list[int]) -> DataFrame:
    from pyspark.ml.feature import Bucketizer
    edges = [float(b) for b in bounds] + [float(1 << BITS)]
    if len(edges) < 3:
        return recs.withColumn("range", F.lit(0))
    got = Bucketizer(splits=edges, inputCol="x", outputCol="range").transform(recs.withColumn("x", F.col("key").cast("double")))
    return got.drop("x").withColumn("range", F.col("range").cast("int"))


def cells(recs: DataFrame, bounds: list[int], rows: int) -> DataFrame:
    """``cell`` for each record: its range, subdivided where exact counts say it is overfull.  Cells follow the order.

    The driver holds range counts and the keys and ids that have over half a cell's rows: 2 * rows / cell at most.
    """
    most = min(CELL_ROWS, max(1, 2 * rows // RANGES))
    count = lambda df, *by: {r[:-1] if len(by) > 1 else r[0]: r["n"] for r in df.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > (0 if by == ("range",) else most // 2)).collect()}
    ranged = _ranged(recs, bounds)
    counts = count(ranged, "range")
    full = [r for r, n in counts.items() if n > most]
    hot = count(ranged.where(F.col("range").isin(full)), "key") if full else {}
    if hot:
        bounds = sorted({*bounds, *hot, *(k + 1 for k in hot if k + 1 < 1 << BITS)})
        ranged = _ranged(recs, bounds)
        counts = count(ranged, "range")
    width = float(1 << BITS)
    edges = [float(b) for b in bounds] + [width]
    single = [r for r, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi - lo <= 1 and counts.get(r, 0) > most]
    ties: dict[int, list] = {}
    for (r, tie), n in sorted((count(ranged.where(F.col("range").isin(single)), "range", "tie") if single else {}).items()):
        ties.setdefault(r, []).append((tie, n))
    plan, base = [], 0
    for r, (lo, hi) in enumerate(zip(edges, edges[1:])):
        n, parts = counts.get(r, 0), []  # (first tie, what divides it, from where, how wide, rows)
        if r in single:
            rest, at = n - sum(k for _, k in ties.get(r, ())), 0.0
            for tie, k in ties.get(r, ()):
                if tie > at:
                    parts.append((at, "tie", at, tie - at, rest * (tie - at) / width))
                parts.append((float(tie), "mix", 0.0, width, k))
                at = tie + 1.0
            if at < width:
                parts.append((at, "tie", at, width - at, rest * (width - at) / width))
        else:
            parts.append((0.0, "key", lo, hi - lo, n))
        first = []
        for *_, k in parts:
            first.append((base, subs := max(1, -(-int(k) // most))))
            base += subs
        plan.append((r, [int(p[0]) for p in parts], [p[1] for p in parts], [p[2] for p in parts], [p[3] for p in parts], [b for b, _ in first], [k for _, k in first]))
    small = recs.sparkSession.createDataFrame(plan, "range int, ties array<long>, what array<string>, lo array<double>, width array<double>, base array<long>, subs array<long>")
    part = F.size(F.filter("ties", lambda t: t <= F.col("tie"))) - 1
    at = lambda c: F.get(c, F.col("part"))
    x = F.when(at("what") == "key", F.col("key")).when(at("what") == "tie", F.col("tie")).otherwise(F.col("mix"))
    sub = F.least(at("subs") - 1, F.floor((x - at("lo")) / at("width") * at("subs")))
    # a row a range, of which there are RANGES and two per key of over half a cell
    return ranged.join(small, "range").withColumn("part", part).withColumn("cell", (at("base") + sub).cast("long")).select(*recs.columns, "cell")


def shard(df: DataFrame, n_shards: int = 8, slack: float = GROUP_SLACK) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, at (bytes before the record in the order).

    Null texts count as empty (size 1); repeated rows are records of their own; an empty table gives no rows.
    The driver holds range counts, the sample of keys and one record per cut.
    """
    recs = written(records(df), "shard-records")
    total, rows = recs.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    celled = cells(recs, splitters(recs, total), rows)
    sums = celled.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # over cells, not records
    starts = sums.select("cell", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("cell_at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_rank"))
    inside = Window.partitionBy("cell").orderBy("key", "tie", "mix", "row")
    placed = written(
        celled.withColumn("at", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("rank", F.row_number().over(inside) - 1)
        .join(starts, "cell").select("doc_id", "size", "text_crc32", "key", (F.col("at") + F.col("cell_at")).alias("at"), (F.col("rank") + F.col("cell_rank")).alias("rank")), "shard-placed")
    cuts = _cuts(placed, total, n_shards, slack)
    where = F.lit(0)
    for c in cuts:
        where = where + (F.col("at") >= c).cast("int")
    sharded = placed.withColumn("shard", where)
    firsts = dict(sharded.groupBy("shard").agg(F.min("rank")).collect())
    first = F.lit(0)
    for s, r in firsts.items():
        first = F.when(F.col("shard") == s, F.lit(r)).otherwise(first)
    return sharded.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - first).cast("long").alias("slot"), "at")


def _cuts(placed: DataFrame, total: int, n_shards: int, slack: float) -> list[int]:
    """Where shards 1, 2, ... begin, in bytes: the record's or small group's end that is nearest to the exact quantile."""
    aims = [total * j // n_shards for j in range(1, n_shards)]
    hit = None
    for a in aims:
        here = (F.col("at") <= a) & (F.col("at") + F.col("size") > a)
        hit = here if hit is None else hit | here
    if hit is None or not total:
        return []
    struck = placed.where(hit).select("key", "at", "size").collect()
    groups = {k: (a, b) for k, a, b in placed.where(F.col("key").isin([r["key"] for r in struck] or [-1])).groupBy("key").agg(F.min("at"), F.max(F.col("at") + F.col("size"))).collect()}
    cuts = []
    for a in aims:
        r = next(r for r in struck if r["at"] <= a < r["at"] + r["size"])
        lo, hi = groups[r["key"]]
        if hi - lo > slack * total / n_shards:
            lo, hi = r["at"], r["at"] + r["size"]
        cuts.append(lo if a - lo <= hi - a else hi)
    return cuts


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shard(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
