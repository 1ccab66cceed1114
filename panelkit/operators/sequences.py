"""Sequence datasets (D1-D6, P14, U1, U2): fixed-length windows per symbol by reference.

The stored panel is kept as dense blocks (``dense_blocks``): per symbol and ROWS
consecutive rows one row of arrays, one array a column, with the rows before
and the one row after that windows need.  A window is a block and an offset in
its arrays, so the table is stored about once, not once per place in a window.
A block knows its rows' numbers and how many rows its symbol has; so the
windows' starts (D1), the label after a window (D4) and the chronological split
(D5) are arithmetic inside a block, and whether a missing feature lies in a
training window (P14) is one flag a block.  Nothing here orders or shuffles a
symbol's rows; blocks are bucketed by symbol for what is grouped by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions.sql import q
from panelkit.plans import segments as G
from panelkit.session import cut

# Window lengths and split sizes of the reference trainers.
SEQ_SINGLE, SEQ_PANEL = 10, 50
PREDICT_WINDOWS, TEST_WINDOWS = 10, 90
ROWS = 256  # of a block
SHORT = 8 * ROWS  # rows of a key that are held as one list


def any_null(columns):
    """Whether a row has a NULL in any of the columns."""
    return reduce(lambda a, b: a | b, [F.col(q(c)).isNull() for c in columns], F.lit(False))


def dense_blocks(df: DataFrame, features, others=(), back: int = SEQ_PANEL - 1, rows: int = ROWS, key: str = "symbol", flag: str | None = None) -> DataFrame:
    """key, block, first, n, halo, len, dates, nulls and an array of each of ``features`` and ``others``.

    A block's own rows have the numbers ``first`` to ``first + n - 1`` (from 1) of the key's ``len`` rows in order of
    trade_date.  Arrays hold ``halo`` rows before them (``back``, or as many as there are) and one row after them, if
    there is one.  nulls: whether a row has a NULL in any of ``features``, or what the column ``flag`` says of it.

    Keys with at most SHORT rows are sent once, as one list each (``list_blocks``); those with more are numbered and cut
    by segments first (``numbered_blocks``), so that no task holds one.  ``df`` is read more than once.
    """
    features, others = list(features), list(others)
    bad = any_null(features) if flag is None else F.col(flag)
    t = df.select(key, "trade_date", *map(q, [*features, *others]), bad.alias("nulls"))
    long = cut(df.groupBy(key).agg(F.count("*").alias("len")).where(F.col("len") > SHORT), "long-keys")
    back = min(back, rows)
    if long.isEmpty():
        return list_blocks(t, [*features, *others], back, rows, key)
    few, many = t.join(F.broadcast(long.select(key)), key, "left_anti"), t.join(F.broadcast(long), key).drop("len")
    return list_blocks(few, [*features, *others], back, rows, key).unionByName(numbered_blocks(many, long, [*features, *others], back, rows, key))


def list_blocks(df: DataFrame, columns, back: int, rows: int, key: str) -> DataFrame:
    """``dense_blocks`` of keys whose rows fit a list: one exchange, on the key."""
    row = F.struct(F.col("trade_date").alias("dates"), "nulls", *[F.col(q(c)) for c in columns])
    held = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("r"))
    first, halo = f"(b * {rows}L + 1)", f"least({back}L, b * {rows}L)"
    n = f"least({rows}L, len - b * {rows}L)"
    own = f"slice(r, CAST({first} - {halo} AS INT), CAST({halo} + {n} + 1 AS INT))"
    made = held.selectExpr(key, "r", "CAST(size(r) AS BIGINT) AS len")
    cuts = f"inline(transform(sequence(0L, (len - 1) div {rows}), b -> named_struct('block', b, 'first', {first}, 'n', {n}, 'halo', {halo}, 'len', len, 'r', {own})))"
    return made.selectExpr(key, cuts).select(key, "block", "first", "n", "halo", "len", *[F.col("r").getField(c).alias(c) for c in ["dates", "nulls", *columns]])


def numbered_blocks(df: DataFrame, lens: DataFrame, columns, back: int, rows: int, key: str) -> DataFrame:
    """``dense_blocks`` of keys of any length: rows are numbered, then dealt by (key, block).  lens: key, len."""
    placed = G.segment(G.row_numbers(df, key), rows, back=back, fwd=1)
    row = F.struct("_grn", F.col("trade_date").alias("dates"), "nulls", *[F.col(q(c)) for c in columns])
    held = placed.groupBy(key, F.col("_seg").alias("block")).agg(F.sort_array(F.collect_list(row)).alias("r"), F.sum(F.col("_home").cast("long")).alias("n"))
    first = F.col("block") * rows + 1
    got = held.join(F.broadcast(lens), key).where("n > 0")
    return got.select(key, "block", first.alias("first"), "n", (first - F.col("r")[0]["_grn"]).alias("halo"), "len",
                      *[F.col("r").getField(c).alias(c) for c in ["dates", "nulls", *columns]])


def segment_blocks(df: DataFrame, features, rows: int = ROWS, back: int = SEQ_PANEL - 1, key: str = "symbol") -> DataFrame:
    """``dense_blocks`` of rows that lie in their segments already (``features.bar_features`` with ``around=(back, 1)``):
    blocks are cut from a segment's rows in order, with no exchange and no sort where these lie so.  A task holds one
    segment; in each the blocks begin anew, so those of a key that has more than one are not all of ``rows`` rows.
    """
    features = list(features)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    # the row's place in its segment: by this, a segment's rows lie together and in order
    place = F.row_number().over(Window.partitionBy(key, "_seg").orderBy("trade_date")).alias("_place")
    t = df.select(key, "_seg", "_home", "_no", "_len", "trade_date", *map(q, features), place)

    def cut(segments):
        """The blocks of whole segments, one after the other in a table."""
        import numpy as np
        import pyarrow as pa
        starts = np.flatnonzero(segments["_place"].to_numpy() == 1)
        home, number = segments["_home"].to_numpy(zero_copy_only=False), segments["_no"].to_numpy()
        at, begin, end, first, n, halo, block = [], [], [], [], [], [], []
        for a, b in zip(starts, [*starts[1:], len(segments)]):
            own = a + np.flatnonzero(home[a:b])
            for k, i in enumerate(own[::rows]):
                last = min(i + rows, own[-1] + 1)
                lo, hi = max(a, i - back), min(last + 1, b)
                for made, x in zip((at, begin, end, first, n, halo, block), (i, lo, hi, number[i], last - i, i - lo, k)):
                    made.append(x)
        if not at:
            return None
        taken = pa.array(np.concatenate([np.arange(lo, hi) for lo, hi in zip(begin, end)]))
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.subtract(end, begin))]).astype(np.int32))
        whole = segments.take(taken).combine_chunks()
        null = np.zeros(len(whole), bool)
        for c in features:
            if whole[c].null_count:
                null |= whole[c].is_null().to_numpy()

        def one(x):
            return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x

        segs = segments["_seg"].to_numpy()[at]
        lists = [pa.ListArray.from_arrays(offsets, x) for x in (one(whole["trade_date"]), pa.array(null), *[one(whole[c]) for c in features])]
        keys, lens = one(segments[key].take(pa.array(at))), one(segments["_len"].take(pa.array(at)))
        numbers = [pa.array(np.asarray(x, np.int64)) for x in (block, first, n, halo)]
        names = [key, "_seg", "block", "first", "n", "halo", "len", "dates", "nulls", *features]
        return pa.RecordBatch.from_arrays([keys, pa.array(segs.astype(np.int64)), *numbers, lens, *lists], names)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        held = None  # the rows of a segment that may go on
        for batch in batches:
            rows_so_far = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            starts = np.flatnonzero(rows_so_far["_place"].to_numpy() == 1)
            whole = int(starts[-1]) if len(starts) else 0
            got = cut(rows_so_far.slice(0, whole)) if whole else None
            held = rows_so_far.slice(whole)
            if got is not None:
                yield got
        got = cut(held) if held is not None and len(held) else None
        if got is not None:
            yield got

    arrays = ", ".join(f"{q(c)} array<{types[c]}>" for c in features)
    schema = f"{key} {types[key]}, _seg long, block long, first long, n long, halo long, len long, dates array<date>, nulls array<boolean>, {arrays}"
    got = t.mapInArrow(run, schema)
    # in the order of a key's segments, whatever a segment holds
    return got.withColumn("block", F.col("_seg") * F.lit(2 ** 20) + F.col("block")).drop("_seg")


def store_blocks(blocks: DataFrame, path: str, name: str, buckets: int | None = None, key: str = "symbol") -> DataFrame:
    """The blocks as a table bucketed by ``key`` and sorted: grouping by it needs no exchange.

    Each writing task makes a file per bucket that it has rows of.  buckets: as many as shuffle partitions if not given."""
    buckets = buckets or int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(buckets, key).sortBy(key, "block").option("path", path).format("parquet").saveAsTable(name)
    return blocks.sparkSession.table(name)


def ends(seq: int, r: int = 1) -> str:
    """Row numbers of the last rows of a block's windows: every ``r``-th, none without a row after it (``range(0, L - seq, r)``)."""
    return f"filter(sequence(first, first + n - 1), e -> e >= {seq} AND e < len AND (e - {seq}) % {r} = 0)"


def at(column: str, row: str) -> str:
    """The value of a column at a row number."""
    return f"{q(column)}[CAST({row} - first + halo AS INT)]"


def split_of(seq: int, r: int = 1, predict: int = PREDICT_WINDOWS, test: int = TEST_WINDOWS) -> str:
    """The split of the window that ends with row ``e``: the last ``predict`` windows, the ``test`` before them, the rest."""
    left = f"((len - 1 - {seq}) div {r} - (e - {seq}) div {r})"  # windows after it
    return f"CASE WHEN {left} < {predict} THEN 'predict' WHEN {left} < {predict + test} THEN 'test' ELSE 'train' END"


def window_ends(blocks: DataFrame, seq: int = SEQ_SINGLE, r: int = 1, last=(), labels=(), factor: float = 0.1,
                predict: int = PREDICT_WINDOWS, test: int = TEST_WINDOWS, key: str = "symbol") -> DataFrame:
    """D1 + D4 + D5 without the windows' rows: key, end_date, k, split, has_null, ``last`` (columns at the window's last
    row) and ``labels`` (at the row after the window, times ``factor``)."""
    fields = {"end_date": at("dates", "e"), "k": f"e - {seq}", "split": split_of(seq, r, predict, test),
              "has_null": f"exists(slice(nulls, CAST(e - first + halo AS INT) - {seq - 2}, {seq}), x -> x)",
              **{c: at(c, "e") for c in last}, **{c: f"{at(c, 'e + 1')} * {float(factor)!r}D" for c in labels}}
    made = ", ".join(f"'{n}', {x}" for n, x in fields.items())
    return blocks.selectExpr(key, f"inline(transform({ends(seq, r)}, e -> named_struct({made})))")


def window_rows(blocks: DataFrame, values: dict, seq: int = SEQ_SINGLE, r: int = 1, key: str = "symbol") -> DataFrame:
    """D1 in long form: key, end_date, pos, trade_date and ``values``: name -> SQL over ``row`` (number of the row at
    ``pos``) and ``begin`` (of the window's first row)."""
    place = f"e - {seq - 1} + p"
    fields = {"end_date": at("dates", "e"), "pos": "CAST(p AS BIGINT)", "trade_date": at("dates", place),
              **{c: x.replace("{row}", f"({place})").replace("{begin}", f"(e - {seq - 1})") for c, x in values.items()}}
    made = ", ".join(f"'{n}', {x}" for n, x in fields.items())
    return blocks.selectExpr(key, f"inline(flatten(transform({ends(seq, r)}, e -> transform(sequence(0, {seq - 1}), p -> named_struct({made})))))")


def sequence_windows(blocks: DataFrame, cols, seq: int = SEQ_SINGLE, r: int = 1) -> DataFrame:
    """D1 in long form: the rows of every window as they are."""
    return window_rows(blocks, {c: at(c, "{row}") for c in cols}, seq, r)


def anchor_relative(blocks: DataFrame, prices=("close", "open", "high", "low"), seq: int = SEQ_SINGLE, r: int = 1) -> DataFrame:
    """D2 in long form: in-window prices as ``10*p/(0.01 + close_first) - 10``."""
    return window_rows(blocks, {p: f"10.0D * {at(p, '{row}')} / (0.01D + {at('close', '{begin}')}) - 10.0D" for p in prices}, seq, r)


def first_row_norm(blocks: DataFrame, cols, scale: float = 1.0, seq: int = SEQ_SINGLE, r: int = 1) -> DataFrame:
    """D3 in long form: every column relative to the window's first row, ``scale*x/first - scale`` (10 in the single
    trainer, 1 in the panel one); NULL where that is 0 or NULL."""
    s = f"{float(scale)!r}D"
    return window_rows(blocks, {c: f"{s} * {at(c, '{row}')} / NULLIF({at(c, '{begin}')}, 0.0D) - {s}" for c in cols}, seq, r)


def null_symbols(blocks: DataFrame, seq: int = SEQ_SINGLE, r: int = 1, predict: int = PREDICT_WINDOWS, test: int = TEST_WINDOWS, key: str = "symbol") -> DataFrame:
    """(key, rejected) of the keys that have a window: 1 where any feature is NULL in any training window.

    Row g lies in a training window if the first window that ends at g or later is one and begins at g or before.
    """
    j = f"greatest(0, CAST(ceil((first + i - {seq}) / {r}) AS BIGINT))"
    inside = f"{j} <= (len - 1 - {seq}) div {r} - {predict + test} AND {seq} + {j} * {r} < first + i + {seq}"
    bad = f"exists(sequence(0L, n - 1), i -> nulls[CAST(halo + i AS INT)] AND {inside})"
    return blocks.where(F.col("len") > seq).selectExpr(key, f"CAST({bad} AS INT) AS bad").groupBy(key).agg(F.max("bad").alias("rejected"))


def reject_null_symbols(blocks: DataFrame, seq: int = SEQ_SINGLE, r: int = 1, key: str = "symbol") -> DataFrame:
    """The blocks of the symbols that are not rejected."""
    return blocks.join(null_symbols(blocks, seq, r, key=key).where("rejected = 1").select(key), key, "left_anti")


def union_splits(**splits: DataFrame) -> DataFrame:
    """Separately stored frames stacked by column name, told apart by ``split``."""
    named = [df.drop("split").withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(DataFrame.unionByName, named)


def matrices(batch, fields, seq: int, r: int = 1, labels=(), factor: float = 0.1):
    """For each block of an Arrow batch: (its row in the batch, numbers of its windows' last rows, windows, label rows).

    windows: an array (window, place, field), a view on the block; label rows: (window, label).  NULL is NaN.
    """
    import numpy as np

    def arrays(names):
        return [(c.offsets.to_numpy(), c.flatten().to_numpy(zero_copy_only=False)) for c in map(batch.column, names)]

    x, y = arrays(fields), arrays(labels)
    begin = x[0][0] - x[0][0][0]
    values = np.stack([v.astype(float) for _, v in x], 1)
    targets = np.stack([v.astype(float) * factor for _, v in y], 1) if y else np.zeros((len(values), 0))
    first, n, halo, total = (batch.column(c).to_numpy() for c in ("first", "n", "halo", "len"))
    for i in range(batch.num_rows):
        e = np.arange(max(first[i], seq), min(first[i] + n[i], total[i]))
        e = e[(e - seq) % r == 0]
        if not len(e):
            continue
        at_end = e - first[i] + halo[i]
        rows = values[begin[i]:begin[i + 1]]
        seen = np.lib.stride_tricks.sliding_window_view(rows, seq, axis=0).transpose(0, 2, 1)
        yield i, e, seen[at_end - seq + 1], targets[begin[i]:begin[i + 1]][at_end + 1]


def _digest(x, seen, begin: int, n: int, seq: int, scale: float | None, r: int):
    """(field, window): the windows' sums of place x value; window k is the columns ``begin + k * r`` and on of ``x``.
    ``seen``: per field how many values are no NaN before a column."""
    import numpy as np

    def at(a, p):
        return a[:, begin + p:begin + p + (n - 1) * r + 1:r]

    whole = np.nan_to_num(x) if scale is None else x
    base = None if scale is None else np.where(at(x, 0) == 0, np.nan, at(x, 0))
    total, term = np.empty((len(x), n)), np.empty((len(x), n))
    for p in range(seq):
        if scale is None:
            np.multiply(at(whole, p), p + 1, out=term)
        else:
            np.multiply(at(whole, p), scale, out=term)
            np.divide(term, base, out=term)
            np.subtract(term, scale, out=term)
            np.multiply(term, p + 1, out=term)
        if p:
            np.add(total, term, out=total)
        else:
            total[:] = term
    if scale is None:
        total[at(seen, seq) == at(seen, 0)] = np.nan
    return total


def window_digests(blocks: DataFrame, fields, forms: dict, name: str = "form", r: int = 1, key: str = "symbol") -> DataFrame:
    """key, end_date, ``name`` and per field the sum over the window of (place from 1) x value, for each of ``forms``:
    what ``name`` says of it -> (rows of a window, scale).  The blocks are read once for all forms.

    The values as they are (D1; a NULL adds nothing, a window of NULLs gives NULL), or with a scale relative to the
    window's first row (D3; NULL if any is).  Places are added in order, so that the sum is one in every engine.
    """
    fields, together = list(fields), 32  # blocks whose sums are sent on together

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in (b.slice(i, together) for b in batches for i in range(0, b.num_rows, together)):
            dates = batch.column("dates")
            begin = dates.offsets.to_numpy() - dates.offsets[0].as_py()
            values = np.stack([batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float) for c in fields])
            days = dates.flatten()
            first, n, halo, total = (batch.column(c).to_numpy() for c in ("first", "n", "halo", "len"))
            got = {tag: ([], [], []) for tag in forms}
            for i in range(batch.num_rows):
                x = np.ascontiguousarray(values[:, begin[i]:begin[i + 1]])
                seen = np.zeros((x.shape[0], x.shape[1] + 1), np.int32)
                np.cumsum(~np.isnan(x), axis=1, out=seen[:, 1:])
                for tag, (seq, scale) in forms.items():
                    e = np.arange(max(first[i], seq), min(first[i] + n[i], total[i]))
                    e = e[(e - seq) % r == 0]
                    if len(e):
                        sums, which, ends_at = got[tag]
                        at_end = e - first[i] + halo[i]
                        sums.append(_digest(x, seen, int(at_end[0]) - seq + 1, len(e), seq, scale, r))
                        which.append(np.full(len(e), i))
                        ends_at.append(begin[i] + at_end)
            for tag, (sums, which, ends_at) in got.items():
                if sums:
                    flat = np.concatenate(sums, 1)
                    cols = [batch.column(key).take(pa.array(np.concatenate(which))), days.take(pa.array(np.concatenate(ends_at))), pa.array(np.full(flat.shape[1], tag, np.int32))]
                    yield pa.RecordBatch.from_arrays([*cols, *[pa.array(c, mask=np.isnan(c)) for c in flat]], [key, "end_date", name, *fields])

    schema = f"{key} string, end_date date, {name} int, " + ", ".join(f"{q(c)} double" for c in fields)
    return blocks.select(key, "first", "n", "halo", "len", "dates", *map(q, fields)).mapInArrow(run, schema)


def window_digest(blocks: DataFrame, fields, seq: int, scale: float | None = None, r: int = 1, key: str = "symbol") -> DataFrame:
    """``window_digests`` of one form: key, end_date and the fields' sums."""
    return window_digests(blocks, fields, {0: (seq, scale)}, "_form", r, key).drop("_form")


def drop_blocks(spark: SparkSession, name: str) -> None:
    """Forget a stored table; its files belong to whoever named the path."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
