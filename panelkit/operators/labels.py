"""Forward-looking labels and per-symbol quantile classes.

Edges (A1) are exact interpolating percentiles per symbol over its whole
history, by rank (very long histories: from counts of values), joined back on
the symbol.  Bin
assignment (A2) counts the inner edges at or below the value, JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelkit.functions import CENTS, sdiv
from panelkit.functions import sql as E
from panelkit.session import cut

# Label horizons (days), classes per label, edge rounding.
HORIZONS = (2, 4, 7, 10)
BUY_HORIZONS = (4, 7, 10)
N_CLASSES = 10
EDGE_DECIMALS = 3
BUCKETS = 256  # per unit of value, and of a bucket that is divided; only for ranking, no effect on results
CROWDED = 100_000  # values of a bucket that holds a wanted rank, beyond which it is divided
DEEPEST = 3  # divisions
# The labels that survive the column drop (P11), in the reference's order.
LABEL_COLUMNS = (["resultbuy4", "resultbuy7", "resultbuy10"]
                 + [f"result{k}class{h}" for h in HORIZONS for k in ("", "rel")])


def label_columns_of(horizons) -> list[str]:
    """The stored labels for other horizons, in the same order."""
    return [f"resultbuy{h}" for h in horizons if h > 2] + [f"result{k}class{h}" for h in horizons for k in ("", "rel")]


def forward_return(w: WindowSpec, h: int) -> Column:
    """L1: ``close.shift(-h)/close - 1``."""
    close = F.col("close_c") / CENTS
    return sdiv(F.lead("close_c", h).over(w) / CENTS, close) - 1.0


def label_stages(horizons=HORIZONS, r: int = 1, ws: str = E.WS) -> tuple[dict, dict]:
    """L1-L4 for every horizon as SQL expressions: the next bars' extremes, then the labels, which use each several times."""
    close = E.price("close_c")
    reach, out = {}, {}

    def b(cond):
        return f"CAST(coalesce({cond}, false) AS INT)"
    for i in horizons:
        h = i * r
        # next h closes via leads (shared across horizons); full iff the h-th exists
        leads = ", ".join(E.lead("close_c", k, ws) for k in range(1, h + 1))
        full = f"{E.lead('close_c', h, ws)} IS NOT NULL"
        remax = f"((CASE WHEN {full} THEN greatest({leads}) END) / 100.0D)" if h > 1 else \
            f"(CAST({E.lead('close_c', 1, ws)} AS DOUBLE) / 100.0D)"
        remin = f"((CASE WHEN {full} THEN least({leads}) END) / 100.0D)" if h > 1 else \
            f"(CAST({E.lead('close_c', 1, ws)} AS DOUBLE) / 100.0D)"
        reach[f"_max{i}"], reach[f"_min{i}"] = remax, remin
        remax, remin = f"_max{i}", f"_min{i}"
        mx = f"({E.sdiv(remax, close)} - 1.0D)"
        mn = f"({E.sdiv(remin, close)} - 1.0D)"
        fwd = f"({E.lead('close_c', h, ws)} / 100.0D)"
        out[f"result{i}"] = f"({E.sdiv(fwd, close)} - 1.0D)"
        out[f"resultmax{i}"] = mx
        out[f"resultmin{i}"] = mn
        out[f"resultrel{i}"] = f"({mx} + {mn})"
        if i > 2:
            rng = f"({remax} - {remin})"
            low5 = b(f"{close} < {remin} + {rng} / 5.0D")
            sig = (f"({low5} * 2 + {b(f'{close} < {remin} + {rng} / 3.0D')} * 2"
                   f" - {b(f'{close} > {remax} - {rng} / 3.0D')} * 2 - {b(f'{close} > {remax} - {rng} / 5.0D')} * 2)")
            out[f"resultbuy{i}"] = (f"CAST(4 + {b(E.sdiv(rng, close) + ' > 0.03D')} * {sig}"
                                    f" + {b(E.sdiv(rng, close) + ' > 0.05D')} * {low5} AS BIGINT)")
    return reach, out


def label_columns(df: DataFrame, horizons=HORIZONS, r: int = 1, w: WindowSpec | None = None,
                  ws: str = E.WS) -> DataFrame:
    """L1-L4 for every horizon: ``result{h}, resultmax{h}, resultmin{h},
    resultrel{h}`` and ``resultbuy{h}`` for h > 2."""
    reach, labels = label_stages(horizons, r, ws)
    return df.selectExpr("*", *E.alias(reach)).selectExpr(*map(E.q, df.columns), *E.alias(labels))


def _places(level: int) -> list[Column]:
    """Bucket of ``_v`` at each level down to ``level``: of 1 / BUCKETS, then each a BUCKETS-th of the one before."""
    x, out = F.col("_v") * BUCKETS, []
    for k in range(level + 1):
        b = F.floor(x).cast("long")
        out.append(b.alias(f"_b{k}"))
        x = (x - b) * BUCKETS
    return out


def quantile_edges(df: DataFrame, value: str, key="symbol", n: int = N_CLASSES, name: str = "edges") -> DataFrame:
    """A1: per key, the ``n-1`` inner edges ``round_half_even(quantile(i/n), 3)``; NULL values are ignored.

    Keys with at most CROWDED values, so that a group is bounded, are ranked as they are: one exchange and one sort of
    the values alone.  Others go by selection (``selected_edges``).  The interpolation
    ``(hi - pos) * v_lo + (pos - lo) * v_hi`` with ``pos = (n - 1) * p`` is that of Spark's exact ``percentile``.
    ``key`` may be a list.  ``df`` is read more than once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = df.select(*keys, (F.col(value).cast("double") + F.lit(0.0)).alias("_v")).filter("_v IS NOT NULL").dropna(subset=keys)
    sizes = values.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = cut(sizes.filter(F.col("_n") > CROWDED).select(*keys), "hot-keys")
    if hot.isEmpty():
        return ranked_edges(values, keys, n, name)
    few, many = (values.join(F.broadcast(hot), keys, how) for how in ("left_anti", "left_semi"))
    return ranked_edges(few, keys, n, name).unionByName(selected_edges(many, keys, n, name))


def _edge(pos: Column, lo: Column, hi: Column) -> Column:
    """The interpolated order statistic, rounded."""
    return F.bround(F.when(lo == hi, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi), EDGE_DECIMALS)


def ranked_edges(values: DataFrame, keys, n: int, name: str) -> DataFrame:
    """Edges by sorting all values of a key (column ``_v``) as one list of at most CROWDED."""
    return listed_edges(values, keys, {name: "_v"}, n)


def listed_edges(df: DataFrame, keys, columns: dict, n: int) -> DataFrame:
    """Per key the edges of each of ``columns`` (name -> column, NULLs ignored; NULL if it has no value), whose values of
    a key are sorted as one list."""
    held = df.groupBy(*keys).agg(*[F.sort_array(F.collect_list(F.col(c) + F.lit(0.0))).alias(name) for name, c in columns.items()])

    def edges(name):
        def edge(i):
            pos = (F.size(name) - 1) * (i / F.lit(n))
            return _edge(pos, F.get(name, F.floor(pos).cast("int")), F.get(name, F.ceil(pos).cast("int")))
        return F.when(F.size(name) > 0, F.transform(F.sequence(F.lit(1), F.lit(n - 1)), edge))

    return held.select(*keys, *[edges(name).alias(name) for name in columns])


def selected_edges(values: DataFrame, keys, n: int, name: str) -> DataFrame:
    """Edges of keys with very many values (column ``_v``), of which no task holds all.

    By selection: values are counted per bucket (a partial aggregation), the counts before a bucket say which ranks
    it holds, and only buckets that hold one of the wanted order statistics, 2 (n - 1) of a key at most, are looked
    into.  While one of them has more than CROWDED values, it is divided further the same way, DEEPEST times at most;
    what is left is counted by value (so ties cost nothing) and ranked.
    """
    level, wanted, path = 0, None, []
    while True:
        new, path = f"_b{level}", [f"_b{k}" for k in range(level + 1)]
        placed = values.select(*keys, "_v", *_places(level))
        if wanted is not None:
            placed = placed.join(wanted.select(*keys, *path[:-1]), [*keys, *path[:-1]], "left_semi")
        counts = placed.groupBy(*keys, *path).agg(F.count("*").alias("_c"))
        order = Window.partitionBy(*keys, *path[:-1]).orderBy(new).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_c").over(order), F.lit(0))
        if wanted is None:
            total = F.sum("_c").over(Window.partitionBy(*keys))
            at = lambda i: (F.col("_n") - 1) * F.lit(i / n)
            ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("s"), at(i).alias("pos"), side(at(i)).cast("long").alias("rank"))
                              for i in range(1, n) for s, side in (("lo", F.floor), ("hi", F.ceil))])
            found = counts.select("*", before.alias("_before"), total.alias("_n")).withColumn("_ranks", ranks)
        else:
            held = wanted.select(*keys, *path[:-1], F.col("_before").alias("_start"), "_ranks")
            found = counts.select("*", before.alias("_inside")).join(held, [*keys, *path[:-1]]).withColumn("_before", F.col("_start") + F.col("_inside"))
        mine = F.filter("_ranks", lambda x: (x["rank"] >= F.col("_before")) & (x["rank"] < F.col("_before") + F.col("_c")))
        wanted = cut(found.select(*keys, *path, "_c", "_before", mine.alias("_ranks")).filter(F.size("_ranks") > 0), "wanted-buckets")
        if level == DEEPEST or (wanted.agg(F.max("_c")).first()[0] or 0) <= CROWDED:
            break
        level += 1
    alike = placed_in(values, wanted, keys, path, level).groupBy(*keys, *path, "_v").agg(F.count("*").alias("_c"))
    inside = Window.partitionBy(*keys, *path).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = alike.withColumn("_end", F.sum("_c").over(inside)).join(wanted.drop("_c"), [*keys, *path])
    first, end = F.col("_before") + F.col("_end") - F.col("_c"), F.col("_before") + F.col("_end")
    taken = F.filter("_ranks", lambda x: (x["rank"] >= first) & (x["rank"] < end))
    got = ranked.select(*keys, "_v", F.explode(taken).alias("x"))
    pair = got.groupBy(*keys, F.col("x.i").alias("i")).agg(
        F.max(F.col("x.pos")).alias("pos"), F.max(F.when(F.col("x.s") == "lo", F.col("_v"))).alias("lo"), F.max(F.when(F.col("x.s") == "hi", F.col("_v"))).alias("hi"))
    edge = _edge(F.col("pos"), F.col("lo"), F.col("hi"))
    return pair.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", edge.alias("e")))), lambda x: x["e"]).alias(name))


def placed_in(values: DataFrame, wanted: DataFrame, keys, path, level: int) -> DataFrame:
    """The values that lie in a wanted bucket, with its path."""
    return values.select(*keys, "_v", *_places(level)).join(wanted.select(*keys, *path), [*keys, *path], "left_semi")


def bin_code(x, edges) -> Column:
    """A2: left-closed bin code 0..n-1 = number of inner edges <= x; NULL stays NULL.

    Duplicate edges leave an empty bin instead of raising (deviation)."""
    x = F.col(x) if isinstance(x, str) else x
    edges = F.col(edges) if isinstance(edges, str) else edges
    return F.when(x.isNotNull(), F.size(F.filter(edges, lambda e: e <= x)).cast("bigint"))


def quantile_class(df: DataFrame, value: str, out: str, key: str = "symbol",
                   n: int = N_CLASSES) -> DataFrame:
    """A1 + A2: per-key decile class of ``value`` over the key's full history.  ``df`` is written once, as it is: give
    the columns that are wanted only."""
    df = cut(df, "to-classify")
    edges = quantile_edges(df, value, key, n, name="_edges")
    return df.join(edges, key, "left").select(*df.columns, bin_code(value, "_edges").alias(out))


def sources(horizons=HORIZONS, kinds=("", "rel")) -> list[str]:
    """The values that are classed."""
    return [f"result{k}{h}" for h in horizons for k in kinds]


def edge_table(df: DataFrame, horizons=HORIZONS, key: str = "symbol", kinds=("", "rel"), sizes: DataFrame | None = None) -> DataFrame:
    """(key, _e_result{h}, _e_resultrel{h}): the edges of all label values, one row per key.

    Keys with at most CROWDED rows (``sizes``: key, _n, counts that are no less, if they are known) send each value once,
    in lists; those with more go by selection.  ``df`` is read more than once."""
    srcs = sources(horizons, kinds)
    if sizes is None:
        sizes = df.groupBy(key).agg(F.count("*").alias("_n"))
    hot = cut(sizes.filter(F.col("_n") > CROWDED).select(key), "hot-keys")
    lists = {f"_e_{s}": s for s in srcs}
    if hot.isEmpty():
        return listed_edges(df, [key], lists, N_CLASSES)
    few, many = (df.join(F.broadcast(hot), key, how) for how in ("left_anti", "left_semi"))
    stacked = cut(many.select(key, F.explode(F.array(*[
        F.struct(F.lit(s).alias("_which"), F.col(s).alias("_val")) for s in srcs])).alias("_x")).select(key, "_x._which", "_x._val"), "hot-values")
    edges = quantile_edges(stacked, "_val", [key, "_which"], name="_edges")
    by_key = edges.groupBy(key).agg(*[F.max(F.when(F.col("_which") == s, F.col("_edges"))).alias(f"_e_{s}") for s in srcs])
    return listed_edges(few, [key], lists, N_CLASSES).unionByName(by_key)


def class_columns(df: DataFrame, edges: DataFrame, horizons=HORIZONS, key="symbol", kinds=("", "rel")) -> DataFrame:
    """L5 + L6: ``resultclass{h}`` and ``resultrelclass{h}`` from a table of edges."""
    out = [bin_code(f"result{k}{h}", f"_e_result{k}{h}").alias(f"result{k}class{h}") for h in horizons for k in kinds]
    return df.join(edges, key, "left").select(*df.columns, *out)


def class_labels(df: DataFrame, horizons=HORIZONS, key: str = "symbol", until=None, kinds=("", "rel"), keep=None) -> DataFrame:
    """L5 + L6 for every horizon.  ``until``: take the edges from bars up to that date only (no look ahead).

    ``keep``: the columns wanted besides the classes (default: all); only these and the values are written."""
    srcs = sources(horizons, kinds)
    keep = list(df.columns if keep is None else keep)
    df = cut(df.select(*dict.fromkeys([*keep, key, "trade_date", *srcs])), "to-classify")
    seen = df if until is None else df.filter(F.col("trade_date") <= F.lit(until))
    classed = class_columns(df, edge_table(seen, horizons, key, kinds), horizons, key, kinds)
    return classed.select(*keep, *[f"result{k}class{h}" for h in horizons for k in kinds])
