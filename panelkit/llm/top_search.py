"""Operator 12, exact top-k search: exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights: its component at place t, scaled
and rounded down, is the weight of term t; a weight of 0 is no posting.
Candidates are dealt to blocks and each block is inverted: per term, the
candidates that hold it with their weights.  A query visits its terms one
after the other and scatters weight times weight into a dense array of scores,
one place per candidate of the block; a batch of queries does so at once.  A
partition selection keeps each query's best in the block, and a ranking over
the blocks' rows, cut short before the shuffle, merges them.

Every query meets every candidate in one cell (block of candidates, block of
queries); a cell's rows are bounded by the blocks' sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.common import table, written

SCALE = 64
BEST = 20
EVERY = 20  # a row whose id is divisible by it is a query
CANDIDATES, QUERIES = 8_192, 4_096  # vectors of a block, as expected
AT_ONCE = 128  # queries whose score arrays stand at once
LONG = (1 << 63) - 1


def weights(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """row, vec_id, x: the rows that take part, numbered and written.

    Left out: a null id (it could not be named in a result), a null vector, a vector with a null, NaN or infinite
    component.  An empty vector takes part and scores 0.
    """
    fine = F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    some = df.where(F.col(key).isNotNull() & fine)
    return written(some.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")), "search-vectors")


class Postings:
    """A block of candidates, inverted."""

    def __init__(self, ids, rows, sizes, values):
        """ids, rows: of the candidates; sizes: components of each; values: their weights, one after the other."""
        import numpy as np
        order = np.lexsort((rows, ids))  # so that among equal scores the first place is the smaller id
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.rows = ids[order], rows[order]
        self.at = dict(zip(self.rows.tolist(), range(len(order))))
        term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owner = np.repeat(place, sizes)
        held = np.flatnonzero(values)
        by = held[np.lexsort((owner[held], term[held]))]
        self.owner, self.weight = owner[by], values[by]
        self.starts = np.searchsorted(term[by], np.arange(sizes.max(initial=0) + 1))
        self.largest = np.abs(self.weight).max(initial=0)

    def scores(self, sizes, values):
        """Scores of a batch of queries against the block: an array (query, candidate)."""
        import numpy as np
        n, terms = len(sizes), len(self.starts) - 1
        query = np.repeat(np.arange(n), sizes)
        term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        held = np.flatnonzero((values != 0) & (term < terms))
        held = held[np.argsort(term[held], kind="stable")]
        term, query, values = term[held], query[held], values[held]
        bound = float(self.largest) * float(np.abs(values).max(initial=0)) * max(1, sizes.max(initial=1))
        kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 2.0 ** 62 else object
        total = np.zeros((len(self.ids), n), kind)
        cuts = np.flatnonzero(np.diff(term, prepend=-1, append=terms)) if len(term) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            lo, hi = self.starts[term[a]], self.starts[term[a] + 1]
            owner, weight = self.owner[lo:hi], _as(self.weight[lo:hi], kind)
            own, other = query[a:b], _as(values[a:b], kind)
            if 2 * len(own) >= n:  # most queries hold the term: whole rows of the array
                across = np.zeros(n, kind)
                across[own] = other
                total[owner] += weight[:, None] * across
            else:
                total[np.ix_(owner, own)] += weight[:, None] * other
        if kind is object:
            total = np.clip(total, -LONG - 1, LONG).astype(np.int64)
        return np.ascontiguousarray(total.T)

    def best(self, scores, k):
        """Per query the places of its k best, best first, ties to the first place."""
        import numpy as np
        n = scores.shape[1]
        if n > k:
            least = np.partition(scores, n - k, axis=1)[:, n - k, None]
            above, level = scores > least, scores == least
            places = np.nonzero(above | level & (np.cumsum(level, axis=1) <= k - above.sum(1, keepdims=True)))[1].reshape(-1, k)
        else:
            places = np.broadcast_to(np.arange(n), scores.shape)
        got = np.take_along_axis(scores, places, 1).astype(np.int64)
        rank = np.argsort(~got, axis=1, kind="stable")  # ~x falls as x rises, also at a long's ends
        return np.take_along_axis(places, rank, 1), np.take_along_axis(got, rank, 1)


def _as(values, kind):
    """Weights as integers; beyond 62 bits as Python's own."""
    import numpy as np
    return np.array(list(map(int, values)), object) if kind is object else values.astype(kind)


def search(vectors: DataFrame, queries: DataFrame, k: int = BEST, scale: float = SCALE, candidates: int = CANDIDATES, block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all ``vectors`` for each row of ``queries`` but the row itself.

    Both are rows of ``weights``.  Score: inner product of floor(scale * x); places that only one vector has count
    as 0; cut to a long's range.  Ties go to the smaller vec_id.  Rows that repeat count each, as candidates and as
    queries.  Fewer than k rows give all; an empty table gives none.
    """
    n, m = vectors.count(), queries.count()
    c, q = max(1, -(-n // candidates)), max(1, -(-m // block))
    dealt = F.xxhash64("row")
    every = lambda b: F.explode(F.sequence(F.lit(0), F.lit(b - 1)))
    held = vectors.select(F.pmod(dealt, F.lit(c)).cast("int").alias("c"), every(q).alias("q"), F.lit(0).alias("kind"), "row", "vec_id", "x")
    asked = queries.select(every(c).alias("c"), F.pmod(dealt, F.lit(q)).cast("int").alias("q"), F.lit(1).alias("kind"), "row", "vec_id", "x")
    cells = held.unionByName(asked).repartition("c", "q").sortWithinPartitions("c", "q", "kind")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def columns(part):
            x = part.column("x")
            sizes = np.diff(x.offsets.to_numpy())
            return part.column("vec_id").to_numpy(), part.column("row").to_numpy(), sizes, np.floor(scale * x.flatten().to_numpy(zero_copy_only=False))

        def answers(block, part):
            ids, rows, sizes, values = columns(part)
            ends = np.cumsum(sizes)
            for a in range(0, len(ids), AT_ONCE):
                b = min(len(ids), a + AT_ONCE)
                places, scores = block.best(block.scores(sizes[a:b], values[ends[a] - sizes[a]:ends[b - 1]]), k + 1)
                own = np.array([block.at.get(r, -1) for r in rows[a:b].tolist()])
                at, rank = np.nonzero(places != own[:, None])
                took = np.arange(len(at)) - np.searchsorted(at, at) < k
                at, rank = at[took], rank[took]
                got = places[at, rank]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (rows[a:b][at], ids[a:b][at], block.ids[got], block.rows[got], scores[at, rank])], ["query_row", "query_id", "vec_id", "row", "score"])

        cell, mine, block = None, [], None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part, (ci, qi, kind) = batch.slice(a, b - a), key[a].tolist()
                if (ci, qi) != cell:
                    cell, mine, block = (ci, qi), [], None
                if kind == 0:
                    mine.append(columns(part))
                elif mine or block:
                    if block is None:
                        block, mine = Postings(*map(np.concatenate, zip(*mine))), []
                    yield from answers(block, part)

    rows = cells.mapInArrow(run, "query_row long, query_id long, vec_id long, row long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_top_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = weights(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
