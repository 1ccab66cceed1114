"""Operator 3, embedding near-duplicates: an exact metric range join on cosine.

For unit vectors, cosine >= c is Euclidean distance <= e = sqrt(2 - 2c).  Per
label, sampled pivots partition the vectors by nearest pivot.  A vector u of
cell h is replicated to the cell of p if its distance to the plane between h
and p, (d(u,p)^2 - d(u,h)^2) / (2 d(p,h)), is at most e: by the triangle
inequality nothing in that cell is nearer to u than this plane.  So a cell
holds every partner of its own vectors, and cells are joined independently: a
block of owners is held, the cell's members stream by.  A cell of many blocks
is first divided in the same way by pivots of its own, level by level, so that
cells stay small however many vectors there are.  Equal vectors are one
vector with a weight.  Cells emit counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import map_rows, table, written
from panelkit.llm.components import components

COSINE = 0.98
BLOCK = 1_024  # owners that a task holds; a larger cell becomes several such blocks
MAX_PIVOTS = 4_096  # of all labels together, as expected; they are what every task gets
SUB_PIVOTS = 1_024  # of a cell that is divided, as expected
LARGE = 4  # blocks of owners beyond which a cell is divided
LEVELS = 3  # of such divisions
DEAL = 100_000  # owners of a cell that is divided, per task


def vectors(df: DataFrame) -> DataFrame:
    """label, v, node, weight: the different vectors that can link at all.

    node: least vec_id of the equal vectors.  Left out: null ids or labels, null or empty vectors, zero vectors,
    vectors with a null, NaN or infinite component.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    some = df.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    return some.groupBy("label", F.col("embedding").alias("v")).agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))


def _unit(raw: list, dim: int):
    import numpy as np
    x = np.frombuffer(b"".join(raw)).reshape(-1, dim)
    return x, np.sqrt((x * x).sum(1))


def assign(reps: DataFrame, cosine: float, block: int) -> DataFrame:
    """The rows of ``reps`` with home (cell) and cells (home and those it is replicated to)."""
    e = sqrt(2 - 2 * cosine) + 1e-9
    sizes = reps.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > block)
    rate = min(1.0 / block, MAX_PIVOTS / max(1, reps.count()))
    u = F.pmod(F.xxhash64("node", "raw"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = reps.join(sizes.select("label", "dim"), ["label", "dim"], "left_semi").where(u < rate).select("label", "dim", "raw").collect()  # MAX_PIVOTS or so
    pivots: dict = {}
    for label, dim, raw in sorted((r[0], r[1], bytes(r[2])) for r in drawn):
        pivots.setdefault((label, dim), []).append(raw)

    def run(rows):
        import numpy as np
        units = {}
        held: dict = {}

        def flush(key):
            part = held.pop(key)
            label, dim = key
            if key not in pivots:
                return [(*r, 0, [0]) for r in part]
            if key not in units:
                x, n = _unit(pivots[key], dim)
                p = x / n[:, None]
                between = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))
                units[key] = p, np.where(between < 1e-7, np.inf, between)  # equal pivots: any plane is as good; see below
            p, between = units[key]
            x, n = _unit([r[4] for r in part], dim)
            d2 = np.maximum(2 - 2 * (x / n[:, None]) @ p.T, 0)
            home = d2.argmin(1)
            plane = (d2 - d2[np.arange(len(part)), home][:, None]) / (2 * between[home])
            # beside an equal pivot, the first one is the home of every vector, so the other cells stay empty
            near = plane <= e
            return [(*r, int(h), np.flatnonzero(near[i]).tolist()) for i, (r, h) in enumerate(zip(part, home))]

        for r in rows:
            key = r[1], r[2]
            held.setdefault(key, []).append(r)
            if len(held[key]) >= 1_024:
                yield from flush(key)
        for key in list(held):
            yield from flush(key)

    return map_rows(reps.select("node", "label", "dim", "weight", "raw"), run, "node long, label int, dim int, weight long, raw binary, home int, cells array<int>")


CELL = ["label", "dim", "cell"]


def members_of(placed: DataFrame) -> DataFrame:
    """label, dim, cell, member (0: an owner, in its home; 1: a member, also of its home), node, weight, raw."""
    owners = placed.select("label", "dim", F.col("home").cast("long").alias("cell"), F.lit(0).alias("member"), "node", "weight", "raw")
    return owners.unionByName(placed.select("label", "dim", F.explode(F.col("cells").cast("array<bigint>")).alias("cell"), F.lit(1).alias("member"), "node", "weight", "raw"))


def divided(rows: DataFrame, cosine: float, block: int) -> DataFrame:
    """The rows of ``members_of`` with large cells divided by pivots sampled from their owners.

    An owner goes to the cell of its nearest pivot, a member to all that the plane between pivots does not rule out.
    A cell's pivots go to each of the tasks that its rows are dealt to.
    """
    e = sqrt(2 - 2 * cosine) + 1e-9

    def run(stream):
        import numpy as np
        at, p, between, held, raws = None, None, None, [], []

        def flush():
            if not held:
                return
            if p is None:  # no pivot drawn: the cell stays as it is
                yield from ((*r[:3], *r[4:]) for r in held)
            else:
                x, n = _unit([r[7] for r in held], at[1])
                d2 = np.maximum(2 - 2 * (x / n[:, None]) @ p.T, 0)
                home = d2.argmin(1)
                near = (d2 - d2[np.arange(len(held)), home][:, None]) / (2 * between[home]) <= e
                for i, r in enumerate(held):
                    for j in (home[i:i + 1] if r[4] == 0 else np.flatnonzero(near[i])).tolist():
                        yield r[0], r[1], (r[2] + 1) * (8 * SUB_PIVOTS) + j, *r[4:]  # another number than any cell's that is not divided
            held.clear()

        for r in stream:  # label, dim, cell, salt, member (-1: a pivot), node, weight, raw
            if r[:4] != at:
                yield from flush()
                at, p, raws = r[:4], None, []
            if r[4] < 0:
                raws.append(r[7])
                continue
            if raws:
                x, n = _unit(sorted(raws)[:8 * SUB_PIVOTS], at[1])
                p, raws = x / n[:, None], []
                between = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))
                between = np.where(between < 1e-7, np.inf, between)
            held.append(r)
            if len(held) >= 512:
                yield from flush()
        yield from flush()

    for _ in range(LEVELS):
        large = written(rows.where("member = 0").groupBy(*CELL).agg(F.count("*").alias("n")).where(F.col("n") > LARGE * block), "large-cells")
        if large.isEmpty():
            break
        deal = F.ceil(F.col("n") / DEAL).cast("int")
        u = F.pmod(F.xxhash64("raw", "cell"), F.lit(1 << 40)) / F.lit(float(1 << 40))
        mine = rows.join(large, CELL)
        drawn = mine.where("member = 0").where(u < F.least(F.lit(1.0 / block), F.lit(float(SUB_PIVOTS)) / F.col("n")))
        drawn = drawn.select(*CELL, F.explode(F.sequence(F.lit(0), deal - 1)).alias("salt"), F.lit(-1).alias("member"), "node", "weight", "raw")
        dealt = mine.select(*CELL, F.pmod(F.xxhash64("node"), deal).cast("int").alias("salt"), "member", "node", "weight", "raw").unionByName(drawn)
        ordered = dealt.repartition(*CELL, "salt").sortWithinPartitions(*CELL, "salt", "member")
        split = map_rows(ordered, run, "label int, dim int, cell long, member int, node long, weight long, raw binary")
        rows = written(rows.join(large, CELL, "left_anti").select(*CELL, "member", "node", "weight", "raw").unionByName(split), "divided-cells")
    return rows


def cell_links(rows: DataFrame, cosine: float, block: int) -> DataFrame:
    """(node, label, dim, raw, links, null) for each vector and (a, null, null, null, null, b) for each edge of a spanning forest.

    rows: as ``members_of`` gives them.  links: weight of all other different vectors linked with it.
    """
    counts = rows.where("member = 0").groupBy(*CELL).agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n")
    sized = rows.join(counts, CELL)
    every = F.when(F.col("member") == 0, F.array(F.pmod(F.xxhash64("node"), "blocks").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = sized.select(*CELL, F.explode(every).alias("block"), "member", "node", "weight", "raw")
    key = ["label", "dim", "cell", "block"]
    rows = rows.repartition(*key).sortWithinPartitions(*key, "member")

    def run(rows):
        import numpy as np
        at, mine, state, batch = None, [], None, []

        def begin():
            x, n = _unit([r[7] for r in mine], at[1])
            return {"x": x, "n": n, "u": (x / n[:, None]).astype("f4"), "id": np.array([r[5] for r in mine]), "links": np.zeros(len(mine), "i8"), "tree": np.arange(len(mine))}

        def meet(s, part):
            x, n = _unit([r[7] for r in part], at[1])
            ids, weight = np.array([r[5] for r in part]), np.array([r[6] for r in part])
            rough = s["u"] @ (x / n[:, None]).astype("f4").T
            margin = max(1e-4, 4e-7 * at[1])  # single precision's error grows with the dimension
            linked = rough > cosine + margin
            for i, j in zip(*np.nonzero((rough > cosine - margin) & ~linked)):  # single precision can't tell
                linked[i, j] = (s["x"][i] * x[j]).sum() / (s["n"][i] * n[j]) >= cosine
            linked &= s["id"][:, None] != ids
            s["links"] += linked @ weight
            has = linked.any(0)
            first = linked.argmax(0)
            edges = [(int(ids[j]), int(s["id"][first[j]])) for j in np.flatnonzero(has)]
            linked = linked[:, has]
            while linked.size:  # owners that share a member are of one tree
                tree = s["tree"]
                low = np.where(linked, tree[:, None], len(tree)).min(0)
                to = np.minimum(tree, np.where(linked, low, len(tree)).min(1))
                root = np.arange(len(tree))
                np.minimum.at(root, tree, to)
                while (root[root] != root).any():
                    root = root[root]
                s["tree"] = root[tree]
                if (s["tree"] == tree).all():
                    break
            return edges

        def finish(s):
            for i, (r, k) in enumerate(zip(mine, s["links"])):
                yield r[5], r[0], r[1], r[7], int(k), None
                if s["tree"][i] != i:
                    yield r[5], None, None, None, None, int(s["id"][s["tree"][i]])

        def step(last):
            nonlocal state, batch, mine
            if batch:
                state = state or begin()
                for a, b in meet(state, batch):
                    yield a, None, None, None, None, b
                batch = []
            if last and state:
                yield from finish(state)
                state, mine = None, []

        for r in rows:
            if r[:4] != at:
                yield from step(True)
                at, mine, state = r[:4], [], None
            if r[4] == 0:
                mine.append(r)
            elif mine:  # no owners: nothing to join the members with
                batch.append(r)
                if len(batch) >= 2_048:
                    yield from step(False)
        yield from step(True)

    return map_rows(rows, run, "node long, label int, dim int, raw binary, links long, b long")


def near_duplicates(df: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Rows that can't link (see ``vectors``) have no links and are their own component; a null vec_id has a null
    component and is kept.  Equal vectors of one label link with one another; repeated rows count as vectors of their own.
    """
    reps = vectors(df)
    pack = _packed()
    reps = written(reps.select("node", "label", F.size("v").alias("dim"), "weight", pack("v").alias("raw")), "embedding-reps")
    placed = written(assign(reps, cosine, block), "embedding-cells")
    got = written(cell_links(divided(members_of(placed), cosine, block), cosine, block), "embedding-links")
    trees = components(got.where("b IS NOT NULL").select(F.col("node").alias("a"), "b"))
    links = got.where("b IS NULL").select("label", "dim", "raw", "links", "node").join(reps.select("label", "dim", "raw", "weight"), ["label", "dim", "raw"])
    known = links.join(trees, "node", "left").select("label", "raw", F.coalesce("root", "node").alias("component_id"), (F.col("links") + F.col("weight") - 1).alias("n_links"))
    rows = df.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("label")).alias("label"), pack("embedding").alias("raw"))
    out = rows.join(known, ["label", "raw"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _packed():
    """A column of arrays as one binary value each, 64-bit floats; null where a component is null."""
    @F.pandas_udf("binary")
    def pack(vs):
        import numpy as np
        import pandas as pd
        return pd.Series([None if v is None or any(x is None for x in v) else (np.asarray(v, "f8") + 0.0).tobytes() for v in vs], dtype=object)

    return pack


def op3_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a),
n AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""
