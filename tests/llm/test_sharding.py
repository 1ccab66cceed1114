"""Operator 5 against a plain sort with prefix sums."""

import zlib
from collections import Counter, defaultdict

import odd
from panelkit.llm import sharding


def verify(rows, want, n=8):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in want)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    return sizes


def test_odd_inputs(spark):
    rows = sharding.shard(odd.docs(spark)).collect()
    sizes = verify(rows, [r[:2] for r in odd.rows()])
    total, most = sum(sizes.values()), max(r["size"] for r in rows)
    assert all(abs(sizes[s] - total / 8) <= most for s in range(8))
    assert sharding.shard(odd.empty(spark)).count() == 0
    assert {(r["shard"], r["slot"]) for r in sharding.shard(spark.createDataFrame([(5, None, None, None, None)], odd.DOCS)).collect()} <= {(s, 0) for s in range(8)}


def test_hot_text_is_subdivided_and_small_groups_stay_whole(spark):
    docs = [(i, "the same text over and over") for i in range(3_000)] + [(10_000 + i, f"text number {i // 3} of its own " * 2) for i in range(6_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    recs = sharding.records(df)
    total = sum(len(t) + 1 for _, t in docs)
    cells = sharding.cells(recs, sharding.splitters(recs, total), len(docs)).groupBy("cell").count().collect()
    assert max(r["count"] for r in cells) < 4 * 2 * len(docs) // sharding.RANGES
    rows = sharding.shard(df).collect()
    sizes = verify(rows, docs)
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * total / 8
    groups = defaultdict(set)
    for r in rows:
        groups[r["text_crc32"]].add(r["shard"])
    assert sorted(len(s) for s in groups.values())[:-1] == [1] * (len(groups) - 1)  # all but the hot one


def test_hot_keys_below_a_quantile_and_repeated_rows(spark, monkeypatch):
    """A text of half a quantile, one of many, and one row repeated very often: no cell holds much more than its share."""
    monkeypatch.setattr(sharding, "CELL_ROWS", 200)
    docs = [(i, f"text number {i} of its own") for i in range(30_000)] + [(50_000 + i, "half a quantile") for i in range(300)]
    docs += [(60_000 + i, "very many") for i in range(9_000)] + [(70_000, "one row over and over")] * 20_000 + [(60_007, "very many")] * 3_000 + [(None, None)] * 2_000
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    recs = sharding.written(sharding.records(df), "test-records")
    total = sum(len((t or "").encode()) + 1 for _, t in docs)
    cells = sharding.cells(recs, sharding.splitters(recs, total), len(docs)).groupBy("cell").count().collect()
    assert sum(r["count"] for r in cells) == len(docs) and max(r["count"] for r in cells) <= 2 * 200
    sizes = verify(sharding.shard(df).collect(), docs)
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * total / 8
    equal = spark.createDataFrame([(7, "x")] * 100_000, "doc_id long, text string").repartition(8)
    recs = sharding.written(sharding.records(equal), "test-records")
    assert max(r["count"] for r in sharding.cells(recs, sharding.splitters(recs, 200_000), 100_000).groupBy("cell").count().collect()) <= 2 * 200


def test_order_is_the_documented_one(spark, sf):
    """Shards and slots follow (hash of text, hash of id) whatever the sample drew."""
    rows = sharding.op5_sharding(spark, sf).collect()
    import duckdb
    want = duckdb.sql(f"SELECT doc_id FROM '{sf}/documents.parquet' ORDER BY substr(md5(coalesce(text, '')), 1, 13), substr(md5(doc_id::VARCHAR), 1, 13)").fetchall()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))] == [i for i, in want]
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
