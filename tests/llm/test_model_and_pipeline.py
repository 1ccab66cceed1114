"""Operator 4 by held-out accuracy and brute force, and the pipeline stage by stage."""

import zlib

import duckdb
import numpy as np

import odd
from panelkit.llm import quality_model as q
from panelkit.llm import secrets
from panelkit.llm.common import numbered, table

LABELS = "doc_id long, quality int, toxic int"


def test_op4_query(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")  # the smallest scale has too few labels to tell
    rows = {r["doc_id"]: r for r in q.op4_quality_model(spark, sf).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    tested = [i for i in labels if rows[i]["held_out"]]
    assert len(tested) > 20 and np.mean([rows[i]["predicted"] == labels[i] for i in tested]) >= 0.95


def test_held_out_labels_are_not_learned(spark, sf):
    feats, labels = q.features(table(spark, sf, "documents")).persist(), table(spark, sf, "labels")
    from pyspark.sql import functions as F
    other = labels.withColumn("quality", F.when(q.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = q.fit(feats, labels), q.fit(feats, other)
    assert np.allclose(one.weights, two.weights) and one.knots == two.knots
    feats.unpersist()


def test_normal_equations_and_isotonic_are_plain_ones(spark, sf):
    feats, labels = q.features(table(spark, sf, "documents")).persist(), table(spark, sf, "labels")
    rows = q.learning_rows(feats, labels).collect()
    x, y, f = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]), np.array([r["fold"] for r in rows])
    model = q.fit(feats, labels)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose([s for s, v in zip(model.scale, x.std(0)) if v > 1e-9], [v for v in x.std(0) if v > 1e-9], rtol=1e-4)
    phi = q.fourier(x, model.mean, model.scale)
    solve = lambda p, t: np.linalg.solve(p.T @ p + q.RIDGE * len(t) * np.eye(p.shape[1]), p.T @ t)
    assert np.allclose(model.weights, solve(phi, y), atol=1e-6)
    raw = np.where(f == 0, phi @ solve(phi[f == 2], y[f == 2]), phi @ solve(phi[f == 0], y[f == 0]))
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(model.knots, model.knots[1:]))
    bins = np.clip(np.floor(raw * q.BINS), -1, q.BINS)
    level = [(b, y[bins == b].sum(), (bins == b).sum()) for b in np.unique(bins)]
    mean_of = lambda part: sum(s for _, s, _ in part) / sum(n for _, _, n in part)
    fitted = [max(min(mean_of(level[j:k + 1]) for k in range(i, len(level))) for j in range(i + 1)) for i in range(len(level))]  # the min-max formula
    assert np.allclose(sorted({round(v, 9) for v in fitted}), [v for _, v in model.knots])
    for at, v in model.knots:
        mine = [(b, n) for (b, _, n), w in zip(level, fitted) if abs(w - v) < 1e-9]
        assert np.isclose(at, sum((b + 0.5) / q.BINS * n for b, n in mine) / sum(n for _, n in mine))
    feats.unpersist()


def test_model_odd_inputs(spark):
    docs = odd.docs(spark)
    feats = q.features(docs)
    nothing = q.fit(feats, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in q.scored(feats, nothing).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, 0, 0), (5, None, 0), (None, 1, 0), (999, 1, 0)], LABELS)
    model = q.fit(feats, labels)
    got = q.scored(feats, model).collect()
    assert len(got) == len(odd.rows()) and all(0 <= r["score"] <= 1 for r in got)
    kept = q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] >= 0.5 for r in got)
    assert q.scored(q.features(odd.empty(spark)), model).count() == 0 and q.keep_good(odd.empty(spark), model).count() == 0
    one_class = q.fit(feats, spark.createDataFrame([(i, 1, 0) for i in range(40)], LABELS))
    assert all(r["score"] > 0.9 for r in q.scored(feats, one_class).collect())


def test_pipeline(spark, sf):
    import corpus_pipeline as p
    from test_links_and_repeats import brute_classes, brute_repeats
    docs = table(spark, sf, "documents")
    columns = docs.columns
    assert [n for n, _ in p.STAGES] == ["quality classifier", "MinHash near-dedup", "suffix-array dedup", "secret scans", "packing"]
    state = {r["doc_id"]: r for r in docs.collect()}

    def step(k, df):
        out = p.STAGES[k][1](spark, df, sf)
        assert out.columns == columns or k == 4
        rows, number = numbered(out)
        return rows.drop(number)

    good = step(0, docs)
    got = {r["doc_id"]: r for r in good.collect()}
    scores = {r["doc_id"]: r["predicted"] for r in q.op4_quality_model(spark, sf).collect()}
    assert got == {i: r for i, r in state.items() if scores[i]}
    state = got

    single = step(1, good)
    got = {r["doc_id"]: r for r in single.collect()}
    classes, _ = brute_classes([(i, i, r["text"]) for i, r in sorted(state.items())])
    assert got == {i: r for i, r in state.items() if classes[i, i]}
    state = got

    cut = step(2, single)
    got = {r["doc_id"]: r for r in cut.collect()}
    ids = sorted(state)
    want = brute_repeats([(state[i]["text"] or "").encode() for i in ids])
    assert set(got) == set(state)
    for i, (n, removed, _, _) in zip(ids, want):
        text = got[i]["text"]
        assert (text == state[i]["text"]) if not removed else n - removed - 6 <= len(text.encode()) <= n - removed
        assert got[i]["n_chars"] == (len(text) if removed else state[i]["n_chars"])
    state = got

    clean = step(3, cut)
    got = {r["doc_id"]: r for r in clean.collect()}
    assert set(got) == set(state)
    for i, r in state.items():
        spans = secrets.scan(r["text"])
        assert got[i]["text"] == r["text"] if not spans else "[SECRET]" in got[i]["text"]
        assert all(r["text"][a:b] not in got[i]["text"] for a, _, b in spans)

    pieces = p.STAGES[4][1](spark, clean, sf).collect()
    whole = p.run(spark, sf).collect()
    assert sum(r["length"] for r in pieces) == sum(r["length"] for r in whole) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())
    assert {r["doc_id"] for r in pieces} == set(got)
