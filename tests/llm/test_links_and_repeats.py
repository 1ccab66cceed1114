"""Operators 2, 3 and 6 and the components they share, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import odd
from panelkit.llm import components, embedding_links, near_text, repeats, suffix_array
from panelkit.llm.common import numbered


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


@pytest.mark.parametrize("kind", ["random", "chain", "hub"])
def test_components(spark, kind):
    rng = random.Random(1)
    if kind == "random":
        edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    elif kind == "chain":
        ids = list(range(60))
        rng.shuffle(ids)
        edges = list(zip(ids, ids[1:]))
    else:
        edges = [(500, i) for i in range(400)]
    u = Union()
    for a, b in edges:
        if a != b:
            u.join(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: u.find(x) for x in u.up}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def lcs(a, b):
    """Plain dynamic programming."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def test_banded_alignment_is_the_full_one():
    rng = random.Random(2)
    for _ in range(1_500):
        a = rng.sample(range(40), rng.randint(0, 30))
        b = a[:]
        for _ in range(rng.randint(0, 6)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), 100 + rng.randrange(50))
        if rng.random() < 0.3:
            k = rng.randint(0, len(b))
            b = b[k:] + b[:k]
        b = list(dict.fromkeys(b))
        n = lcs(a, b)
        want = bool(a and b) and n / (len(a) + len(b) - n) >= 0.8 - 1e-12
        assert near_text.aligned(near_text.Kmers(np.array(a, np.uint64)), near_text.Kmers(np.array(b, np.uint64))) == want, (a, b)


def brute_classes(rows):
    """rows: (row number, doc_id, text).  All pairs, no sketch."""
    k = [near_text.Kmers(near_text.kmers(near_text.word_hashes(t or ""))) for _, _, t in rows]
    u = Union()
    for i in range(len(rows)):
        u.find(i)
        for j in range(i):
            if near_text.aligned(k[i], k[j]):
                u.join(i, j)
    groups = defaultdict(list)
    for i, (_, d, _) in enumerate(rows):
        groups[u.find(i)].append(d)
    out = Counter()
    for ids in groups.values():
        known = [d for d in ids if d is not None]
        low = min(known) if known else None
        out.update((d, low) for d in ids)
    return out, len(groups)


def family(rng, n, words=120, edits=3):
    base = odd.prose(rng, words).split()
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = base[:]
        for _ in range(edits):
            w[rng.randrange(len(w))] = odd.prose(rng, 1)
        out.append(" ".join(w))
    return out


def test_near_text_odd_inputs(spark):
    rows = odd.rows()
    want, n = brute_classes([(i, r[0], r[1]) for i, r in enumerate(rows)])
    got = near_text.classes(odd.docs(spark)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want and sum(r["kept"] for r in got) == n
    assert near_text.classes(odd.empty(spark)).count() == 0
    left = near_text.deduplicate(odd.docs(spark))
    assert left.count() == n and left.columns == odd.docs(spark).columns


@pytest.mark.parametrize("large", [2_048, 4])
def test_near_text_hot_families(spark, monkeypatch, large):
    """Families larger than a bucket may be, chains near the limit and a passage that very many texts share."""
    monkeypatch.setattr(near_text, "LARGE", large)
    rng = random.Random(11)
    texts = [t for n, e in ((40, 2), (30, 5), (12, 1), (2, 1)) for t in family(rng, n, edits=e)]
    step = family(rng, 1)[0].split()
    for _ in range(15):  # a chain: each near its neighbour, the ends far apart
        texts.append(" ".join(step))
        step = step[:]
        step[rng.randrange(len(step))] = odd.prose(rng, 1)
    passage = odd.prose(rng, 60)
    texts += [f"{odd.prose(rng, 40)} {passage} {odd.prose(rng, 20)}" for _ in range(60)]
    texts += [f"{passage} {odd.prose(rng, 6)}" for _ in range(20)]  # mostly passage: near the limit
    rng.shuffle(texts)
    rows = [(i, i, t) for i, t in enumerate(texts)]
    want, n = brute_classes(rows)
    got = near_text.classes(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string").repartition(4)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want and sum(r["kept"] for r in got) == n


@pytest.mark.parametrize("frequent", [4_096, 0])
def test_near_text_short_texts(spark, monkeypatch, frequent):
    """Pairs of 8 to 30 words near the limit, which agree in few entries or in none, and short texts with a common beginning."""
    monkeypatch.setattr(near_text, "FREQUENT", frequent)
    rng = random.Random(12)
    texts = []
    for n in range(8, 31):
        for _ in range(12):
            w = odd.prose(rng, n).split()
            texts += [" ".join(w), " ".join(rng.choice((w[:-1], w[1:], [*w, "more"], [*w[:-1], "other"])))]
    texts += [f"the same first words of all texts {odd.prose(rng, rng.randint(1, 4))}" for _ in range(60)]
    texts = sorted(set(texts))
    rng.shuffle(texts)
    want, n = brute_classes([(i, i, t) for i, t in enumerate(texts)])
    assert n < len(texts) - 100
    got = near_text.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want and sum(r["kept"] for r in got) == n


@pytest.mark.parametrize("large", [2_048, 6])
def test_near_text_short_texts_with_one_beginning(spark, monkeypatch, large):
    """A prefix bucket larger than LARGE is dealt by lengths and further k-mers without loss."""
    monkeypatch.setattr(near_text, "LARGE", large)
    rng = random.Random(21)
    begin = odd.prose(rng, 16).split()
    texts = {" ".join([*begin[:k], *odd.prose(rng, r).split()]) for k in (9, 12, 14, 16) for r in (0, 1, 1, 2, 2, 3, 4) for _ in range(6)}
    texts |= {" ".join([*odd.prose(rng, r).split(), *begin[:k]]) for k in (12, 16) for r in (0, 1, 2) for _ in range(6)}
    texts |= {" ".join([*begin[:6], odd.prose(rng, 1), *begin[7:16]]) for _ in range(8)}
    texts = sorted(texts)
    rng.shuffle(texts)
    want, n = brute_classes([(i, i, t) for i, t in enumerate(texts)])
    got = near_text.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want and sum(r["kept"] for r in got) == n


def bucket_of(texts, path):
    """Rows of a piece of work as bucket_links takes them, with two entries that all texts agree in."""
    out = []
    for i, w in enumerate(texts):
        entries = np.concatenate([[7, 8], np.arange(near_text.ENTRIES - 2) + 1_000 * (i + 1)]).astype("<u8")
        raw = w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :near_text.WORD_BYTES].tobytes()
        out.append((path, i, i, len(w) - 4, entries.tobytes(), raw, 0))
    return out


def test_near_text_work_on_a_full_bucket_is_bounded():
    """LARGE texts of PIECE words that share a passage but are not similar, and a few that are: under 200 MB and quick."""
    import time
    import tracemalloc
    rng = np.random.default_rng(8)
    passage = rng.integers(0, 1 << 24, 1_000)
    texts = [np.concatenate([passage, rng.integers(0, 1 << 24, 900 + i % 100)]) for i in range(near_text.LARGE - 2)]
    texts += [np.append(texts[3], rng.integers(0, 1 << 24, 50)), np.append(texts[4], texts[5][:40])]
    rows = bucket_of(texts, [0, 1])
    tracemalloc.start()
    began = time.time()
    got = list(near_text.bucket_links(rows, near_text.SIMILARITY))
    assert tracemalloc.get_traced_memory()[1] < 200_000_000 and time.time() - began < 120
    tracemalloc.stop()
    assert sorted(tuple(sorted(p)) for p in got) == [(3, near_text.LARGE - 2), (4, near_text.LARGE - 1)]


def test_bound_is_never_less_than_the_common_kmers():
    rng = np.random.default_rng(9)
    for n in (30, 400, 3_000):
        words = [rng.integers(0, 1 << 24, n).astype(np.uint64) for _ in range(6)]
        words += [np.concatenate([w[:n // 2], words[0][n // 2:]]) for w in words] + [np.zeros(n, np.uint64)]
        texts = near_text.Texts([w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :near_text.WORD_BYTES].tobytes() for w in words], np.full(len(words), n - 4))
        for b in range(1, len(words)):
            bound = texts.bound(np.arange(b), b)
            for a in range(b):
                common = len(np.intersect1d(texts.kmers(a).kmers, texts.kmers(b).kmers))
                assert common <= bound[a] <= common + 10 + 2 * n * n // texts.cells


def test_near_text_recall_by_length():
    """The worst pairs of every length beyond the exact path are candidates but for 2e-6; the sketch's entries agree as calculated."""
    from math import ceil, comb
    for n in range(near_text.SHORT + 1, 300):
        for m in range(n, int(n / 0.8) + 1):
            common = ceil(0.8 * (n + m) / 1.8 - 1e-9)
            p = comb(common, near_text.SAMPLE) / comb(n + m - common, near_text.SAMPLE)
            assert common > n or sum(comb(near_text.ENTRIES, i) * p**i * (1 - p) ** (near_text.ENTRIES - i) for i in range(near_text.AGREE)) < 2e-6
    rng, agree = np.random.default_rng(5), []
    for _ in range(400):
        k = rng.integers(0, 1 << 63, 25, dtype=np.uint64)
        agree.append((near_text.sketch(k[:20]) == near_text.sketch(k)).mean())
    assert abs(np.mean(agree) - comb(20, 5) / comb(25, 5)) < 0.02


def test_near_text_blocks_of_a_bucket():
    """Two blocks of one bucket give the pairs between them, one block its own."""
    rng = random.Random(14)
    rows = []
    for i, t in enumerate(t for _ in range(3) for t in family(rng, 2, edits=1)):
        w = near_text.word_hashes(t)
        k = near_text.kmers(w)
        rows.append(([near_text.PREFIX], i, i, len(k), near_text.sketch(k).tobytes(), w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :near_text.WORD_BYTES].tobytes(), int(i > 2)))
    assert list(near_text.bucket_links(rows, 0.8)) == [(2, 3)]
    assert list(near_text.bucket_links(rows[:3], 0.8)) == [(0, 1)] and list(near_text.bucket_links(rows[3:], 0.8)) == [(4, 5)]


def test_op2_query(spark, sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    want, n = brute_classes([(i, i, t) for i, t in rows])
    got = near_text.op2_order_minhash(spark, sf).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want and sum(r["kept"] for r in got) == n


EMB = "vec_id long, embedding array<float>, label int, weight string"


def vectors(n=300, dim=8, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    base[n // 2:] = base[rng.integers(0, 12, n - n // 2)] + 0.05 * rng.standard_normal((n - n // 2, dim))  # families
    rows = [(i, [float(x) for x in v.astype("f4")], int(i % 3) if i % 7 else 1, "clash") for i, v in enumerate(base)]
    rows += [(1_000 + i, rows[5][1], rows[5][2], "") for i in range(9)] + [(1_100, rows[5][1], 77, ""), (1_100, rows[5][1], 77, "")]
    rows += [(2_000, None, 1, ""), (2_001, [0.0] * dim, 1, ""), (2_002, [float("nan")] + [1.0] * (dim - 1), 1, ""), (2_003, [float("inf")] * dim, 1, ""), (2_004, [None] + [1.0] * (dim - 1), 1, ""),
             (2_005, rows[5][1], None, ""), (None, rows[5][1], rows[5][2], ""), (2_006, [], 1, ""), (2_007, [1.0, 2.0], 1, ""), (2_008, [2.0, 4.0], 1, ""), (2_009, [-0.0, 1.0], 1, ""), (2_010, [0.0, 1.0], 1, "")]
    return rows


def brute_links(rows):
    fine = [i for i, (v, e, lab, _) in enumerate(rows) if v is not None and lab is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, u = Counter(), Union()
    for a in fine:
        for b in fine:
            x, y = np.array(rows[a][1], "f8"), np.array(rows[b][1], "f8")
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                links[a] += 1
                u.join(rows[a][0], rows[b][0])
    return Counter((v, links[i], u.find(v) if v is not None else None, v is None or u.find(v) == v) for i, (v, _, _, _) in enumerate(rows))


@pytest.mark.parametrize("block,pivots,large", [(1_024, 4_096, 4), (16, 4_096, 4), (3, 6, 1)])
def test_embedding_links(spark, monkeypatch, block, pivots, large):
    """In one cell, in many, and in few large ones that are divided level by level."""
    monkeypatch.setattr(embedding_links, "MAX_PIVOTS", pivots)
    monkeypatch.setattr(embedding_links, "LARGE", large)
    monkeypatch.setattr(embedding_links, "DEAL", 20)
    df = spark.createDataFrame(vectors(), EMB).repartition(3)
    got = Counter(tuple(r) for r in embedding_links.near_duplicates(df, block=block).collect())
    assert got == brute_links(vectors())
    assert embedding_links.near_duplicates(spark.createDataFrame([], EMB)).count() == 0


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(600):
        size, depth = rng.choice((2, 3, 5, 30)), rng.choice((4, 10, 40, 300))
        b = [rng.randrange(size) for _ in range(rng.randint(1, 60))] * rng.choice((1, 1, 1, 3))
        t = np.array(b, np.uint8)
        order = suffix_array.suffix_array(t, size, depth)
        assert sorted(order.tolist()) == list(range(len(b)))
        pairs = list(zip(order.tolist(), order.tolist()[1:]))
        assert all(b[x:x + depth] <= b[y:y + depth] for x, y in pairs)
        for (x, y), got in zip(pairs, suffix_array.permuted_prefixes(t, order, depth)):
            k = next((k for k in range(depth) if b[x + k:x + k + 1] != b[y + k:y + k + 1] or x + k >= len(b)), depth)
            assert got >= k and (got == k or min(len(b) - x, len(b) - y) <= k)


def brute_repeats(docs):
    """{index: (n_bytes, n_removed, n_spans, sha256)} with a set of all windows; docs in the order that counts."""
    seen, out = set(), []
    for raw in docs:
        edge = np.zeros(len(raw) + 1, int)
        for s in range(len(raw) - 99):
            if raw[s:s + 100] in seen:
                edge[s] += 1
                edge[s + 100] -= 1
            else:
                seen.add(raw[s:s + 100])
        gone = np.cumsum(edge[:-1]) > 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((len(raw), len(raw) - len(kept), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_cases():
    rng = random.Random(8)
    p = [odd.prose(rng, 40) for _ in range(3)]
    rows = [(r[0], r[1]) for r in odd.rows()]
    rows += [(200 + i, f"{odd.prose(rng, rng.randint(1, 30))} {rng.choice(p)} {odd.prose(rng, 10)} {rng.choice(p)}") for i in range(40)]
    rows += [(300 + i, p[0][i:i + 100 + i]) for i in range(0, 60, 7)]  # windows at the limit
    rows += [(400, "ab" * 400), (401, "ab" * 60), (402, "ééé" * 200), (403, "x" + "ééé" * 100), (404, "short copy"), (405, "short copy")]
    return rows


@pytest.mark.parametrize("hot", [4_096, 3])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repeat_cases()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    want = Counter((rows[i][0], *w) for i, w in zip(order, brute_repeats([(rows[i][1] or "").encode() for i in order])))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, block string").coalesce(1)
    got = Counter(tuple(r)[1:] for r in repeats.repeats(*numbered(df)).collect())
    assert got == want


def test_repeats_between_blocks_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BITS", 2)
    monkeypatch.setattr(repeats, "STEP", 4_096)
    rows = repeat_cases()
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string").repartition(5)
    got = Counter(tuple(r)[1:] for r in repeats.repeats(*numbered(df)).collect())
    assert got == Counter((i, *w) for i, w in enumerate(brute_repeats([(t or "").encode() for _, t in rows])))
    assert repeats.repeats(*numbered(odd.empty(spark))).count() == 0


def test_remove_repeats_keeps_the_columns(spark):
    df = odd.docs(spark)
    out = repeats.remove_repeats(df)
    assert out.columns == df.columns and out.count() == df.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[100] is None and texts[101] == "" and texts[109] == "x"
    assert texts[0] == odd.rows()[0][1]


def test_op6_query(spark, sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    want = Counter((i, *w) for (i, _), w in zip(rows, brute_repeats([(t or "").encode() for _, t in rows])))
    assert Counter(tuple(r) for r in repeats.op6_suffix_repeats(spark, sf).collect()) == want
