"""Operators 11, 12 and 13 against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import odd
from panelkit.llm import periodic, token_groups, top_search
from panelkit.llm.common import tokenizer_path
from panelkit.llm.token_files import byte_alphabet


def plain_runs(w):
    """By trying every period: maximal stretches, without those that a smaller period explains."""
    n, out, long = len(w), [], []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                if not any(a <= i and j + q <= b for a, b in long):
                    out.append((i, j + q, q))
                long.append((i, j + q))
            i = max(i + 1, j + 1)
    return sorted(out)


def test_transform_gives_exact_sums():
    rng = np.random.default_rng(5)
    for n in (8, 32, 128, 2048):
        w, p = rng.integers(0, periodic.PRIME, (3, n - 1)).astype(np.uint64), rng.integers(0, periodic.PRIME, (3, n // 2)).astype(np.uint64)
        got = periodic.mismatches(w, p)
        for r in range(3):
            for k in (0, 1, n - 1 - n // 2):
                assert int(got[r, k]) == sum((int(w[r, k + j]) - int(p[r, j])) ** 2 for j in range(n // 2)) % periodic.PRIME


def test_runs_are_those_of_brute_force():
    rng = random.Random(3)
    for _ in range(600):
        n, k = rng.randint(0, 260), rng.choice([1, 2, 3, 5, 50])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 4)):
            if n > 3:
                a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
                for i in range(a + p, min(n, a + rng.randint(1, n - a))):
                    w[i] = w[i - p]
        assert periodic.find_runs(np.array(w, np.int64)) == plain_runs(w), w


def test_runs_at_large_scales_and_equal_words():
    a = np.arange(40_000)
    a[5_000:35_000] = 50_000 + np.arange(30_000) % 9_001
    assert periodic.find_runs(a) == [(5_000, 35_000, 9_001)]
    assert periodic.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert periodic.find_runs(np.arange(300_000) % 7) == [(0, 300_000, 7)]
    other = np.arange(5_000)
    other[1_000] = 2_000 + periodic.PRIME  # equal modulo the prime only
    assert periodic.find_runs(other) == []


def expected(doc_id, text, change):
    words = periodic.words_of(text or "")
    if change and words and (c := periodic.planted(doc_id, len(words))):
        words = [words[i] if i < c[0] else words[c[0] + (i - c[0]) % c[1]] for i in range(len(words))]
    numbers = {}
    runs = [(s, e - s, q) for s, e, q in plain_runs([numbers.setdefault(w, len(numbers)) for w in words])]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_runs_of_odd_documents(spark):
    rows = [r for r in odd.rows() if r[0] != 106] + [(200, "again and " * 40, "en", "s", 1), (201, "one two three four five six seven eight " * 5, "en", "s", 1), (201, "one two three four five six seven eight " * 5, "en", "s", 1)]
    df = spark.createDataFrame(rows, odd.DOCS).repartition(3).select("*", *[F.lit("clash").alias(c) for c in ("runs", "length", "period", "start", "collapsed", "n_words", "m")])
    for change in (None, periodic.planted):
        got = Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in periodic.periodic_runs(df, change).collect())
        want = Counter()
        for i, t, *_ in rows:
            n, runs, text = expected(i, t, change)
            want[i, n, tuple(runs), text] += 1
        assert got == want
    assert periodic.periodic_runs(odd.empty(spark)).count() == 0


def test_op11_query_against_brute_force(spark, sf):
    import duckdb
    want = set()
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall():
        _, runs, text = expected(i, t, True)
        m = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.add((i, len(runs), *(m or (None,) * 3), m and 1000 * m[1] // m[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sum(w[1] > 0 for w in want) > 5
    assert {tuple(r) for r in periodic.op11_periodic_runs(spark, sf).collect()} == want


VECTORS = "vec_id long, embedding array<double>, row string, score string, rank string, x string, label int"


def plain_search(rows, k):
    """Of every row with an id divisible by 20: (query id, its results) by sorting all scores."""
    fine = [(i, [int(np.floor(64 * v)) for v in x]) for i, x in rows if i is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)]
    out = []
    for at, (i, x) in enumerate(fine):
        if i % 20 == 0:
            scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(x, y)))), j) for other, (j, y) in enumerate(fine) if other != at)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("candidates,block,at_once", [(8_192, 4_096, 128), (13, 5, 3)])
def test_search_against_sorting(spark, monkeypatch, candidates, block, at_once):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.integers(-3, 4, 6) / 64 * (rng.random(6) < .6)).tolist()) for i in range(120)]  # many ties and zeros
    rows += [(20, rows[20][1]), (20, rows[20][1]), (None, rows[1][1]), (140, None), (160, [None, 1.0]), (180, [float("nan")]), (200, [float("inf")]), (220, []), (240, [0.0] * 6), (260, [.5]), (261, [1.0] * 9)]
    monkeypatch.setattr(top_search, "AT_ONCE", at_once)
    df = spark.createDataFrame([(i, x, "c", "c", "c", "c", 1) for i, x in rows], VECTORS).repartition(3)
    v = top_search.weights(df)
    got = top_search.search(v, v.where("vec_id % 20 = 0"), 7, candidates=candidates, block=block)
    assert Counter(map(tuple, got.collect())) == plain_search(rows, 7)


def test_search_of_few_large_and_no_rows(spark):
    for rows in ([], [(20, [1.0])], [(20, [1.0]), (21, [2.0])], [(0, [1e18, 3.0]), (20, [1e18, -3.0]), (7, [-1e18, 2.0]), (9, [1e17, 1.0]), (40, [2.0 ** 30, 2.0 ** 20])]):
        v = top_search.weights(spark.createDataFrame([(i, x, "c", "c", "c", "c", 1) for i, x in rows], VECTORS))
        assert Counter(map(tuple, top_search.search(v, v.where("vec_id % 20 = 0")).collect())) == plain_search(rows, 20)


def plain_groups(docs):
    """Per document (tokens of A, of B, groups, links, links of a best pair, sum of counts, groups as text), by walking both sides."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    back = {c: x for x, c in byte_alphabet().items()}
    found, held = [], Counter()
    for i, text in docs:
        ia, ib = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        ba = [bytes(back[c] for c in a.id_to_token(t)) for t in ia]
        bb = [bytes([int(b.id_to_piece(t)[3:5], 16)]) if b.is_byte(t) else b.id_to_piece(t).replace("▁", " ").encode() for t in ib]
        if not text or not b"".join(ba) == b"".join(bb) == (" " + text).encode():
            found.append((i, None, ia, ib))
            continue
        groups, left, right, x, y, ea, eb = [], [], [], 0, 0, 0, 0
        while x < len(ia) or y < len(ib):
            if ea <= eb:
                left.append(ia[x])
                ea, x = ea + len(ba[x]), x + 1
            else:
                right.append(ib[y])
                eb, y = eb + len(bb[y]), y + 1
            if ea == eb:
                groups.append((left, right))
                left, right = [], []
        found.append((i, groups, ia, ib))
        held.update({(p, q) for l, r in groups for p in l for q in r})
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    out = Counter()
    for i, groups, ia, ib in found:
        if groups is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        links = [(p, q) for l, r in groups for p in l for q in r]
        text = ";".join(",".join(map(str, l)) + "|" + ",".join(map(str, r)) for l, r in groups)
        out[i, len(ia), len(ib), len(groups), len(links), sum(held[k] == best[k[0]] for k in links), sum(held[k] for k in links), text] += 1
    return out


def test_pointers_end_at_the_groups_last_tokens():
    a, b = token_groups.groups(np.array([2, 4, 5, 9, 10]), np.array([1, 4, 6, 8, 10]))
    assert a.tolist() == [0, 0, 1, 1, 1] and b.tolist() == [0, 0, 1, 1, 1]
    n = 5_001  # one chain from end to end
    a, b = token_groups.groups(np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n))
    assert set(a.tolist()) == set(b.tolist()) == {0}


@pytest.mark.parametrize("links,block,together", [(2_000_000, 4_000_000, 500), (100, 500, 3)])
def test_groups_of_odd_documents(spark, monkeypatch, links, block, together):
    monkeypatch.setattr(token_groups, "LINKS", links)
    monkeypatch.setattr(token_groups, "BLOCK", block)
    monkeypatch.setattr(token_groups, "TOGETHER", together)
    extra = [(300, " leading", None, None, None), (301, "trailing ", None, None, None), (302, "a▁b and more", None, None, None), (303, "plain ▁", None, None, None), (304, "<s> <unk> </s> <0x41> ­", None, None, None), (305, "x\ny. Zed\n", None, None, None)]
    rows = odd.rows() + extra
    df = spark.createDataFrame(rows, odd.DOCS).repartition(2).select("*", *[F.lit("clash").alias(c) for c in ("row", "groups", "n_a", "block", "pairs", "links")])
    docs, blocks = token_groups.align(df)
    sums = token_groups.link_sums(blocks, token_groups.pair_counts(blocks))
    got = docs.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)), F.coalesce("count_sum", F.lit(0)), "groups")
    assert Counter(map(tuple, got.collect())) == plain_groups([r[:2] for r in rows])
    docs, blocks = token_groups.align(odd.empty(spark))
    assert docs.count() == 0 and token_groups.link_sums(blocks, token_groups.pair_counts(blocks)).count() == 0


def test_op13_query_against_brute_force(spark, sf):
    import duckdb
    want = Counter({(*k[:7], hashlib.sha256(k[7].encode()).hexdigest() if k[7] else ""): n for k, n in plain_groups(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()).items()})
    assert Counter(map(tuple, token_groups.op13_token_groups(spark, sf).collect())) == want
