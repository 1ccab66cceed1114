"""Operators 9 and 10 against brute force, and planted secrets in nested layers."""

import base64
import gzip
import random
import re
import zlib
from urllib.parse import quote

import odd
from panelkit.llm import quality_rules, secrets


def brute_base(text):
    """The contract's patterns, word for word."""
    found = []
    pat = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end()) for m in pat.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, secrets.KINDS[k], b) for a, k, b in sorted(found)]


def test_base_spans():
    rng = random.Random(3)
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", "apikey", ":", "=", " ", "  ", '"', "'", "abc", "abcdef1", "AKIA", "Q" * 16, "AKIA" + "Z9" * 8, "0123456789abcdef", "deadbeef" * 3, "\n", "ſecret=longenough", "é", "漢", "x" * 7]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secrets.base_spans(text) == brute_base(text), text


SECRET = "password=hunter2hunter2"
KEY = "AKIA" + "ABCDEFGH12345678"


def spans(text):
    return {(k, text[a:b]) for a, k, b in secrets.scan(text)}


def test_layers_and_their_spans():
    b64 = lambda b: base64.b64encode(b).decode()
    enc = quote(SECRET, safe="")
    assert ("assign", enc) in spans(f"see {enc} there")
    escaped = "".join(f"\\u{ord(c):04x}" for c in KEY)
    assert ("access", escaped) in spans(f"see {escaped} there")
    one = b64(f"my {SECRET} ok".encode())
    assert ("assign", one) in spans(f"see {one} there")
    two = b64(one.encode())
    assert ("assign", two) in spans(f"see {two} there")
    for z in (gzip.compress, zlib.compress):
        packed = b64(z(f"a {KEY} b".encode()))
        assert ("access", packed) in spans(f"see {packed} there")
        deep = quote(b64(z(b64(quote(f"a {KEY} b").encode()).encode())), safe="")
        assert any(k == "access" and s in (deep, deep.rstrip("%3D")) or deep.startswith(s[:20]) for k, s in spans(f"x {deep} y"))
    twice = f"{one} and {one}"
    assert sum(k == "assign" for _, k, _ in secrets.scan(twice)) == 2
    assert secrets.scan("%41%42 \\u0041 QUFBQUFBQUFBQUFBQUFB") == []
    mixed = "%70assword=%68unter2hunter2"  # only parts are escaped
    assert ("assign", mixed) in spans(f"see {mixed} there")


def test_layers_with_odd_bytes():
    for odd_byte in ("\u00a0", "\u200b", "\ufeff", "\x00", "\x1b"):
        packed = base64.b64encode(f"my{odd_byte} {SECRET} ok".encode()).decode()
        assert ("assign", packed) in spans(f"see {packed} there")
    for raw in (b"\xff my " + SECRET.encode(), zlib.compress(b"\xff\x00 my " + SECRET.encode() + b" \xfe")):
        packed = base64.b64encode(raw).decode()
        assert ("assign", packed) in spans(f"see {packed} there")


def test_wide_stretches():
    for text in ("password%3A hunter2hunter2", 'token%3D"abcdef123', "password\\u003d hunter2hunter2"):
        assert ("assign", text) in spans(f"see {text} there")
    rng = random.Random(9)
    noise = "".join(rng.choice("abcdefghijklmnop qrstuv") for _ in range(400))
    for width in (64, 76):
        for end in ("\n", "\r\n", "\n  "):
            for raw in (f"{'x ' * 20}{SECRET} {noise}".encode(), gzip.compress(f"{noise} {SECRET}".encode())):
                b = base64.b64encode(raw).decode()
                wrapped = end.join(b[i:i + width] for i in range(0, len(b), width))
                assert any(k == "assign" and wrapped.startswith(s[:16]) for k, s in spans(f"see:\n{wrapped}\nthere"))
    for before in ("/", "/d/", "/dir/", "/dir/e/", "x_y-"):
        for raw in (SECRET.encode(), gzip.compress(SECRET.encode())):
            b = base64.b64encode(raw).decode()
            assert any(k == "assign" and s.endswith(b) for k, s in spans(f"see {before}{b} there")), (before, raw)


def test_inflated_to_the_end(monkeypatch):
    members = gzip.compress(b"nothing here") + gzip.compress(b"my pass") + gzip.compress(f"word=hunter2hunter2 {KEY}".encode())
    packed = base64.b64encode(members).decode()
    assert {("assign", packed), ("access", packed)} <= spans(f"see {packed} there")
    monkeypatch.setattr(secrets, "WINDOW", 3 * secrets.STEP)
    monkeypatch.setattr(secrets, "OVERLAP", secrets.STEP)
    for at in (3 * secrets.STEP - 10, 5 * secrets.STEP - 10, 9 * secrets.STEP):
        big = b" " * at + SECRET.encode() + b" " * secrets.STEP
        for z in (gzip.compress(big), zlib.compress(gzip.compress(big))):
            packed = base64.b64encode(z).decode()
            assert ("assign", packed) in spans(f"see {packed} there")
            cut = packed[:len(packed) // 4 * 4 - 8]
            assert z[:2] != b"\x1f\x8b" or ("assign", cut) in spans(f"see {cut} there")


def test_long_runs_end(spark):
    for text in ("a" * 300_000 + "%", "%" * 100_000, "\\u" * 60_000, "AKIA" * 40_000, "f" * 200_000, "token=" * 30_000, "%41" * 30_000):
        assert set(secrets.base_spans(text)) <= set(secrets.scan(text))


def test_find_and_redact(spark):
    df = spark.createDataFrame([(1, f"a {SECRET} b {KEY}", "en", "s", 3), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "clean text", "en", "s", 10)], odd.DOCS)
    got = {r["doc_id"]: r for r in secrets.find_secrets(df).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[1]["spans"]] == [("assign", 2, 2 + len(SECRET)), ("access", 5 + len(SECRET), 5 + len(SECRET) + 20)]
    assert got[2]["spans"] == got[3]["spans"] == got[None]["spans"] == []
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in secrets.redact(df).collect()} == {(1, "a [SECRET] b [SECRET]", 21), (2, None, None), (3, "", 0), (None, "clean text", 10)}
    assert secrets.redact(df).columns == df.columns
    assert secrets.find_secrets(odd.docs(spark)).count() == len(odd.rows()) and secrets.find_secrets(odd.empty(spark)).count() == 0


def test_op9_query(spark, sf):
    import hashlib

    import duckdb
    rows = {r["doc_id"]: r for r in secrets.op9_secret_scans(spark, sf).collect()}
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall():
        base, r = brute_base(t or ""), rows[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in base) for x in secrets.KINDS)
        assert {f"{k}:{a}:{b}" for a, k, b in base} <= set(r["spans"].split(",") if r["spans"] else [])


def brute_repeat(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    return len({j for i, w in enumerate(wins) if wins.count(w) > 1 for j in (i, i + 1, i + 2)})


def test_statistics():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(("a ", "b ", "c\n", "#", " | ", "\n", "\x0b", " ", "é ", "a b c ")) for _ in range(rng.randint(0, 40)))
        t = quality_rules.Text(text)
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (t["n_words"], t["word_chars"], t["n_repeat_words"]) == (len(words), sum(map(len, words)), brute_repeat(text))
        assert (t["n_symbols"], t["n_dup_lines"]) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))


def test_cascade_verdict_is_independent_of_the_order(spark):
    docs = odd.docs(spark)
    measured = quality_rules.measure(docs, one_in=1)
    assert {m["rule"] for m in measured} == {r.name for r in quality_rules.RULES} and {m["asked"] for m in measured} == {len(odd.rows())}
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    one = [(r["doc_id"], r["accepted"]) for r in sorted(quality_rules.cascade(docs, quality_rules.order_rules(measured)).collect(), key=key)]
    two = [(r["doc_id"], r["accepted"]) for r in sorted(quality_rules.cascade(docs, quality_rules.RULES[::-1]).collect(), key=key)]
    assert one == two and len(one) == len(odd.rows())
    assert quality_rules.cascade(odd.empty(spark), quality_rules.order_rules(quality_rules.measure(odd.empty(spark)))).count() == 0


def test_rules_ask_the_best_first():
    order = quality_rules.order_rules([{"rule": "symbols", "seconds": 1.0, "rejected": 5}, {"rule": "few_words", "seconds": 0.1, "rejected": 5}])
    assert [r.name for r in order[:2]] == ["few_words", "symbols"] and len(order) == len(quality_rules.RULES)


def test_cascade_spares_what_lies_behind_a_rejection(spark, monkeypatch):
    """No document that an earlier rule rejects computes a later rule's statistic; the others do."""
    asked = spark.sparkContext.accumulator(0)
    real = quality_rules.STATISTICS["n_commonest"]

    def counted(t):
        asked.add(1)
        return real(t)

    monkeypatch.setitem(quality_rules.STATISTICS, "n_commonest", counted)
    docs = odd.docs(spark)
    rows = quality_rules.cascade(docs, quality_rules.RULES, ["n_words", "n_repeat_words"]).collect()
    through = sum(r["rejected_by"] in (None, "one_word") for r in rows)
    assert asked.value == through and 0 < through < len(rows)
    t = quality_rules.Text("few words")
    assert quality_rules.first_rejection(t, quality_rules.RULES) == "few_words" and set(t.known) == {"n_words", "words", "one"}


def test_given_statistics_cost_a_rule_nothing(spark):
    import time
    from unittest import mock
    slow = {**quality_rules.STATISTICS, "n_symbols": lambda t: time.sleep(0.02) or 0}
    with mock.patch.object(quality_rules, "STATISTICS", slow):
        seconds = [next(m["seconds"] for m in quality_rules.measure(odd.docs(spark), one_in=1, given=g) if m["rule"] == "symbols") for g in ((), ("n_symbols", "n_words"))]
    assert seconds[0] > 0.02 * len(odd.rows()) > 10 * seconds[1]
