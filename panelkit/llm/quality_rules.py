"""Operator 10, quality rules: a short-circuit cascade.

Each rule is a cheap statistic with a bound.  A first job runs all rules on a
sample of the rows and measures, per rule, seconds and rejected share; what is
computed for every document anyway costs a rule nothing.  The cascade then asks
the rules in order of rejections per second.  A document that one rule rejects
is asked no further, and the statistics of the rules behind are never computed
for it.  The order moves time only: the verdict is the conjunction of all rules
and so the same for every order and sample.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import map_rows, slim_texts, table

# The characters that count as symbols, and those that separate words.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "\x20\x09\x0a\x0b\x0c\x0d"


class Text:
    """A text and its statistics; each statistic is computed when first asked for."""

    def __init__(self, text: str):
        self.text = text
        self.known: dict[str, float] = {}

    def __getitem__(self, name: str):
        if name not in self.known:
            self.known[name] = STATISTICS[name](self)
        return self.known[name]


def _words(t: Text) -> list[bytes]:
    return t.text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly the ASCII separators


def _repeat_words(t: Text) -> int:
    """Words inside three-word windows that occur twice or more, the first occurrence included."""
    import numpy as np
    words = t["words"]
    if len(words) < 4:
        return 0
    ids = dict.fromkeys(words)
    for i, w in enumerate(ids):
        ids[w] = i
    a = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) > 1_600_000:  # three ids would overflow 64 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[:-1] * len(ids) + a[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def _dup_lines(t: Text) -> int:
    seen = [x for x in t.text.split("\n") if x.strip(SEPARATORS)]
    return len(seen) - len(set(seen))


STATISTICS: dict[str, Callable] = {
    "words": _words,
    "n_words": lambda t: len(t["words"]),
    "word_chars": lambda t: len(t.text) - sum(map(t.text.count, SEPARATORS)),
    "n_symbols": lambda t: sum(map(t.text.count, SYMBOLS)),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda t: sum(1 for x in t.text.split("\n") if x.strip(SEPARATORS)),
    "n_repeat_words": _repeat_words,
    "n_shouts": lambda t: t.text.count("!"),
    "n_commonest": lambda t: max(_counts(t).values(), default=0),
}


def _counts(t: Text) -> dict:
    from collections import Counter
    return Counter(t["words"])


@dataclass(frozen=True)
class Rule:
    """Rejects when 100 * statistic > percent * per (integers only, so that SQL can say the same)."""
    name: str
    statistic: str
    per: str
    percent: int
    above: bool = True

    def rejects(self, t: Text) -> bool:
        x, y = 100 * t[self.statistic], self.percent * t[self.per]
        return x > y if self.above else x < y


RULES = (
    Rule("few_words", "n_words", "one", 5_000, above=False),
    Rule("repeated_windows", "n_repeat_words", "n_words", 50),
    Rule("long_words", "word_chars", "n_words", 1_400),
    Rule("short_words", "word_chars", "n_words", 200, above=False),
    Rule("symbols", "n_symbols", "n_words", 25),
    Rule("shouting", "n_shouts", "n_words", 30),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", 50),
    Rule("one_word", "n_commonest", "n_words", 40),
)
STATISTICS["one"] = lambda t: 1
BASE = ("few_words", "repeated_windows")


def measure(df: DataFrame, rules=RULES, one_in: int = 64, given=()) -> list[dict]:
    """Per rule: seconds and rejected documents on a sample of one row in ``one_in``, drawn by row number.

    given: statistics that every document gets anyway, so that their time is no rule's.
    The sums have one row per rule, whatever the size of the input.
    """
    given = list(given)

    def run(rows):
        from time import perf_counter
        for (text,) in rows:
            known = Text(text)
            for s in given:
                known[s]
            for r in rules:
                t = Text(text)  # a fresh one: the full cost of asking this rule first
                t.known.update(known.known)
                at = perf_counter()
                no = r.rejects(t)
                yield r.name, perf_counter() - at, int(no), 1

    sample = df.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(one_in)) == 0)
    got = map_rows(slim_texts(sample), run, "rule string, seconds double, rejected long, asked long")
    return [r.asDict() for r in got.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("asked").alias("asked")).collect()]


def order_rules(measured: list[dict], rules=RULES) -> list[Rule]:
    """By rejections per second, most first; rules that the sample says nothing about come last, as listed."""
    rate = {m["rule"]: m["rejected"] / max(m["seconds"], 1e-9) for m in measured}
    return sorted(rules, key=lambda r: -rate.get(r.name, -1.0))


def first_rejection(t: Text, ordered) -> str | None:
    """The first rule that rejects the text; the rules behind it are not asked."""
    return next((r.name for r in ordered if r.rejects(t)), None)


def cascade(df: DataFrame, ordered: list[Rule], statistics=()) -> DataFrame:
    """doc_id, the wanted statistics, accepted, rejected_by (the first rule of the order that rejects; null if none).

    One narrow pass, no shuffle.  Null texts are empty and rejected by ``few_words``;
    repeated rows give repeated rows; an empty table gives an empty table.
    """
    ordered, statistics = list(ordered), list(statistics)

    def run(rows):
        for doc_id, text in rows:
            t = Text(text)
            by = first_rejection(t, ordered)
            yield (doc_id, *[t[s] for s in statistics], by is None, by)

    schema = "doc_id long, " + "".join(f"{s} long, " for s in statistics) + "accepted boolean, rejected_by string"
    return map_rows(slim_texts(df, "doc_id"), run, schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = cascade(docs, order_rules(measure(docs, given=stats)), stats)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *stats, base.alias("base_failed"), (F.col("accepted") & ~base).alias("kept"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
s AS (SELECT doc_id, ws, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
             len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM w),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM s),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c, i + 2 <= len(ws) AS whole FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE whole AND c > 1) GROUP BY doc_id),
m AS (SELECT doc_id, max(c) AS n_commonest FROM (SELECT doc_id, ws[i] AS word, count(*) AS c FROM p GROUP BY 1, 2) GROUP BY doc_id),
x AS (SELECT s.*, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_commonest, 0) AS n_commonest FROM s LEFT JOIN r USING (doc_id) LEFT JOIN m USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars > 14 * n_words OR word_chars < 2 * n_words
            OR 100 * n_symbols > 25 * n_words OR 100 * n_shouts > 30 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR 100 * n_commonest > 40 * n_words) AS kept
FROM x
"""
