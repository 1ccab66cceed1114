"""Operator 11, periodic run detection by block convolution.

A run is a maximal stretch of words with smallest period q that is three
periods and 24 words long or longer.  At scale b = 8, 16, 32 and so on, the
word sequence is cut into blocks of b words.  A run of period q in [b, 2b) (at
the first scale, 1 to 15) holds a whole block that stands again q words later:
2b - 1 + q words suffice for that, and it has 3q (or 24).  For each block, the
sums of squared differences to the words at all those distances come from one
convolution over the window that follows, by a number-theoretic transform in
exact integers: sum w^2 - 2 sum w p + sum p^2 modulo a prime.  A zero is an
occurrence without a mismatch; its distance is the seed of an extension to
both sides, word by word, which also settles zeros that only the modulus made.

Blocks that can't recur are left out before: each of its words must occur
again within 2b words, and a block is of no use where a run of a smaller period
already covers it with its whole window.  Neither loses a run: what lies
inside a run of period q and has another period d as well has, over d + q
words, the greatest common divisor of both as its period.

Documents are worked on in batches as one sequence in which no two documents
share a word number.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.bpe import batches
from panelkit.llm.common import map_rows, slim_texts, table

LEAST, TIMES = 24, 3  # words and periods of a run, at least
FIRST = 8  # words of a block at the first scale
PRIME, ROOT = 3 * 2 ** 30 + 1, 5  # fixed values: a prime with roots of unity up to 2^30, and a generator
TILE = 64  # from this length on, the passes of a transform go down columns
AT_ONCE = 1 << 18  # words of the windows that are transformed together
CHARACTERS = 2_000_000  # of the texts of a batch


def _mod(x):
    return x - x // PRIME * PRIME


def _once(x):
    """x modulo the prime for x below twice the prime: the difference wraps round where x is smaller already."""
    import numpy as np
    return np.minimum(x, x - np.uint64(PRIME))


_roots: dict[int, tuple] = {}


def _powers(n: int):
    """The first n / 2 powers of an n-th root of unity and of its inverse."""
    import numpy as np
    if n not in _roots:
        out = []
        for r in (pow(ROOT, (PRIME - 1) // n, PRIME), pow(ROOT, (PRIME - 1) // n * (n - 1), PRIME)):
            p = np.ones(1, np.uint64)
            while len(p) < n // 2:
                p = np.concatenate([p, _mod(p * np.uint64(pow(r, len(p), PRIME)))])
            out.append(p)
        _roots[n] = tuple(out)
    return _roots[n]


def _spread(u, w, power):
    """A pass of the forward transform on the halves u, w of its parts."""
    import numpy as np
    s, d = _once(u + w), _once(u + (np.uint64(PRIME) - w))
    u[...], w[...] = s, _mod(d * power)


def _gather(u, w, power):
    """A pass of the inverse transform."""
    import numpy as np
    t = _mod(w * power)
    s, d = _once(u + t), _once(u + (np.uint64(PRIME) - t))
    u[...], w[...] = s, d


def _forward(x):
    """The transforms of the rows of x, in some order of their places: (place in a tile, row and tile)."""
    import numpy as np
    rows, n = x.shape
    power, half, tile = _powers(n)[0], n // 2, min(TILE, n)
    while half >= tile:
        v = x.reshape(-1, 2, half)
        _spread(v[:, 0], v[:, 1], power[::n // 2 // half])
        half //= 2
    x = np.ascontiguousarray(x.reshape(-1, tile).T)
    while half:
        v = x.reshape(-1, 2, half, x.shape[1])
        _spread(v[:, 0], v[:, 1], power[::n // 2 // half][:, None])
        half //= 2
    return x


def _inverse(x, n: int):
    import numpy as np
    power, half, tile = _powers(n)[1], 1, len(x)
    while half < tile:
        v = x.reshape(-1, 2, half, x.shape[1])
        _gather(v[:, 0], v[:, 1], power[::n // 2 // half][:, None])
        half *= 2
    x = np.ascontiguousarray(x.T).reshape(-1, n)
    while half < n:
        v = x.reshape(-1, 2, half)
        _gather(v[:, 0], v[:, 1], power[::n // 2 // half])
        half *= 2
    return _mod(x * np.uint64(pow(n, PRIME - 2, PRIME)))


def mismatches(windows, blocks):
    """Per row, the sums of squared differences of the block to the window at each place where it fits, modulo the prime."""
    import numpy as np
    rows, width = windows.shape
    b = blocks.shape[1]
    n = 1 << (width - 1).bit_length()
    x, y = np.zeros((rows, n), np.uint64), np.zeros((rows, n), np.uint64)
    x[:, :width] = windows
    y[:, 0], y[:, n - b + 1:] = blocks[:, 0], blocks[:, :0:-1]  # backwards, so that the product is a correlation
    both = _inverse(_mod(_forward(x) * _forward(y)), n)[:, :width - b + 1]
    squares = np.cumsum(_mod(windows * windows), axis=1)
    squares = np.concatenate([np.zeros((rows, 1), np.uint64), squares], axis=1)
    own = _mod(_mod(blocks * blocks).sum(1))[:, None]
    return _mod(_mod(squares[:, b:] - squares[:, :-b]) + own + np.uint64(2 * PRIME) - 2 * both)


def seeds(number, starts, b: int):
    """(start, distance) of the blocks' occurrences in their windows, maybe with some that the modulus made."""
    import numpy as np
    first = 1 if b == FIRST else b
    width = 3 * b - 1 - first
    step = max(1, AT_ONCE // (2 * b))
    padded = np.concatenate([number, np.zeros(3 * b, np.uint64)])
    got = [(np.zeros(0, np.int64),) * 2]
    for at in range(0, len(starts), step):
        some = starts[at:at + step]
        zero = mismatches(padded[some[:, None] + np.arange(first, first + width)], padded[some[:, None] + np.arange(b)]) == 0
        row, k = np.nonzero(zero)
        got.append((some[row], k + first))
    start, distance = map(np.concatenate, zip(*got))
    fits = start + distance + b <= len(number)
    return start[fits], distance[fits]


def _same(left, right):
    """How many elements agree from the front; looks in steps that double."""
    at, step, n = 0, 64, min(len(left), len(right))
    while at < n:
        to = min(n, at + step)
        differ = left[at:to] != right[at:to]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = to, 2 * step
    return n


def extend(word, x: int, d: int, b: int):
    """The maximal stretch [start, end) of period d around the block at x, or None if the block does not recur at x + d."""
    if _same(word[x:x + b], word[x + d:x + d + b]) < b:
        return None
    right = _same(word[x + b:], word[x + b + d:])
    left = _same(word[:x][::-1], word[:x + d][::-1])
    return x - left, x + b + d + right


def find_runs(word):
    """[(start, end, period)] of the runs of an integer array, by start, then period."""
    import numpy as np
    n, found = len(word), []
    if n < LEAST:
        return found
    order = np.argsort(word, kind="stable")
    again = np.flatnonzero(word[order[1:]] == word[order[:-1]])
    gap = np.full(n, n, np.int64)  # words to the next occurrence of the same word
    gap[order[again]] = order[again + 1] - order[again]
    number = _mod(word.astype(np.uint64))
    cover = np.zeros(n, np.int64)  # the farthest end of a run that holds the place
    b, worst = FIRST, gap
    while TIMES * (1 if b == FIRST else b) <= n and len(worst):
        step = b if b == FIRST else 2
        worst = worst[:len(worst) // step * step].reshape(-1, step).max(1)
        starts = np.flatnonzero(worst < 2 * b) * b
        starts = starts[cover[starts] < starts + 3 * b - 1]
        begin, distance = seeds(number, starts, b)
        left = cover[begin] < begin + distance + b
        begin, distance = begin[left], distance[left]
        by = np.lexsort((begin, distance))
        begin, distance = begin[by], distance[by]
        cuts = [0, *(np.flatnonzero(np.diff(distance)) + 1).tolist(), len(begin)]
        longer = cover.copy() if len(begin) else cover
        for a, z in zip(cuts, cuts[1:]):
            while a < z:
                d, x = int(distance[a]), int(begin[a])
                got = extend(word, x, d, b)
                if got is None:
                    a += 1
                    continue
                start, end = got
                if end - start >= max(LEAST, TIMES * d) and longer[start] < end:  # else inside a run of a smaller period
                    found.append((start, end, d))
                    longer[start:end] = np.maximum(longer[start:end], end)
                a += max(1, int(np.searchsorted(begin[a:z], end - d - b, "right")))
        cover = longer
        b *= 2
    return sorted((s, e, d) for s, e, d in found)


def words_of(text: str) -> list[bytes]:
    """What ASCII white space separates."""
    return text.encode("utf-8", "surrogatepass").split()


def periodic_runs(df: DataFrame, rewrite=None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start, then period), collapsed (text).

    collapsed: the words joined by single spaces, without those that lie in a run after its first period.  Null and
    empty texts and texts of white space have no words, no runs and an empty text.  Repeated rows are treated each.
    ``rewrite(doc_id, n)``, if given, is None or (a, p): then each word i >= a becomes word a + (i - a) % p first.
    """
    def run(rows):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for some in batches(rows, most=CHARACTERS):
            texts = [words_of(t) for _, t in some]
            counts = np.fromiter(map(len, texts), np.int64, len(texts))
            ends = np.cumsum(counts)
            line = [b" ".join(t) for t in texts]
            full = pa.array([x for x in line if x], pa.large_binary())
            code = pc.split_pattern(full, b" ").values.dictionary_encode().indices.to_numpy().astype(np.int64)
            source = {}
            for i, ((doc_id, _), n, end) in enumerate(zip(some, counts.tolist(), ends.tolist())):
                change = rewrite(doc_id, n) if rewrite and n else None
                if change:
                    source[i] = np.arange(n)
                    a, p = change
                    source[i][a:] = a + np.arange(n - a) % p
                    code[end - n:end] = code[end - n:end][source[i]]
            code += np.repeat(np.arange(len(texts)), counts) << 32
            runs = [[] for _ in texts]
            dropped = np.zeros(len(code), bool)
            for start, end, q in find_runs(code):
                i = int(np.searchsorted(ends, start, "right"))
                runs[i].append((int(start - ends[i] + counts[i]), int(end - start), q))
                dropped[start + q:end] = True
            for i, (doc_id, _) in enumerate(some):
                text = line[i]
                if i in source or runs[i]:
                    keep = np.flatnonzero(~dropped[ends[i] - counts[i]:ends[i]])
                    text = b" ".join(map(texts[i].__getitem__, (source[i][keep] if i in source else keep).tolist()))
                yield doc_id, len(texts[i]), [dict(zip(("start", "length", "period"), r)) for r in runs[i]], text.decode("utf-8", "surrogatepass")

    return map_rows(slim_texts(df, "doc_id"), run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id, n: int):
    """The query's rewriting: a tenth of the documents gets a periodic end.  A null doc_id gets none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


def strongest(runs: str) -> Column:
    """The run of greatest exact length / period, the first of equals; runs are in order of start, then period."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.expr(f"aggregate({runs}, cast(null as {kind}), (m, r) -> CASE WHEN m IS NULL OR r.length * m.period > m.length * r.period THEN r ELSE m END)")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = periodic_runs(table(spark, sf_dir, "documents"), planted).withColumn("m", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    milli = F.expr("1000 * m.length div m.period")
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "m.start", "m.length", "m.period", milli.alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
