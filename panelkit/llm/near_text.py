"""Operator 2, near-duplicate texts by order MinHash.

A text's k-mers are its shingles of five words, each labelled with its
occurrence number, so that all are different.  For each of ENTRIES hash
functions the SAMPLE k-mers of least hash are taken and kept in text order;
their hash is one entry of the sketch.  Two texts agree in an entry if the
same k-mers are least and stand in the same order, which is sensitive to edit
similarity, not to common content alone.

Texts that agree in AGREE entries or more are candidates; at a similarity of
0.8 about 15 of 47 entries agree, and fewer than two with a chance of 2e-7 for
long texts and 2e-6 at most for texts of 21 k-mers and more.
Candidates are verified on their whole word sequences by banded alignment: the
longest common subsequence L of the labelled shingles inside the band that the
similarity allows, L / (n + m - L) >= 0.8.

An entry of a text with few k-mers holds a large part of them, so that similar
texts may agree in none.  Pairs of which one has SHORT k-mers or fewer are
found exactly, by a prefix filter: in any common order of the k-mers, of two
similar texts the first n - ceil(0.8 n) + 1 share one.  The order puts frequent
k-mers last; each k-mer of a prefix is a bucket, of which all pairs are tested.

No pair of texts is ever a row but a link or one of the first tests.  First,
each text is tested against the text that is least in most of its buckets;
links contract texts to classes.  Then buckets that still hold several classes
are worked through one by one, strip by strip: candidates between classes,
those that agree most first, until they are linked or all have been tested; a
pair is looked at in the first entry it agrees in.  Before the alignment, a
bound on the common k-mers (the lesser counts of k-mers by hash cell, summed)
leaves out what can't reach the similarity.  A bucket of more than LARGE texts
is dealt by the next entry that its texts agree in; if they agree in AGREE
entries and are still too many, or hold more than PIECE words, it is cut into
blocks, and each pair of blocks is one piece of work.  A large bucket of the
prefix filter is dealt by the two texts' lengths (as far as the place of the
shared k-mer still allows enough common ones), then by the next shared k-mers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import discard, map_rows, numbered, release, table, written
from panelkit.llm.components import components

SHINGLE = 5  # words
SIMILARITY = 0.8
ENTRIES = 47  # of a sketch
SAMPLE = 5  # k-mers of an entry
AGREE = 2  # entries in which candidates agree at least
SHORT = 20  # k-mers up to which a text's pairs are found exactly, not by entries
FREQUENT = 4_096  # k-mers that come last in the order of the prefix filter
PREFIX = -1  # the path of a prefix's bucket
LARGE = 2_048  # texts of a bucket that one task works through
PIECE = 4_000_000  # words of them
STRIP = 64  # texts whose candidates are looked up together
CELLS = 8_192  # of the k-mer counts that bound a pair's common ones, at most
HELD = 1_000_000  # k-mers of texts kept ready for alignment
WORD_BYTES = 3  # of a word's hash as kept for the alignment
SEED = 977
SALTS = 64


def word_hashes(text: str):
    """The first WORD_BYTES bytes of each word's hash, as numbers; words are what ASCII white space separates."""
    import numpy as np
    import xxhash
    words = text.encode("utf-8", "surrogatepass").split()
    of = xxhash.xxh3_64_intdigest
    return np.fromiter(map(of, words), np.uint64, len(words)) & np.uint64((1 << 8 * WORD_BYTES) - 1)


def _mix(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def kmers(words):
    """Occurrence-labelled shingles in text order, as 64-bit hashes; a text of fewer than five words has one, of all its words."""
    import numpy as np
    n = len(words) - SHINGLE + 1
    if not len(words):
        return words
    width, n = (SHINGLE, n) if n > 0 else (len(words), 1)
    s = np.full(n, width, np.uint64)
    for i in range(width):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if not new.all():
        at = np.arange(n)
        label = np.empty(n, np.uint64)
        label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        s = np.where(label > 0, _mix(s + label * np.uint64(0xD6E8FEB86659FD93)), s)
    return s


def _least(hashed):
    """Per row the places of its SAMPLE least values; most rows are settled by those under a common bound."""
    import numpy as np
    rows, n = hashed.shape
    if n <= 200:
        return np.argpartition(hashed, SAMPLE - 1, axis=1)[:, :SAMPLE]
    row, col = np.nonzero(hashed < np.uint64((1 << 64) // n * 5 * SAMPLE))
    order = np.lexsort((hashed[row, col], row))
    row, col = row[order], col[order]
    count = np.bincount(row, minlength=rows)
    if count.min() < SAMPLE:
        return np.argpartition(hashed, SAMPLE - 1, axis=1)[:, :SAMPLE]
    return col[(np.cumsum(count) - count)[:, None] + np.arange(SAMPLE)]


def sketch(s):
    """The ENTRIES entries of the order MinHash of k-mers s."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 63, ENTRIES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.arange(ENTRIES, dtype=np.uint64)
    n = len(s)
    if n <= SAMPLE:
        least = np.broadcast_to(np.arange(n), (ENTRIES, n))
    else:
        least = np.sort(_least(s[None, :] * factors[:, None]), axis=1)  # in text order
    for i in range(least.shape[1]):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + s[least[:, i]])
    return out


class Kmers:
    """The k-mers of a text and, for look-ups, their order."""

    def __init__(self, kmers):
        self.kmers = kmers
        self.order = kmers.argsort()
        self.ranked = kmers[self.order]


def aligned(a: Kmers, b: Kmers, similarity: float = SIMILARITY) -> bool:
    """Whether two k-mer sequences reach the similarity by an alignment inside the band.

    An alignment with L matches has n + m - 2L gaps, so one that suffices leaves the diagonal by no more than that.
    K-mers are different within a text, so the longest common subsequence is a longest increasing one.
    """
    from bisect import bisect_left
    from math import ceil

    import numpy as np
    n, m = len(a.kmers), len(b.kmers)
    if not n or not m:
        return False
    need = ceil(similarity * (n + m) / (1 + similarity) - 1e-9)
    if need > min(n, m):
        return False
    where = np.minimum(a.ranked.searchsorted(b.kmers), n - 1)
    at = np.flatnonzero(a.ranked[where] == b.kmers)
    if len(at) < need:
        return False
    pos = a.order[where[at]]
    pos = pos[np.abs(pos - at) <= n + m - 2 * need]
    if len(pos) < need:
        return False
    if (pos[1:] > pos[:-1]).all():
        return True
    tails: list[int] = []
    for p in pos.tolist():
        k = bisect_left(tails, p)
        if k == len(tails):
            tails.append(p)
        else:
            tails[k] = p
    return len(tails) >= need


def unpacked(raw: bytes) -> Kmers:
    """The k-mers from the stored word hashes."""
    import numpy as np
    x = np.zeros((len(raw) // WORD_BYTES, 8), np.uint8)
    x[:, :WORD_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, WORD_BYTES)
    return Kmers(kmers(x.view("<u8").ravel()))


def sketches(df: DataFrame, row: str | None = None) -> DataFrame:
    """row (column ``row`` of ``df``, else a new number), doc_id, digest (of the word sequence), n (k-mers), entries (64-bit each), words: written; one pass over the whole texts."""
    def run(rows):
        import numpy as np
        import xxhash
        for row, doc_id, text in rows:
            w = word_hashes(text)
            raw = w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
            k = kmers(w)
            entries = sketch(k).astype("<u8").tobytes() if len(w) else b""
            yield row, doc_id, xxhash.xxh3_128_digest(b" ".join(text.encode("utf-8", "surrogatepass").split())), len(k), entries, raw

    number = F.col(row) if row else F.monotonically_increasing_id()
    docs = df.select(number.alias("row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return written(map_rows(docs, run, "row long, doc_id long, digest binary, n long, entries binary, words binary"), "order-minhash", compression="zstd")


def _verify(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` that are similar; words: row, words."""
    def run(rows):
        last, held = None, None
        for a, b, x, y in rows:
            if b != last:
                last, held = b, unpacked(y)
            if aligned(unpacked(x), held, similarity):
                yield a, b

    left = pairs.join(words.select(F.col("row").alias("a"), F.col("words").alias("x")), "a")
    both = left.join(words.select(F.col("row").alias("b"), F.col("words").alias("y")), "b").select("a", "b", "x", "y")
    found = written(map_rows(both, run, "a long, b long"), "similar")
    release(pairs.sparkSession)
    return found


MEMBER = "row long, bucket long, path array<int>, n long"


def _buckets(rows: DataFrame) -> DataFrame:
    """row, bucket, path, n of every entry of ``rows`` (row, entries, n); path: the entries that the bucket's texts agree in."""
    def run(parts):
        import numpy as np
        for row, entries, n in parts:
            for i, e in enumerate(_hashed(np.frombuffer(entries, "<u8"))):
                yield row, e, [i], n

    return map_rows(rows.select("row", "entries", "n"), run, MEMBER)


def _prefix(n: int, similarity: float) -> int:
    """Of how many first k-mers, in any common order, similar texts share one."""
    from math import ceil
    return n - ceil(similarity * n - 1e-9) + 1


def _need(n: int, m: int, similarity: float) -> int:
    """Common k-mers of two similar texts of n and m, at least."""
    from math import ceil
    return ceil(similarity * (n + m) / (1 + similarity) - 1e-9)


def _frequent(rows: DataFrame) -> dict[int, int]:
    """The FREQUENT k-mers of ``rows`` (row, words) that come last in the order, the most frequent first."""
    def every(parts):
        for (words,) in parts:
            for k in unpacked(words).kmers.view("i8").tolist():
                yield (k,)

    counted = map_rows(rows.select("words"), every, "kmer long").groupBy("kmer").count().where("count > 1")
    return {r["kmer"]: i for i, r in enumerate(counted.orderBy("count", "kmer", ascending=False).limit(FREQUENT).collect())}


def _ordered(words: bytes, last: dict[int, int]) -> list[int]:
    return sorted(unpacked(words).kmers.view("i8").tolist(), key=lambda x: (-last.get(x, FREQUENT), x))


def _short_buckets(rows: DataFrame, last: dict[int, int], similarity: float) -> DataFrame:
    """row, bucket, path, n of the prefix of every text of ``rows`` (row, words).

    path: PREFIX, how many shared k-mers the bucket stands for, the place of the last of them in the text's order.
    """
    def run(parts):
        for row, words in parts:
            k = _ordered(words, last)
            for i, x in enumerate(k[:_prefix(len(k), similarity)]):
                yield row, x, [PREFIX, 1, i], len(k)

    return map_rows(rows.select("row", "words"), run, MEMBER)


def _deeper_short(mixed: DataFrame, rows: DataFrame, last: dict[int, int], similarity: float) -> DataFrame:
    """The members of prefix buckets dealt by pairs of lengths, and once that is done, by the next shared k-mer.

    path then goes on with the two lengths and the common k-mers that such texts need.  What two similar texts share
    first, second and so on stands within the first n - need + 1, + 2 and so on of each.
    """
    def run(parts):
        from math import ceil, floor
        for row, bucket, path, words in parts:
            k = _ordered(words, last)
            n, (_, level, place, *sized) = len(k), path
            if not sized:
                for m in range(ceil(similarity * n - 1e-9), floor(n / similarity + 1e-9) + 1):
                    need = _need(n, m, similarity)
                    if need <= level + n - place - 1:
                        to = [max(n, m), min(n, m), need]
                        yield row, _deepened(bucket, to[0] << 32 | to[1]), [PREFIX, level, place, *to], n
            else:
                for j in range(place + 1, n - sized[2] + level + 1):
                    yield row, _deepened(bucket, k[j]), [PREFIX, level + 1, j, *sized], n

    return map_rows(mixed.select("row", "bucket", "path").join(rows, "row").select("row", "bucket", "path", "words"), run, MEMBER)


def _deepened(bucket: int, by: int) -> int:
    import numpy as np
    return _hashed(np.array([by & (1 << 64) - 1], np.uint64), bucket)[0]


def _hashed(entries, bucket: int = 0) -> list[int]:
    """A number per entry that tells its place and value, and the bucket it deepens."""
    import numpy as np
    return _mix(_mix(entries + np.arange(len(entries), dtype=np.uint64)) ^ np.uint64(bucket & ((1 << 64) - 1))).view(np.int64).tolist()


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members (row, bucket, path, n) of buckets that hold more than one class, with class, size and weight (k-mers) of the bucket.

    A text without links is a class of its own.
    """
    classed = members.join(roots, F.col("row") == F.col("node"), "left").withColumn("class", F.coalesce("root", "row")).drop("node", "root")
    of = classed.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi")
    return classed.join(of.select("bucket", "size", "weight"), "bucket")


class Texts:
    """The texts of a piece of work: their k-mers, made when needed, and the bound on a pair's common ones."""

    def __init__(self, words: list[bytes], size):
        import numpy as np
        self.words, self.size = words, size
        self.ready: dict[int, Kmers] = {}
        self.held = 0
        cells = 256
        while cells < CELLS and cells < 4 * np.median(size):
            cells *= 2
        self.cells = cells
        self.counts = np.zeros((len(words), cells), np.uint8)
        self.counted = np.zeros(len(words), bool)

    def kmers(self, i: int) -> Kmers:
        if i not in self.ready:
            if self.held > HELD:
                self.ready, self.held = {}, 0
            self.ready[i] = unpacked(self.words[i])
            self.held += len(self.ready[i].kmers)
        return self.ready[i]

    def bound(self, some, b: int):
        """For each text of ``some`` no less than the k-mers it has in common with b."""
        import numpy as np
        for i in (*some[~self.counted[some]].tolist(), *(() if self.counted[b] else (b,))):
            cell = np.bincount(self.kmers(i).kmers.astype(np.int64) & (self.cells - 1), minlength=self.cells)
            if cell.max() > np.iinfo(self.counts.dtype).max:
                self.counts = self.counts.astype(np.uint32)
            self.counts[i] = cell
            self.counted[i] = True
        return np.minimum(self.counts[some], self.counts[b]).sum(1, dtype=np.int64)


def bucket_links(rows: list[tuple], similarity: float):
    """The links (row, row) between classes of one bucket, or of two of its blocks, enough to join all that are linked.

    rows: (path, row, class, n, entries, words, block); of two blocks, only pairs between them count.  Strip by strip,
    candidates are tested in order of agreement; a pair whose classes have been joined meanwhile needs no test.  Held
    besides the rows: counts of LARGE times CELLS bytes (more for texts of very many equal cells), the candidates of
    one strip and the k-mers of HELD.
    """
    import numpy as np
    path = list(rows[0][0])
    short, sized = path[0] == PREFIX, path[3:]
    sketches_ = None if short else np.frombuffer(b"".join(r[4] for r in rows), "<u8").reshape(len(rows), -1)
    group = np.unique([r[2] for r in rows], return_inverse=True)[1]
    size = np.array([r[3] for r in rows])
    block = np.array([r[6] for r in rows])
    within = block.min() == block.max()
    texts = Texts([r[5] for r in rows], size)
    for strip in range(1, len(rows), STRIP):
        pairs = []
        for b in range(strip, min(strip + STRIP, len(rows))):
            near = np.flatnonzero((group[:b] != group[b]) & (within | (block[:b] != block[b])) & (np.minimum(size[:b], size[b]) >= similarity * np.maximum(size[:b], size[b])))
            if short:
                if sized:
                    near = near[(np.maximum(size[near], size[b]) == sized[0]) & (np.minimum(size[near], size[b]) == sized[1])]
                agreed = np.full(len(near), AGREE)
            else:
                agree = sketches_[near] == sketches_[b]
                agreed = agree.sum(1)
                # the bucket's entries must be the first that the two agree in, so that no other bucket has the pair
                here = (agreed >= AGREE) & (agree[:, :path[-1] + 1].sum(1) == len(path))
                near, agreed = near[here], agreed[here]
            if len(near) > 4:
                can = texts.bound(near, b) >= similarity * (size[near] + size[b]) / (1 + similarity) - 1e-9
                near, agreed = near[can], agreed[can]
            if len(near):
                pairs.append(np.column_stack([near, np.full(len(near), b), agreed]))
        if not pairs:
            continue
        pairs = np.concatenate(pairs)
        for a, b, _ in pairs[np.argsort(-pairs[:, 2], kind="stable")].tolist():
            if group[a] != group[b] and aligned(texts.kmers(a), texts.kmers(b), similarity):
                group[group == group[b]] = group[a]
                yield rows[a][1], rows[b][1]


def _work_through(mixed: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the links between classes inside buckets, large ones block against block."""
    # blocks of half of LARGE; block i goes with every block j to the piece (least, greatest), with itself to (i, i)
    share = F.greatest(F.col("size") / LARGE, F.col("weight") / PIECE)
    blocks = F.when(share <= 1, 1).otherwise(F.least(F.ceil(2 * share), F.col("size"))).cast("int")
    cut = mixed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("row", "bucket"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("row", "bucket", "path", "class", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    rows = cut.join(docs.select("row", "n", "entries", "words"), "row").select("bucket", "lo", "hi", "path", "row", "class", "n", "entries", "words", "block")
    ordered = rows.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    def run(parts):
        key, held = None, []
        for bucket, lo, hi, *r in parts:
            if held and (bucket, lo, hi) != key:
                yield from bucket_links(held, similarity)
                held = []
            key = bucket, lo, hi
            held.append(r)
        if held:
            yield from bucket_links(held, similarity)

    return written(map_rows(ordered, run, "a long, b long"), "bucket-links")


def _deeper(mixed: DataFrame, docs: DataFrame) -> DataFrame:
    """The members dealt by each later entry as well: row, bucket, path, n."""
    def run(rows):
        import numpy as np
        for row, bucket, path, n, entries in rows:
            for i, e in enumerate(_hashed(np.frombuffer(entries, "<u8"), bucket)):
                if i > path[-1]:
                    yield row, e, [*path, i], n

    rows = mixed.select("row", "bucket", "path", "n").join(docs.select("row", "entries"), "row").select("row", "bucket", "path", "n", "entries")
    return map_rows(rows, run, MEMBER)


def classes(df: DataFrame, similarity: float = SIMILARITY, row: str | None = None) -> DataFrame:
    """row, doc_id, class_id (least doc_id of the class), kept (one row of each class: of least doc_id, then row).

    Classes are the connected components of the similarity links; texts with equal word sequences are one.
    Texts without a word (null, empty, white space) are similar to nothing and kept.  Repeated rows are copies.
    A class without any id has a null class_id.
    """
    docs = sketches(df, row)
    node = docs.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"))
    slim = docs.select("row", "doc_id", "digest")
    texts = docs.select("row", "digest", "n").join(node, "digest").where("row = node").select("row")
    flat = _buckets(docs.where(F.col("n") > SHORT).join(texts, "row", "left_semi"))
    # a text similar to a short one has SHORT / similarity k-mers at most
    short = written(docs.where(F.col("n") * similarity <= SHORT + 1e-9).select("row", "words").join(texts, "row", "left_semi"), "short")
    last = _frequent(short)
    flat = flat.union(_short_buckets(short, last, similarity))
    sized = flat.groupBy("bucket").agg(F.min("row").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = written(flat.join(sized.drop("size"), "bucket"), "buckets")
    # the text that is least in most of a text's buckets, if in enough of them for a candidate
    weight = F.when(F.col("path")[0] == PREFIX, AGREE).otherwise(1)
    often = members.where("row != hub").groupBy("row", "hub").agg(F.sum(weight).alias("count")).where(F.col("count") >= AGREE)
    first = often.groupBy("row").agg(F.max(F.struct("count", -F.col("hub"))).alias("m")).select(F.col("row").alias("a"), (-F.col("m")["col2"]).alias("b"))
    made = [short, members, links := _verify(first, docs.select("row", "words"), similarity)]
    roots, at = components(links), members.select("row", "bucket", "path", "n")
    while True:
        mixed = written(_mixed(at, roots), "mixed")
        prefix = F.col("path")[0] == PREFIX
        deep = F.when(prefix, (F.size("path") > 3) & (F.get("path", F.lit(1)) >= F.get("path", F.lit(5)))).otherwise(F.size("path") >= AGREE)
        made += [mixed, more := _work_through(mixed.where((F.col("size") <= LARGE) | deep), docs, similarity)]
        release(df.sparkSession)
        links = links.union(more)
        roots = components(links)
        large = mixed.where((F.col("size") > LARGE) & ~deep)
        if large.isEmpty():
            break
        at = written(_deeper(large.where(~prefix), docs).union(_deeper_short(large.where(prefix), short, last, similarity)), "dealt")
        made.append(at)
    # copies of one text are dealt over SALTS tasks
    node = node.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    slim = slim.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    ids = slim.join(node, ["digest", "salt"], "left").join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    ids = written(ids.select("row", "doc_id", F.coalesce("root", "node", "row").alias("root")), "class-roots")
    discard(docs, *made)
    release(df.sparkSession)
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")
    best = ids.groupBy("root").agg(F.min(first).alias("best"), F.count("*").alias("n")).where("n > 1")
    best = best.select("root", "best", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = ids.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(best, ["root", "salt"], "left")
    alone = F.col("best").isNull()
    return dealt.select("row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"), (alone | (F.col("row") == F.col("best.row"))).alias("kept"))


def deduplicate(df: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows that stay, all columns as they are."""
    rows, number = numbered(df)
    keep = classes(rows, similarity, number).where("kept").select(F.col("row").alias(number))
    return rows.join(keep, number, "left_semi").drop(number)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
