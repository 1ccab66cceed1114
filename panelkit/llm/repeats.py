"""Operator 6, exact repeats by suffix arrays.

A byte goes if some LENGTH-byte string that covers it also starts earlier
(documents by doc_id, then place).  Strings never cross documents and are
judged on the input.

1. Every LENGTH-byte window has an anchor, the least hash among its K-byte
   strings (the leftmost one), which depends on the window's bytes alone: equal
   windows have equal anchors at equal places.  Windows are neighbours in runs
   of one anchor.  Blocks of documents send the anchors that they hold, each
   once; anchors that only one text holds, and once, are settled: nothing there
   repeats.
2. For each other anchor, the bytes that its run of windows spans are sent to
   the anchor's shard, equal ones of a block once.  An anchor of very many
   texts is subdivided: its windows go one by one, by their own hash, so that
   no shard gathers what grows with the corpus but a window's equal copies,
   which blocks have merged.
3. A shard sorts the suffixes of its spans by induced sorting
   (``suffix_array``); the permuted common prefixes tell which neighbouring
   windows agree over LENGTH bytes, and of each such set all but the earliest
   are removed.
4. Blocks add up their removed windows by document.

Later copies of a whole text are removed as such before all that.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import fresh, map_rows, numbered, release, slim_texts, table, written
from panelkit.llm.suffix_array import permuted_prefixes, suffix_array

LENGTH = 100  # bytes
K = 50  # bytes of an anchor
WINDOW = LENGTH - K + 1  # places of an anchor in a window; a run of one anchor has so many windows at most
BLOCK_BITS = 9  # 512 consecutive rows are a block
LONG = 65_536  # bytes beyond which a text is a block of its own, so that a block is 32 MB of texts at most, or one text
STEP = 1 << 19  # windows worked on at once; places fit PLACE bits
PLACE = np.uint64((1 << 20) - 1)
BUCKET_BYTES = 8_000_000  # of text, per bucket of anchors
SHARD_BYTES = 2_000_000  # of spans, per suffix array, about
SALTS = 64
HOT = 4_096  # different texts that hold an anchor, from which on its windows go one by one


def _hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the K bytes at each place, by doubling."""
    def join(left, right):
        x = left * np.uint64(0x9E3779B97F4A7C15) + right
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        return x ^ (x >> np.uint64(27))

    h, s = b.astype(np.uint64) + np.uint64(1), 1
    while 2 * s <= K:
        h, s = join(h[:-s], h[s:]), 2 * s
    return join(h[:len(h) - (K - s)], h[K - s:]) if s < K else h


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, by minima from both ends of blocks of w."""
    y = np.concatenate([x, np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    forth, back = np.minimum.accumulate(y, 1).ravel(), np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:len(x) - w + 1], forth[w - 1:len(x)])


def anchor_runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, 48-bit anchor hash) of each run of windows with one anchor, by text and place."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    for base in range(0, max(0, len(buf) - LENGTH + 1), STEP):
        h = _hashes(buf[base:base + STEP + LENGTH - 1])
        place = _least((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), WINDOW) & PLACE
        n = len(place)
        inside = of[base:base + n] == of[base + LENGTH - 1:base + LENGTH - 1 + n]
        new = np.append(True, (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]))
        at = np.flatnonzero(new)
        count = np.diff(at, append=n)
        at, count = at[inside[at]], count[inside[at]]
        found.append((at + base, count, h[place[at].astype(np.int64)] >> np.uint64(16)))
    at, count, anchor = (np.concatenate(x) for x in zip(*found))
    text = of[at] if len(at) else np.empty(0, np.int32)
    return text, at - begins[text], count, anchor


def _cut(x: np.ndarray, width: int) -> bytes:
    """Unsigned numbers in ``width`` bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _uncut(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _grouped(rows):
    """(key, rows) of neighbouring rows with the same first value."""
    key, held = None, []
    for r in rows:
        if held and r[0] != key:
            yield key, held
            held = []
        key = r[0]
        held.append(r)
    if held:
        yield key, held


def _by_key(df: DataFrame, *key: str) -> DataFrame:
    """Rows of a key side by side in one partition; tasks stream them, and hold one key's at a time."""
    return df.repartition(key[0]).sortWithinPartitions(*key)


def _block(n_bytes):
    return F.when(n_bytes > LONG, -1 - F.col("row")).otherwise(F.shiftright("row", BLOCK_BITS)).alias("block")


def _documents(rows: DataFrame) -> DataFrame:
    """block, row, doc_id, text of ``rows`` (row, doc_id, text)."""
    return slim_texts(rows, "row", "doc_id").select(_block(F.octet_length("text")), "row", "doc_id", "text")


def repeated_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """block, kind 0, payload: the anchors of a block that two texts hold or one holds twice (hash * 2 + hot)."""
    def send(rows):
        import xxhash
        for block, docs in _grouped(rows):
            texts = [d[3].encode("utf-8", "surrogatepass") for d in docs]
            text, _, _, anchor = anchor_runs(texts)
            digest = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64) >> np.uint64(1)  # 63 bits, and one for a mark
            order = np.lexsort((text, anchor))
            text, anchor = text[order], anchor[order]
            twice = np.zeros(len(text), bool)
            twice[1:] = (text[1:] == text[:-1]) & (anchor[1:] == anchor[:-1])
            holder = digest[text] << np.uint64(1)
            order = np.lexsort((~twice, holder, anchor))  # of one text's repeats, the row that says so stays
            anchor, holder, twice = anchor[order], holder[order], twice[order]
            if not len(anchor):
                continue
            first = np.append(True, (anchor[1:] != anchor[:-1]) | (holder[1:] != holder[:-1]))
            anchor, holder = anchor[first], holder[first] | twice[first].astype(np.uint64)
            bucket = (anchor % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            anchor, holder = anchor[order], holder[order]
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            for b in np.unique(bucket).tolist():
                part = slice(ends[b - 1] if b else 0, ends[b])
                yield b, block, _cut(anchor[part], 6) + holder[part].tobytes()

    def settle(rows):
        for _, parts in _grouped(rows):
            size = [len(p) // 14 for _, _, p in parts]
            anchor = np.concatenate([_uncut(p[:6 * n], 6) for n, (_, _, p) in zip(size, parts)])
            holder = np.concatenate([np.frombuffer(p[6 * n:], "<u8") for n, (_, _, p) in zip(size, parts)])
            block = np.repeat(np.array([b for _, b, _ in parts], np.int64), size)
            order = np.lexsort((holder, anchor))
            anchor, holder, block = anchor[order], holder[order], block[order]
            new = np.append(True, anchor[1:] != anchor[:-1])
            other = np.append(True, new[1:] | (holder[1:] >> np.uint64(1) != holder[:-1] >> np.uint64(1)))
            at = np.flatnonzero(new)
            texts, twice = np.add.reduceat(other.astype(np.int64), at), np.maximum.reduceat(holder & np.uint64(1), at)
            group = np.cumsum(new) - 1
            wanted = ((texts > 1) | (twice > 0))[group]
            anchor, block, hot = anchor[wanted], block[wanted], (texts >= HOT)[group][wanted]
            order = np.argsort(block, kind="stable")
            anchor, block, hot = anchor[order], block[order], hot[order]
            for part in np.split(np.arange(len(block)), np.flatnonzero(block[1:] != block[:-1]) + 1):
                if len(part):
                    yield int(block[part[0]]), 0, np.unique(anchor[part] << np.uint64(1) | hot[part].astype(np.uint64)).tobytes()

    sent = map_rows(_documents(rows), send, "bucket int, block long, payload binary")
    return map_rows(_by_key(sent, "bucket"), settle, "block long, kind int, payload binary")


def candidates(rows: DataFrame, anchors: DataFrame, copies: DataFrame) -> DataFrame:
    """block, payload, bytes: the block's documents that hold repeated anchors, with the runs of these; written.

    copies: row and block of each later copy of a whole text, which has no say.
    """
    import zstandard

    def pack(rows):
        press = zstandard.ZstdCompressor(level=1)
        for block, docs in _grouped(rows):
            yield block, 2, press.compress(pickle.dumps([(row, doc_id, text.encode("utf-8", "surrogatepass")) for _, row, doc_id, text in docs]))

    def select(rows):
        press, open_ = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for block, parts in _grouped(rows):
            known = [np.frombuffer(p, np.uint64) for _, kind, p in parts if kind == 0]
            if not known:
                continue
            known = np.unique(np.concatenate(known))
            gone = {int.from_bytes(p, "little") for _, kind, p in parts if kind == 1}
            docs = [d for _, kind, p in parts if kind == 2 for d in pickle.loads(open_.decompress(p)) if d[0] not in gone and len(d[2]) >= LENGTH]
            docs.sort(key=lambda d: (d[1] is not None, d[1] or 0, d[0]))
            text, at, count, anchor = anchor_runs([d[2] for d in docs])
            where = np.minimum(np.searchsorted(known >> np.uint64(1), anchor), len(known) - 1)
            held = known[where] >> np.uint64(1) == anchor
            if not held.any():
                continue
            text, at, count, anchor, hot = text[held], at[held], count[held], anchor[held], (known[where[held]] & np.uint64(1)).astype(bool)
            used, text = np.unique(text, return_inverse=True)
            work = [docs[i] for i in used], text.astype(np.int32), at.astype(np.int32), count.astype(np.uint8), anchor, hot
            yield block, press.compress(pickle.dumps(work)), int(count.sum()) + (LENGTH - 1) * len(count)

    docs = map_rows(_documents(rows), pack, "block long, kind int, payload binary")
    later = copies.select("block", F.lit(1).alias("kind"), F.col("row").alias("payload"))

    def as_bytes(rows):
        for block, kind, row in rows:
            yield block, kind, row.to_bytes(8, "little")

    everything = anchors.unionByName(map_rows(later, as_bytes, "block long, kind int, payload binary")).unionByName(docs)
    return written(map_rows(_by_key(everything, "block", "kind"), select, "block long, payload binary, bytes long"), "repeat-candidates", compression="uncompressed")


def _spans(payload: bytes):
    """(documents, spans, runs) of a block.

    spans: {(bytes, None or a hot window's mark): (number, anchor, document, place)}, the earliest occurrence in the
    block; runs: (document, place, windows, number of the span, whether it is that occurrence).
    """
    import zstandard
    docs, text, at, count, anchor, hot = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
    spans: dict = {}
    runs = []
    for d, a, n, key, one_by_one in zip(text.tolist(), at.tolist(), count.tolist(), anchor.tolist(), hot.tolist()):
        raw = docs[d][2]
        for b, m in ((a + i, 1) for i in range(n)) if one_by_one else ((a, n),):
            span = raw[b:b + m + LENGTH - 1], one_by_one
            got = spans.get(span)
            if got is None:
                spans[span] = got = len(spans), key, d, b
                runs.append((d, b, m, got[0], True))
            else:
                runs.append((d, b, m, got[0], False))
    return docs, spans, runs


def _send_spans(work: DataFrame, shards: int) -> DataFrame:
    """shard, block, payload."""
    def run(rows):
        import xxhash
        for block, payload in rows:
            docs, spans, _ = _spans(payload)
            to: dict = {}
            for (raw, hot), (number, key, d, place) in spans.items():
                shard = xxhash.xxh3_64_intdigest(raw) if hot else key
                to.setdefault(shard % shards, []).append((number, docs[d][1], docs[d][0], place, raw))
            for shard, held in to.items():
                yield shard, block, pickle.dumps(held)

    return map_rows(work.select("block", "payload"), run, "shard int, block long, payload binary")


def shard_masks(parts: list[tuple[int, list]]):
    """(block, number, mask) for the earliest occurrence of each different span in a shard; bit i: window i goes.

    parts: (block, [(number, doc_id, row, place, bytes)]).  Other occurrences go whole.
    """
    first: dict = {}
    for block, held in parts:
        for number, doc_id, row, place, raw in held:
            key = (doc_id is not None, doc_id or 0, row, place)
            if raw not in first or key < first[raw][0]:
                first[raw] = key, block, number
    lengths = np.array([len(raw) for raw in first], np.int64)
    t = np.frombuffer(b"".join(first), np.uint8)
    begins = np.cumsum(lengths) - lengths
    windows = lengths - LENGTH + 1
    span = np.repeat(np.arange(len(lengths)), windows)
    offset = np.arange(len(span)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begins[span] + offset
    of = np.full(len(t), -1, np.int64)
    of[at] = np.arange(len(at))
    order = suffix_array(t, 256, LENGTH)
    order = order[of[order] >= 0]  # windows only
    new = np.append(True, permuted_prefixes(t, order, LENGTH) < LENGTH)
    docs = {d: i for i, d in enumerate(sorted({key[:3] for key, _, _ in first.values()}))}
    rank = np.array([docs[key[:3]] for key, _, _ in first.values()], np.int64)
    place = np.array([key[3] for key, _, _ in first.values()], np.int64)
    window = of[order]
    age = (rank[span[window]] << 32) + place[span[window]] + offset[window]
    eldest = np.minimum.reduceat(age, np.flatnonzero(new))
    goes = np.zeros(len(at), np.uint64)
    goes[window] = age != eldest[np.cumsum(new) - 1]
    masks = np.bitwise_or.reduceat(goes << offset.astype(np.uint64), np.cumsum(windows) - windows)
    for (_, block, number), mask in zip(first.values(), masks.tolist()):
        yield block, number, mask


def _settle_spans(sent: DataFrame) -> DataFrame:
    """block, kind 1, payload: numbers and masks."""
    def run(rows):
        for _, parts in _grouped(rows):
            out: dict = {}
            for block, number, mask in shard_masks([(b, pickle.loads(p)) for _, b, p in parts]):
                out.setdefault(block, []).append((number, mask))
            for block, held in out.items():
                yield block, 1, np.array([n for n, _ in held], np.uint32).tobytes() + np.array([m for _, m in held], np.uint64).tobytes()

    return map_rows(_by_key(sent, "shard"), run, "block long, kind int, payload binary")


def _add_up(work: DataFrame, masks: DataFrame, with_text: bool) -> DataFrame:
    """row, n_removed, n_spans, sha256 and, if wanted, the bytes kept, of each candidate document."""
    def run(rows):
        import hashlib
        for _, parts in _grouped(rows):
            mask = {}
            for _, kind, p in parts:
                if kind == 1:
                    n = len(p) // 12
                    mask.update(zip(np.frombuffer(p[:4 * n], np.uint32).tolist(), np.frombuffer(p[4 * n:], np.uint64).tolist()))
            for _, kind, p in parts:
                if kind == 1:
                    continue
                docs, _, runs = _spans(p)
                doc, at, count, number, first = (np.array(x) for x in zip(*runs))
                sizes = np.array([len(d[2]) + 1 for d in docs])
                ends = np.cumsum(sizes)
                start = (ends - sizes)[doc] + at
                whole = [(1 << m) - 1 for m in count.tolist()]
                bits = [mask.get(k, w) if f else w for k, w, f in zip(number.tolist(), whole, first.tolist())]
                full = np.array([x == w for x, w in zip(bits, whole)])
                parts_of = np.array([x for x, w in zip(bits, whole) if x != w], np.uint64)
                opened, closed = [start[full]], [(start + count + LENGTH - 1)[full]]
                for i in range(WINDOW):
                    goes = start[~full][(parts_of >> np.uint64(i)) & np.uint64(1) == 1] + i
                    opened.append(goes)
                    closed.append(goes + LENGTH)
                size = int(ends[-1])
                cover = np.cumsum(np.bincount(np.concatenate(opened), minlength=size) - np.bincount(np.concatenate(closed), minlength=size)) > 0
                for (row, _, raw), end in zip(docs, ends.tolist()):
                    gone = cover[end - len(raw) - 1:end - 1]
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    yield row, len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None

    both = work.select("block", F.lit(0).alias("kind"), "payload").unionByName(masks)
    return map_rows(_by_key(both, "block", "kind"), run, "row long, n_removed long, n_spans long, sha256 string, kept binary")


def repeats(rows: DataFrame, number: str, with_text: bool = False) -> DataFrame:
    """row, doc_id, n_bytes, n_removed, n_spans, sha256 of the bytes kept; with_text: kept, null where nothing was removed.

    rows, number: as ``numbered`` gives them.  Null texts are empty.  Null doc_ids come first; rows of one doc_id are ordered by row number, and repeated
    rows are documents of their own, so later ones are removed whole (if LENGTH bytes or longer).
    """
    rows = rows.select(F.col(number).alias("row"), "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = written(rows.select("row", "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"), _block(F.octet_length(text))), "repeat-documents")
    order = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "row")
    firsts = base.where(F.col("n_bytes") >= LENGTH).groupBy("whole").agg(F.min(order).alias("f"), F.count("*").alias("n")).where("n > 1").select("whole", F.col("f.row").alias("first"))
    # a text that very many documents hold is dealt over SALTS tasks
    salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = written(base.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["whole", "salt"]).where("row != first").select("row", "block"), "repeat-copies")
    total = base.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    anchors = repeated_anchors(rows, max(16, total // BUCKET_BYTES))
    work = candidates(rows, anchors, copies)
    release(rows.sparkSession)
    spans = work.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    masks = _settle_spans(_send_spans(work, max(16, spans // SHARD_BYTES)))
    changed = _add_up(work, masks, with_text).withColumnRenamed("sha256", "rest")
    out = base.join(copies.select("row", F.lit(True).alias("copy")), "row", "left").join(changed, "row", "left")
    none = F.lit(0).cast("long")
    return out.select(
        "row", "doc_id", "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", none)).alias("n_removed"),
        F.when(F.col("copy"), F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", none)).alias("n_spans"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("rest", "whole")).alias("sha256"),
        *([F.when(F.col("copy"), F.lit(b"")).when(F.col("n_removed") > 0, F.col("kept")).alias("kept")] if with_text else []))


def remove_repeats(df: DataFrame) -> DataFrame:
    """The rows with the bytes that go cut out of the text; n_chars follows it, other columns stay.

    Characters that a cut leaves in part are dropped whole.  Texts without repeats stay as they are, null ones null.
    """
    rows, number = numbered(df)
    left = fresh(rows, "__kept")
    kept = repeats(rows, number, with_text=True).where("kept IS NOT NULL").select(F.col("row").alias(number), F.col("kept").alias(left))

    @F.pandas_udf("string")
    def text(raw):
        import pandas as pd
        return pd.Series([None if b is None else bytes(b).decode("utf-8", "ignore") for b in raw], dtype=object)

    out = rows.join(kept, number, "left").withColumn("text", F.coalesce(text(left), F.col("text")))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(F.col(left).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.drop(number, left)


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repeats(*numbered(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("sha256").alias("kept_sha256"))
