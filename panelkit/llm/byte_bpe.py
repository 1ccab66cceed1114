"""Operator 1, byte-level BPE encoding and decoding: overlapping chunk encoding.

Long texts are cut into chunks that overlap.  Chunks are pre-tokenised in
parallel, each from its own start.  A chunk's first pre-tokens may be wrong
(its start can lie inside one), but the pattern looks only ahead: from the
first boundary that a chunk shares with its left neighbour on, both agree.
There the chunks are stitched, which cuts the text into segments at true
pre-token boundaries; segments are encoded independently and their ids
concatenated.  Where two chunks share no boundary (a pre-token longer than the
overlap), the rest of that text is one segment, so the result stays exact.
"""

from __future__ import annotations

from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.bpe import Merger, Speller, batches, load_ranks
from panelkit.llm.common import map_rows, slim_texts, table, tokenizer_path, worker_state

CHUNK, OVERLAP = 32_768, 1_024  # code points
AHEAD = 8  # a boundary so near a chunk's cut end may be due to the cut; the pattern looks ahead by less


def _pattern(pattern: str):
    import regex
    state = worker_state()
    if ("pattern", pattern) not in state:
        state["pattern", pattern] = regex.compile(pattern)
    return state["pattern", pattern]


def _speller(path: str, pattern: str) -> Speller:
    state = worker_state()
    if ("bpe", path, pattern) not in state:
        merger = Merger(load_ranks(path))
        state["bpe", path, pattern] = Speller(_pattern(pattern).findall, lambda p: array("I", merger.ids(p.encode("utf-8", "surrogatepass"))).tobytes(), 4, entries=120_000)
    return state["bpe", path, pattern]


def boundaries(text: str, find) -> list[int]:
    return [m.end() for m in find(text)]


def stitch(chunks, size: int, length: int) -> list[tuple[int, int]]:
    """Segments (start, end) of a text from its chunks' (start, head, tail) boundaries, by start.

    head: boundaries in the chunk's first part, which its left neighbour also covers; tail: those in the part that
    the right neighbour covers.  All are positions in the text; only sure ones are listed.
    """
    cuts, ok = [0], True
    for (_, _, tail), (_, head, _) in zip(chunks, chunks[1:]):
        shared = set(tail) & set(head)
        ok = ok and bool(shared)
        if not ok:
            break
        cuts.append(min(shared))
    return [(a, b) for a, b in zip(cuts, [*cuts[1:], length])]


def segments(df: DataFrame, pattern: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """row, doc_id, seg, n_segs, text: every text cut at true pre-token boundaries."""
    docs = slim_texts(df.withColumn("row", F.monotonically_increasing_id()), "row", "doc_id")
    short = docs.where(F.length("text") <= size).select("row", "doc_id", F.lit(0).alias("seg"), F.lit(1).alias("n_segs"), "text")

    def cut(rows):
        for row, doc_id, text in rows:
            for k, at in enumerate(range(0, len(text), size)):
                yield row, doc_id, k, len(text), text[at:at + size + overlap]

    def pretokenise(rows):
        find = _pattern(pattern).finditer
        for row, doc_id, k, length, text in rows:
            at, whole = k * size, k * size + len(text) >= length
            ends = [at + e for e in boundaries(text, find) if whole or e <= len(text) - AHEAD]
            yield row, doc_id, k, length, [e for e in ends if e < at + overlap], [e for e in ends if e >= at + size], text

    chunks = map_rows(docs.where(F.length("text") > size), cut, "row long, doc_id long, chunk int, length long, text string")
    heads = map_rows(chunks.repartition("row", "chunk"), pretokenise, "row long, doc_id long, chunk int, length long, head array<long>, tail array<long>, text string")

    def join(pdf):
        import pandas as pd
        pdf = pdf.sort_values("chunk")
        length = int(pdf["length"].iloc[0])
        at = [(k * size, list(h), list(t)) for k, h, t in zip(pdf["chunk"], pdf["head"], pdf["tail"])]
        cuts = stitch(at, size, length)
        texts = [t[:size] for t in pdf["text"]]
        out = []
        for k, (a, b) in enumerate(cuts):
            first, last = a // size, max(a, b - 1) // size
            part = "".join(texts[first:last + 1])
            out.append((pdf["row"].iloc[0], pdf["doc_id"].iloc[0], k, len(cuts), part[a - first * size:b - first * size]))
        got = pd.DataFrame(out, columns=["row", "doc_id", "seg", "n_segs", "text"])
        got["doc_id"] = got["doc_id"].astype("Int64")
        return got

    # a text is one row of the input, so its chunks fit where the row did
    long = heads.groupBy("row").applyInPandas(join, "row long, doc_id long, seg int, n_segs int, text string")
    return short, long


def encode(df: DataFrame, path: str | None = None, pattern: str | None = None, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids: the ids of every whole text, little-endian unsigned 32-bit, no special tokens.

    Null and empty texts have no ids (empty, not null); repeated rows give repeated rows.  Texts of one
    chunk take one narrow pass; only longer ones are shuffled, by chunk, by text and by segment.
    """
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")
    short, long = segments(df, pattern, size, overlap)

    def run(rows):
        speller = _speller(path, pattern)
        for some in batches(rows, most=4_000_000):
            for (row, doc_id, seg, _), ids in zip(some, speller.many([r[3] for r in some])):
                yield row, doc_id, seg, ids

    schema = "row long, doc_id long, seg int, ids binary"
    one = map_rows(short.select("row", "doc_id", "seg", "text"), run, schema).select("doc_id", "ids")
    many = map_rows(long.repartition("row", "seg").select("row", "doc_id", "seg", "text"), run, schema)

    def concat(pdf):
        import pandas as pd
        pdf = pdf.sort_values("seg")
        return pd.DataFrame({"doc_id": pdf["doc_id"].iloc[:1].astype("Int64"), "ids": [b"".join(pdf["ids"])]})

    return one.unionByName(many.groupBy("row").applyInPandas(concat, "doc_id long, ids binary"))


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows with ``bytes``: the concatenated bytes of their ids."""
    path = path or tokenizer_path("byte_bpe_50k.tiktoken")

    def run(rows):
        import numpy as np
        state = worker_state()
        if ("bytes", path) not in state:
            state["bytes", path] = {i: b for b, i in load_ranks(path).items()}
        token = state["bytes", path].__getitem__
        for doc_id, ids in rows:
            yield doc_id, ids, b"".join(map(token, np.frombuffer(ids or b"", "<u4").tolist()))

    return map_rows(df.select("doc_id", "ids"), run, "doc_id long, ids binary, bytes binary")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decode(encode(table(spark, sf_dir, "documents")))
    return got.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
