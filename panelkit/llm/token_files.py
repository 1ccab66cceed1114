"""Operator 7, token-id output: documents compressed one by one with a shared zstandard dictionary.

Documents are range-partitioned by doc_id, encoded, serialized and compressed
separately, so one short document can be read without its neighbours.  A block
of the format is one binary value:

    magic, version, id width, documents, sha256 of the dictionary   header
    one zstandard frame per document                                frames
    doc_id, null flag, offset, frame bytes, ids  per document       index
    index offset, magic                                             trailer

Blocks are rows of a table in the shared folder, written by Spark's own writer
(so on any store), beside a table with the dictionary under its hash.
"""

from __future__ import annotations

import hashlib
import struct

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.bpe import WordTable, batches, spaced
from panelkit.llm.common import map_rows, slim_texts, table, tokenizer_path, worker_state, written

MAGIC = b"IDZ1"
HEAD, ENTRY, TAIL = "<4sBBI32s", "<qBQII", "<Q4s"  # layouts of the header, an index entry and the trailer
BLOCK_BYTES = 2_000_000
SAMPLES = 1_500  # documents that the dictionary is trained on, as expected by the sampling rate
SAMPLE_BYTES = 16_384  # ids of a training document beyond these bytes are left out of the training only
DICTIONARY_BYTES = 65_536


def load_tokenizer(path: str, plain_specials: bool = False):
    """The library's tokenizer; plain_specials: the strings of special tokens are ordinary text."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = plain_specials
    return t


def byte_alphabet() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: printable Latin-1 as itself, the rest from 256 on."""
    out, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 255 and b != 173:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Library:
    """Whole texts, and pre-tokens one by one, by the library."""

    def __init__(self, path: str, width: int, plain_specials: bool = False):
        self.tokenizer, self.kind = load_tokenizer(path, plain_specials), f"<u{width}"
        self.special = [] if plain_specials else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = WordTable(self._pieces, width)

    def whole(self, text: str) -> bytes:
        import numpy as np
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def each(self, texts: list[str]):
        """(ids of all, ids per text) of whole texts."""
        import numpy as np
        ids = [np.frombuffer(self.whole(t), self.kind) for t in texts]
        return np.concatenate([np.zeros(0, self.kind), *ids]), np.array([len(i) for i in ids], np.int64)

    def ordinary(self, text: str) -> bool:
        """Whether the text holds none of the strings that the library looks for in whole texts."""
        return not any(s in text for s in self.special)

    def _pieces(self, pieces: list[str]):
        """(ids of all, ids per piece) of pre-tokens; an empty one has none."""
        import numpy as np
        model, alphabet = self.tokenizer.model.tokenize, byte_alphabet()
        ids = [[] if p == "" else [t.id for t in model(p.encode().decode("latin-1").translate(alphabet))] for p in pieces]
        return np.fromiter((i for x in ids for i in x), self.kind), np.fromiter(map(len, ids), np.int64, len(ids))


    def after_spaces(self, words: list[str]):
        """(ids of all, ids per word) of words after a space, for the byte-level pattern: found in one text, in which
        each pre-token that begins with a space begins a word."""
        import numpy as np
        import public_tokenizers
        import regex
        found = regex.findall(public_tokenizers.PATTERN, " " + " ".join(words))  # the module keeps compiled patterns
        word = np.cumsum(np.fromiter((p[0] == " " for p in found), bool, len(found))) - 1
        if word[-1] != len(words) - 1:
            raise ValueError("words that the pattern does not part at spaces")
        ids, count = self.pieces.flat(found)
        return ids, np.bincount(word, count, len(words)).astype(np.int64)


def _encode(path: str, width: int):
    """A function from whole texts to their serialized ids by the library; its memory lives as long as the worker.

    In texts with plain spaces, each word with the space before it is encoded once and remembered; texts with other
    white space or with a special token's string go to the library whole.
    """
    state = worker_state()
    if ("byte level", path, width) not in state:
        library = Library(path, width)
        after, first = WordTable(library.after_spaces, width), WordTable(library.each, width)

        def many(texts):
            plain = [spaced(t) and library.ordinary(t) for t in texts]
            some = [t for t, p in zip(texts, plain) if p]
            heads, rests = first.spell([t.split(" ", 1)[0] for t in some]), after.spell(some, skip_first=True)
            known = iter(map(bytes.__add__, heads, rests))
            return [next(known) if p else library.whole(t) for t, p in zip(texts, plain)]

        state["byte level", path, width] = many
    return state["byte level", path, width]


def id_width(path: str) -> int:
    """Bytes of a stored id: 2 where the vocabulary allows it."""
    state = worker_state()
    if ("width", path) not in state:
        state["width", path] = 2 if load_tokenizer(path).get_vocab_size() <= 65_536 else 4
    return state["width", path]


def train(df: DataFrame, path: str, width: int, end_id: int) -> bytes:
    """The dictionary, from a hash sample of about SAMPLES documents (fewer if there are fewer).

    Too small a sample to train on gives a dictionary of the samples themselves, maybe an empty one.
    """
    import zstandard
    n = df.count()
    rate = min(1.0, SAMPLES / max(n, 1))
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_000_000)) < int(rate * 1_000_000_000)
    docs = slim_texts(df.where(drawn), "doc_id")

    def run(rows):
        encode = _encode(path, width)
        for some in batches(rows):
            for (doc_id, _), ids in zip(some, encode([t for _, t in some])):
                yield doc_id, (ids + end_id.to_bytes(width, "little"))[:SAMPLE_BYTES]

    samples = [bytes(r[1]) for r in sorted(map_rows(docs, run, "doc_id long, ids binary").collect(), key=lambda r: (r[0] is not None, r[0] or 0, bytes(r[1])))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def pack_block(docs: list[tuple], width: int, digest: bytes) -> bytes:
    """docs: (doc_id, number of ids, frame) in order."""
    out, index = [struct.pack(HEAD, MAGIC, 1, width, len(docs), digest)], []
    at = struct.calcsize(HEAD)
    for doc_id, n, frame in docs:
        index.append(struct.pack(ENTRY, doc_id or 0, doc_id is None, at, len(frame), n))
        out.append(frame)
        at += len(frame)
    return b"".join([*out, *index, struct.pack(TAIL, at, MAGIC)])


def block_index(block: bytes) -> tuple[int, bytes, list[tuple]]:
    """(id width, dictionary hash, [(doc_id or None, offset, frame bytes, ids)]) of a block."""
    magic, version, width, n, digest = struct.unpack_from(HEAD, block)
    at, last = struct.unpack_from(TAIL, block, len(block) - struct.calcsize(TAIL))
    if magic != MAGIC or last != MAGIC or version != 1:
        raise ValueError("not a block of this format")
    index = [struct.unpack_from(ENTRY, block, at + i * struct.calcsize(ENTRY)) for i in range(n)]
    return width, digest, [(None if null else d, o, size, k) for d, null, o, size, k in index]


def write_tokens(df: DataFrame, path: str | None = None, end_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """(blocks, dictionary), both written.  blocks: part, block, first_doc, last_doc, n_docs, n_tokens, payload.

    Ascending doc_id over (part, block), null first; ties by a row number, so that one doc_id with very many rows
    spreads over parts.  Null and empty texts hold the end id alone.  An empty table gives no blocks.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    width = id_width(path)
    raw = train(df, path, width, end_id)
    digest = hashlib.sha256(raw).digest()
    dictionary = df.sparkSession.createDataFrame([(digest.hex(), bytearray(raw))], "hash string, dictionary binary")
    spread = slim_texts(df.withColumn("tie", F.monotonically_increasing_id()), "doc_id", "tie")
    ordered = spread.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").withColumn("part", F.spark_partition_id())

    def run(rows):
        import zstandard
        encode = _encode(path, width)
        shared = zstandard.ZstdCompressionDict(raw) if raw else None
        if shared:
            shared.precompute_compress(level=1)
        press = zstandard.ZstdCompressor(level=1, dict_data=shared, write_checksum=False)
        end = end_id.to_bytes(width, "little")
        held, size, block, part = [], 0, 0, 0

        def done():
            return part, block, held[0][0], held[-1][0], len(held), sum(n for _, n, _ in held), pack_block(held, width, digest)

        for some in batches(rows):
            for (part, doc_id, _), ids in zip(some, encode([r[2] for r in some])):
                frame = press.compress(ids + end)
                held.append((doc_id, len(ids) // width + 1, frame))
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield done()
                    held, size, block = [], 0, block + 1
        if held:
            yield done()

    blocks = map_rows(ordered.select("part", "doc_id", "text"), run, "part int, block int, first_doc long, last_doc long, n_docs long, n_tokens long, payload binary")
    return written(blocks, "token-blocks", compression="uncompressed"), written(dictionary, "token-dictionary")


def read_tokens(blocks: DataFrame, dictionary: DataFrame) -> DataFrame:
    """part, block, slot, doc_id, start_in_block, ids (little-endian unsigned 32-bit) of each document in the blocks."""
    dictionaries = {r["hash"]: bytes(r["dictionary"]) for r in dictionary.collect()}  # one row a run of the writer

    def run(rows):
        import numpy as np
        import zstandard
        opened = {}
        for part, block, payload in rows:
            width, digest, index = block_index(payload)
            if digest not in opened:
                raw = dictionaries[digest.hex()]
                opened[digest] = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
            at = 0
            for slot, (doc_id, offset, size, n) in enumerate(index):
                ids = np.frombuffer(opened[digest].decompress(payload[offset:offset + size]), f"<u{width}")
                yield part, block, slot, doc_id, at, ids.astype("<u4").tobytes()
                at += n

    return map_rows(blocks.select("part", "block", "payload"), run, "part int, block int, slot int, doc_id long, start_in_block long, ids binary")


def lookup(blocks: DataFrame, dictionary: DataFrame, doc_id: int) -> DataFrame:
    """One document's rows: the table's statistics skip other blocks, the index other frames."""
    near = blocks.where((F.col("first_doc").isNull() | (F.col("first_doc") <= doc_id)) & (F.col("last_doc") >= doc_id))
    return read_tokens(near, dictionary).where(F.col("doc_id") == doc_id)


def block_starts(blocks: DataFrame) -> DataFrame:
    """part, block, block_start: ids in all blocks before it.

    Prefix sums in two steps: totals per part (one row per task of the writer) in one order, blocks within their part.
    """
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = parts.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.select("part", "block", inside.alias("inside")).join(before, "part").select("part", "block", (F.col("part_start") + F.col("inside")).alias("block_start"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, dictionary = write_tokens(table(spark, sf_dir, "documents"))
    read = read_tokens(blocks, dictionary).select("part", "block", "doc_id", "start_in_block", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return read.join(block_starts(blocks), ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32")
