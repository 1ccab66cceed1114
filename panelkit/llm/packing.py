"""Operator 8, packing: concatenate and cut.

First pass: every partition encodes its documents, numbers its tokens from 0
and is written.  The partitions' totals (one number each) give by prefix sums
where each partition starts in the concatenation.  Second pass: fixed windows
of the concatenation are cut; a document that crosses a window's edge, or a
window that crosses a partition's, yields one piece on either side, which
carry the window and the place in it.  Only the last window has padding.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.bpe import WordTable, batches
from panelkit.llm.common import map_rows, slim_texts, table, tokenizer_path, worker_state, written
from panelkit.llm.token_files import Library, id_width

WINDOW = 2_048


#: Words whose normal form is their lower case, which Python and the library agree on: Latin letters without marks.
PLAIN = r"[!-~\u00a1-\u012f\u0131-\u017e]+"
#: Fixed value: the vocabulary's pre-tokens.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n"  # and, here, line ends, which part words


def _encode(path: str, width: int):
    """A function from whole texts to their serialized ids by the library.

    The vocabulary's pattern drops white space and never reaches across it, so words are encoded once and
    remembered; texts with unprintable characters, where notions of white space differ, and those with a special
    token's string go to the library whole.
    """
    state = worker_state()
    if ("word ends", path, width) not in state:
        import re

        import numpy as np
        import regex
        library, find = Library(path, width), regex.compile(PIECES).findall
        plain_word, all_plain = re.compile(PLAIN).fullmatch, re.compile(f"(?:{PLAIN}|\n)+").fullmatch

        def simple(words):
            found = find("\n".join(words).lower())
            ends = np.fromiter((p == "\n" for p in found), bool, len(found))
            ids, count = library.pieces.flat(["" if e else p for p, e in zip(found, ends.tolist())])
            return ids, np.bincount(np.cumsum(ends), count, len(words)).astype(np.int64)

        def words(new):
            if all_plain("\n".join(new)) and "" not in new:
                return simple(new)
            is_plain = np.array([plain_word(w) is not None for w in new])
            some, rest = [w for w, p in zip(new, is_plain) if p], [w for w, p in zip(new, is_plain) if not p]
            parts = simple(some) if some else library.each([]), library.each(rest)
            count = np.empty(len(new), np.int64)
            count[is_plain], count[~is_plain] = parts[0][1], parts[1][1]
            ids, owner = np.empty(count.sum(), library.kind), np.repeat(is_plain, count)
            ids[owner], ids[~owner] = parts[0][0], parts[1][0]
            return ids, count

        known_words = WordTable(words, width)

        def many(texts):
            lines = [t.replace("\n", " ") for t in texts]
            plain = [t.isprintable() and library.ordinary(t) for t in lines]
            known = iter(known_words.spell([t for t, p in zip(lines, plain) if p]))
            return [next(known) if p else library.whole(t) for t, p in zip(texts, plain)]

        state["word ends", path, width] = many
    return state["word ends", path, width]


def tokens(df: DataFrame, path: str | None = None, end_id: int = 1) -> DataFrame:
    """part, place, doc_id, n, ids: written; place counts the partition's ids before the document.

    Null and empty texts hold the end id alone.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    width = id_width(path)
    kind = f"<u{width}"

    def run(rows):
        encode, at = _encode(path, width), 0
        end = end_id.to_bytes(width, "little")
        for some in batches(rows):
            for (part, doc_id, _), ids in zip(some, encode([r[2] for r in some])):
                n = len(ids) // width + 1
                yield part, at, doc_id, n, ids + end
                at += n

    docs = slim_texts(df, "doc_id").select(F.spark_partition_id().alias("part"), "doc_id", "text")
    return written(map_rows(docs, run, "part int, place long, doc_id long, n long, ids binary"), "packing-ids", compression="zstd"), kind


def pack(df: DataFrame, window: int = WINDOW, path: str | None = None, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    Repeated rows are packed each; an empty table gives no pieces.  The driver holds one total per partition.
    """
    got, kind = tokens(df, path, end_id)
    totals = dict(got.groupBy("part").agg(F.sum("n").alias("n")).collect())
    order = sorted(totals)
    begins = dict(zip(order, accumulate((totals[p] for p in order), initial=0)))

    def run(rows):
        import numpy as np
        for part, place, doc_id, n, ids in rows:
            at = begins[part] + place
            ids = np.frombuffer(ids, kind).astype("<u4").tobytes()
            start = 0
            while start < n:
                offset = (at + start) % window
                length = min(window - offset, n - start)
                yield doc_id, start, length, n, (at + start) // window, offset, ids[4 * start:4 * (start + length)]
                start += length

    return map_rows(got, run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the pieces of each window joined (a window bounds the group)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
