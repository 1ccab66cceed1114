"""Operators 1, 7 and 8 against the libraries on whole texts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import odd
from panelkit.llm import bpe, byte_bpe, packing, token_files
from panelkit.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def tiktoken_ids():
    import public_tokenizers as P
    import tiktoken
    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda t: enc.encode_ordinary(t or "")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    def load(name):
        t = Tokenizer.from_file(tokenizer_path(name))
        return lambda s: t.encode(s or "", add_special_tokens=False).ids
    return load


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_merge_is_tiktokens(tiktoken_ids):
    merger = bpe.Merger(bpe.load_ranks(tokenizer_path("byte_bpe_50k.tiktoken")))
    for piece in (" hello", "antidisestablishment", "é", "aaaaaaaaaaaaaaaaaaaa", " " + "ab" * 500, "zqxjkvzqxjkv", "!!!!!!!!!!!!!!!"):
        assert merger.ids(piece.encode()) == merger._long(piece.encode()) == tiktoken_ids(piece), piece


@pytest.mark.parametrize("size,overlap", [(32_768, 1_024), (64, 24), (40, 30)])
def test_encode_equals_tiktoken(spark, tiktoken_ids, size, overlap):
    got = Counter((r["doc_id"], bytes(r["ids"])) for r in byte_bpe.encode(odd.docs(spark), size=size, overlap=overlap).collect())
    assert got == Counter((r[0], u32(tiktoken_ids(r[1]))) for r in odd.rows())


def test_decode_is_the_text(spark):
    got = Counter((r["doc_id"], bytes(r["bytes"])) for r in byte_bpe.decode(byte_bpe.encode(odd.docs(spark))).collect())
    assert got == Counter((r[0], (r[1] or "").encode()) for r in odd.rows())
    assert byte_bpe.decode(byte_bpe.encode(odd.empty(spark))).count() == 0


def test_stitch_falls_back_to_one_segment():
    find = __import__("regex").compile(" ?[a-z]+").finditer
    text = "ab " * 10 + "x" * 200 + " cd" * 10
    size, overlap = 32, 16
    chunks = []
    for at in range(0, len(text), size):
        part = text[at:at + size + overlap]
        ends = [at + e for e in byte_bpe.boundaries(part, find) if at + len(part) >= len(text) or e <= len(part) - byte_bpe.AHEAD]
        chunks.append((at, [e for e in ends if e < at + overlap], [e for e in ends if e >= at + size]))
    cuts = byte_bpe.stitch(chunks, size, len(text))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert [x for a, b in cuts for x in [m.group() for m in find(text[a:b])]] == [m.group() for m in find(text)]


def test_every_whitespace_and_letter_class_agrees(tiktoken_ids, library):
    """The memory's cut at spaces and the pattern's classes, over code points of every category."""
    merger = bpe.Merger(bpe.load_ranks(tokenizer_path("byte_bpe_50k.tiktoken")))
    import public_tokenizers as P
    import regex
    find = regex.compile(P.PATTERN).findall
    lib = library("byte_bpe_50k.json")
    text = "".join(f"a{chr(c)}1 {chr(c)} " for c in [*range(1, 0x600), *range(0x2000, 0x2100), *range(0x3000, 0x3050)])
    want = tiktoken_ids(text)
    assert [i for p in find(text) for i in merger.ids(p.encode())] == want == lib(text)
    assert not any(map(bpe.spaced, ("a  b", "a\u00a0b", "a \nb", "a\n b", "a\tb"))) and bpe.spaced(" a b\nc ")


def test_token_files_round_trip(spark, library, monkeypatch):
    encode = library("byte_bpe_50k.json")
    blocks, dictionary = token_files.write_tokens(odd.docs(spark))
    rows = token_files.read_tokens(blocks, dictionary).join(token_files.block_starts(blocks), ["part", "block"]).collect()
    got = Counter((r["doc_id"], bytes(r["ids"])) for r in rows)
    assert got == Counter((r[0], u32([*encode(r[1]), 0])) for r in odd.rows())
    rows.sort(key=lambda r: r["block_start"] + r["start_in_block"])
    at = 0
    for r in rows:
        assert r["block_start"] + r["start_in_block"] == at
        at += len(r["ids"]) // 4
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [bytes(r["ids"]) for r in token_files.lookup(blocks, dictionary, 103).collect()] == [u32([*encode(odd.rows()[3][1]), 0])]
    assert dictionary.count() == 1 and {token_files.block_index(bytes(r["payload"]))[1].hex() for r in blocks.collect()} == {dictionary.first()["hash"]}


def test_token_files_of_nothing(spark):
    blocks, dictionary = token_files.write_tokens(odd.empty(spark))
    assert blocks.count() == 0 and token_files.read_tokens(blocks, dictionary).count() == 0 and token_files.block_starts(blocks).count() == 0


def test_op7_query_against_library(spark, sf, library):
    import duckdb
    encode = library("byte_bpe_50k.json")
    at, want = 0, set()
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall():
        ids = [*encode(t), 0]
        want.add((i, at, len(ids), zlib.crc32(u32(ids))))
        at += len(ids)
    assert {tuple(r) for r in token_files.op7_token_files(spark, sf).collect()} == want


def test_op1_query_against_tiktoken(spark, sf, tiktoken_ids):
    import duckdb
    want = {(i, len(x := tiktoken_ids(t)), hashlib.sha256(u32(x)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()}
    assert {tuple(r) for r in byte_bpe.op1_byte_bpe(spark, sf).collect()} == want


def check_pieces(pieces, want, window):
    """Every id once, in place; windows full but the last one, gapless."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4 and 0 < p["length"] <= window
        by_doc[p["doc_id"]].append(p)
        by_window[p["sequence_id"]].append((p["offset"], p["length"]))
    texts = Counter()
    for d, ps in by_doc.items():
        whole, left = [], sorted(ps, key=lambda p: (p["sequence_id"], p["offset"]))
        for p in left:  # repeated rows follow one another
            if p["start"] == 0:
                whole.append(b"")
            assert p["start"] == len(whole[-1]) // 4
            whole[-1] += bytes(p["ids"])
            assert p["doc_tokens"] * 4 >= len(whole[-1])
        texts.update((d, w) for w in whole)
    assert texts == Counter((d, u32(ids)) for d, ids in want)
    total = sum(len(ids) for _, ids in want)
    assert sorted(by_window) == list(range(-(-total // window)))
    for k, spans in by_window.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == min(window, total - k * window)


def test_packing(spark, library):
    encode = library("word_bpe_49k.json")
    want = [(r[0], [*encode(r[1]), 1]) for r in odd.rows()]
    for window in (2_048, 64):
        pieces = packing.pack(odd.docs(spark), window=window)
        check_pieces(pieces.collect(), want, window)
    seqs = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(pieces).collect()}
    by = sorted(pieces.collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    assert b"".join(seqs[k] for k in sorted(seqs)) == b"".join(bytes(p["ids"]) for p in by)
    assert packing.pack(odd.empty(spark)).count() == 0


def test_op8_query_against_library(spark, sf, library):
    import duckdb
    encode = library("word_bpe_49k.json")
    ids = {i: [*encode(t), 1] for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()}
    rows = packing.op8_packing(spark, sf).collect()
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(u32(part)), len(ids[r["doc_id"]]))
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))


def test_piecewise_encoding_is_the_librarys(library):
    """Every code point of the ranges that words are remembered for, and others, alone and inside words; special strings."""
    bytes_, words = token_files._encode(tokenizer_path("byte_bpe_50k.json"), 4), packing._encode(tokenizer_path("word_bpe_49k.json"), 4)
    lib_bytes, lib_words = library("byte_bpe_50k.json"), library("word_bpe_49k.json")
    for c in [*range(1, 0x260), *range(0x300, 0x310), *range(0x390, 0x3D0), 0x1E9E, 0x2028, 0x3000, 0xFB01, 0x1F600]:
        for text in (chr(c), f"Ab{chr(c)}cD, x{chr(c)}{chr(c)} {chr(c)}1a", f"{chr(c)} {chr(c).upper()}'s 12 {chr(c)}"):
            assert bytes_([text, text]) == [u32(lib_bytes(text))] * 2, hex(c)
            assert words([text, ""]) == [u32(lib_words(text)), b""], hex(c)
    for text in ("a <|endoftext|> b", "<|startoftext|> hi", "x<|endoftext|>y z", "<|endoftext|>", "one two\n<|endoftext|>", "a <|endoftext |> b", "end space ", " start", "l\n", "a b\n\nc d\n"):
        assert bytes_([text, "plain words"]) == [u32(lib_bytes(text)), u32(lib_bytes("plain words"))], text
        assert words([text, "plain words"]) == [u32(lib_words(text)), u32(lib_words("plain words"))], text


def test_word_tables_forget_without_loss(library):
    rng = __import__("random").Random(4)
    lib_bytes, lib_words = library("byte_bpe_50k.json"), library("word_bpe_49k.json")
    texts = [odd.prose(rng, 60) for _ in range(60)]
    from panelkit.llm.common import worker_state
    for name, encode, lib, path in (("byte level", token_files._encode, lib_bytes, "byte_bpe_50k.json"), ("word ends", packing._encode, lib_words, "word_bpe_49k.json")):
        many = encode(tokenizer_path(path), 2)
        for cell in many.__closure__:
            if isinstance(cell.cell_contents, bpe.WordTable):
                cell.cell_contents.most = 2_000
        for at in range(0, 60, 5):
            got = many(texts[at:at + 5] + texts[:2])
            assert got == [np.array(lib(t), "<u2").tobytes() for t in texts[at:at + 5] + texts[:2]]
        del worker_state()[name, tokenizer_path(path), 2]
