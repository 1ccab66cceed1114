"""Operator 9, secret scans: a recursive decoding worklist.

A text is layer 0.  Each layer is searched for secrets, and for stretches that
decode to text: percent escapes, unicode escapes, base64, and base64 of gzip
or zlib data.  A decoded stretch becomes a new layer unless the worklist has
had that content (cycle detection), until nothing new turns up.  Every layer
keeps, for each of its characters, the stretch of the original text that it
came from, so a finding deep down is reported as a span of the text itself.
"""

from __future__ import annotations

import binascii
import hashlib
import itertools
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import map_rows, slim_texts, table

KINDS = ("assign", "access", "hex")


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The base patterns.  Either case is spelled out, as case folding would add letters outside ASCII.
ASSIGN = re.compile("(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key") + ")"
                    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # the same spans: a run of the class is matched whole or not at all
#: Stretches that may decode.  Lines of base64 are one stretch; what else stands before or after it is decoded along with it.
PERCENT_ESCAPE = re.compile(r"%([0-9A-Fa-f]{2})")
UNICODE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U00((?:0[0-9A-Fa-f]|10)[0-9A-Fa-f]{4})|\\u\{0*((?:10|[0-9A-Fa-f])?[0-9A-Fa-f]{1,4})\}")
_C, _LINE = "[A-Za-z0-9+/_-]", r"[ \t]*\r?\n[ \t]*"
BASE64 = re.compile(f"(?<!{_C})(?:{_C}{{1,15}}{_LINE})?{_C}{{16,}}(?:{_LINE}{_C}{{16,}})*(?:={{1,2}}|{_LINE}{_C}{{1,15}}={{0,2}})?")
BASE64_LINE = re.compile(f"{_C}+={{0,2}}")
URL_SAFE = bytes.maketrans(b"-_", b"+/")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then kind: the spans of the three base patterns."""
    found = []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def _unescaped(text: str, escape) -> tuple | None:
    """The text with its escapes decoded and, for each character, its start and end in ``text``; None if it has none.

    A percent escape is one character, also if it is one byte of several: all patterns are ASCII.
    """
    import numpy as np
    chars, starts, ends, at = [], [], [], 0
    for m in escape.finditer(text):
        chars += [text[at:m.start()], chr(int(m[m.lastindex], 16))]
        plain = np.arange(at, m.start())
        starts += [plain, [m.start()]]
        ends += [plain + 1, [m.end()]]
        at = m.end()
    if not at:
        return None
    plain = np.arange(at, len(text))
    return "".join([*chars, text[at:]]), (np.concatenate([*starts, plain]).astype(int), np.concatenate([*ends, plain + 1]).astype(int))


WINDOW = 64_000_000  # bytes of inflated data that are one layer; more of it is searched in windows that overlap
OVERLAP = 4_000_000
STEP = 1 << 20  # bytes inflated at once


def _is_packed(raw: bytes) -> bool:
    return raw[:2] == b"\x1f\x8b" or len(raw) > 1 and raw[0] & 15 == 8 and raw[0] >> 4 < 8 and (raw[0] * 256 + raw[1]) % 31 == 0


def _inflated(chunks, left: list):
    """The data inside gzip or zlib streams that follow one another, in parts; what a damaged or cut one gave counts.

    ``left`` gets the bytes of the last chunk that follow the streams, if they end whole.
    """
    data, d = b"", None
    for chunk in chunks:
        data += chunk
        while data:
            if d is None:
                if not _is_packed(data):
                    left[:] = [len(data)]
                    return
                d = zlib.decompressobj(47)
            while True:
                try:
                    out = d.decompress(data, STEP)
                except zlib.error:
                    return
                data = d.unconsumed_tail
                if out:
                    yield out
                if d.eof or len(out) < STEP:
                    break
            if d.eof:
                data, d = d.unused_data.lstrip(b"\0"), None
    if d is None:
        left[:] = [len(data)]


def _windows(chunks, seen: frozenset = frozenset()):
    """Texts of WINDOW bytes, each with the last OVERLAP of the one before; streams inside the stream are inflated too."""
    first = next(chunks, None)
    if first is None:
        return
    mark = hashlib.blake2b(first).digest()
    whole = itertools.chain([first], chunks)
    if _is_packed(first) and mark not in seen:  # else it may be a stream that holds itself
        yield from _windows(_inflated(whole, []), seen | {mark})
    else:
        yield from _cut(whole)


def _cut(chunks):
    held = bytearray()
    new = False
    for chunk in chunks:
        held += chunk
        new = True
        if len(held) >= WINDOW:
            yield held.decode("latin-1")
            del held[:-OVERLAP]
            new = False
    if new:
        yield held.decode("latin-1")


def _decoded(text: str, m):
    """(texts, map) of a base64 stretch, at each of its four alignments: the bytes, and what is inflated from any place in them.

    Bytes are read as one character each, so that no byte hides what is beside it.  A finding's span is that of the lines it comes from.
    """
    import numpy as np
    lines = [x.span() for x in BASE64_LINE.finditer(text, m.start(), m.end())]
    bodies = [text[a:b].rstrip("=") for a, b in lines]
    body = "".join(bodies).encode().translate(URL_SAFE)
    line = np.repeat(np.arange(len(lines)), [len(x) for x in bodies])  # of each character
    starts, ends = np.array([a for a, _ in lines]), np.array([b for _, b in lines])
    for k in range(4):
        part = body[k:]
        part = part[:-1] if len(part) % 4 == 1 else part
        raw = binascii.a2b_base64(part + b"=" * (-len(part) % 4))
        if not raw:
            continue
        of = np.arange(len(raw)) * 4 // 3 + k
        lo, hi = line[of], line[np.minimum(of + 1, len(line) - 1)]
        yield iter([raw.decode("latin-1")]), (starts[lo], ends[hi])
        at = 0
        for head in PACKED.finditer(raw):
            if head.start() < at or not _is_packed(raw[head.start():head.start() + 2]):
                continue
            left = []
            chunks = _inflated(iter([raw[head.start():]]), left)
            for text_ in _windows(chunks):
                end = len(raw) - left[0] if left else len(raw)
                yield iter([text_]), (int(starts[lo[head.start()]]), int(ends[hi[end - 1]]))
            if left:
                at = len(raw) - left[0]


PACKED = re.compile(rb"\x1f\x8b|[\x08\x18\x28\x38\x48\x58\x68\x78]")


def layers(text: str):
    """(decoded text, map) of the whole text without its percent or unicode escapes, and of each stretch of base64.

    The map: per decoded character its start and its end in ``text``, as two arrays, or one start and end for all.
    """
    for sign, escape in (("%", PERCENT_ESCAPE), ("\\", UNICODE_ESCAPE)):
        if sign in text and (got := _unescaped(text, escape)):
            yield got
    for m in BASE64.finditer(text):
        for texts, to in _decoded(text, m):
            for x in texts:
                yield x, to


def _mapped(to, a, b):
    """Where the characters a to b of a layer come from; a and b may be arrays."""
    if to is None:
        return a, b
    return (to[0][a], to[1][b - 1]) if hasattr(to[0], "__len__") else to


def scan(text: str) -> list[tuple[int, str, int]]:
    """All (start, kind, end) in ``text``, base spans and those of decoded layers, each once, by start, kind, end."""
    found = set(base_spans(text))
    seen, work = set(), [(text, None)]  # a content counts as seen at its place only: the same secret elsewhere is another one
    while work:
        layer, at = work.pop()
        for inner, own in layers(layer):
            if not inner:
                continue
            to = at if at is not None and not hasattr(at[0], "__len__") else _mapped(at, *own)
            first, last = _mapped(to, 0, len(inner))
            mark = (hashlib.blake2b(inner.encode("utf-8", "surrogatepass")).digest(), int(first), int(last))
            if mark in seen:
                continue
            seen.add(mark)
            for a, kind, b in base_spans(inner):
                x, y = _mapped(to, a, b)
                found.add((int(x), kind, int(y)))
            if SIGNS.search(inner):
                work.append((inner, to))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


#: Without any of these, a layer holds nothing that decodes.
SIGNS = re.compile(f"%|\\\\|{_C}{{16}}")


def find_secrets(df: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end) over code points, end exclusive.

    One narrow pass over whole texts, no shuffle.  Null and empty texts have no spans;
    repeated rows give repeated rows.
    """
    def run(rows):
        for doc_id, text in rows:
            yield doc_id, [dict(zip(("start", "kind", "end"), x)) for x in base_spans(text)], [dict(zip(("start", "kind", "end"), x)) for x in scan(text)]

    one = "array<struct<start:long,kind:string,end:long>>"
    return map_rows(slim_texts(df, "doc_id"), run, f"doc_id long, base {one}, spans {one}")


def redact(df: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows with each union of overlapping spans replaced by ``mark``; all other columns stay, n_chars follows the text.

    A null text stays null.
    """
    @F.pandas_udf("string")
    def cut(texts):
        import pandas as pd

        def one(text):
            spans = scan(text) if text else []
            if not spans:
                return text
            out, at, end = [], 0, -1
            for a, _, b in spans:
                if a > end:  # a new stretch
                    out += [text[max(at, 0):a], mark]
                end = max(end, b)
                at = end
            return "".join(out) + text[at:]

        return pd.Series([one(t) for t in texts], dtype=object)

    out = df.withColumn("text", cut("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in df.columns else out


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    got = find_secrets(table(spark, sf_dir, "documents"))
    return got.select("doc_id", *map(count, KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
