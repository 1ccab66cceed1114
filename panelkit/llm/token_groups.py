"""Operator 13, cross-tokenizer alignment by pointer jumping.

A text is encoded by two tokenizers whose tokens both spell its bytes.  Every
token points to the token that overlaps it and reaches farthest to the right
(at a common end: to the second tokenizer's).  All pointers are doubled at
once until none changes; the terminal token that a token then points to labels
its group, the bytes between two offsets where tokens of both sides end.

Tokens end before a space in both vocabularies, so texts are cut into units
there (a text with unusual white space is one unit).  Ids of units are
remembered per worker; the different units of a block are aligned together,
and documents are lists of units.

Links are the pairs of tokens of one group.  Documents are gathered to blocks
of bounded text, in which id pairs are numbered: a block states each pair once,
with the block's documents that hold it.  Only those statements are shuffled,
summed to corpus-wide counts, and looked up again; a block's own table then
turns counts into sums for its units and documents.  So no row per document and
pair is ever made.  A unit with very many links is split by ranges of its first
ids into blocks of its own.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.bpe import WordTable, batches
from panelkit.llm.common import map_rows, slim_texts, table, tokenizer_path, worker_state, written
from panelkit.llm.token_files import Library, byte_alphabet

BLOCK = 4_000_000  # characters of a block
LINKS = 2_000_000  # of a unit; beyond, it is split
TOGETHER = 500  # units that the piece tokenizer gets in one call
SPACE = "▁"  # fixed value: the piece vocabulary's sign for a space


class Side:
    """One tokenizer: ids of units and of texts, with the space before them, and the bytes of tokens."""

    def __init__(self, units, text, spelled: list[bytes]):
        """units: from a list of units to (ids of all, ids per unit); text: from a text to its ids; spelled: the bytes
        of every id."""
        import numpy as np
        self._units, self.text, self.spelled = units, text, spelled
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.opens = np.array([s[:1] == b" " for s in spelled])
        self.known = WordTable(self.units, 4)

    def spells(self, ids, text: str) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids)) == (" " + text).encode("utf-8", "surrogatepass")

    def units(self, units: list[str]):
        """(ids of all, ids per unit), none for a unit that its tokens don't spell."""
        import numpy as np
        ids, count = self._units(units)
        if not self.spells(ids.tolist(), " ".join(units)):
            parts = np.split(ids, np.cumsum(count)[:-1])
            parts = [p if self.spells(p.tolist(), u) else p[:0] for p, u in zip(parts, units)]
            ids, count = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, count


def byte_level(path: str) -> Side:
    library = Library(path, 4, plain_specials=True)
    t, back = library.tokenizer, {c: b for b, c in byte_alphabet().items()}
    spelled = [bytes(back[c] for c in p) if all(c in back for c in p) else p.encode() for p in map(t.id_to_token, range(t.get_vocab_size()))]
    return Side(library.after_spaces, lambda text: t.encode(" " + text, add_special_tokens=False).ids, spelled)


def pieces(path: str) -> Side:
    import numpy as np
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(p.get_piece_size()):
        s = p.id_to_piece(i)
        spelled.append(bytes([int(s[3:5], 16)]) if p.is_byte(i) else s.replace(SPACE, " ").encode())

    def units(some):
        ids = [np.array(p.encode(" ".join(some[at:at + TOGETHER]), num_threads=1), np.int64) for at in range(0, len(some), TOGETHER)]
        ids = np.concatenate(ids)
        return ids, np.bincount(np.cumsum(side.opens[ids]) - 1, minlength=len(some))

    side = Side(units, lambda text: p.encode(text, num_threads=1), spelled)
    return side


def plain(text: str) -> bool:
    """Whether units are what single spaces separate: every token of either side then lies within one of them."""
    return (text != "" and text[0] not in " \n" and text[-1] not in " \n" and SPACE not in text
            and "  " not in text and "\n " not in text and " \n" not in text and text.replace("\n", "").isprintable())


def groups(ends_a, ends_b):
    """The group of each token of both sides: labels that rise along the text.

    ends: byte offsets at which the tokens end, over texts one after the other; both sides end at every text's end.
    """
    import numpy as np
    a, b = len(ends_a), len(ends_b)
    # a token of A points to the token of B that holds its last byte, which reaches at least as far, and one of B to
    # the token of A that holds its last byte, or to itself where that ends with it
    to = np.concatenate([a + np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)])
    same = np.flatnonzero(ends_a[to[a:]] == ends_b) if b else np.zeros(0, np.int64)
    to[a + same] = a + same
    while True:
        farther = to[to]
        if (farther == to).all():
            break
        to = farther
    label = np.zeros(a + b, np.int64)
    label[a + same] = np.arange(len(same))
    label = label[to]
    return label[:a], label[a:]


class Aligned:
    """Some units with their groups, in flat arrays."""

    def __init__(self, first: Side, second: Side, ids_a, unit_a, ids_b, unit_b, units: int):
        import numpy as np
        self.ids = ids_a, ids_b
        self.n = np.bincount(unit_a, minlength=units), np.bincount(unit_b, minlength=units)
        self.group = groups(np.cumsum(first.size[ids_a]), np.cumsum(second.size[ids_b]))
        total = int(self.group[0][-1]) + 1 if len(ids_a) else 0
        self.count = [np.bincount(g, minlength=total) for g in self.group]  # tokens of each group
        owner = np.zeros(total, np.int64)
        owner[self.group[0]] = unit_a
        self.groups = np.bincount(owner, minlength=units)
        self.links = np.bincount(owner, self.count[0] * self.count[1], units).astype(np.int64)

    def spelled(self):
        """(characters, where each unit's end): the units' groups as text, each with a separator behind it."""
        import numpy as np
        (ids_a, ids_b), (ga, gb), (ca, cb) = self.ids, self.group, self.count
        ids, sign = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        ids[np.arange(len(ids_a)) + (np.cumsum(cb) - cb)[ga]] = ids_a
        ids[np.arange(len(ids_b)) + np.cumsum(ca)[gb]] = ids_b
        ends = np.cumsum(ca + cb)
        sign[ends - cb - 1], sign[ends - 1] = ord("|"), ord(";")
        tens = 10 ** np.arange(1, 19)
        size = np.searchsorted(tens, ids, "right") + 2  # digits and a sign
        done = np.cumsum(size)
        text = np.empty(int(done[-1]) if len(done) else 0, np.uint8)
        text[done - 1] = sign
        for k in range(int(size.max(initial=1)) - 1):  # the k-th digit from the right
            has = size > k + 1
            text[done[has] - 2 - k] = ids[has] // 10 ** k % 10 + ord("0")
        return text, np.concatenate([[0], done])[np.cumsum(self.n[0] + self.n[1])]

    def pairs(self):
        """The links as (first id << 32 | second id), by unit."""
        import numpy as np
        (ids_a, ids_b), (ga, _), (_, cb) = self.ids, self.group, self.count
        many = cb[ga]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(ids_a.astype(np.int64) << 32, many) | ids_b[np.repeat((np.cumsum(cb) - cb)[ga], many) + within]

    def slices(self):
        """The links of all units together, each pair once: (pairs, how many) by ranges of first ids.  For large units."""
        import numpy as np
        (ids_a, ids_b), (ga, gb) = self.ids, self.group
        (ka, na), (kb, nb) = (np.unique(g << 32 | i, return_counts=True) for g, i in ((ga, ids_a), (gb, ids_b)))
        begin, many = np.searchsorted(kb >> 32, ka >> 32), np.bincount(kb >> 32)[ka >> 32]
        order = np.argsort(ka & 0xFFFFFFFF, kind="stable")
        begin, many, na, first = begin[order], many[order], na[order], (ka & 0xFFFFFFFF)[order]
        done, at = np.cumsum(many), 0
        while at < len(first):
            to = max(at + 1, int(np.searchsorted(done, done[at] - many[at] + LINKS, "right")))
            to = int(np.searchsorted(first, first[to - 1], "right"))  # all of an id's links are of one range
            m = many[at:to]
            place = np.repeat(begin[at:to], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            pair, back = np.unique(np.repeat(first[at:to] << 32, m) | kb[place] & 0xFFFFFFFF, return_inverse=True)
            yield pair, np.bincount(back, np.repeat(na[at:to], m) * nb[place]).astype(np.int64)
            at = to


class Aligner:
    """Units and texts to aligned units."""

    def __init__(self, first: Side, second: Side):
        self.sides = first, second

    def units(self, units):
        """(units that both sides spell, these aligned) of an Arrow array of different units of plain texts."""
        import numpy as np
        both = [s.known.flat(units) for s in self.sides]
        good = (both[0][1] > 0) & (both[1][1] > 0)
        flat = []
        for ids, count in both:
            flat += [ids[np.repeat(good, count)].astype(np.int64), np.repeat(np.arange(good.sum()), count[good])]
        return good, Aligned(*self.sides, *flat, int(good.sum()))

    def text(self, text: str) -> Aligned | None:
        """One text as one unit; None if it is empty or a side doesn't spell it."""
        import numpy as np
        if not text:
            return None
        flat = []
        for s in self.sides:
            ids = s.text(text)
            if not s.spells(ids, text):
                return None
            flat += [np.array(ids, np.int64), np.zeros(len(ids), np.int64)]
        return Aligned(*self.sides, *flat, 1)


def _aligner(path_a: str, path_b: str) -> Aligner:
    state = worker_state()
    if ("aligner", path_a, path_b) not in state:
        state["aligner", path_a, path_b] = Aligner(byte_level(path_a), pieces(path_b))
    return state["aligner", path_a, path_b]


def _ranges(begin, many):
    """begin, begin + 1 and so on, as many as ``many`` says, for each pair of the two."""
    import numpy as np
    return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())


class Block:
    """Documents as lists of units, units as lists of links, links as numbers of the block's pairs."""

    def __init__(self, links, of_unit, rows, sizes, unit):
        """links: pairs by unit; of_unit: links per unit; rows: the documents; sizes: units of each; unit: these, by document."""
        self.links, self.of_unit, self.rows, self.sizes, self.unit = links, of_unit, rows, sizes, unit

    def packed(self) -> dict:
        import numpy as np
        pair, link = np.unique(self.links, return_inverse=True)
        of_unit, units = self.of_unit, max(1, len(self.of_unit))
        begin = np.cumsum(of_unit) - of_unit
        # a document's different units, then its different pairs
        key = np.sort(np.repeat(np.arange(len(self.sizes)), self.sizes) * units + self.unit)
        unit = key % units
        own = key[np.flatnonzero(np.diff(key, prepend=-1))]
        own, doc_of = own % units, own // units
        held = np.repeat(doc_of, of_unit[own]) * max(1, len(pair)) + link[_ranges(begin[own], of_unit[own])]
        held.sort()
        docs = np.bincount(held[np.flatnonzero(np.diff(held, prepend=-1))] % max(1, len(pair)), minlength=len(pair))
        return self._fields(pair, docs, link, of_unit, unit)

    def _fields(self, pair, docs, link, of_unit, unit, weight=b""):
        import numpy as np
        first, sizes = np.zeros(len(unit), bool), self.sizes
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        step = np.diff(unit, prepend=0)
        step[first] = unit[first]  # the units of a document rise: their steps compress well
        return {"pairs": pair.tolist(), "docs": docs.tolist(), "links": link.astype("<u4").tobytes(), "of_unit": of_unit.astype("<u4").tobytes(), "weight": weight,
                "rows": np.array(self.rows, "<i8").tobytes(), "of_row": sizes.astype("<u4").tobytes(), "steps": step.astype("<u4").tobytes()}

    @classmethod
    def slice(cls, row: int, pair, weight):
        """A block of one document with one unit, a range of whose links these are."""
        import numpy as np
        one = np.ones(1, np.int64)
        return cls(None, None, [row], one, None)._fields(pair, np.ones(len(pair), np.int64), np.arange(len(pair)), one * len(pair), 0 * one, weight.astype("<i8").tobytes())


DOC = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
BLOCKS = "block string, pairs array<long>, docs array<long>, links binary, of_unit binary, weight binary, rows binary, of_row binary, steps binary"


def align(df: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, blocks), from one written table.

    documents: row, doc_id, n_a, n_b, n_groups, n_links, groups ("a1,a2|b1;a3|b2,b3", or its hash if ``digest``).
    Texts that are null, empty or not spelled by both tokenizers have no tokens: zeros and an empty ``groups``.
    blocks: see ``pair_counts`` and ``link_sums``.  Repeated rows are documents of their own.
    """
    path_a, path_b = path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")
    nothing = [None] * 9

    def run(rows):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for some in batches(rows, most=BLOCK):
            texts = [r[2] for r in some]
            is_plain = np.array([plain(t) for t in texts])
            words = pc.split_pattern(pa.array([t for t, p in zip(texts, is_plain) if p], pa.large_string()), " ")
            coded = words.values.dictionary_encode()
            aligner = _aligner(path_a, path_b)
            good, units = aligner.units(coded.dictionary)
            code = coded.indices.to_numpy().astype(np.int64)
            sizes = np.diff(words.offsets.to_numpy())
            doc = np.repeat(np.arange(len(sizes)), sizes)
            valid = np.bincount(doc, ~good[code], len(sizes)) == 0  # documents all of whose units both sides spell
            number = np.cumsum(good) - 1
            kept = valid[doc]
            unit, doc = number[code[kept]], doc[kept]
            figures = np.stack([*units.n, units.groups, units.links], 1)
            totals = np.stack([np.bincount(doc, figures[unit, k], len(sizes)) for k in range(4)], 1).astype(np.int64).tolist()
            at, sizes = np.cumsum(sizes * valid), sizes * valid
            spelled, ends = units.spelled()
            begins = np.concatenate([[0], ends[:-1]])
            place, plain_rows, more = iter(range(len(sizes))), [], []
            for (row, doc_id, text), p in zip(some, is_plain.tolist()):
                numbers, shown = (0, 0, 0, 0), b""
                if p:
                    k = next(place)
                    if valid[k]:
                        mine = unit[at[k] - sizes[k]:at[k]]
                        numbers, shown = totals[k], spelled[_ranges(begins[mine], (ends - begins)[mine])][:-1].tobytes()
                        plain_rows.append(row)
                elif (found := aligner.text(text)) is not None:
                    numbers, shown = [int(x[0]) for x in (*found.n, found.groups, found.links)], found.spelled()[0][:-1].tobytes()
                    if numbers[3] > LINKS:
                        for k, (pair, weight) in enumerate(found.slices()):
                            yield (*[None] * 7, f"{row}.{k}", *Block.slice(row, pair, weight).values())
                    else:
                        more.append((row, found))
                yield (row, doc_id, *numbers, (hashlib.sha256(shown).hexdigest() if digest else shown.decode()) if shown else "", *nothing)
            all_rows = plain_rows + [row for row, _ in more]
            if all_rows:
                one = np.ones(1, np.int64)
                links = np.concatenate([units.pairs(), *(f.pairs() for _, f in more)])
                of_unit = np.concatenate([units.links, *(f.links for _, f in more)])
                unit = np.concatenate([unit, len(units.links) + np.arange(len(more))])
                block = Block(links, of_unit, all_rows, np.concatenate([sizes[valid], *[one] * len(more)]), unit)
                yield (*[None] * 7, str(all_rows[0]), *block.packed().values())

    got = written(map_rows(slim_texts(df.withColumn("__at", F.monotonically_increasing_id()), "__at", "doc_id"), run, f"{DOC}, {BLOCKS}"), "aligned", compression="zstd")
    return got.where("row IS NOT NULL").select(*[c.split()[0] for c in DOC.split(", ")]), got.where("block IS NOT NULL").select(*[c.split()[0] for c in BLOCKS.split(", ")])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (first id << 32 | second id), docs: documents that hold it linked; best: whether no pair of the first id has more."""
    said = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("x.pairs", "x.docs")
    counts = written(said.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("docs")), "pair-counts")
    first = F.shiftrightunsigned("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", first).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def link_sums(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_best, count_sum: over the links of each document that has any, those of a best pair, and the pairs' counts."""
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("at", "docs", "best")).alias("told"))
    told = told.select("block", F.col("told.at").alias("at"), F.col("told.docs").alias("docs"), F.col("told.best").alias("best"))
    both = blocks.select("block", "links", "of_unit", "weight", "rows", "of_row", "steps").join(told, "block")

    def run(rows):
        import numpy as np
        for links, of_unit, weight, ids, of_row, steps, at, docs, best in rows:
            value = np.zeros((2, len(at)), np.int64)
            value[0, at], value[1, at] = docs, best
            value = value[:, np.frombuffer(links, "<u4")]
            if weight:
                value *= np.frombuffer(weight, "<i8")
            done = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(value, axis=1)], axis=1)
            cut = np.concatenate([[0], np.cumsum(np.frombuffer(of_unit, "<u4").astype(np.int64))])
            unit_sum = np.diff(done[:, cut], axis=1)
            sizes, step = np.frombuffer(of_row, "<u4").astype(np.int64), np.frombuffer(steps, "<u4").astype(np.int64)
            ends = np.cumsum(sizes)
            total = np.cumsum(step)
            before = np.concatenate([[0], total])[ends - sizes]
            unit = total - np.repeat(before, sizes)
            done = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(unit_sum[:, unit], axis=1)], axis=1)
            sums = done[:, ends] - done[:, ends - sizes]
            yield from zip(np.frombuffer(ids, "<i8").tolist(), sums[1].tolist(), sums[0].tolist())

    got = map_rows(both.select("links", "of_unit", "weight", "rows", "of_row", "steps", "at", "docs", "best"), run, "row long, n_best long, count_sum long")
    return got.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def op13_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, blocks = align(table(spark, sf_dir, "documents"), digest=True)
    sums = link_sums(blocks, pair_counts(blocks))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return docs.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), F.col("groups").alias("groups_sha256"))
