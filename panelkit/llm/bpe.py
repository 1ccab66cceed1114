"""Byte-level BPE by ranks, and memories of encoded words shared by the tokenizing operators."""

from __future__ import annotations

import base64
import heapq
from itertools import islice


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merger:
    """BPE by ranks: a token's id is its rank, so the id of a joined pair is also its priority."""

    NEVER = 1 << 62
    SHORT = 64  # bytes

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = [ranks[bytes([b])] for b in range(256)]
        self.pair = {}  # two ids in one number -> the id of the two joined
        for token, i in ranks.items():
            for k in range(1, len(token)):
                if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None:
                    self.pair[a << 32 | b] = i

    def ids(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: the adjacent pair of least rank is joined first, the leftmost among equals."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        return self._short(piece) if len(piece) <= self.SHORT else self._long(piece)

    def _short(self, piece: bytes) -> list[int]:
        """By a list of the pairs' ids; quadratic, but quickest for words."""
        joined, never = self.pair.get, self.NEVER
        ids = list(map(self.byte.__getitem__, piece))
        pairs = [joined(a << 32 | b, never) for a, b in zip(ids, ids[1:])]
        while pairs and (least := min(pairs)) != never:
            i = pairs.index(least)
            ids[i] = least
            del ids[i + 1], pairs[i]
            if i:
                pairs[i - 1] = joined(ids[i - 1] << 32 | least, never)
            if i < len(pairs):
                pairs[i] = joined(least << 32 | ids[i + 1], never)
        return ids

    def _long(self, piece: bytes) -> list[int]:
        """By a heap of candidate pairs over a linked list: n log n, so that a pre-token of a megabyte is no trap."""
        joined, n = self.pair.get, len(piece)
        ids = list(map(self.byte.__getitem__, piece))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(j, i, ids[i], ids[i + 1]) for i in range(n - 1) if (j := joined(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            j, i, a, b = heapq.heappop(heap)
            k = after[i]
            if ids[i] != a or k >= n or ids[k] != b:
                continue  # one of the two has changed since
            ids[i], ids[k], after[i] = j, None, after[k]
            if after[i] < n:
                before[after[i]] = i
                if (x := joined(j << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (x, i, j, ids[after[i]]))
            if (p := before[i]) >= 0 and (x := joined(ids[p] << 32 | j)) is not None:
                heapq.heappush(heap, (x, p, ids[p], j))
        return [i for i in ids if i is not None]


class Memory:
    """Serialized ids by word, in two generations: a full one becomes the old one, from which words that are still
    in use come back, and the former old one goes.  So it is bounded, which moves time, never results.
    """

    LONGEST = 200  # a word beyond it is not remembered

    def __init__(self, encode_all, entries: int = 300_000):
        self.encode_all, self.entries = encode_all, entries
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def all(self, words: list[str]) -> list[bytes]:
        """The ids of each word; the words must be different."""
        got = list(map(self.known.get, words))
        missing = [w for w, g in zip(words, got) if g is None]
        if missing:
            ids = list(map(self.old.get, missing))
            fresh = iter(self.encode_all([w for w, x in zip(missing, ids) if x is None]))
            ids = [next(fresh) if x is None else x for x in ids]
            rest = iter(ids)
            got = [next(rest) if g is None else g for g in got]
            if len(self.known) + len(missing) > self.entries:
                self.old, self.known = self.known, {}
            if max(map(len, missing)) <= self.LONGEST:
                self.known.update(zip(missing, ids))
            else:
                self.known.update((w, x) for w, x in zip(missing, ids) if len(w) <= self.LONGEST)
        return got

    def each(self, words: list[str]) -> list[bytes]:
        """The ids of each word of a list that may repeat some."""
        different = list(dict.fromkeys(words))
        return list(map(dict(zip(different, self.all(different))).__getitem__, words))


BATCH = 8_000_000  # characters of text that are worked on at once


def batches(rows, text: int = -1, most: int = BATCH):
    """Lists of rows whose texts (at ``text``) are ``most`` characters long together, about."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[text])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def spell_words(texts: list[str], memory: Memory, width: int, skip_first: bool) -> list[bytes]:
    """Per text, the joined ids of its words between spaces (all but the first, if so wished).

    Arrow splits the texts and numbers the different words, which alone are looked up; numpy gathers their ids.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    if not texts:
        return []
    words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    ends = words.offsets.to_numpy()
    coded = words.values.dictionary_encode()
    number = coded.indices.to_numpy()
    ids = memory.all(coded.dictionary.to_pylist())
    length = np.fromiter(map(len, ids), np.int64, len(ids)) // width
    begin = np.cumsum(length) - length
    take = length[number]
    if skip_first:
        take[ends[:-1]] = 0
    done = np.cumsum(take)
    small = np.int32 if not len(done) or done[-1] < 1 << 31 else np.int64
    at = np.repeat((begin[number] - (done - take)).astype(small), take)
    at += np.arange(len(at), dtype=small)
    out = np.frombuffer(b"".join(ids), f"<u{width}")[at]
    cut = np.concatenate([[0], done])[ends]
    return [out[a:b].tobytes() for a, b in zip(cut.tolist(), cut[1:].tolist())]


def spaced(text: str) -> bool:
    """Whether no space has white space beside it, nor anything unprintable but line ends occurs.

    For the byte-level pattern, a cut before a space between two other characters is always one between
    pre-tokens, and what is left and right of it is split alike with or without the other side.  So the words of
    such a text, each with the space before it, can be encoded one by one.
    """
    return "  " not in text and "\n " not in text and " \n" not in text and text.replace("\n", "").isprintable()


class WordTable:
    """Ids by word, in Arrow and numpy arrays: looked up, gathered and forgotten without Python objects.

    ``encode``: from a list of words to (ids of all, ids per word), two numpy arrays.  Beyond ``most`` bytes only the
    words of the current texts stay, which moves time, never results.
    """

    def __init__(self, encode, width: int, most: int = 16_000_000):
        import numpy as np
        import pyarrow as pa
        self.encode, self.kind, self.most = encode, f"<u{width}", most
        self.words = pa.array([], pa.large_string())
        self.ids, self.length = np.zeros(0, self.kind), np.zeros(0, np.int64)

    def _places(self, words):
        """The places of different words in the table, which gets those that it has not."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        if len(new):
            ids, count = self.encode(new.to_pylist())
            at[at < 0] = len(self.words) + np.arange(len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.ids, self.length = np.concatenate([self.ids, ids.astype(self.kind)]), np.concatenate([self.length, count])
        return at

    def _gather(self, words, skip=None):
        """The ids of an Arrow array of words one after the other, and how many each has; ``skip``: places to leave out."""
        import numpy as np
        coded = words.dictionary_encode()
        place = self._places(coded.dictionary)
        begin = np.cumsum(self.length) - self.length
        number = coded.indices.to_numpy()
        take, begin_of = self.length[place], begin[place]
        take = take[number]
        if skip is not None:
            take[skip] = 0
        done = np.cumsum(take)
        small = np.int32 if not len(done) or max(done[-1], len(self.ids)) < 1 << 31 else np.int64
        at = np.repeat((begin_of[number] - (done - take)).astype(small), take)
        at += np.arange(len(at), dtype=small)
        out = self.ids[at]
        if self.words.nbytes + self.ids.nbytes + self.length.nbytes > self.most:
            self._keep(np.sort(place), begin)
        return out, take

    def flat(self, words):
        """(ids of all, ids per word) of a list or an Arrow array of words that may repeat."""
        import pyarrow as pa
        return self._gather(words if isinstance(words, pa.Array) else pa.array(words, pa.large_string()))

    def spell(self, texts: list[str], skip_first: bool = False) -> list[bytes]:
        """Per text, the joined ids of its words between single spaces (all but the first, if so wished)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not texts:
            return []
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends = words.offsets.to_numpy()
        ids, take = self._gather(words.values, ends[:-1] if skip_first else None)
        cut = (np.concatenate([[0], np.cumsum(take)])[ends] * ids.itemsize).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def _keep(self, place, begin):
        import numpy as np
        import pyarrow as pa
        length = self.length[place]
        at = np.repeat(begin[place] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        self.words, self.ids, self.length = self.words.take(pa.array(place)), self.ids[at], length


class Speller:
    """Serialized ids of texts from those of pre-tokens, by the byte-level pattern.

    ``piece_ids`` encodes one pre-token.  Pre-tokens are remembered, and so are words after a space, which may be
    several pre-tokens (a word and its comma).
    """

    def __init__(self, find, piece_ids, width: int, entries: int = 300_000):
        self.find, self.width = find, width
        self.pieces = Memory(lambda new: list(map(piece_ids, new)), entries)
        self.words = Memory(self._words, entries)

    def _words(self, words: list[str]) -> list[bytes]:
        """Of words after a space: found in one text, in which each pre-token that begins with a space begins a word."""
        pieces = self.find(" " + " ".join(words)) if words else []
        ids = self.pieces.each(pieces)
        begins = [i for i, p in enumerate(pieces) if p[0] == " "]
        if len(begins) != len(words):
            raise ValueError("words that the pattern does not part at spaces")
        return [b"".join(ids[a:b]) for a, b in zip(begins, [*begins[1:], len(ids)])]

    def many(self, texts: list[str]) -> list[bytes]:
        plain = [spaced(t) for t in texts]
        rest = iter(spell_words([t for t, p in zip(texts, plain) if p], self.words, self.width, True))
        first = [self.find(t.split(" ", 1)[0] if p else t) for t, p in zip(texts, plain)]
        ids = iter(self.pieces.each([x for f in first for x in f]))
        out = []
        for f, p in zip(first, plain):
            head = b"".join(islice(ids, len(f)))
            out.append(head + next(rest) if p else head)
        return out
