"""Byte-level BPE encoding with a pair occurrence index, and decoding.

A partition's texts are cut into words by the vocabulary's splitting rule.  The
words that the partition has not met before are laid out one after the other,
some MB of text at a time, and every mergeable pair of neighbouring symbols is
listed with all the positions where it stands.  The ranks that have positions are
applied in ascending order: all positions of a pair are merged, and the lists of
the pairs that this makes are extended.  So a merge costs its own positions,
never another scan of the text, and a word of a million letters takes no longer
for each letter than a short one.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidemark.llm.common import batched

VOCABULARY = "byte_bpe_50k.json"
#: Words that a worker remembers with their ids; beyond that it starts anew.
REMEMBERED = 400_000
#: Longer ones are encoded, but not remembered.
LONG_WORD = 200
#: Characters of text whose new words share a pair index.
TOGETHER = 4 << 20
#: From so many positions on a merge is done by array operations.
MANY = 24

#: Fixed value: the splitting rule's part for ASCII.
ASCII_RULE = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
_ASCII_WORD = re.compile(ASCII_RULE)
#: White space other than blanks and line ends.
_RARE_SPACE = re.compile(r"[\t\x0b-\r\x85\xa0  -     　]")
#: Unicode versions agree on the classes of all characters before this one.
SETTLED = 0x530
_UNSETTLED = re.compile(f"[{chr(SETTLED)}-\U0010ffff]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow at 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else more))
        more += b not in shown
    return out


class PairIndex:
    """Positions of every mergeable pair in a run of words (UTF-8)."""

    def __init__(self, words: list[bytes], bpe: Bpe):
        self.ranks, self.width, self.merges = bpe.ranks, bpe.width, bpe.merges
        self.pairs, self.pair_ranks = bpe.pairs, bpe.pair_ranks
        # 0xFF is in no UTF-8: symbol -1 separates words and marks merged-away places.
        raw = np.frombuffer(b"".join([b"\xff" + w for w in words]) + b"\xff", "u1")
        self.ends = np.flatnonzero(raw == 0xFF)
        n = len(raw)
        self.symbols = array("i", bpe.byte_ids[raw].tobytes())
        self.after = array("i", np.arange(1, n + 1, dtype="i4").tobytes())
        self.before = array("i", np.arange(-1, n - 1, dtype="i4").tobytes())
        self.places: dict[int, list[int]] = {}
        self.active: list[int] = []
        self._list(bpe.byte_pairs[raw[:-1], raw[1:]], np.arange(n - 1))

    def _list(self, ranks: np.ndarray, at: np.ndarray) -> None:
        """Positions by rank (-1: no merge)."""
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        edges = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                self._add(int(ranks[a]), at[a:b].tolist())

    def _add(self, rank: int, at: list[int]) -> None:
        if rank in self.places:
            self.places[rank] += at
        else:
            self.places[rank] = at
            heapq.heappush(self.active, rank)

    def apply(self) -> None:
        """Merge all active ranks, lowest first."""
        while self.active:
            rank = heapq.heappop(self.active)
            at = self.places.pop(rank)
            (self._merge_one_by_one if len(at) < MANY else self._merge_all)(at, *self.merges[rank])

    def _merge_one_by_one(self, at: list[int], a: int, b: int, c: int) -> None:
        symbols, after, before, width = self.symbols, self.after, self.before, self.width
        for p in sorted(at):
            q = after[p]
            if symbols[p] != a or symbols[q] != b:
                continue  # taken by another merge since it was listed
            symbols[p], symbols[q] = c, -1
            right, left = after[q], before[p]
            after[p], before[right] = right, p
            for place, key in ((left, symbols[left] * width + c), (p, c * width + symbols[right])):
                rank = self.ranks.get(key)
                if rank is not None:
                    self._add(rank, [place])

    def _merge_all(self, at: list[int], a: int, b: int, c: int) -> None:
        symbols, after, before = (np.frombuffer(x, "i4") for x in (self.symbols, self.after, self.before))
        p = np.sort(np.array(at, "i4"))
        p = p[(symbols[p] == a) & np.concatenate([[True], p[1:] != p[:-1]])]
        p = p[symbols[after[p]] == b]
        if a == b and len(p):
            # In a run of equal symbols every second pair is merged, from the left.
            begins = np.concatenate([[True], after[p[:-1]] != p[1:]])
            place = np.arange(len(p))
            p = p[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
        q = after[p]
        right = after[q]
        symbols[p], symbols[q] = c, -1
        after[p], before[right] = right, p
        left = before[p]
        for place, key in ((left, symbols[left].astype("i8") * self.width + c),
                           (p, c * self.width + symbols[right].astype("i8"))):
            found = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            self._list(np.where(self.pairs[found] == key, self.pair_ranks[found], -1), place)

    def ids(self) -> tuple[bytes, list[int]]:
        """All words' ids as little-endian 32-bit numbers, and where each word
        begins among them (and the last one's end)."""
        symbols = np.frombuffer(self.symbols, "i4")
        ends = np.cumsum(symbols >= 0)[self.ends]
        return symbols[symbols >= 0].astype("<i4").tobytes(), ends.tolist()


class Bpe:
    """A byte-level vocabulary file of the ``tokenizers`` format."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocab: dict[str, int] = data["model"]["vocab"]
        added = {x["content"]: x["id"] for x in data["added_tokens"]}
        symbols = byte_symbols()
        self.path = path
        self.byte_ids = np.array([vocab[s] for s in symbols], "i4")
        self.width = max([*vocab.values(), *added.values()]) + 2  # a pair of symbols in one number
        self.merges: list[tuple[int, int, int]] = []
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(data["model"]["merges"]):
            self.merges.append((vocab[a], vocab[b], vocab[a + b]))
            self.ranks[vocab[a] * self.width + vocab[b]] = rank
        self.pairs = np.array(sorted(self.ranks), "i8")
        self.pair_ranks = np.array([self.ranks[k] for k in self.pairs.tolist()], "i8")
        ids = self.byte_ids.tolist()
        self.byte_pairs = np.array([[self.ranks.get(a * self.width + b, -1) for b in ids] for a in ids], "i8")
        self.byte_ids[0xFF] = -1
        self.byte_pairs[0xFF, :] = self.byte_pairs[:, 0xFF] = -1
        byte_of = {s: i for i, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if all(c in byte_of for c in s)}
        self.bytes_of |= {i: s.encode() for s, i in added.items()}
        self.by_id = np.full(self.width, b"", object)  # its last place stands for unknown ids
        for i, b in self.bytes_of.items():
            self.by_id[i] = b
        self.added = {s: np.array([i], "<i4").tobytes() for s, i in added.items()}
        # Added tokens are cut out of a text before anything else, the longest first.
        names = sorted(map(re.escape, added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(names) + ")") if names else None
        self.pattern = regex.compile(pattern)
        self.doubtful: re.Pattern | None = None
        self._forget()

    def _forget(self) -> None:
        line_end = np.array([self.byte_ids[10]], "<i4").tobytes()
        self.known: dict[str, bytes] = {"\n": line_end}

    def _stand_ins(self) -> None:
        """Characters that Unicode versions class differently are split as the
        vocabulary's own library splits them, which is asked once."""
        import regex
        from tokenizers import Tokenizer

        every = "".join(map(chr, [*range(SETTLED, 0xD800), *range(0xE000, 0x110000)]))
        other = {m[0]: m.lastgroup for m in regex.finditer(r"(?P<L>\p{L})|(?P<N>\p{N})", every)}
        category = unicodedata.category
        doubtful = [c for c in every if other.get(c, "") != (k if (k := category(c)[0]) in "LN" else "")]
        split = Tokenizer.from_file(self.path).pre_tokenizer.pre_tokenize_str
        # A letter joins the a before it, a number the 1; a mark joins neither.
        ends = {end for _, (_, end) in split("".join(f"a{c}1{c}!" for c in doubtful))}
        self.stand_in = {ord(c): "1" if 5 * i + 3 not in ends else "a" if 5 * i + 1 not in ends else "!"
                         for i, c in enumerate(doubtful)}
        codes = np.array([ord(c) for c in doubtful] or [SETTLED])
        runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
        self.doubtful = re.compile("[" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in runs) + "]")

    def split(self, text: str) -> list[str]:
        """The words of a text, by the vocabulary's splitting rule."""
        if text.isascii():
            return _ASCII_WORD.findall(text)
        if _UNSETTLED.search(text):
            if self.doubtful is None:
                self._stand_ins()
            if self.doubtful.search(text):
                return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.stand_in))]
        return self.pattern.findall(text)

    def _pieces(self, text: str, words: set[str], units: set[str]) -> tuple[list[str], list[bytes | None]]:
        """A text in words or, where its white space is plain, in units: cut
        before each blank and around each line end, as no word reaches over such
        a place.  With the ids of those that are known; others are added to the sets."""
        plain = not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\0" in text
                     or text[0] in " \n" or text[-1] in " \n" or _RARE_SPACE.search(text))
        if plain:
            out = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        else:
            out = self.split(text)
        ids = list(map(self.known.get, out))
        if None in ids:
            (units if plain else words).update([u for u, x in zip(out, ids) if x is None])
        return out, ids

    def _learn(self, words: set[str], units: set[str]) -> None:
        """Encode what is not known: one pair index over all new words."""
        known = self.known
        groups = [[u for u in units if u.isascii()], [u for u in units if not u.isascii()]]
        # A line end between two units is a word of its own.
        cut = [(g, self.split("\n".join([*g, ""]))) for g in groups if g]
        fresh = list(words.union(*[[w for w in split if w not in known] for _, split in cut]))
        index = PairIndex([w.encode("utf-8") for w in fresh], self)
        index.apply()
        ids, edges = index.ids()
        known.update(zip(fresh, [ids[4 * a:4 * b] for a, b in zip(edges, edges[1:])]))
        for group, split in cut:
            begin = 0
            for u in group:
                end = split.index("\n", begin)
                if end > begin + 1:
                    known[u] = b"".join([known[w] for w in split[begin:end]])
                begin = end + 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > REMEMBERED:
            self._forget()
        words: set[str] = set()
        units: set[str] = set()
        cut = []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            # Every second part is an added token.
            cut.append([p if k % 2 else self._pieces(p, words, units) if p else ((), ()) for k, p in enumerate(parts)])
        self._learn(words, units)
        known = self.known

        def joined(pieces: list[str], ids: list[bytes | None]) -> bytes:
            return b"".join([known[u] if x is None else x for u, x in zip(pieces, ids)] if None in ids else ids)

        out = [np.frombuffer(b"".join([self.added[p] if k % 2 else joined(*p) for k, p in enumerate(parts)]), "<i4")
               for parts in cut]
        for w in [w for w in (*words, *units) if len(w) > LONG_WORD]:
            known.pop(w, None)
        return out

    def decode(self, ids: list[int | None]) -> str:
        """The text of some ids; unknown ids count for nothing, and bytes that are
        no UTF-8 become the replacement character."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")

    def decode_lists(self, lists: pa.ListArray) -> list[str]:
        """The same for a column of lists: one look-up for all ids, null ones are unknown."""
        at = lists.offsets.to_numpy()
        ids = lists.values[int(at[0]):int(at[-1])].fill_null(-1).to_numpy()
        last = self.width - 1
        parts = self.by_id[np.where((ids >= 0) & (ids < last), ids, last)]
        at = (at - at[0]).tolist()
        return [b"".join(parts[a:b].tolist()).decode("utf-8", "replace") if some else ""
                for a, b, some in zip(at, at[1:], lists.is_valid().to_pylist())]


_LOADED: dict[str | None, Bpe] = {}


def _bpe(folder: str | None) -> Bpe:
    if folder not in _LOADED:
        import public_tokenizers as P

        _LOADED[folder] = Bpe(f"{folder}/{VOCABULARY}" if folder else P.path(VOCABULARY), P.PATTERN)
    return _LOADED[folder]


def _as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype="i8")]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, "i4"), *arrays])))


def encode(docs: DataFrame, tokenizers: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs(text, ...)`` with an added column ``ids array<int>``.

    The ids are those of the ``tokenizers`` library with ``byte_bpe_50k.json``
    and ``add_special_tokens=False``; the special token's own string in a text is
    that token.  ``tokenizers`` is the folder of the vocabulary file.  Null and
    empty texts have no ids (an empty list).  Rows are taken one by one: repeated
    ones, null ids and all other columns pass through, an empty table gives no
    row.  A column already called ``ids`` is replaced; ``keep_text=False`` leaves
    the text out.
    """
    columns = [c for c in docs.columns if c != "ids"]
    kept = [c for c in columns if keep_text or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizers)
        held: list[tuple[pa.RecordBatch, list[str]]] = []
        size = 0

        def encoded() -> Iterator[pa.RecordBatch]:
            ids, at = bpe.encode([t for _, texts in held for t in texts]), 0
            for batch, texts in held:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, _as_lists(ids[at:at + len(texts)])], [*kept, "ids"])
                at += len(texts)

        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            held.append((batch, texts))
            size += sum(map(len, texts))
            if size >= TOGETHER:
                yield from encoded()
                held, size = [], 0
        yield from encoded()

    rows = batched(docs).select(*[(F.col("text").cast("string") if c == "text" else F.col(f"`{c}`")).alias(c)
                                  for c in columns])
    schema = rows.select(*[F.col(f"`{c}`") for c in kept]).schema.add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, tokenizers: str | None = None) -> DataFrame:
    """``rows(ids, ...)`` with an added column ``decoded``: the text of the ids,
    special tokens included.

    Null and empty lists give an empty text, null and unknown ids nothing; a
    column already called ``decoded`` is replaced, all others pass through.
    """
    columns = [c for c in rows.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizers)
        for batch in batches:
            texts = bpe.decode_lists(batch.column(batch.schema.get_field_index("ids")))
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    out = batched(rows).select(*[F.col(f"`{c}`") for c in columns])
    return out.mapInArrow(run, out.select("*").schema.add("decoded", "string"))
