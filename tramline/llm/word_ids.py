"""Token ids of many texts, each distinct piece of a word asked for once.

For tokenizers whose pre-tokens never cross white space (``word_bpe``): the ids
of a text are those of its words in order. Words are cut at 0x20 and 0x09-0x0D
only, all of which the tokenizer takes as white space; other white space stays
inside a word and is left to the tokenizer.

Most distinct words are Latin letters with signs behind them. Letters and signs
are pre-tokens of their own, so these words are cut into the two, as arrays over
all bytes of a block, and the pieces go straight to the tokenizer's model, past
normalising and splitting, if the tokenizer proves on ``PROBES`` to work that
way. All other words are one piece and take the whole way.

The tokenizer ignores case, so ASCII letters of cut words are looked up in lower
case; other words are not, since a few letters compose with accents in one case
only. Words with ``<|``, which may hold special strings, are never cut.
"""

from __future__ import annotations

import gc
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tramline.llm import arrays

CACHE_BYTES = 16 << 20  # of pieces; the table starts anew beyond that
KEY_BYTES = 16  # pieces up to this size are found as two numbers
CUT_BYTES = 256 << 10  # texts cut together: their arrays stay in the processor's cache

LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+\\Z")
SIGNS = re.compile("[!-/:-@\\[-`{-~]+\\Z")
IS_ASCII_LETTER = np.zeros(256, dtype=bool)
IS_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
IS_SIGN = np.zeros(256, dtype=bool)
IS_SIGN[[b for b in range(0x21, 0x7F) if SIGNS.match(chr(b))]] = True
# The bytes that follow 0xC3 in the letters of Latin-1.
IS_SECOND = np.zeros(256, dtype=bool)
IS_SECOND[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
PROBES = ("hand", "Hand,", "tokenization...", "its'", "(", "xyzzyq|%", "Élève,", "Größe!", "ÿÏàâã")
# Byte-level vocabularies write printable bytes as themselves and the others as code points from 256 on, in order.
_OTHERS = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
BYTE_NAMES = np.arange(256, dtype="<u4")
BYTE_NAMES[_OTHERS] = 256 + np.arange(len(_OTHERS))
BYTE_NAMES[0x20] = 0x20  # between pieces


def cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with cut words in lower case, byte starts and ends of all pieces, and each text's offset among the pieces."""
    starts, ends, words = arrays.find_words(data, offsets)
    letter, sign = IS_ASCII_LETTER[data], IS_SIGN[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[IS_SECOND[data[lead + 1]]]
    letter[lead] = letter[lead + 1] = True
    letters, signs = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (letter, sign))
    middle = starts + letters[ends] - letters[starts]
    # Letters come first if behind as many bytes as there are letters all are signs.
    plain = (middle > starts) & (signs[ends] - signs[middle] == ends - middle)
    special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
    if len(special):
        plain[np.searchsorted(starts, special, "right") - 1] = False
    is_cut = plain & (middle < ends)
    before = np.concatenate([[0], np.cumsum(is_cut)])
    at = np.arange(len(starts)) + before[:-1]
    first, last = (np.empty(len(starts) + int(before[-1]), np.int64) for _ in range(2))
    first[at], last[at] = starts, np.where(is_cut, middle, ends)
    first[at[is_cut] + 1], last[at[is_cut] + 1] = middle[is_cut], ends[is_cut]
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[plain]] += 1
    edges[ends[plain]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    return np.where(inside, LOWER[data], data), first, last, words + before[words]


def named(pieces: str) -> str:
    """Letters and signs as the vocabulary writes them; spaces between them stay."""
    pieces = pieces.lower()
    if pieces.isascii():  # named by themselves
        return pieces
    return BYTE_NAMES[np.frombuffer(pieces.encode(), np.uint8)].tobytes().decode("utf-32-le")


def grown(values: np.ndarray, n: int) -> np.ndarray:
    """The array with room for n values or more, doubled as often as that takes."""
    while n > len(values):
        values = np.concatenate([values, np.zeros_like(values)])
    return values


def _hash(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
    return arrays.mix(arrays.mix(low) + high * np.uint64(arrays.WORD_BASE) + size.astype(np.uint64))


class Keys:
    """Pieces as numbers: sizes and up to 16 bytes in two of 64 bits; longer ones stay bytes, by their row."""

    def __init__(self, pieces: pa.LargeBinaryArray):
        n = len(pieces)
        _, where, held = pieces.buffers()
        where = np.frombuffer(where, np.int64, n + 1 + pieces.offset)[pieces.offset :] if n else np.zeros(1, np.int64)
        held = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
        held = np.concatenate([held[where[0] : where[-1]], np.zeros(16, np.uint8)])
        eight = np.ndarray(len(held) - 7, "<u8", held, strides=(1,))  # the eight bytes from each byte on
        first = where[:-1] - where[0]
        self.size = np.diff(where)
        self.low = eight[first] & FIRST_BYTES[np.minimum(self.size, 8)]
        self.high = eight[first + 8 * (self.size > 8)] & FIRST_BYTES[np.clip(self.size - 8, 0, 8)]
        rows = np.flatnonzero(self.size > KEY_BYTES)
        self.long = {int(i): held[first[i] : first[i] + self.size[i]].tobytes() for i in rows}


class Pieces:
    """Pieces in the order in which they were added, found as arrays by open addressing."""

    def __init__(self):
        self.n = 0
        self.low, self.high = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64)
        self.size = np.zeros(1 << 12, np.uint8)  # 0 for the long ones
        self.slots = np.full(1 << 14, -1, np.int32)
        self.long: dict[bytes, int] = {}

    def _home(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (_hash(low, high, size) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, keys: Keys) -> np.ndarray:
        """The place of each piece, -1 if it has none."""
        out = np.full(len(keys.size), -1, np.int64)
        left = np.flatnonzero(keys.size <= KEY_BYTES)
        slot = self._home(keys.low[left], keys.high[left], keys.size[left])
        while len(left):
            place = self.slots[slot]
            taken = place >= 0  # a piece whose search ends at a free slot has no place
            left, slot, place = left[taken], slot[taken], place[taken]
            same = (self.low[place] == keys.low[left]) & (self.high[place] == keys.high[left])
            same &= self.size[place] == keys.size[left]
            out[left[same]] = place[same]
            left, slot = left[~same], (slot[~same] + 1) & (len(self.slots) - 1)
        for i, piece in keys.long.items():
            out[i] = self.long.get(piece, -1)
        return out

    def add(self, keys: Keys, rows: np.ndarray) -> np.ndarray:
        """Places for those rows of the keys, which have none yet."""
        places = np.arange(self.n, self.n + len(rows))
        self.n += len(rows)
        self.low, self.high, self.size = (grown(x, self.n) for x in (self.low, self.high, self.size))
        self.low[places], self.high[places] = keys.low[rows], keys.high[rows]
        self.size[places] = np.where(keys.size[rows] > KEY_BYTES, 0, keys.size[rows])
        if keys.long:
            self.long |= {keys.long[i]: p for i, p in zip(rows.tolist(), places.tolist()) if i in keys.long}
        enter = places
        if 2 * self.n > len(self.slots):
            self.slots = np.full(1 << (4 * self.n).bit_length(), -1, np.int32)
            enter = np.arange(self.n)
        enter = enter[self.size[enter] > 0]
        slot = self._home(self.low[enter], self.high[enter], self.size[enter])
        while len(enter):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = enter[free]
            out = self.slots[slot] != enter  # of those that meet at a free slot one has it now
            enter, slot = enter[out], (slot[out] + 1) & (len(self.slots) - 1)
        return places

    def index(self) -> dict[bytes, int]:
        """The place of each piece."""
        raw = np.stack([self.low, self.high], 1)[: self.n].astype("<u8").tobytes()
        return {raw[16 * i : 16 * i + k]: i for i, k in enumerate(self.size[: self.n].tolist()) if k} | self.long


class WordIds:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = True
        self.plain = all(
            [i for piece in self._pieces(w) for i in self.ids_of(piece)] == self._whole(w) for w in PROBES
        )
        self.clear()

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _pieces(self, text: str) -> list[str]:
        data, first, last, _ = self._cut(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        return [data[a:b].tobytes().decode() for a, b in zip(first, last)]

    def _cut(self, data: np.ndarray, offsets: np.ndarray):
        return cut_words(data, offsets) if self.plain else (data, *arrays.find_words(data, offsets))

    def ids_of(self, piece: str) -> list[int]:
        """The ids of one piece."""
        if self.plain and (LETTERS.match(piece) or SIGNS.match(piece) and "<|" not in piece):
            return [t.id for t in self.model.tokenize(named(piece))]
        return self._whole(piece)

    def _found(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece; letters are named all at once."""
        names = [p if self.plain and LETTERS.match(p) else "" for p in pieces]
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(n)] if n else self.ids_of(p) for p, n in zip(pieces, named(" ".join(names)).split(" "))]

    def clear(self) -> None:
        self.table = Pieces()
        self.size = 0
        self.lengths = np.zeros(1 << 12, np.int64)
        self.first = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    @property
    def index(self) -> dict[bytes, int]:
        """The place of each piece in the table."""
        return self.table.index()

    def learn(self, pieces: pa.LargeBinaryArray) -> np.ndarray:
        """The places of distinct pieces; the ids of those that are not in the table are found."""
        keys = Keys(pieces)
        place = self.table.find(keys)
        new = np.flatnonzero(place < 0)
        if not len(new):
            return place
        if self.size + int(keys.size[new].sum()) > CACHE_BYTES and self.table.n:
            self.clear()
            new = np.arange(len(pieces))
        self.size += int(keys.size[new].sum())
        # Many small lists live for a moment: looking for cycles among them would take longer than making them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            found = self._found(pieces.take(pa.array(new)).cast(pa.large_string()).to_pylist())
        finally:
            if collecting:
                gc.enable()
        length = np.fromiter(map(len, found), np.int64, len(found))
        n, at, total = len(new), self.table.n, int(length.sum())
        self.lengths, self.first = grown(self.lengths, at + n), grown(self.first, at + n)
        self.ids = grown(self.ids, self.used + total)
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.lengths[at : at + n] = length
        self.first[at : at + n] = self.used + np.cumsum(length) - length
        self.used += total
        place[new] = self.table.add(keys, new)
        return place

    def _places(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in the table of each piece of the texts, and each text's offset among the pieces."""
        held, sizes, at, n, first = [], [], [np.zeros(1, np.int64)], 0, 0
        while first < len(offsets) - 1:
            last = int(np.searchsorted(offsets, offsets[first] + CUT_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(offsets) - 1)
            lo, hi = int(offsets[first]), int(offsets[last])
            data, starts, ends, texts = self._cut(np.frombuffer(raw, np.uint8, hi - lo, lo), offsets[first : last + 1] - lo)
            held.append(data[~arrays.SEPARATOR[data]])
            sizes.append(ends - starts)
            at.append(texts[1:] + n)
            n, first = n + len(starts), last
        where = np.concatenate([[0], *sizes]).cumsum()
        buffers = [None, pa.py_buffer(where), pa.py_buffer(np.concatenate([np.zeros(0, np.uint8), *held]))]
        pieces = pa.Array.from_buffers(pa.large_binary(), n, buffers).dictionary_encode()
        return self.learn(pieces.dictionary)[np.asarray(pieces.indices)], np.concatenate(at)

    def encode(self, raw: bytes, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts raw[offsets[i]:offsets[i+1]], each with ``end`` appended, and their offsets."""
        at, pieces = self._places(raw, offsets)
        length = self.lengths[at]
        before = np.concatenate([[0], np.cumsum(length)])[pieces]
        out = np.empty(int(before[-1]) + len(offsets) - 1, np.uint32)
        borders = before + np.arange(len(offsets))
        is_end = np.zeros(len(out), dtype=bool)
        is_end[borders[1:] - 1] = True
        out[is_end] = end
        out[~is_end] = self.ids[arrays.ranges(self.first[at], length)]
        return out, borders


def word_ids(path: str) -> WordIds:
    """The worker's table for this tokenizer file."""
    state = arrays.worker_state()
    if ("word ids", path) not in state:
        state["word ids", path] = WordIds(path)
    return state["word ids", path]
