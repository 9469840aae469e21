"""Splitting UTF-8 texts into byte-level BPE pre-tokens, and looking them up,
as whole-array numpy steps.

The splitter gives exactly the matches of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

found from left to right.  Stated over runs of equal character class (letter,
number, white space, other):

* every run of a class that is no white space is one pre-token;
* white space before such a run is cut before its last character; that
  character belongs to the run if it is U+0020 and else stands alone; white
  space at the end of the text is one pre-token;
* an apostrophe that is a whole run and has no space in front, followed by one
  of ``s t m d re ve ll``, is a pre-token with those letters; the rest of that
  letter run is the next.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import regex

LETTER, NUMBER, SPACE, OTHER, CUT = 0, 1, 2, 3, 4
#: Stands between texts of a run; never occurs in UTF-8.
CUT_BYTE = 0xFF
PAD = 16
#: Longer texts are cut where a pre-token surely begins.
PIECE_BYTES = 1 << 22


@functools.lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """The class of every code point, from the properties the pattern names."""
    table = np.full(0x110000, OTHER, np.uint8)
    low = "".join(map(chr, range(0xD800)))
    high = "".join(map(chr, range(0xE000, 0x110000)))
    for start, chars in ((0, low), (0xE000, high)):
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, chars):
                table[start + m.start():start + m.end()] = kind
    return table


@functools.lru_cache(maxsize=1)
def _byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[:128] = _class_table()[:128]
    table[CUT_BYTE] = CUT
    return table


def _classes(b: np.ndarray) -> np.ndarray:
    """The class of each byte: that of its character."""
    classes = _byte_classes()[b]
    high = np.flatnonzero(b >= 0xC0)
    high = high[b[high] != CUT_BYTE]
    if high.size:
        c0 = b[high].astype(np.int32)
        c1, c2, c3 = (b[np.minimum(high + k, b.size - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3))
        three, four = c0 >= 0xE0, c0 >= 0xF0
        point = np.where(four, (c0 & 7) << 18 | c1 << 12 | c2 << 6 | c3,
                         np.where(three, (c0 & 15) << 12 | c1 << 6 | c2, (c0 & 31) << 6 | c1))
        kind = _class_table()[np.minimum(point, 0x10FFFF)]
        classes[high] = kind
        classes[high + 1] = kind
        classes[high[three] + 2] = kind[three]
        classes[high[four] + 3] = kind[four]
    return classes


def split(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of the texts in ``b``, which end with
    ``CUT_BYTE`` each and are followed by at least ``PAD`` zero bytes."""
    kind = _classes(b)
    kind[-PAD:] = CUT
    first = np.empty(b.size, bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & (kind[1:] != CUT))
    lead = last.copy()
    inner = np.flatnonzero(b[lead] >= 0x80)
    while inner.size:  # from the last byte of a character to its first
        inner = inner[(b[lead[inner]] & 0xC0) == 0x80]
        lead[inner] -= 1
    first[lead] = True
    first[last[b[last] == 0x20] + 1] = False

    mark = np.flatnonzero(first & (b == 0x27))
    if mark.size:
        n1, n2 = b[mark + 1], b[mark + 2]
        one = np.isin(n1, np.frombuffer(b"stmd", np.uint8))
        two = ((n1 == ord("r")) & (n2 == ord("e"))) | ((n1 == ord("v")) & (n2 == ord("e"))) \
            | ((n1 == ord("l")) & (n2 == ord("l")))
        first[mark[one | two] + 1] = False
        end = np.concatenate([mark[one] + 2, mark[two] + 3])
        first[end[kind[end] == LETTER]] = True

    at = np.flatnonzero(first)
    ends = np.append(at[1:], b.size)
    real = kind[at] != CUT
    return at[real], ends[real]


def pieces_of(text: bytes, limit: int = PIECE_BYTES) -> list[bytes]:
    """``text`` in parts of about ``limit`` bytes, cut only before a U+0020
    between two ASCII characters that are no white space (there a pre-token
    begins whatever stands around), so the pre-tokens are those of the whole."""
    if len(text) <= limit:
        return [text]
    out, at = [], 0
    cut = regex.compile(rb"(?<=[!-~]) (?=[!-~])")
    while len(text) - at > limit:
        m = cut.search(text, at + limit)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    out.append(text[at:])
    return out


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces as one padded array for ``split``, and where each begins."""
    cut = bytes([CUT_BYTE])
    b = np.frombuffer(cut.join(pieces) + cut + bytes(PAD), np.uint8)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
    return b, np.cumsum(lengths) - lengths


_LOW = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
#: The longest pre-token that two 64-bit words hold exactly, with its length.
WORDS_HOLD = 15


def keys(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pre-tokens of at most ``WORDS_HOLD`` bytes two words that equal
    their bytes and length (so equal keys are equal pre-tokens)."""
    words = np.ndarray((b.size - 8,), "<u8", b, 0, (1,))
    n = ends - starts
    low = words[starts] & _LOW[np.minimum(n, 8)]
    high = words[np.minimum(starts + 8, b.size - 9)] & _LOW[np.clip(n - 8, 0, 7)]
    return low, high | (n.astype(np.uint64) << np.uint64(56))


class WordTable:
    """A compact hash table from two 64-bit words to a number (open
    addressing over flat arrays, all rows of an array probed at once)."""

    def __init__(self, bits: int):
        self.bits = bits
        size = 1 << bits
        self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.value = np.full(size, -1, np.int32)
        self.count = 0

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 for those that are not there."""
        out = np.full(low.size, -1, np.int32)
        slot = self._slots(low, high)
        rows = None
        mask = (1 << self.bits) - 1
        while slot.size:
            value = self.value[slot]
            same = (self.low[slot] == low) & (self.high[slot] == high)
            hit = same & (value >= 0)
            if rows is None:
                out[hit] = value[hit]
            else:
                out[rows[hit]] = value[hit]
            on = np.flatnonzero(~same & (value >= 0))
            rows = on if rows is None else rows[on]
            low, high, slot = low[on], high[on], (slot[on] + 1) & mask
        return out

    def add(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> None:
        """Puts keys that are not there yet, each once."""
        self.count += low.size
        if self.count * 2 > 1 << self.bits:
            raise ValueError("the table is full")
        slot = self._slots(low, high)
        mask = (1 << self.bits) - 1
        while slot.size:
            free = self.value[slot] < 0
            self.value[slot[free]] = value[free]  # of those with the same slot one stays
            won = free & (self.value[slot] == value)
            self.low[slot[won]], self.high[slot[won]] = low[won], high[won]
            on = ~won
            low, high, value, slot = low[on], high[on], value[on], (slot[on] + 1) & mask


def distinct(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct key the first row that has it, and each row's key
    number."""
    order = np.lexsort((high, low))
    a, c = low[order], high[order]
    new = np.empty(order.size, bool)
    new[:1] = True
    new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
    number = np.empty(order.size, np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class IdCache:
    """Token ids of the pre-tokens a worker has met, encoded once each.

    ``encode`` maps a list of distinct pre-tokens to (flat ids, lengths).  The
    cache starts anew when it holds ``limit`` pre-tokens, which changes no
    result.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 limit: int = 1 << 19):
        self.encode, self.limit = encode, limit
        self._start()

    def _start(self) -> None:
        self.table = WordTable(max(4, (4 * self.limit - 1).bit_length()))
        self.long: dict[bytes, int] = {}
        self.n = self.used = 0
        self.offset = np.zeros(1 << 10, np.int64)
        self.length = np.zeros(1 << 10, np.int64)
        self.pool = np.zeros(1 << 12, np.uint32)

    @staticmethod
    def _fit(a: np.ndarray, n: int) -> np.ndarray:
        if n <= a.size:
            return a
        out = np.zeros(max(n, 2 * a.size), a.dtype)
        out[:a.size] = a
        return out

    def _put(self, tokens: list[bytes]) -> np.ndarray:
        ids, lengths = self.encode(tokens)
        n, m = self.n + len(tokens), self.used + ids.size
        self.offset, self.length, self.pool = self._fit(self.offset, n), self._fit(self.length, n), self._fit(self.pool, m)
        self.pool[self.used:m] = ids
        self.length[self.n:n] = lengths
        self.offset[self.n:n] = self.used + np.cumsum(lengths) - lengths
        numbers = np.arange(self.n, n, dtype=np.int32)
        self.n, self.used = n, m
        return numbers

    def numbers(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The cache's number of each pre-token."""
        out = np.empty(starts.size, np.int32)
        short = ends - starts <= WORDS_HOLD
        raw = b.tobytes() if b.size else b""
        rows = np.flatnonzero(short)
        low, high = keys(b, starts[rows], ends[rows])
        found = self.table.find(low, high)
        miss = np.flatnonzero(found < 0)
        if miss.size:
            heads, which = distinct(low[miss], high[miss])
            if self.table.count + heads.size > self.limit:
                return self._anew(b, starts, ends)
            at = rows[miss[heads]]
            numbers = self._put([raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            self.table.add(low[miss[heads]], high[miss[heads]], numbers)
            found[miss] = numbers[which]
        out[rows] = found
        rows = np.flatnonzero(~short)
        if rows.size:
            tokens = [raw[s:e] for s, e in zip(starts[rows].tolist(), ends[rows].tolist())]
            if len(self.long) + len(tokens) > self.limit:
                self.long = {}
            new = [t for t in dict.fromkeys(tokens) if t not in self.long]
            if new:
                self.long.update(zip(new, self._put(new).tolist()))
            out[rows] = [self.long[t] for t in tokens]
        return out

    def _anew(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts the cache anew for a run that does not fit into the rest."""
        self.limit = max(self.limit, distinct(*keys(b, starts, ends))[0].size)
        self._start()
        return self.numbers(b, starts, ends)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pre-tokens in order, and how many each has."""
        lengths = self.length[numbers]
        total = int(lengths.sum())
        before = np.cumsum(lengths) - lengths
        at = np.repeat(self.offset[numbers] - before, lengths) + np.arange(total)
        return self.pool[at], lengths
