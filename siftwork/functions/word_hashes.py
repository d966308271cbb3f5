"""Hashes of the words, or of the runs of three characters, of many texts at a time, equal to Spark's ``xxhash64`` of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_SEED = 42
#: White space as in ``text.WS_CHARS``: single bytes, and the UTF-8 sequences of the others.
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _xxhash64(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 of spans of bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    seed = np.uint64(_SEED)
    with np.errstate(over="ignore"):
        at, left = starts.copy(), sizes.copy()
        h = np.full(len(starts), seed + _P5)
        long = np.flatnonzero(sizes >= 32)
        if len(long):
            lanes = [np.full(len(long), v) for v in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
            going = np.arange(len(long))
            while len(going):
                of = long[going]
                for k, lane in enumerate(lanes):
                    lane[going] = _turned(lane[going] + eight[at[of] + 8 * k] * _P2, 31) * _P1
                at[of] += 32
                left[of] -= 32
                going = going[left[of] >= 32]
            mixed = sum((_turned(v, b) for v, b in zip(lanes[1:], (7, 12, 18))), _turned(lanes[0], 1))
            for lane in lanes:
                mixed = (mixed ^ (_turned(lane * _P2, 31) * _P1)) * _P1 + _P4
            h[long] = mixed
        h += sizes.astype(np.uint64)
        while len(of := np.flatnonzero(left >= 8)):
            h[of] = _turned(h[of] ^ (_turned(eight[at[of]] * _P2, 31) * _P1), 27) * _P1 + _P4
            at[of] += 8
            left[of] -= 8
        of = np.flatnonzero(left >= 4)
        h[of] = _turned(h[of] ^ ((eight[at[of]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
        at[of] += 4
        left[of] -= 4
        while len(of := np.flatnonzero(left > 0)):
            h[of] = _turned(h[of] ^ (padded[at[of]].astype(np.uint64) * _P5), 11) * _P1
            at[of] += 1
            left[of] -= 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts, and where each begins and the last ends."""
    n = len(texts)
    texts = texts.fill_null("").cast(pa.large_string())
    _, where, buffer = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None and n else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(texts: pa.Array, empty: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word of ``texts``, in order; a null text has none. With ``empty``, those of the empty word of each row."""
    n = len(texts)
    if empty:
        return np.arange(n), _xxhash64(np.zeros(0, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64))
    data, offsets = _bytes(texts)
    space = _SPACE[data]
    for lead in {w[0] for w in _WIDE}:
        at = np.flatnonzero(data == lead)
        for size in (2, 3):
            there = at[at + size <= len(data)]
            for sequence in (w for w in _WIDE if w[0] == lead and len(w) == size):
                match = there[np.logical_and.reduce([data[there + k] == sequence[k] for k in range(1, size)])]
                for k in range(size):
                    space[match + k] = True
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = ~space
    begins, ends = word[1:] & ~word[:-1], word[:-1] & ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    joined = inner[word[inner] & word[inner + 1]]  # the last word of a text and the first of the next
    begins[joined] = ends[joined] = True
    starts = np.flatnonzero(begins)
    return np.searchsorted(offsets, starts, "right") - 1, _xxhash64(data, starts, np.flatnonzero(ends) - starts)


#: Codes of runs of three characters that are counted or looked up by a table, at most; more are sorted.
_DENSE = 1 << 22


def _char_hash(seeds: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """XXH64 of one character each, whose UTF-8 bytes are those of a little-endian number."""
    sizes = 1 + sum((chars > np.uint32(v)).astype(np.int64) for v in (0x7F, 0xFFFF, 0xFFFFFF))
    wide = chars.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = seeds + _P5 + sizes.astype(np.uint64)
        for b in range(3):
            byte = (wide >> np.uint64(8 * b)) & np.uint64(0xFF)
            h = np.where((sizes < 4) & (sizes > b), _turned(h ^ (byte * _P5), 11) * _P1, h)
        h = np.where(sizes == 4, _turned(h ^ (wide * _P1), 23) * _P2 + _P3, h)
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


class Trigrams:
    """Runs of three characters of texts. ``codes`` has one of each character's place, for the run that begins there (the last
    two of a text have none of their own); text ``i`` has the runs from ``first[i]`` to before ``end[i]``."""

    def __init__(self, texts: pa.Array):
        data, offsets = _bytes(texts)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        padded = np.concatenate([data, np.zeros(4, np.uint8)])
        chars = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))[at]
        lead = data[at]
        chars = chars & np.where(lead < 0x80, 0xFF, np.where(lead < 0xE0, 0xFFFF, np.where(lead < 0xF0, 0xFFFFFF, 0xFFFFFFFF))).astype(np.uint32)
        short = chars < 1 << 16
        seen = np.zeros(1 << 16, bool)
        seen[chars[short]] = True
        self._chars = np.flatnonzero(seen).astype(np.uint32)
        numbers = np.zeros(1 << 16, np.int64)
        numbers[self._chars] = np.arange(len(self._chars))
        place = numbers[np.where(short, chars, 0)]
        if not short.all():
            others, place[~short] = np.unique(chars[~short], return_inverse=True)
            place[~short] += len(self._chars)
            self._chars = np.concatenate([self._chars, others])
        self._n = k = max(len(self._chars), 1)
        place = np.concatenate([place, np.zeros(2, np.int64)])
        self.codes = (place[:-2] * k + place[1:-1]) * k + place[2:]
        edges = np.searchsorted(at, offsets)
        self.first, self.end = edges[:-1], np.maximum(edges[1:] - 2, edges[:-1])

    def ids(self, codes: np.ndarray) -> np.ndarray:
        """Spark's ``xxhash64`` of the three characters of each code."""
        k, h = self._n, np.full(len(codes), np.uint64(_SEED))
        for number in (codes // (k * k), codes // k % k, codes % k):
            h = _char_hash(h, self._chars[number])
        return h

    def counts(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs of the texts that ``of`` is true for, and how often each occurs."""
        change = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(change, self.first[of], 1)
        np.add.at(change, self.end[of], -1)
        codes = self.codes[np.cumsum(change)[:-1] > 0]
        if self._n**3 <= _DENSE:
            n = np.bincount(codes, minlength=1)
            found = np.flatnonzero(n)
            return self.ids(found), n[found]
        found, n = np.unique(codes, return_counts=True)
        return self.ids(found), n

    def sums(self, values) -> list[np.ndarray]:
        """Per text the sums over its runs of each array that ``values`` gives for an array of ids."""
        if self._n**3 <= _DENSE:
            found, codes, size = np.flatnonzero(np.bincount(self.codes, minlength=1)), self.codes, self._n**3
        else:
            found, codes = np.unique(self.codes, return_inverse=True)
            size = len(found)
        places, out = found if codes is self.codes else np.arange(size), []
        for value in values(self.ids(found)):
            table = np.zeros(size, np.int64)
            table[places] = value
            total = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(table[codes], out=total[1:])
            out.append(total[self.end] - total[self.first])
        return out
