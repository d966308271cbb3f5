"""Vectorised views on Arrow batches of texts, shared by the operators that run numpy inside tasks.

A view holds the UTF-8 bytes of some documents and everything is computed for all of them at once: words are runs of
ASCII letters and digits and of all bytes from 0x80, letters A-Z count as a-z. Hashes are 64-bit polynomials over a
table of random values per byte, so equal words have equal hashes in every task of every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer document is a view of its own.
VIEW_BYTES = 1 << 21
BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_values(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(mix_int(seed)))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & _MASK], dtype=np.uint64))[0])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Powers:
    """Powers of the polynomial base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = _powers(BASE, 1)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, VIEW_BYTES + 1)
            self.up, self.down = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]


def byte_classes() -> np.ndarray:
    """Byte to lower-case byte for word bytes, to 0 for the others."""
    table = np.zeros(256, dtype=np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    for c in range(26):
        table[ord("a") + c] = table[ord("A") + c] = ord("a") + c
    return table


#: Rows of a view, so that a row fits into 16 bits.
VIEW_ROWS = 1 << 16


def views(texts: pa.Array, most: int = VIEW_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of rows holding at most ``most`` bytes or one row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    texts = texts.fill_null("").cast(pa.large_string())
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        end = min(end, first + VIEW_ROWS, len(texts))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


class Words:
    """Word positions and hashes of one view. ``of`` has the first word of each document and the end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, powers: Powers, classes: np.ndarray, seeds: np.ndarray):
        low = classes[data]
        word = low != 0
        begins, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        begins[:-1] = word
        begins[1:-1] &= ~word[:-1]
        ends[1:] = word
        ends[1:-1] &= ~word[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        joined = inner[word[inner] & word[inner - 1]]
        begins[joined] = ends[joined] = True
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends)
        self.of = np.searchsorted(self.starts, offsets)
        up, down = powers.to(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(seeds[low] * up[:-1], out=total[1:])
        self._total, self._down = total, down
        self.hashes = self._hash(self.starts, self.ends)

    def _hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._total[ends] - self._total[starts]) * self._down[starts])

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of more than ``n`` bytes, and the hashes of their first ``n`` bytes."""
        longer = np.flatnonzero(self.ends - self.starts > n)
        return longer, self._hash(self.starts[longer], self.starts[longer] + n)

    def shingles(self, n: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words inside a document, and the first of each document and the end.

        With ``whole`` a document of fewer than ``n`` words, but not none, has one shingle of all its words.
        """
        h, of = self.hashes, self.of
        counts = np.diff(of)
        if len(h) == 0:
            return h, np.zeros(len(of), np.int64)
        padded = np.concatenate([h, np.zeros(n - 1, np.uint64)])
        sums = np.zeros(len(h), np.uint64)
        for j in range(n):
            sums = sums * np.uint64(BASE) + padded[j:j + len(h)]
        there = np.maximum(counts - (n - 1), 0)
        if whole:
            for d in np.flatnonzero((counts > 0) & (counts < n)):
                total = int(counts[d])
                for x in h[of[d]:of[d + 1]].tolist():
                    total = (total * BASE + x) & _MASK
                sums[of[d]] = total
            there[(counts > 0) & (counts < n)] = 1
        kept = np.ones(len(h), bool)
        if len(h):
            steps = np.zeros(len(h) + 1, np.int64)
            cut = np.flatnonzero(there < counts)
            np.add.at(steps, of[cut] + there[cut], 1)
            np.add.at(steps, of[cut + 1], -1)
            kept = np.cumsum(steps)[:-1] == 0
        return mix(sums[kept]), np.concatenate([[0], np.cumsum(there)])


class WordReader:
    """Makes :class:`Words` of views; one per task, so that tables are built once."""

    def __init__(self, seed: int = 336):
        self.powers, self.classes = Powers(), byte_classes()
        self.seeds = random_values(256, seed)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Words:
        return Words(data, offsets, self.powers, self.classes, self.seeds)


def distinct_grams(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit ids of the distinct values of each document in ascending order, and where each document's start."""
    n = len(starts) - 1
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(starts))
    keys = np.sort((owner << np.uint64(48)) | (hashes >> np.uint64(16)))
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys & np.uint64((1 << 48) - 1), np.searchsorted(keys >> np.uint64(48), np.arange(n + 1, dtype=np.uint64))


def with_text_columns(df, text: str, make, fields: str):
    """``df`` with columns computed from its texts by numpy.

    ``make()`` is called once per task and returns a function of ``(bytes, offsets)`` of a view, which returns one array
    per field of ``fields``. All other columns pass through, and columns of the same names are replaced; a null text counts
    as the empty one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(fields)
    replaced = {f.name.lower() for f in added}
    df = df.select(*[c for c in df.columns if c.lower() not in replaced])
    schema = StructType(df.schema.fields + added.fields)
    types = [f.type for f in to_arrow_schema(added)]
    names = schema.names

    def run(batches):
        compute = make()
        for batch in batches:
            where = batch.schema.get_field_index(text)
            for first, end, data, offsets in views(batch.column(where)):
                part = batch.slice(first, end - first)
                found = [pa.array(a) if not isinstance(a, pa.Array) else a for a in compute(data, offsets)]
                columns = [*part.columns, *[a.cast(t) for a, t in zip(found, types)]]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)


def list_array(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """An Arrow list per document from its values in order and the places where they start."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values))
