"""Statistics of whole texts as features of classifiers: shares of characters, words, lines and repetitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwork.llm.batches import WordReader, with_text_columns

#: Classes of bytes whose shares are features; every other byte is in class 0.
CLASSES = (
    "\n", " ", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "|",
    "*$%&#@^~+=<>", "-_/\\", "'\"`", ":;", "()[]{}",
)
NAMES = (
    ["log_words", "log_bytes", "word_length", "word_length_spread", "distinct_words", "distinct_shingles", "upper_words",
     "line_words", "lines_ended", "bytes_per_word", "short_words", "long_words"]
    + [f"share_{i}" for i in range(len(CLASSES) + 2)]
)
#: Further columns of the rows with letters.
LETTERS = 26 + 64


def _per_document(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def _distinct(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distinct values of each document."""
    n = len(starts) - 1
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(starts))
    bits = np.uint64(max(1, int(n).bit_length()))
    keys = np.sort((owner << (np.uint64(64) - bits)) | (hashes >> bits))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[new] >> (np.uint64(64) - bits)).astype(np.int64), minlength=n)


class Statistics:
    """Feature rows of a view; one per task."""

    def __init__(self):
        self.read = WordReader()
        self.classes = np.zeros(256, np.int64)
        for i, members in enumerate(CLASSES):
            self.classes[[ord(c) for c in members]] = i + 1
        self.classes[0x80:] = len(CLASSES) + 1

    def __call__(self, data: np.ndarray, offsets: np.ndarray, letters: bool = False) -> np.ndarray:
        """Rows in the order of ``NAMES``; with ``letters`` also the shares of each letter and of each second byte of
        the letters beyond ASCII."""
        n, k = len(offsets) - 1, len(CLASSES) + 2
        words = self.read(data, offsets)
        owner = np.repeat(np.arange(n), np.diff(offsets))
        counts = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
        shares = counts @ np.eye(k)[self.classes]
        size, count = np.maximum(np.diff(offsets), 1), np.diff(words.of)
        some = np.maximum(count, 1)
        length = (words.ends - words.starts).astype(np.float64)
        mean = _per_document(length, words.of) / some
        spread = np.sqrt(np.maximum(_per_document(length**2, words.of) / some - mean**2, 0))
        is_upper = np.concatenate([[0], np.cumsum(self.classes[data] == 4)])
        capital = (is_upper[words.ends] - is_upper[words.starts] == length) & (length > 1)
        shingles, of = words.shingles(5, whole=True)
        breaks = data == 10
        ended = np.zeros(len(data), bool)
        ended[1:] = breaks[1:] & np.isin(data[:-1], [ord(c) for c in ".!?"])
        lines = shares[:, 1] + 1
        columns = [
            np.log1p(count), np.log1p(np.diff(offsets)), mean, spread, _distinct(words.hashes, words.of) / some,
            _distinct(shingles, of) / np.maximum(np.diff(of), 1), _per_document(capital, words.of) / some, count / lines,
            _per_document(ended, offsets) / lines, size / some, _per_document(length <= 3, words.of) / some,
            _per_document(length >= 12, words.of) / some,
        ]
        rows = [*columns, shares / size[:, None]]
        if letters:
            rows.append((counts[:, 65:91] + counts[:, 97:123]) / size[:, None])
            rows.append(counts[:, 0x80:0xC0] / size[:, None])
        return np.column_stack(rows).astype(np.float32)


def with_statistics(df: DataFrame, text: str = "text", name: str = "features") -> DataFrame:
    """``df`` with ``name``: an array of floats in the order of ``NAMES``. An empty text has all zeros but few."""

    def make():
        compute = Statistics()

        def run(data, offsets):
            rows = compute(data, offsets)
            return [pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float32()))]

        return run

    return with_text_columns(df, text, make, f"{name} array<float>")
