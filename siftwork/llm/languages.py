"""Language identification by the nearest of several centroids per language.

A text is a vector of the byte trigrams of its words (words are runs of letters and of bytes from 0x80, A-Z count as a-z, a
word's ends count as blanks), hashed into ``SLOTS``, with weights ``log(1 + tf) * idf``, scaled to length 1. The vectors of each
language's texts are clustered by spherical k-means, and a text gets the language of the centroid with the largest cosine.
A text that is farther from its centroid than nearly all texts the centroid was made of is marked as rejected.

Document frequencies are counted in Spark over all texts to learn from. Centroids are fitted by numpy on a bounded sample of
them: of each language about as many rows, chosen by a hash, together ``MOST_ROWS`` at most; these vectors alone are collected. The
``MOST_LANGUAGES`` most frequent languages are learned. Scoring reads whole texts in blocks and needs no shuffle.

Defined results: a text without letters, a null one included, is ``und`` with score 0 and rejected, and so is every text if there is
nothing to learn from; a text that shares no trigram with any centroid gets score 0 and the first language in order, rejected;
equal cosines go to the first language in order; rows to learn from need letters and a language, and a
language's rows may repeat; columns named like the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm.batches import views, with_text_columns
from siftwork.llm.tables import saved

#: Rows whose vectors are collected to fit the centroids, at most.
MOST_ROWS = 4_000
MOST_LANGUAGES = 1_000
SLOTS = 1 << 13
#: Texts whose vectors are held at a time, and bytes of one text that are counted at a time.
BLOCK_ROWS, PIECE = 256, 1 << 22
UNKNOWN = "und"


@dataclass(frozen=True)
class CentroidRule:
    centroids: int = 4
    rounds: int = 12
    #: Texts per centroid at least; a language with fewer texts has fewer centroids.
    least_texts: int = 8
    #: Share of a centroid's own texts that its limit of distance would reject.
    tail: float = 0.005


@dataclass(frozen=True)
class Model:
    languages: list[str]  # in order
    idf: np.ndarray
    centroids: np.ndarray  # (centroids, SLOTS), of length 1
    language: np.ndarray  # of each centroid
    nearest: np.ndarray  # least cosine that a centroid accepts


def _letters() -> np.ndarray:
    """Byte to lower-case letter or byte from 0x80; all others to a blank."""
    table = np.full(256, ord(" "), np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for c in range(26):
        table[ord("a") + c] = table[ord("A") + c] = ord("a") + c
    return table


class Counter:
    """Trigram counts of texts as dense rows."""

    def __init__(self):
        self.letters = _letters()

    def blocks(self, data: np.ndarray, offsets: np.ndarray):
        """``(first row, end row, counts)`` of blocks of the texts of a view."""
        for first in range(0, len(offsets) - 1, BLOCK_ROWS):
            end = min(first + BLOCK_ROWS, len(offsets) - 1)
            if end - first > 1 and offsets[end] - offsets[first] > PIECE:
                for row in range(first, end):
                    yield row, row + 1, self._counts(data, offsets[row:row + 2])
            else:
                yield first, end, self._counts(data, offsets[first:end + 1])

    def _counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if n > 1 or offsets[1] - offsets[0] <= PIECE:
            return self._piece(data[offsets[0]:offsets[-1]], offsets - offsets[0])
        found = np.zeros((1, SLOTS))
        for start in range(int(offsets[0]), int(offsets[1]), PIECE):
            stop = min(start + PIECE, int(offsets[1]))
            before, after = start > offsets[0], stop < offsets[1]
            part = data[start - before:stop + after]
            found += self._piece(part, np.array([0, len(part)]), before, after)
        return found

    def _piece(self, data: np.ndarray, offsets: np.ndarray, before: bool = False, after: bool = False) -> np.ndarray:
        """Counts of trigrams by the text of their middle byte; a byte before or after the piece is none's middle."""
        n = len(offsets) - 1
        row = np.repeat(np.arange(n), np.diff(offsets))
        padded = np.full(len(data) + n + 1, ord(" "), np.uint8)
        place = np.arange(len(data)) + row + 1
        padded[place] = self.letters[data]
        middle = padded[place] != ord(" ")
        if before and len(middle):
            middle[0] = False
        if after and len(middle):
            middle[-1] = False
        place, row = place[middle], row[middle]
        gram = (padded[place - 1].astype(np.uint32) << 16) | (padded[place].astype(np.uint32) << 8) | padded[place + 1]
        slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOTS.bit_length() + 1)
        return np.bincount(row * SLOTS + slot, minlength=n * SLOTS).reshape(n, SLOTS).astype(float)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts) * idf
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.maximum(length, 1e-12)


def _document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and in how many of them each slot occurs; a row per slot and task is shuffled."""

    def run(batches):
        count, total, n = Counter(), np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in views(batch.column("text")):
                for _, _, counts in count.blocks(data, offsets):
                    total += (counts > 0).sum(axis=0)
            n += batch.num_rows
        slots = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.append(total[slots[:-1]], n))], names=["slot", "n"])

    found = texts.select("text").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    total, n = np.zeros(SLOTS, np.int64), 0
    for r in found:
        if r["slot"] < 0:
            n = r["n"]
        else:
            total[r["slot"]] = r["n"]
    return n, total


def _sample(texts: DataFrame, key: str, most: int) -> DataFrame:
    """``(text, lang, _r)``: about the same number of rows of each language, by a hash that also is their order.

    The share of a language that is wanted follows from its count, so no language is brought together in a task.
    """
    counted = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    each = most * 0.9 / max(len(counted), 1)
    wanted = F.coalesce(*[F.when(F.col("lang") == r["lang"], each / r["n"]) for r in counted], F.lit(0.0))
    rows = texts.withColumn("_r", F.xxhash64(F.lit("sample"), key))
    rows = rows.where((F.col("_r") / 2.0**64 + 0.5) < wanted)
    return rows.orderBy("_r", "text").limit(most).select("text", "lang", "_r")


def cluster(rows: np.ndarray, rule: CentroidRule) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit vectors, and for each the least cosine of its vectors but for the tail."""
    k = max(1, min(rule.centroids, len(rows) // rule.least_texts))
    unit = lambda c: c / np.maximum(np.sqrt((c * c).sum(axis=-1, keepdims=True)), 1e-12)
    chosen = [int((rows @ unit(rows.sum(axis=0))).argmax())]
    while len(chosen) < k:  # the farthest from all that are chosen
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centers = rows[chosen]
    for _ in range(rule.rounds):
        own = (rows @ centers.T).argmax(axis=1)
        used = np.unique(own)
        centers = unit(np.array([rows[own == c].sum(axis=0) for c in used]))
    cosine = rows @ centers.T
    own = cosine.argmax(axis=1)
    nearest = [float(np.quantile(cosine[own == c, c], rule.tail)) if (own == c).any() else 1.0 for c in range(len(centers))]
    return centers, np.array(nearest)


def train(
    docs: DataFrame, rule: CentroidRule = CentroidRule(), key: str = "doc_id", text: str = "text", lang: str = "lang",
    most: int = MOST_ROWS,
) -> Model:
    """Centroids of the languages of ``docs``; rows without text or language are not used."""
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    texts = texts.where("text IS NOT NULL AND lang IS NOT NULL")
    n, found = _document_frequencies(texts)
    idf = np.log((n + 1) / (found + 1)) + 1
    sample = saved(_sample(texts, "_key", most), "language-sample")

    def run(batches):
        count = Counter()
        for batch in batches:
            for first, end, data, offsets in views(batch.column("text")):
                for a, b, counts in count.blocks(data, offsets):
                    rows = _weighted(counts, idf)
                    row, slot = np.nonzero(rows)
                    starts = np.searchsorted(row, np.arange(b - a + 1))
                    slots = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(slot, pa.int32()))
                    weights = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(rows[row, slot], pa.float32()))
                    part = batch.slice(first + a, b - a)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("lang"), part.column("_r"), slots, weights], names=["lang", "_r", "slots", "weights"]
                    )

    vectors = sample.mapInArrow(run, "lang string, _r bigint, slots array<int>, weights array<float>").toArrow().combine_chunks()
    names = np.array(vectors["lang"].to_pylist(), object)
    order = vectors["_r"].to_numpy()
    languages: list[str] = []
    centroids, language, nearest = [np.zeros((0, SLOTS))], [], []
    for name in sorted(set(names)):
        here = np.flatnonzero(names == name)
        part = vectors.take(pa.array(here[np.argsort(order[here], kind="stable")]))
        rows = np.zeros((part.num_rows, SLOTS))
        for r, (slots, weights) in enumerate(zip(part["slots"], part["weights"])):
            rows[r, slots.values.to_numpy()] = weights.values.to_numpy()
        rows = rows[rows.any(axis=1)]  # texts without letters teach nothing
        if len(rows):
            centers, least = cluster(rows, rule)
            centroids.append(centers), nearest.extend(least)
            language += [len(languages)] * len(centers)
            languages.append(name)
    return Model(languages, idf, np.concatenate(centroids), np.array(language, np.int64), np.array(nearest))


def with_language(
    df: DataFrame, model: Model, text: str = "text", name: str = "lang_pred", score: str = "score", rejected: str = "rejected"
) -> DataFrame:
    """``df`` with the language of a text, the cosine to its centroid, and whether that is too far away."""
    fields = f"{name} string, {score} double, {rejected} boolean"
    known = len(model.languages) > 0

    def make():
        count, transposed = Counter(), np.ascontiguousarray(model.centroids.T)
        names = pa.array(model.languages, pa.string())

        def run(data, offsets):
            n = len(offsets) - 1
            if not known:
                return [pa.array([UNKNOWN] * n), np.zeros(n), np.ones(n, bool)]
            best, cosine = np.zeros(n, np.int64), np.zeros(n)
            for first, end, counts in count.blocks(data, offsets):
                found = _weighted(counts, model.idf) @ transposed
                best[first:end] = found.argmax(axis=1)
                cosine[first:end] = found.max(axis=1)
            far = (cosine < model.nearest[best]) | (cosine <= 0)
            return [names.take(pa.array(model.language[best])), np.clip(cosine, 0, 1), far]

        return run

    found = with_text_columns(df, text, make, fields)
    blank = ~F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return found.withColumns({
        name: F.when(blank, UNKNOWN).otherwise(F.col(name)), score: F.when(blank, 0.0).otherwise(F.col(score)),
        rejected: blank | F.col(rejected),
    })
