"""Linear text classifiers trained and applied as Spark jobs.

A model is a table with one row per feature and one column of log-probabilities per class. One feature, the bias, is present
once in every document and carries the class priors. Training is one
grouped count over exploded features; applying it is an explode, a join with the model and a grouped sum. Weights are
fixed-point integers, so sums do not depend on the order of rows and results are the same for any partitioning.

Every feature that occurs ``min_count`` times belongs to the model. Its most frequent features are sent to every task, which sums
their weights inside the row; of a larger model only the features that are left are shuffled, as numbers, to meet the rest of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions import text as T
from siftwork.functions.word_hashes import Trigrams, word_hashes
from siftwork.operators.skew import lookup_join, salted_join
from siftwork.session import materialize

#: Fixed-point unit of log-probabilities.
UNIT = 1_000_000
#: Features of a model that are sent to every task: its most frequent ones.
FREQUENT = 1 << 20
#: Bytes of text a task works on at a time; a longer text is worked on alone.
STRETCH = 1 << 23


@dataclass(frozen=True)
class FeatureNames:
    """Features as strings: ``prepare`` runs once per text, ``expand`` turns its result into an array of names."""

    prepare: Callable[[Column], Column]
    expand: Callable[[Column], Column]

    #: SQL for "this row is the bias".
    is_bias = "feature = ''"

    def explode(self, df: DataFrame, text: str, *keep: str, when: Column | None = None) -> DataFrame:
        """``(*keep, feature)``; texts for which ``when`` is false get the bias feature only."""
        source = F.col(text) if when is None else F.when(when, F.col(text))
        # a projection of its own, so that the prepared value is not recomputed for every use in the array
        prepared = df.select(*keep, self.prepare(source).alias("_prepared"))
        found = F.concat(F.array(F.lit("")), F.coalesce(self.expand(F.col("_prepared")), F.array().cast("array<string>")))
        return prepared.select(*keep, F.explode(found).alias("feature"))


@dataclass(frozen=True)
class FeatureIds:
    """Features as 64-bit hashes, which are cheaper to make, join and group than strings.

    ``units`` turns a text into an array of strings (words, characters); ``ids`` turns each ``width`` units in a row, null beyond the
    end, into hashes, null for none. Everything after ``units`` is generated code. The empty unit, first in every text, is the bias.
    """

    units: Callable[[Column], Column]
    width: int
    ids: Callable[..., list[Column]]

    is_bias = "feature = xxhash64('')"

    def explode(self, df: DataFrame, text: str, *keep: str, when: Column | None = None) -> DataFrame:
        """``(*keep, feature)``; texts for which ``when`` is false get the bias feature only."""
        source = F.col(text) if when is None else F.when(when, F.col(text))
        units = F.concat(F.array(F.lit("")), F.coalesce(self.units(source), F.array().cast("array<string>")))
        names = [f"_u{i}" for i in range(self.width)]
        runs = F.arrays_zip(*[F.slice("_units", F.lit(i + 1), F.lit(1 << 30)).alias(n) for i, n in enumerate(names)])
        rows = df.select(*keep, units.alias("_units")).select(*keep, F.inline(runs).alias(*names))
        found = rows.select(*keep, F.explode(F.array(*self.ids(*map(F.col, names)))).alias("feature"))
        return found.where("feature IS NOT NULL")


@dataclass(frozen=True)
class TrigramIds(FeatureIds):
    """Runs of three characters as ids. ``spelled`` is the text they are read from; where texts are counted or scored, it travels,
    and a task finds and hashes the runs of many texts at a time."""

    spelled: Callable[[Column], Column]


@dataclass(frozen=True)
class WordIds:
    """Lower-cased words and neighbouring word pairs as 64-bit ids: a word's hash, and a mix of the hashes of a pair.

    ``words`` turns a text into an array of words. Where texts are counted or scored they travel in lower case, and a task finds
    and hashes the words of many texts at a time. The empty word, first in every text, is the bias.
    """

    words: Callable[[Column], Column]

    is_bias = "feature = xxhash64('')"

    def hashes(self, text: Column) -> Column:
        return F.transform(F.coalesce(self.words(text), F.array().cast("array<string>")), lambda w: F.xxhash64(w))

    def explode(self, df: DataFrame, text: str, *keep: str, when: Column | None = None) -> DataFrame:
        """``(*keep, feature)``; texts for which ``when`` is false get the bias feature only."""
        source = F.col(text) if when is None else F.when(when, F.col(text))
        hashed = df.select(*keep, F.explode(F.array(self.hashes(source))).alias("_words"))
        second = F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0)))
        first = F.slice("_words", F.lit(1), F.size(second))
        pairs = F.zip_with(first, second, _pair_id)
        return hashed.select(*keep, F.explode(F.concat(F.array(F.xxhash64(F.lit(""))), F.col("_words"), pairs)).alias("feature"))


FeatureSet = FeatureNames | FeatureIds | TrigramIds | WordIds


def _pair_id(a: Column, b: Column) -> Column:
    """The order of the words counts: the first one's hash is turned by 21 bits."""
    turned = F.shiftleft(a, 21).bitwiseOR(F.shiftrightunsigned(a, 43))
    return turned.bitwiseXOR(b)


def _word_pairs(words: Column) -> Column:
    count = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, count), F.slice(words, 2, count), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def _flat_words(flat: Column) -> Column:
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(F.lower(flat), " "))


def _letters(text: Column) -> Column:
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


#: Lower-cased words and neighbouring word pairs, by name.
WORD_NAMES = FeatureNames(lambda text: T.words(F.lower(T.one_line(text))), _word_pairs)
#: The same as ids; and those of a text whose white space is flattened already.
WORDS = WordIds(lambda text: T.words(F.lower(T.one_line(text))))
FLAT_WORDS = WordIds(_flat_words)
#: Character trigrams of the lower-cased words with one space around each.
TRIGRAMS = TrigramIds(
    lambda text: F.split(_letters(text), ""), 3, lambda a, b, c: [F.when(a == "", F.xxhash64(a)).when(c.isNotNull(), F.xxhash64(a, b, c))],
    _letters,
)


@dataclass(frozen=True)
class Head:
    """One classification task: its classes in order, and how sharp its scores are."""

    label: str
    classes: tuple[str, ...]
    sharpness: float

    def count(self, i: int) -> str:
        return f"n_{self.label}_{i}"

    def weight(self, i: int) -> str:
        return f"w_{self.label}_{i}"


def feature_counts(
    df: DataFrame, heads: tuple[Head, ...], features: FeatureSet, text: str = "text"
) -> DataFrame:
    """Occurrences of every feature in each class of each head; frequent features are combined map-side."""
    if isinstance(features, WordIds):
        return _task_counts(df, heads, F.lower(F.col(text)), _word_counts)
    if isinstance(features, TrigramIds):
        return _task_counts(df, heads, features.spelled(F.col(text)), _trigram_counts)
    rows = features.explode(df, text, *[h.label for h in heads])
    counts = [
        F.expr(f"count_if({h.label} = '{c}') AS {h.count(i)}") for h in heads for i, c in enumerate(h.classes)
    ]
    return rows.groupBy("feature").agg(*counts, F.count(F.lit(1)).alias("total"))


def _task_counts(df: DataFrame, heads: tuple[Head, ...], spelled: Column, counted) -> DataFrame:
    """:func:`feature_counts` where a task counts many texts at a time, so a row stands for many occurrences. ``counted`` gives
    ids and their numbers for the rows of each value of an array of classes."""
    names = [h.count(i) for h in heads for i in range(len(h.classes))]
    within = [F.coalesce(F.col(h.label) == c, F.lit(False)).alias(h.count(i)) for h in heads for i, c in enumerate(h.classes)]
    narrow = df.select(spelled.alias("_text"), *within)
    stretch = STRETCH

    def run(batches):
        for batch in _gathered(batches, stretch):
            for part in _stretches(batch, stretch):
                # the rows of the same classes together
                within = np.stack([np.zeros(part.num_rows, bool), *(part.column(n).to_numpy(zero_copy_only=False) for n in names)]).view(np.uint8)
                _, first, kind = np.unique(within, axis=1, return_index=True, return_inverse=True)
                for k, (ids, total) in enumerate(counted(part, kind.ravel(), len(first))):
                    counts = [pa.array(total * int(part.column(n)[int(first[k])].as_py())) for n in names]
                    yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), *counts, pa.array(total)], names=["feature", *names, "total"])

    rows = narrow.mapInArrow(run, ", ".join(f"{n} bigint" for n in ("feature", *names, "total")))
    return rows.groupBy("feature").agg(*[F.sum(n).alias(n) for n in (*names, "total")])


def _word_counts(part: pa.RecordBatch, kind: np.ndarray, kinds: int):
    owner, found = _features(part)
    for k in range(kinds):
        ids = np.sort(found[(kind == k)[owner]])  # cheaper than finding the place of each
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        yield ids[first], np.diff(np.append(first, len(ids)))


def word_bags(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """``(*keep, feature, c)``: occurrences of words and pairs (:class:`WordIds`), a row for each feature of a text; a null text has the bias only."""
    narrow = df.select(*keep, F.lower(F.col(text)).alias("_text"))
    stretch = STRETCH

    def run(batches):
        for batch in batches:
            for part in _stretches(batch, stretch):
                owner, found = _features(part)
                order = np.lexsort((found, owner))
                owner, found = owner[order], found[order]
                first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])]))
                at = pa.array(owner[first])
                columns = [part.column(c).take(at) for c in keep]
                times = np.diff(np.append(first, len(found)))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found[first].view(np.int64)), pa.array(times)], names=[*keep, "feature", "c"])

    schema = narrow.select(*keep, F.lit(0).cast("long").alias("feature"), F.lit(0).cast("long").alias("c")).schema
    return narrow.mapInArrow(run, schema)


def _trigram_counts(part: pa.RecordBatch, kind: np.ndarray, kinds: int):
    runs = Trigrams(part.column("_text"))
    for k in range(kinds):
        ids, total = runs.counts(kind == k)
        yield np.append(ids, _bias_id()), np.append(total, np.count_nonzero(kind == k))


def _bias_id() -> np.ndarray:
    return word_hashes(pa.array([""]), empty=True)[1]


def _gathered(batches, most: int):
    """Batches put together until their texts have ``most`` bytes, so that more occurrences of a feature meet."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += int(_lengths(batch).sum())
        if size >= most:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def _lengths(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _stretches(batch: pa.RecordBatch, most: int):
    """Runs of rows with texts of at most ``most`` bytes, or one row."""
    ends = np.cumsum(_lengths(batch))
    first = 0
    while first < batch.num_rows:
        end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, "right")))
        yield batch.slice(first, end - first)
        first = end


def _features(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row and id of all features of rows of lower-cased texts: the bias, the words and the pairs, ids as unsigned numbers."""
    owner, words = word_hashes(part.column("_text"))
    rows = np.arange(part.num_rows)
    inside = owner[1:] == owner[:-1]
    turned = (words << np.uint64(21)) | (words >> np.uint64(43))  # as in _pair_id
    bias = np.full(part.num_rows, _bias_id()[0])
    return np.concatenate([rows, owner, owner[1:][inside]]), np.concatenate([bias, words, (turned[:-1] ^ words[1:])[inside]])


def train(
    df: DataFrame,
    heads: tuple[Head, ...],
    features: FeatureSet,
    text: str = "text",
    min_count: int = 2,
) -> DataFrame:
    """Multinomial naive Bayes for all heads in one pass: ``feature``, counts and a weight column per class, stored.

    The bias row holds the log priors; the others log((n + 1) / (N + V)) with N and V taken over the vocabulary.
    """
    counts = feature_counts(df, heads, features, text)
    vocabulary = materialize(counts.where((F.col("total") >= min_count) | F.expr(features.is_bias)))
    pairs = [(h, i) for h in heads for i in range(len(h.classes))]
    words = ~F.expr(features.is_bias)
    sums = vocabulary.agg(
        F.count_if(words).alias("v"), *[F.sum(F.when(words, F.col(h.count(i))).otherwise(0)).alias(h.count(i)) for h, i in pairs]
    ).first()
    weights = []
    for h, i in pairs:
        n, documents = h.count(i), " + ".join(h.count(j) for j in range(len(h.classes)))
        weights.append(
            f"""cast(round({UNIT} * if({features.is_bias}, ln(({n} + 1) / ({documents} + {len(h.classes)})),
                ln(({n} + 1) / {(sums[n] or 0) + sums["v"]}L))) AS bigint) AS {h.weight(i)}"""
        )
    return vocabulary.selectExpr("*", *weights)


def score_sums(
    df: DataFrame,
    model: DataFrame,
    heads: tuple[Head, ...],
    features: FeatureSet,
    keep: list[str],
    text: str = "text",
    when: Column | None = None,
    unknown: bool = False,
) -> DataFrame:
    """Sums of weights per document, and ``_n``, its known features. ``keep`` (the key and small columns derived from the
    row) rides along as grouping key, so nothing has to be joined back; only these sums leave the map tasks. With
    ``unknown``, ``_all`` counts all features."""
    wanted = [h.weight(i) for h in heads for i in range(len(h.classes))]
    if isinstance(features, WordIds):
        return weight_sums(df, model, wanted, features, keep, text, when, unknown)
    if isinstance(features, TrigramIds) and model.count() * len(wanted) <= FREQUENT * 8:
        return _trigram_sums(df, model, wanted, features, keep, text, when, unknown)
    found = features.explode(df, text, *keep, when=when)
    known = lookup_join(found, model.select("feature", *wanted), ["feature"], F.col(keep[0]), "left" if unknown else "inner")
    sums = [F.expr(f"sum({w}) AS {w}") for w in wanted]
    counts = [F.count(wanted[0]).alias("_n"), F.count(F.lit(1)).alias("_all")]
    return known.groupBy(*keep).agg(*sums, *counts[:1 + unknown])


def _trigram_sums(
    df: DataFrame, model: DataFrame, wanted: list[str], features: TrigramIds, keep: list[str], text: str, when: Column | None, unknown: bool
) -> DataFrame:
    """:func:`score_sums` for runs of characters and a model that fits into a task."""
    names = [*wanted, "_n", "_all"]
    source = F.col(text) if when is None else F.when(when, F.col(text))
    narrow = df.select(*keep, features.spelled(source).alias("_text"))
    table = model.select("feature", *wanted).toArrow()
    order = np.argsort(table["feature"].to_numpy().view(np.uint64))
    known = table["feature"].to_numpy().view(np.uint64)[order]
    weights, stretch = [table[w].to_numpy()[order] for w in wanted], STRETCH

    def values(ids):
        place = np.searchsorted(known, ids)
        hit = np.zeros(len(ids), bool)
        inside = place < len(known)
        hit[inside] = known[place[inside]] == ids[inside]
        for w in weights:
            value = np.zeros(len(ids), np.int64)
            value[hit] = w[place[hit]]
            yield value
        yield hit

    def run(batches):
        bias = [int(v[0]) for v in values(_bias_id())]
        for batch in batches:
            for part in _stretches(batch, stretch):
                runs = Trigrams(part.column("_text"))
                columns = [a + b for a, b in zip(runs.sums(values), bias)] + [runs.end - runs.first + 1]
                out = [c for c in batch.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in out), *map(pa.array, columns)], names=[*out, *names])

    found = narrow.mapInArrow(run, narrow.select(*keep, *[F.lit(0).cast("long").alias(n) for n in names]).schema)
    return _summed(found, keep, wanted, unknown)


def weight_sums(
    df: DataFrame, model: DataFrame, wanted: list[str], features: WordIds, keep: list[str], text: str = "text",
    when: Column | None = None, unknown: bool = False,
) -> DataFrame:
    """:func:`score_sums` for words and pairs: the frequent features are summed inside the row.

    If the model has others, a row is stored with its sums and the features that may be among those, and these meet the rest of
    the model by a shuffle of two numbers each. A feature that is hot by its count in training is salted.
    """
    names = [*wanted, "_n", "_all"]
    source = F.col(text) if when is None else F.when(when, F.col(text))
    narrow = df.select(*keep, F.lower(source).alias("_text"))
    least = _frequent_from(model)
    frequent, whole = (_level(F.col("total")) >= least) | F.expr(features.is_bias), least == 0
    top = model.where(frequent).select("feature", *wanted).toArrow()  # at most FREQUENT rows and the bias
    rare = model.where(~frequent)
    summed = narrow.mapInArrow(
        _frequent_sums(top, wanted, None if whole else _member_bits(rare)),
        narrow.select(*keep, *[F.lit(0).cast("long").alias(n) for n in names], F.lit(None).cast("array<bigint>").alias("_rest")).schema,
    )
    if whole:
        found = summed.drop("_rest")
    else:
        stored = materialize(summed.withColumn("_row", F.monotonically_increasing_id()))
        rows = stored.select("_row", F.explode("_rest").alias("feature"))
        met = salted_join(
            rows, rare.select("feature", *wanted), ["feature"], F.col("_row"), counts=rare.select("feature", F.col("total").alias("n")),
            hint="shuffle_hash",
        )
        more = met.groupBy("_row").agg(*[F.sum(w).alias(f"_m{i}") for i, w in enumerate(wanted)], F.count(F.lit(1)).alias("_more"))
        found = stored.drop("_rest").join(more, "_row", "left").select(
            *keep, *[(F.col(w) + F.coalesce(f"_m{i}", F.lit(0))).alias(w) for i, w in enumerate(wanted)],
            (F.col("_n") + F.coalesce("_more", F.lit(0))).alias("_n"), "_all",
        )
    return _summed(found, keep, wanted, unknown)


def _summed(found: DataFrame, keep: list[str], wanted: list[str], unknown: bool) -> DataFrame:
    """Sums of the rows of equal ``keep``, as :func:`score_sums` gives them."""
    sums = [F.expr(f"sum(if(_n > 0, {w}, NULL)) AS {w}") for w in wanted]
    result = found.groupBy(*keep).agg(*sums, F.sum("_n").alias("_n"), F.sum("_all").alias("_all"))
    return result if unknown else result.where("_n > 0").drop("_all")


def _level(total: Column) -> Column:
    """Counts on a scale of 16 steps per doubling, from 1."""
    return F.floor(F.log2(total.cast("double")) * 16) + 1


def _frequent_from(model: DataFrame) -> int:
    """The least level whose features, with those of higher ones, are at most ``FREQUENT``; 0 if all features are."""
    levels = model.groupBy(_level(F.col("total")).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()  # a thousand rows at most
    n, least = 0, 0
    for level, count in sorted(levels, reverse=True):
        n += count
        if n > FREQUENT:
            return least or level + 1
        least = level
    return 0


#: Bits of a feature by which its place among the frequent ones is looked up.
_LEADING = 20


def _places(known: np.ndarray, starts: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each feature is in ``known`` (ascending), and whether it is there. ``starts`` has the first place of each leading
    bits; as features are hashes, only a few share them, and these are compared one after the other."""
    place = starts[found >> np.uint64(64 - _LEADING)]
    ended = np.append(known, ~np.uint64(0))  # so that every place has a value; none is less than the last
    there = ended[place]
    hit = there == found
    left = np.flatnonzero(there < found)
    while len(left):
        place[left] += 1
        there, wanted = ended[place[left]], found[left]
        hit[left] = there == wanted
        left = left[there < wanted]
    hit &= place < len(known)
    return place, hit


#: Bits of the table that tells which features a model may hold besides its frequent ones, and where a feature's two bits begin.
MEMBER_BITS, _MEMBER_SHIFTS = 1 << 27, (0, 27)


def _member_bits(features: DataFrame) -> np.ndarray:
    """Bytes of ``MEMBER_BITS`` bits, of which each feature sets two: most features that are not there lack one of theirs."""
    places = [F.shiftrightunsigned("feature", s).bitwiseAND(F.lit(MEMBER_BITS - 1)) for s in _MEMBER_SHIFTS]
    bits = features.select(F.explode(F.array(*places)).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    words = bits.groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(MEMBER_BITS // 64, "<i8")
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint8)


def _may_be_members(table: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Places of the features whose bits are both set."""
    at = np.arange(len(features))
    for shift in _MEMBER_SHIFTS:
        bit = (features[at] >> np.uint64(shift)) & np.uint64(MEMBER_BITS - 1)
        at = at[(table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


def _frequent_sums(top: pa.Table, wanted: list[str], members: np.ndarray | None):
    """Sums of the weights of ``top`` per row of hashed words, how many features have one and how many there are, and those of the
    others that may be among ``members``."""
    order = np.argsort(top["feature"].to_numpy().view(np.uint64))
    known = top["feature"].to_numpy().view(np.uint64)[order]
    weights, stretch = [top[w].to_numpy()[order] for w in wanted], STRETCH
    starts = np.searchsorted(known, np.arange(1 << _LEADING, dtype=np.uint64) << np.uint64(64 - _LEADING))

    def run(batches):
        for batch in batches:
            for part in _stretches(batch, stretch):
                owner, found = _features(part)
                rows = np.arange(part.num_rows + 1)
                place, hit = _places(known, starts, found)
                at, of = place[hit], owner[hit]
                # sums of whole numbers below 2^53, so floating point has them exactly
                columns = [pa.array(np.bincount(of, w[at], part.num_rows).astype(np.int64)) for w in weights]
                columns += [pa.array(np.bincount(of, minlength=part.num_rows)), pa.array(np.bincount(owner, minlength=part.num_rows))]
                left = np.flatnonzero(~hit) if members is not None else np.zeros(0, np.int64)
                if len(left):
                    left = left[_may_be_members(members, found[left])]
                by_row = np.argsort(owner[left], kind="stable")
                edge = np.searchsorted(owner[left][by_row], rows).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(edge), pa.array(found[left][by_row].view(np.int64)))
                out = [c for c in batch.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in out), *columns, rest], names=[*out, *wanted, "_n", "_all", "_rest"])

    return run


def scores(
    df: DataFrame,
    model: DataFrame,
    heads: tuple[Head, ...],
    features: FeatureSet,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, <head>_label, <head>_score)`` of every document.

    The score is the softmax of the mean weight over the known features, sharpened by the head's factor; ties go
    to the class listed first.
    """
    return score_sums(df, model, heads, features, [key], text).select(key, *verdicts(heads))


def verdicts(heads: tuple[Head, ...]) -> list[Column]:
    """Label and score columns of all heads, from the sums of :func:`score_sums`."""
    return [c for h in heads for c in _verdict(h)]


def _verdict(h: Head) -> list[Column]:
    sums = [h.weight(i) for i in range(len(h.classes))]
    best = f"greatest({', '.join(sums)})" if len(sums) > 1 else sums[0]
    label = " ".join(f"WHEN {s} = {best} THEN '{c}'" for s, c in zip(sums, h.classes, strict=True))
    mass = " + ".join(f"exp(({s} - {best}) * {h.sharpness}D / (_n * {UNIT}D))" for s in sums)
    return [F.expr(f"CASE {label} END AS {h.label}_label"), F.expr(f"round(1 / ({mass}), 6) AS {h.label}_score")]


def evaluate(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """n, precision_at_1 and recall_at_1 (equal, as every row has one label and one prediction)."""
    right = F.count_if(F.col(truth) == F.col(predicted))
    n = F.count(F.lit(1))
    share = F.round(F.when(n > 0, right / n).otherwise(F.lit(0.0)), 6)
    return df.agg(n.alias("n"), share.alias("precision_at_1"), share.alias("recall_at_1"))


QUALITY = Head("quality", ("cc", "wiki"), 4.0)
TOXIC = Head("toxic", ("non-toxic", "toxic"), 10.0)
NSFW = Head("nsfw", ("non-nsfw", "nsfw"), 10.0)


def with_named_labels(df: DataFrame, names: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Turn 0/1 label columns into class names: ``{column: (name of 0, name of 1)}``."""
    return df.withColumns(
        {c: F.when(F.col(c) == 1, one).when(F.col(c) == 0, zero) for c, (zero, one) in names.items()}
    )
