"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the form that each rare one stands for.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Of a pair, the shorter word is cut
into two disjoint chunks. One edit touches one of them, so the other stands in the longer word, at its place or shifted by
one if the edit is an insertion before it. So the shorter word contributes its chunks, the longer one its grams of the
chunks' lengths at each place that a chunk can have within that shift, and both meet by gram and place. Pairs that meet are
verified by edit distance. (Chunks cover the word, so of all positional grams only those at its ends can meet one.)

A chunk many words share, such as a frequent ending, would bring all of them together. Where more than ``GROUP`` words meet,
what is left of the word, the window that must hold the edit, is cut into two chunks again: words of the group meet only
if one of these agrees as well. No pair is lost, since one edit leaves one of them whole. Windows end at one place, where a
group holds words that differ in one code point, all of them near. So candidates grow with the words and their near
pairs, not with the square of a group; keys with very many rows are salted before they are cut.

The form of a word is its near word of the largest count, if that is at least ``factor`` times the word's own; counts grow along
forms, so following them ends, at the root. Roots are found by doubling: each round replaces a form by its form's form.

Defined results: null and empty texts have no words; a null key of a document counts as the empty text in edits; repeated rows
count again; ties of forms go to the least word in code-point order; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.llm.tables import is_small, keyed_join, saved
from siftwork.operators.skew import salted_join

#: A run of letters: ASCII letters and the upper half of Latin-1.
RUN = r"[A-Za-zÀ-ÿ]+"
#: Words that may meet by one chunk before it is cut further.
GROUP = 64


@dataclass(frozen=True)
class SpellingRule:
    least_length: int = 6
    least_count: int = 5
    factor: int = 5


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(
    docs: DataFrame, rule: SpellingRule = SpellingRule(), key: str = "doc_id", text: str = "text",
    change: Callable[[Column, Column], Column] = lambda word, key: word,
) -> DataFrame:
    """``(word, n)`` of the lower-cased runs of all texts that are long and frequent enough.

    ``change(word, key)`` may rewrite a word by the document it stands in. Counting is partial in the task that reads.
    """
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = docs.select(named.alias("key"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.select("key", ascii_lower(F.col("run")).alias("run")).select(change(F.col("run"), F.col("key")).alias("word"))
    counted = words.where(F.length("word") >= rule.least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= rule.least_count)


def _window(word: Column, role: Column, shift: Column, start: Column, end: Column) -> Column:
    """A row of a word whose places ``start`` to ``end`` may hold the edit, keyed by all that stands around them.

    Places are those of the pair's shorter word. ``role`` is 0 for a chunk's word and 1 for a gram's word; of words of equal
    length, each has both roles and one row.
    """
    after = F.substring(word, end + F.when(role == 1, shift).otherwise(0) + 1, F.length(word))
    size = F.length(word) - F.when(role == 1, shift).otherwise(0)
    return F.struct(
        role.alias("role"), shift.alias("shift"), start.alias("start"), end.alias("end"),
        F.xxhash64(size, shift, start, end, F.substring(word, F.lit(1), start), after).alias("gram"),
    )


def _cut(word: Column, role: Column, shift: Column, start: Column, end: Column) -> Column:
    """The two windows that are left when one of the two chunks of a window is held fast."""
    middle = F.floor((start + end) / 2).cast("int")
    single = end - start == 1  # only an insertion before or after that place is left to tell apart
    return F.array(
        _window(word, role, shift, F.when(single, end).otherwise(middle), end),
        _window(word, role, shift, start, F.when(single, start).otherwise(middle)),
    )


def _may_be_cut() -> Column:
    return F.col("end") - F.col("start") + F.col("shift") > 1


def _first_rows(words: DataFrame, least: int) -> DataFrame:
    """Chunks of every word, and grams for words that are one shorter."""
    word, n = F.col("word"), F.length("word")
    zero, one = F.lit(0), F.lit(1)
    rows = F.concat(
        _cut(word, zero, zero, zero, n),
        _cut(word, zero, one, zero, n),
        F.when(n > least, _cut(word, one, one, zero, n - 1)).otherwise(F.array()),
    )
    return words.select("word", F.inline(rows))


def near_pairs(words: DataFrame, rule: SpellingRule = SpellingRule(), group: int = GROUP) -> DataFrame:
    """``(a, b)`` of all near pairs of distinct ``words`` (column ``word``), stored; ``a`` is the shorter or else lesser word."""
    rows, found = _first_rows(words, rule.least_length), None
    while True:
        rows = saved(rows, "chunks")
        one, chunk = F.col("role"), F.col("role") == 0
        counts = saved(
            rows.groupBy("gram").agg(
                F.count(F.lit(1)).alias("n"), F.max(one).alias("_grams"), F.min(one).alias("_chunks"),
                F.max("shift").alias("_shift"),
            ).where("n > 1 AND _chunks = 0 AND (_shift = 0 OR _grams = 1)").select("gram", "n"),
            "chunk-counts",
        )
        large = F.col("n") > group
        if is_small(counts):
            met = rows.join(F.broadcast(counts), "gram")
        else:
            met = salted_join(rows, counts, ["gram"], F.col("word"), counts=counts)
        met = saved(met.withColumn("cut", large & _may_be_cut()).drop("n"), "met")
        few = met.where("NOT cut")
        left = few.where(chunk).select("gram", "shift", F.col("word").alias("a"))
        right = few.where((F.col("role") == F.col("shift"))).select("gram", F.col("word").alias("b"))
        pairs = left.join(right, "gram").where("shift = 1 OR a < b").where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()
        found = saved(pairs if found is None else found.union(pairs).distinct(), "near")
        rows = met.where("cut").select("word", F.inline(_cut(*(F.col(c) for c in ("word", "role", "shift", "start", "end")))))
        if rows.isEmpty():
            return found


def forms(words: DataFrame, rule: SpellingRule = SpellingRule(), group: int = GROUP) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of a table of ``(word, n)`` with one row per word."""
    words = saved(words.select("word", "n"), "words")
    pairs = near_pairs(words, rule, group)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    counted = words.select(F.col("word").alias("other"), F.col("n").alias("_n"))
    near = both.join(counted, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_n")).alias("n"), "other")).alias("_best")
    )
    found = words.join(near, "word", "left").withColumn("_much", -F.col("_best.n") >= F.col("n") * rule.factor)
    found = saved(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("_much"), F.col("_best.other")).alias("form"), F.when(F.col("_much"), -F.col("_best.n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("up")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("up", "word")).drop("up")


def _roots(steps: DataFrame) -> DataFrame:
    """``(word, up)`` with the last word of the chain that ``steps`` (``word``, ``up``) make from each word."""
    steps = saved(steps, "steps")
    while True:
        onward = steps.select(F.col("word").alias("up"), F.col("up").alias("_top"))
        moved = keyed_join(steps, onward, ["up"], F.col("word"), "left").select(
            "word", F.coalesce("_top", "up").alias("up"), F.col("_top").isNotNull().alias("_moved")
        )
        moved = saved(moved, "steps")
        steps = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return steps
