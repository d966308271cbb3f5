"""Benchmark decontamination by a distributed positional inverted index.

The index holds postings ``(term, document, position)`` of training tokens. A benchmark phrase is looked up from its rarest
terms: their posting lists, each shifted by the term's place in the phrase, are intersected; what is left are starts at
which the whole phrase is compared. So a phrase costs as many postings as its rarest terms have, and common words, which
fill most of a corpus, need no list at all as long as a phrase has a rarer one.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z were lower-cased. A window is ``WINDOW`` consecutive words of an
item; an item of fewer words, but not none, is one window.

Defined results: a null text has no words, is contaminated by nothing and yields no window; equal windows of several items
count for each of them; rows with the same key, equal or not, have the matches of all of them, and the report has a row for
each; rows with a null key are left out of matches.

Only DataFrame operations are used. The index holds the postings of the benchmark's terms and is written once to the shared
folder. Texts are read to build it, and once more to compare phrases in documents in which the rarest terms of a phrase
meet at the right distance; if Spark cannot broadcast those candidates by its own size limit, it joins by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftwork.llm.tables import saved, small_side

WINDOW = 10
#: Posting lists that are intersected before a phrase is compared as a whole.
RAREST = 2
#: Stands for the end of a document in the index; no word has this character.
END = "\x00"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAPS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP_CHARACTERS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def words(text: Column) -> Column:
    """The words of a text; an empty array for none."""
    low = F.btrim(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()), F.lit(_GAP_CHARACTERS))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(F.split(low, _GAPS))


def with_words(df: DataFrame, text: str = "text", name: str = "words") -> DataFrame:
    """``df`` with the words of ``text``; a generator of one row keeps later lambdas from splitting the text again."""
    return df.withColumn(name, F.explode(F.array(words(F.col(text)))))


def windows(items: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``(item, window, phrase)``: the word windows of items, named by a hash of their words."""
    n = F.size("_words")
    found = with_words(items.select(item, text), text, "_words").where(n > 0)
    return found.select(
        item,
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), lambda i: F.slice(F.col("_words"), i + 1, F.lit(size))
            )
        ).alias("phrase"),
    ).select(item, F.xxhash64("phrase").alias("window"), "phrase").distinct()


def index(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of the training texts for ``terms``: ``(key, position, term)``, stored.

    Each document also has a posting of the term ``END`` at its number of words.
    """
    # words keep their case until they are rows: lower() is enough for those of ASCII letters only
    whole = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(whole, F.lit(_GAP_CHARACTERS))
    found = F.when(trimmed == "", F.array(F.lit(END))).otherwise(
        F.concat(F.split(trimmed, _GAPS_ANY_CASE), F.array(F.lit(END)))
    )
    rows = docs.select(key, F.posexplode(found).alias("position", "_word"))
    term = F.when(F.length("_word") == F.octet_length("_word"), F.lower("_word")).otherwise(
        F.translate("_word", _UPPER, _UPPER.lower())
    )
    wanted = saved(terms.select("term").union(terms.sparkSession.createDataFrame([(END,)], "term string")), "terms")
    return saved(rows.select(key, "position", term.alias("term")).join(small_side(wanted), "term").select(key, "position", "term"), "index")


def term_counts(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: how often each of ``terms`` occurs in all texts, 0 included."""
    counted = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_terms(phrases: DataFrame, counts: DataFrame, n: int = RAREST) -> DataFrame:
    """``(window, term, offset, rank, lists)``: of each phrase the ``n`` places with the rarest terms.

    ``lists`` is how many there are, fewer than ``n`` for phrases of fewer words.
    """
    places = phrases.select("window", F.posexplode("phrase").alias("offset", "term")).join(counts, "term")
    order = Window.partitionBy("window").orderBy("n", "term", "offset")
    ranked = places.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.withColumn("lists", F.count(F.lit(1)).over(Window.partitionBy("window"))).select(
        "window", "term", "offset", "rank", "lists"
    )


def candidates(postings: DataFrame, phrases: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, window, start)`` at which the shifted posting lists of a phrase's rarest terms meet."""
    counts = saved(term_counts(postings, terms_of(phrases)), "counts")
    anchors = saved(rarest_terms(phrases, counts), "anchors")
    # of a repeated term in one phrase, each place is a list of its own
    met = postings.join(small_side(anchors), "term").select(
        key, "window", (F.col("position") - F.col("offset")).alias("start"), "rank", "lists"
    ).where("start >= 0")
    # which lists meet, not how many postings: a repeated row has each of its postings twice
    lists = F.bit_or(F.expr("shiftleft(1L, rank - 1)")).alias("_met")
    return met.groupBy(key, "window", "start").agg(lists, F.first("lists").alias("_lists")).where(
        "bit_count(_met) = _lists"
    ).select(key, "window", "start")


def terms_of(phrases: DataFrame) -> DataFrame:
    return phrases.select(F.explode("phrase").alias("term")).distinct()


def exact_matches(
    docs: DataFrame, postings: DataFrame, found: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text"
) -> DataFrame:
    """``(key, item, window, start, length)``: every place (in words) of a document where one of the windows ``found`` occurs."""
    phrases = found.dropDuplicates(["window"]).select("window", "phrase")
    met = saved(candidates(postings, phrases, key), "candidates").join(phrases, "window")
    wanted = met.groupBy(key).agg(F.collect_list(F.struct("start", "window", "phrase")).alias("_wanted"))
    texts = with_words(docs.select(key, text).join(wanted, key), text)
    true = texts.select(
        key,
        F.explode(
            F.filter(
                "_wanted", lambda w: F.slice(F.col("words"), w["start"] + 1, F.size(w["phrase"])) == w["phrase"]
            )
        ).alias("_hit"),
    ).select(key, F.col("_hit.window").alias("window"), F.col("_hit.start").alias("start"), F.size("_hit.phrase").alias("length"))
    return true.distinct().join(found.select("window", item), "window").select(key, item, "window", "start", "length")


def proximity_matches(
    docs: DataFrame, phrases: DataFrame, slop: int, key: str = "doc_id", phrase: str = "phrase_id", text: str = "text"
) -> DataFrame:
    """``(key, phrase, position)``: places of a phrase's rarest term that have all its terms within ``slop`` words.

    ``phrases`` has ``phrase`` and ``text``; a term that the phrase has several times must occur as often near the place.
    """
    asked = with_words(phrases.select(phrase, text), text, "phrase").where(F.size("phrase") > 0).select(
        F.col(phrase).alias("window"), "phrase"
    )
    postings = index(docs, terms_of(asked), key, text)
    rarest = rarest_terms(asked, saved(term_counts(postings, terms_of(asked)), "counts"), 1).select("window", "term")
    met = postings.join(rarest, "term").join(asked, "window")
    wanted = saved(
        met.groupBy(key).agg(F.collect_list(F.struct("position", "window", "phrase")).alias("_wanted")), "near"
    )
    texts = with_words(docs.select(key, text).join(wanted, key), text)

    def near(w: Column) -> Column:
        first = F.greatest(w["position"] - slop, F.lit(0))
        around = F.slice(F.col("words"), first + 1, w["position"] + slop - first + 1)
        return F.forall(
            w["phrase"],
            lambda t: F.size(F.filter(around, lambda a: a == t)) >= F.size(F.filter(w["phrase"], lambda p: p == t)),
        )

    return texts.select(key, F.explode(F.filter("_wanted", near)).alias("_hit")).select(
        key, F.col("_hit.window").alias(phrase), F.col("_hit.position").alias("position")
    ).distinct()


def hit_words(matches: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, n_hit)``: words of a document inside any of its matches."""
    spans = matches.groupBy(key, "start").agg(F.max(F.col("start") + F.col("length")).alias("_end"))
    before = Window.partitionBy(key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("_end").over(before), F.lit(0))
    covered = spans.select(key, F.greatest(F.lit(0), F.col("_end") - F.greatest("start", reached)).alias("_n"))
    return covered.groupBy(key).agg(F.sum("_n").alias("n_hit"))


def report(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", size: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: ``n_words, n_hit, items`` (the items that occur, as sorted strings), ``contaminated``."""
    found = saved(windows(items, item, text, size), "windows")
    postings = index(docs, terms_of(found), key, text)
    matches = saved(exact_matches(docs, postings, found, key, item, text), "matches")
    by_item = matches.groupBy(key).agg(F.sort_array(F.collect_set(F.col(item).cast("string"))).alias("items"))
    hits = hit_words(matches, key).join(by_item, key)
    counted = postings.where(F.col("term") == END).select(key, F.col("position").cast("long").alias("n_words"))
    return counted.join(hits, key, "left").select(
        key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
