"""Work per row: steps are computed once, and large models meet texts by their rare features alone."""

import hashlib

import pytest
from pyspark.sql import functions as F

from siftwork import materialize
from siftwork.functions import text as T
from siftwork.operators import classifiers as C
from siftwork.operators import near_duplicates as N
from siftwork.operators import tokens as K
from siftwork.operators import softmax, softmax_arrays
from siftwork.operators.softmax import SoftmaxRule, softmax_scores, train_softmax
from siftwork.llm import suffix_index


def plan(df):
    return df._jdf.queryExecution().toString()


def test_a_stored_step_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    assert materialize(spark.range(0, 100, 1, 4).mapInArrow(count, "id bigint")).count() == 100
    assert seen.value == 100


def test_decomposition_is_no_interpreted_table(spark):
    assert "str_to_map" not in plan(spark.range(1).select(T.canonical_decompose(F.concat(F.lit("é"), F.col("id").cast("string")))))


def test_grams_are_the_md5_of_five_words(spark):
    rows = [(1, "A b, c d e f a b c d e"), (2, None), (3, ""), (4, "one two")]
    found = {r["doc_id"]: r["grams"] for r in N.with_grams(spark.createDataFrame(rows, "doc_id int, text string"), 5).collect()}
    words = "a b c d e f a b c d e".split()
    grams = dict.fromkeys("\x1f".join(words[i : i + 5]) for i in range(len(words) - 4))
    assert found == {1: [int(hashlib.md5(g.encode()).hexdigest()[:15], 16) for g in grams], 2: None, 3: [], 4: []}


def test_no_gram_becomes_a_row(spark):
    rows = spark.createDataFrame([(1, "a b c d e f g")], "doc_id int, text string")
    assert "Generate" not in plan(N.signatures(N.with_grams(rows, 5), N.MinHashParameters(), ["doc_id"]))


@pytest.mark.parametrize("unknown", [False, True])
def test_scores_of_a_model_larger_than_a_task_gets(spark, monkeypatch, unknown):
    texts = [(i, f"word{i % 7} and word{i % 5} or Other{i % 3} lone{i}", ("cc", "wiki")[i % 2]) for i in range(40)] + [(1, "word1", "cc"), (None, None, "cc")]
    docs = spark.createDataFrame(texts, "doc_id int, text string, quality string")
    model = C.train(docs, (C.QUALITY,), C.WORDS)
    sums = lambda: sorted(C.score_sums(docs, model, (C.QUALITY,), C.WORDS, ["doc_id"], unknown=unknown).collect(), key=repr)
    whole = sums()
    monkeypatch.setattr(C, "FREQUENT", 9)
    assert sums() == whole and len(whole) == 41
    # as a join of all features gives them
    joined = C.WORDS.explode(docs, "text", "doc_id").join(model, "feature", "left" if unknown else "inner")
    expected = joined.groupBy("doc_id").agg(F.sum("w_quality_0").alias("a"), F.sum("w_quality_1").alias("b"), F.count("total").alias("n"))
    assert sorted((tuple(r[:4]) for r in whole), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    counted = C.WORDS.explode(docs, "text").groupBy("feature").count()
    assert sorted(C.feature_counts(docs, (C.QUALITY,), C.WORDS).select("feature", "total").collect()) == sorted(map(tuple, counted.collect()))


def test_features_of_no_model_are_not_shuffled(spark, monkeypatch):
    train = [(i, f"word{i % 7} and word{i % 5}", ("cc", "wiki")[i % 2]) for i in range(40)]
    model = C.train(spark.createDataFrame(train, "doc_id int, text string, quality string"), (C.QUALITY,), C.WORDS)
    docs = spark.createDataFrame([(i, f"word{i % 7} " + " ".join(f"new{i}x{j}" for j in range(50))) for i in range(20)], "doc_id int, text string")
    whole = sorted(C.score_sums(docs, model, (C.QUALITY,), C.WORDS, ["doc_id"]).collect())
    monkeypatch.setattr(C, "FREQUENT", 9)
    stored = []
    monkeypatch.setattr(C, "materialize", lambda df: stored.append(df) or materialize(df))
    assert sorted(C.score_sums(docs, model, (C.QUALITY,), C.WORDS, ["doc_id"]).collect()) == whole and len(whole) == 20
    assert stored[0].agg(F.sum(F.size("_rest"))).first()[0] < 100  # of 2,000 words and pairs that the model does not have


def test_read_back_tokens_are_no_rows(spark):
    rows = [(1, "a b\né"), (2, ""), (3, None), (4, "a b"), (4, "a c")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    vocabulary = K.build_vocabulary(docs, size=2)
    found = K.detokenize(K.tokenize(docs, vocabulary), vocabulary)
    assert "Generate explode" not in plan(found).split("Arrow")[0] and "posexplode" not in plan(found)
    assert {r["doc_id"]: r["text"] for r in found.collect() if r["doc_id"] != 4} == {1: "a b\né", 2: "", 3: ""}
    assert found.where("doc_id = 4").count() == 1


def test_lookup_does_not_depend_on_its_stretches(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a bb ccc d{i} é" * (i + 1)) for i in range(9)], "doc_id int, text string")
    vocabulary = K.build_vocabulary(docs, size=3)
    whole = sorted(K.tokenize(docs, vocabulary).collect())
    monkeypatch.setattr(K, "PIECES", 5)
    assert sorted(K.tokenize(docs, vocabulary).collect()) == whole


def test_softmax_scores_of_a_model_larger_than_a_task_gets(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and word{i % 5} or other{i % 3} lone{i}", ("cc", "wiki")[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, quality string")
    model = train_softmax(docs, "quality", ("cc", "wiki"), rule=SoftmaxRule(rounds=2))
    whole = sorted(softmax_scores(docs, model).collect())
    monkeypatch.setattr(C, "FREQUENT", 9)
    scored = softmax_scores(docs, model)
    assert sorted(scored.collect()) == whole and len(whole) == 40
    assert "Generate explode(concat" not in plan(scored)  # the texts are not taken apart into rows


def test_softmax_rounds_over_arrays_are_those_over_rows_and_move_no_features(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and word{i % 5} or Other{i % 3} and lone{i}", ("cc", "wiki", None)[i % 3]) for i in range(40)]
    rows += [(3, rows[3][1], "cc"), (4, "word4 again", "cc"), (4, "word4 again", "wiki"), (None, "word4 lost lost", "cc"), (50, None, "cc"), (51, "", "wiki")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, quality string")
    plans, found = [], []
    met = softmax_arrays._with_weights
    monkeypatch.setattr(softmax_arrays, "_with_weights", lambda *a: plans.append(plan(x := met(*a))) or x)
    monkeypatch.setattr(softmax_arrays, "GATHER_BYTES", 200)
    for documents, part, piece, block in ((10**6, 1 << 20, 1 << 20, 1 << 16), (10**6, 500, 9, 10), (0, 1, 1, 1)):
        monkeypatch.setattr(softmax, "DOCUMENTS", documents)
        monkeypatch.setattr(softmax_arrays, "PART_BYTES", part)
        monkeypatch.setattr(softmax_arrays, "PIECE", piece)
        monkeypatch.setattr(softmax_arrays, "BLOCK", block)
        weights = train_softmax(docs, "quality", ("cc", "wiki"), rule=SoftmaxRule(rounds=3)).weights
        found.append(sorted(map(tuple, weights.select("feature", "total", "w_0", "w_1").collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 20 and any(w[2] for w in found[0])
    assert len(plans) == 8 and all("ShuffledHashJoin" in p and "Exchange" not in p for p in plans[1:4] + plans[5:])
    assert train_softmax(docs.where("false"), "quality", ("cc", "wiki"), rule=SoftmaxRule(rounds=2)).weights.count() == 0


def test_requests_beyond_their_bound_are_not_broadcast(spark, monkeypatch):
    passage = " ".join(f"token{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"start {i} {passage} end {i}") for i in range(6)], "doc_id bigint, text string")
    within = sorted(suffix_index.removed_digests(docs).collect())
    monkeypatch.setattr(suffix_index, "SIDE_BYTES", 0)
    assert sorted(suffix_index.removed_digests(docs).collect()) == within
    assert suffix_index.removed_digests(docs).where("n_removed > 0").count() == 6


def test_words_are_hashed_in_the_task_as_spark_does(spark, monkeypatch):
    spaces = "".join(f"{c}w{i}" for i, c in enumerate(T.WS_CHARS))
    texts = [None, "", " ", "a", "É​x\u0085y", spaces, "x" * 31, "y" * 32, "z" * 33 + " " + "q" * 100 + "é", *["ab" * n for n in range(1, 9)], "end", "İ Σς ΟΔΟΣ"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").coalesce(1)
    expected = sorted(map(tuple, C.WORDS.explode(docs, "text").groupBy("feature").count().collect()))
    found = C.feature_counts(docs, (), C.WORDS)
    assert sorted(map(tuple, found.select("feature", "total").collect())) == expected
    assert "transform" not in plan(found)  # no word becomes a value of its own in the JVM
    monkeypatch.setattr(C, "STRETCH", 3)
    assert sorted(map(tuple, C.feature_counts(docs, (), C.WORDS).select("feature", "total").collect())) == expected
