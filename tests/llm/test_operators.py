"""Operators on small inputs against brute force, and on the inputs that tend to break things."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwork.llm import (
    chat, decontamination, fingerprints, mixing, ngram_join, passages, quality, secret_scan, suffix_index, toxicity,
)
from siftwork.llm.links import connected
from siftwork.llm.statistics import NAMES

ODD = [None, "", " \n ", "...", "one", "One TWO three four five six", "One TWO three four five six", "é" * 50, "x " * 3000]


def prose(seed, n, vocabulary=2000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


# -- fingerprints --------------------------------------------------------------------------------------------


def test_fingerprints_ignore_order_and_follow_edits(spark, docs):
    texts = ["a one.\nb two.\nc three.", "c three.\na one.\nb two.", "a one.\nb two.", "c three.", "a one.\na one.\nb two.\nc three.", *ODD]
    rows = by_id(fingerprints.with_fingerprint(docs(texts)), "fingerprint")
    prints = [rows[i][0] for i in range(len(texts))]
    assert prints[0] == prints[1] != prints[4] and prints[10] == prints[11]
    assert set(prints[5]) == set(prints[6]) == {0}
    two = spark.createDataFrame([(prints[2], prints[3], prints[0])], "a array<long>, b array<long>, c array<long>")
    sums = two.select(fingerprints.combine(F.col("a"), F.col("b")), fingerprints.remove(F.col("c"), F.col("b"))).first()
    assert sums[0] == prints[0] and sums[1] == prints[2]


def test_fingerprint_of_piece_rows_equals_that_of_the_text(spark):
    text = "a one.\nb two.\na one."
    pieces = spark.createDataFrame([(1, p) for p in text.split("\n")], "k int, piece string").repartition(3)
    whole = fingerprints.with_fingerprint(spark.createDataFrame([(1, text)], "k int, text string"))
    assert fingerprints.from_pieces(pieces, "k", "piece").first()["fingerprint"] == whole.first()["fingerprint"]


def test_likeness_estimates_shared_pieces(spark):
    lines = [prose(i, 8) for i in range(2000)]
    rows = [("\n".join(lines[:n]), "\n".join(lines[n // 4: n // 4 + n])) for n in (8, 100, 1000)]
    df = spark.createDataFrame(rows, "x string, y string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "x", "a"), "y", "b")
    found = [r["near"] for r in fingerprints.with_likeness(df, "a", "b", "near").select("near").collect()]
    assert all(abs(n - 0.6) < 0.25 for n in found)
    assert [r["near"] for r in fingerprints.with_likeness(df, "a", "a", "near").select("near").collect()] == [1.0] * 3


@pytest.mark.parametrize("n", [0, 1, 2, 57])
def test_next_row(spark, docs, n):
    found = by_id(fingerprints.with_next(docs([f"t{i}" for i in range(n)]), "doc_id", ["text"]), "text", "next_text")
    assert found == {i: (f"t{i}", f"t{(i + 1) % n}") for i in range(n)}


# -- decontamination -------------------------------------------------------------------------------------------


def test_decontamination_equals_brute_force(spark, docs):
    items = {1: prose(1, 30), 2: prose(2, 10), 3: "Short item", 4: None, 5: "", 6: prose(1, 12), 7: "the the the the the the the the the the the"}
    texts = [*ODD, prose(1, 30), prose(9, 50) + " " + prose(1, 15) + ", " + prose(8, 20), prose(2, 9), prose(2, 10).upper(),
             "a short ITEM, short item", "the " * 40, prose(3, 5) + " " + prose(2, 10), "É " + prose(2, 10) + "é"]
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontamination.report(docs(texts), table).select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("h"), "contaminated"
    )
    expected = brute.contamination(dict(enumerate(texts)), items)
    assert by_id(found, "n_words", "n_hit", "n", "h", "contaminated") == expected
    assert decontamination.report(docs(texts).where("false"), table).count() == 0
    assert not any(r["contaminated"] for r in decontamination.report(docs(texts), table.where("false")).collect())


def test_contaminated_rows_may_be_repeated(spark, docs):
    items = {1: prose(1, 30), 2: "short item", 3: "one"}
    texts = [prose(9, 50) + " " + prose(1, 15), "a short ITEM", "One", "clean words"]
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    once = docs(texts)
    twice = once.union(once.where("doc_id <> 1")).union(once.where("doc_id = 0"))
    found = decontamination.report(twice, table).collect()
    expected = brute.contamination(dict(enumerate(texts)), items)
    assert sorted(r["doc_id"] for r in found) == [0, 0, 0, 1, 2, 2, 3, 3]
    assert all((r["n_words"], r["n_hit"], r["contaminated"]) == (*expected[r["doc_id"]][:2], expected[r["doc_id"]][4]) for r in found)
    assert sorted(r["doc_id"] for r in ngram_join.keep_first(twice).collect()) == [0, 1, 2, 3]


def test_proximity_matches(spark, docs):
    phrases = spark.createDataFrame([(1, "red green blue"), (2, "red red")], "phrase_id long, text string")
    texts = ["blue x green y RED", "red a b c d e f green blue", "red x red", "red", None]
    found = decontamination.proximity_matches(docs(texts), phrases, 4)
    assert {(r["doc_id"], r["phrase_id"]) for r in found.collect()} == {(0, 1), (2, 2)}


# -- secrets ---------------------------------------------------------------------------------------------------


SECRETS = [
    "password = hunter2!", "PassWord:'abcdef'", "token=abc", "secret: token : abcdefgh", "api_key=x apikey: 12345678 API_KEY=\"zzzzzz",
    "AKIA" + "A" * 16, "AKIA" + "B" * 15, "xAKIAAKIA" + "1" * 20 + " AKIA", "0" * 24 + "g" + "f" * 23, "é\U0001f600 deadbeef" + "0" * 30,
    "a\x01b password=\x02 password=abc\x01def secret=aaaaaa", "token=" + "a1" * 5000, "secret=abcdef " * 700,
]


def test_secrets_equal_brute_force(docs):
    texts = [*ODD, *SECRETS]
    found = secret_scan.with_spans(docs(texts)).select(
        "doc_id", *[F.size(k).alias(k) for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed("assign", "access", "hex"), 256).alias("h"),
    )
    assert by_id(found, "assign", "access", "hex", "h") == {i: brute.secrets(t) for i, t in enumerate(texts)}


def test_entropy_and_allow_list(docs):
    texts = ["key Zx9Qw7Lm3Tp5Vb2Nk8Rj4Hc6 end", "123e4567-e89b-42d3-a456-426614174000", "Donaudampfschifffahrtsgesellschaft",
             "your-key-Zx9Qw7Lm3Tp5Vb2Nk8Rj4Hc6", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1A", "9f8e7d6c5b4a39281706f5e4d3c2b1a0"]
    found = [bool(r["entropy"]) for r in secret_scan.with_spans(docs(texts)).orderBy("doc_id").collect()]
    assert found == [True, False, False, False, False, True]


def test_redaction_leaves_clean_texts_alone(docs):
    texts = ["a password=hunter22 b", "clean\x01text", "AKIA" + "A" * 20, "token=abc", ""]
    found = docs(texts).select(secret_scan.redacted(F.col("text")).alias("t")).collect()
    assert [r["t"] for r in found] == ["a password=[SECRET] b", "clean\x01text", "[SECRET]", "token=abc", ""]


@pytest.mark.parametrize("part", ["ab-", "a/", "a_b-", "AB_", "1,", "a.", "x9-", "=", "token="])
def test_secrets_of_long_chains(docs, part):
    size = 100_000 if part in ("AB_", "x9-") else 1_000_000  # windows are counted in these
    text = "see " + part * (size // len(part)) + "ab end"
    found = secret_scan.with_spans(docs([text])).select(F.size("assign"), F.size("hex"), F.size("entropy")).first()
    assert tuple(found)[:2] == ((1, 0) if part == "token=" else (0, 0))
    masked = docs([text]).select(F.length(secret_scan.redacted(F.col("text")))).first()[0]
    assert masked == len(text) or part in ("token=", "x9-")


def test_redaction_keeps_control_characters(docs):
    texts = ["\x01\x02\x03 password=\x02hunter22 token=hunter22\x01\x03\x04\x05\x06", "\x03\x04 plain \x01"]
    found = docs(texts).select(secret_scan.redacted(F.col("text")).alias("t")).collect()
    assert [r["t"] for r in found] == [texts[0].replace("token=hunter22", "token=[SECRET]"), texts[1]]


# -- near copies and passages --------------------------------------------------------------------------------


def test_banding_reaches_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9)):
        bands, rows = ngram_join.banding(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall
    with pytest.raises(ValueError):
        ngram_join.banding(0.1, 0.9999999, 8)


def variants(seed, n, copies, changes):
    r, base = random.Random(seed), prose(seed, n).split()
    for c in range(copies):
        w = list(base)
        for _ in range(changes):
            w[r.randrange(n)] = f"x{r.randrange(10**6)}"
        yield " ".join(w)


def test_ngram_join_equals_brute_force(docs):
    texts = [*ODD, *variants(1, 300, 30, 2), *variants(2, 120, 20, 1), *variants(3, 200, 40, 8), *[prose(50 + i, 80) for i in range(20)]]
    texts += texts[9:20]
    found = by_id(ngram_join.classes(docs(texts)), "class_id")
    expected = brute.components(brute.near_pairs(dict(enumerate(texts))), range(len(texts)))
    assert {i: c for i, (c,) in found.items()} == expected
    kept = {r["doc_id"] for r in ngram_join.keep_first(docs(texts)).collect()}
    assert kept == {i for i, c in expected.items() if i == c}


def test_ngram_join_on_templates_and_empty_tables(docs):
    head = prose(7, 60)
    texts = [head + " " + prose(100 + i, 22) for i in range(60)] + [head + " " + prose(100, 21)]
    found = by_id(ngram_join.classes(docs(texts)), "class_id", "n_links")
    assert found[60] == (0, 1) and all(found[i] == (i, 0) for i in range(1, 60))
    assert ngram_join.classes(docs([])).count() == 0


def crowd():
    """A crowd of one template, no two of them near copies, but for two pairs whose ids are the last."""
    r, head = random.Random(11), prose(7, 180, 10**6)
    texts = [head + " " + prose(1000 + i, 26, 10**6) for i in range(300)]
    for i in (40, 41):
        w = prose(1000 + i, 26, 10**6).split()
        w[r.randrange(8, 18)] = "y"
        texts.append(head + " " + " ".join(w[:-1]))
    return texts


@pytest.mark.parametrize("block, most", [(250_000, 16), (3_000, 10**6), (3_000, 1)])
def test_ngram_join_counts_every_link(docs, monkeypatch, block, most):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "MOST", most)
    texts = [*ODD, *variants(1, 300, 30, 2), *variants(2, 120, 20, 1), *variants(3, 200, 40, 8), *crowd()]
    texts += texts[9:15]
    pairs = brute.near_pairs(dict(enumerate(texts)))
    expected, ends = brute.components(pairs, range(len(texts))), [i for p in pairs for i in p]
    found = by_id(ngram_join.classes(docs(texts)), "class_id", "n_links")
    assert found == {i: (expected[i], ends.count(i)) for i in range(len(texts))}


def test_connected(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_passages(docs):
    shared, near = prose(5, 51, 10**6), prose(6, 120, 10**6)
    edited = near.split()
    edited[30], edited[80] = "y1", "y2"
    texts = [*ODD, prose(10, 80) + " " + shared + " " + prose(11, 9), prose(12, 3) + "\n" + shared.upper() + ". " + prose(13, 200),
             near, prose(14, 60) + " " + " ".join(edited), prose(15, 300), prose(16, 40) + " " + shared[:150], "w1 " * 3000]
    texts += [texts[13], shared]
    found = by_id(passages.classes(docs(texts)), "class_id", "n_links")
    at = len(ODD)
    assert {found[at][0], found[at + 1][0], found[at + 8][0]} == {at}
    assert found[at + 3][0] == at + 2 and found[at + 2][1] == 1
    assert all(found[i] == (i, 0) for i in (*range(8), at + 5))
    assert found[at + 7][0] == found[at + 4][0] == at + 4
    assert passages.classes(docs([])).count() == 0


def test_edited_passages_share_a_cell():
    r, cells, hits = random.Random(7), passages._Cells(), 0
    for _ in range(400):
        before, passage, after = ([f"w{r.randrange(10**6)}" for _ in range(n)] for n in (20, 50, 40))
        edited = list(passage)
        edited[r.randrange(50)] = "y"
        texts = [" ".join(w).encode() for w in (passage + after, before + edited + after[::-1])]
        offsets = np.cumsum([0, *map(len, texts)])
        owner, key, c, _, _ = cells(np.frombuffer(b"".join(texts), np.uint8), offsets)
        there = set(zip(key[owner == 0].tolist(), c[owner == 0].tolist()))
        hits += any((k, p - 20) in there for k, p in zip(key[owner == 1].tolist(), c[owner == 1].tolist()))
    assert hits >= 390


def test_compact_windows_hold_every_subsequence_once():
    r = np.random.default_rng(1)
    values = r.integers(1, 30, 200).astype(np.uint64)
    values[[0, 70, 199]] = 0
    windows = list(zip(*(a.tolist() for a in passages.compact_windows(values, 8))))
    for i in range(200):
        for j in range(i + 7, 200):
            inside = [c for l, c, e in windows if l <= i <= c <= j <= e]
            part = values[i:j + 1]
            assert inside == ([] if (part == 0).any() else [i + int(part.argmin())])


# -- repeated bytes ----------------------------------------------------------------------------------------------


def repeating_texts():
    r = random.Random(3)
    make = lambda n: "".join(r.choice("abcdefgh é.\n") for _ in range(n))
    shared = [make(k) for k in (198, 199, 200, 201, 230, 500)]
    texts = []
    for _ in range(60):
        parts = [make(r.randrange(300)) for _ in range(r.randrange(4))]
        for _ in range(r.randrange(3)):
            parts.insert(r.randrange(len(parts) + 1), r.choice(shared))
        texts.append("".join(parts))
    return [*texts, *ODD, "In. " * 300, "a" * 1000, "a" * 150, texts[5], texts[5], make(300) * 2]


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_repeats_equal_brute_force(docs, batches):
    texts = repeating_texts()
    found = by_id(suffix_index.removed_digests(docs(texts), batches=batches), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.without_repeats(dict(enumerate(texts)))


def test_repeats_with_texts_shuffled_once(spark, docs, monkeypatch):
    monkeypatch.setattr(suffix_index, "SIDE_BYTES", 0)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = repeating_texts()
        result = suffix_index.removed_digests(docs(texts))
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(id") == 1  # the spans; the texts are where they go
        assert by_id(result, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.without_repeats(dict(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


def test_levels_merge_geometrically(spark):
    index = suffix_index.SuffixIndex()
    for b in range(7):
        index.add(spark.createDataFrame([(b, 0), (b + 1, 1)], "key long, ctx long"))
    assert [size for size, _ in index.levels] == [2, 1, 0]
    assert suffix_index.removed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- classifiers -----------------------------------------------------------------------------------------------


def test_boosted_trees_learn_and_traverse():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = quality.fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    row, margin = x[5], forest.base  # the arrays mean what a plain walk does
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
        at = 0
        while at < len(feature):
            at = 2 * at + (2 if row[feature[at]] > threshold[at] else 1)
        margin += leaf[at - len(feature)]
    assert abs(forest.score(x[5:6])[0] - 1 / (1 + np.exp(-margin))) < 1e-9


def test_classifiers_on_odd_inputs(spark, docs):
    table = docs([*ODD, *[prose(i, 60) for i in range(30)]])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(i, 1, 1) for i in range(5)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        scores = [r["score"] for r in quality.classify(table, labels).collect()]
        assert len(scores) == 39 and len(set(scores)) == 1 and 0 < scores[0] < 1
        scores = [r["score"] for r in toxicity.with_score(table, toxicity.train(table, labels)).collect()]
        assert len(scores) == 39 and all(0 < s < 1 for s in scores)
    assert quality.classify(docs([]), one).count() == 0


def test_toxicity_learns_words_and_beginnings(spark, docs):
    r = random.Random(4)
    toxic = lambda i: i % 5 == 0
    texts = [prose(i, 60) + (f" nasty{r.randrange(10**6)} vile" if toxic(i) else "") for i in range(600)]
    labels = spark.createDataFrame([(i, int(toxic(i))) for i in range(400)], "doc_id long, toxic int")
    table = docs(texts)
    scored = by_id(toxicity.with_score(table, toxicity.train(table, labels)), "score")
    assert all((scored[i][0] >= 0.5) == toxic(i) for i in range(400, 600))


def test_mixing_meets_targets(spark, docs):
    texts = [*ODD, *[(prose(i, 60).upper() if i % 4 == 0 else prose(i, 60)) for i in range(200)]]
    labels = spark.createDataFrame([(i + len(ODD), "loud" if i % 4 == 0 else "calm") for i in range(100)], "doc_id long, domain string")
    rows = mixing.mixed(docs(texts), labels, {"calm": 0.5, "loud": 0.5}).toPandas()
    tokens = rows.n_tokens.sum()
    assert (rows.rate >= 0).all() and len(rows) == len(texts) and list(rows.n_tokens[:6]) == [0, 0, 0, 0, 1, 6]
    for k in (0, 1):
        assert abs((rows.rate * rows.n_tokens * rows[f"p_{k}"]).sum() / tokens - 0.5) < 1e-4
    assert mixing.mixed(docs([]), labels, {"calm": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(docs(texts), labels, {"calm": -1.0})


def test_rates_are_clipped_where_a_target_is_out_of_reach(spark):
    rows = spark.createDataFrame([(10, 0.9, 0.1), (10, 0.1, 0.9)], "n_tokens long, p_0 double, p_1 double")
    steps = mixing.fit_rates(rows, np.array([20.0, 0.0]))
    rates = [r["r"] for r in rows.select(mixing.rate_after(steps, 2).alias("r")).collect()]
    # least squares with both rates at least 0: only the first document is taken
    assert rates[1] == 0 and abs(rates[0] - 0.9 * 20 / (0.82 * 10)) < 0.05


def test_statistics_have_their_columns(docs):
    from siftwork.llm.statistics import with_statistics

    rows = by_id(with_statistics(docs([*ODD, "A b. C!\nd"])), "features")
    assert all(len(f) == len(NAMES) and np.isfinite(f).all() for (f,) in rows.values())
    assert abs(rows[len(ODD)][0][0] - np.log(5)) < 1e-6


# -- chat -------------------------------------------------------------------------------------------------------


def test_chat_reads_back_what_it_formats(spark):
    hard = ["\\", "</turn>", "### User: x", "\\### Assistant: </turn> ok", "a\\</turn>\n### Role <x>: ", None, "", "é\n\n", "### Role <"]
    roles = ["system", "user", "assistant", "tool", None, "a>: b"]
    rows = [(c, t, roles[(c + t) % 6], hard[(c * t) % 9]) for c in range(12) for t in range(c)] + [(3, 0, "user", "again"), (None, 1, "user", "n")]
    segments = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    found = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    turns = {}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((r or "", x or ""))
    assert set(found) == set(turns)
    for c, told in turns.items():
        learned = "".join(x for r, x in told if r == "assistant")
        row = found[c]
        assert (row["n_turns"], row["turns_sha256"]) == (len(told), brute.sha("".join(f"{r}\n{x}\n" for r, x in told)))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), brute.sha(learned))


def test_chat_turn_order(spark):
    talk = {1: "system user assistant user assistant", 2: "user assistant", 3: "assistant user", 4: "user user", 5: "user tool"}
    rows = [(c, t, r, "x") for c, rs in talk.items() for t, r in enumerate(rs.split())]
    segments = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert {r["conv_id"]: r["valid"] for r in chat.read_back(segments).collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert {(r["part"], r["loss"]) for r in segments.where("conv_id = 2 and seq >= 3").collect()} == {("header", False), ("body", True), ("end", False)}
    with pytest.raises(ValueError):
        chat.ChatTemplate(end="aXa")


def test_passages_around_a_notice_that_a_lower_id_has_elsewhere(docs):
    """The first cell of a key may hold the notice only, in another document or at another place of the same one."""
    texts, pairs, r = [], [], random.Random(3)
    for trial in range(60):
        notice = prose(900 + trial, 40, 10**6)
        before = r.randrange(11)
        passage = " ".join([prose(2000 + trial, before, 10**6), notice, prose(3000 + trial, 10 - before, 10**6)])
        texts.append(" ".join([prose(4000 + trial, 30, 10**6), notice, prose(5000 + trial, 30, 10**6)] + [passage] * (trial % 4 == 0)))
        for seed in (6000, 7000):
            texts.append(" ".join([prose(seed + trial, 25, 10**6), passage, prose(seed + 500 + trial, 25, 10**6)]))
        pairs.append((3 * trial + 1, 3 * trial + 2))
    table = docs(texts)
    found = by_id(passages.classes(table), "class_id", "longest")
    assert all(found[a][0] == found[b][0] <= a and found[a][1] >= 50 for a, b in pairs)
    assert all(found[3 * t] == ((3 * t, 0) if t % 4 else (3 * t, found[3 * t][1])) for t in range(60))
    by_row = by_id(passages.classes(table.repartition(7, "doc_id")), "class_id")
    assert by_row == {i: (c,) for i, (c, _) in found.items()}


def test_cells_are_passed_on_in_bounded_batches_and_packed(docs, monkeypatch):
    """A task that passed on all cells of a batch at once took more memory than an executor had."""
    table = docs([" ".join(prose(i % 9, 300, 10**6).split()[i:]) for i in range(40)] + ["", "few words"])
    found = by_id(passages.classes(table), "class_id", "n_links", "longest")
    monkeypatch.setattr(passages, "CELLS", 50)
    monkeypatch.setattr(passages, "VIEW", 4000)
    monkeypatch.setattr(passages, "GRAMS", 500)
    assert by_id(passages.classes(table), "class_id", "n_links", "longest") == found

    class Rows:
        dtypes = [("id", "bigint"), ("_text", "string")]

        def mapInArrow(self, run, schema):
            return run

    texts = pa.array([row.text for row in table.orderBy("doc_id").collect()])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), texts], names=["id", "_text"])
    parts = list(passages._cell_rows(Rows())(iter([batch])))
    assert len(parts) > 10 and max(p.num_rows for p in parts) <= 50
    assert parts[0].schema.names == ["a", "diagonal", "id", "place", "key"]


def test_passages_of_many_pairs_are_those_of_each(monkeypatch):
    r = np.random.default_rng(4)
    xs, ys = [], []
    for i in range(400):
        x = r.integers(-60 if i % 7 == 0 else -10**6, 10**6 if i % 7 else 60, r.integers(0, 160)).astype(np.int32)
        y = np.concatenate([r.integers(0, 10**6, r.integers(0, 20)), x[r.integers(0, 10):], x[: r.integers(0, 70)] if i % 5 == 0 else x[:0]]).astype(np.int32)
        if len(y):
            y[r.integers(0, len(y), i % 6)] = 7
        xs.append(x)
        ys.append(y)
    of_x, of_y = (np.concatenate([[0], np.cumsum([len(v) for v in vs])]) for vs in (xs, ys))
    found = passages._all_passages(np.concatenate(xs), of_x, np.concatenate(ys), of_y)
    expected = [(i, *p) for i, (x, y) in enumerate(zip(xs, ys)) for p in passages._passages(x, y)]
    assert sorted(zip(*(c.tolist() for c in found))) == sorted(expected) and len(expected) > 100


def test_places_that_do_not_repeat_the_first_cell_are_open():
    x, y = np.arange(100, dtype=np.int32), np.arange(100, dtype=np.int32)
    y[50] = -1
    one = [np.array([v], np.int64) for v in (0, 0, 0, 0, 70)]  # f0, f1, diagonal, first, last
    of = np.array([0, 100])
    rows = passages._not_settled(x, of, one[0], y, of, one[1], one[2], one[3], one[4])
    assert [c.tolist() for c in rows] == [[0, 0], [5, 55], [50, 70]]
