import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwork.functions import word_hashes as W
from siftwork.operators import classifiers as C
from siftwork.operators import language as L
from siftwork.operators import reports, sampling
from siftwork.operators import softmax as X
from siftwork.plans import curate as P
from siftwork.plans import english
from siftwork.plans import quality_model as Q
from siftwork.streaming.incremental import curate_incrementally, streamed_report

GOOD = "The committee published a careful history of the river and its bridges over many years."
BAD = "Click here now to win free prizes and buy cheap pills from our hot store today."
RUDE = "You are all worthless idiots and nobody wants your stupid opinion anywhere near here."


@pytest.fixture(scope="module")
def models(spark):
    rows = [(i, f"{t} Entry number {i % 3}.", q, x) for i, (t, q, x) in enumerate(
        [(GOOD, "wiki", "non-toxic"), (BAD, "cc", "non-toxic"), (RUDE, "wiki", "toxic")] * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality string, toxic string")
    heads = (C.QUALITY, C.TOXIC)
    return P.Models(C.train(df, heads, C.WORDS).cache(), heads)


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [GOOD * 5, BAD * 5, RUDE * 5, "", "short", "a b " * 60, f" {GOOD * 5} mail me@x.org or 202-555-0143 "]
    rows = [(i, t, f"src{i % 2}", f"http://www.site{i}.example.com/") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, url string")


def test_curation(spark, models, corpus):
    reasons = {r["doc_id"]: r["reason"] for r in P.judge(corpus, models).collect()}
    assert reasons == {0: None, 1: "low_quality", 2: "toxic", 3: "empty", 4: "too_short", 5: "gopher", 6: None}
    kept = {r["doc_id"]: r for r in P.curate(corpus, models).collect()}
    assert sorted(kept) == [0, 6]
    assert kept[6]["text"].endswith("mail |||EMAIL_ADDRESS||| or |||PHONE_NUMBER|||") and kept[6]["domain"] == "example.com"
    assert kept[6]["word_count"] == len(kept[6]["text"].split())
    refused = {r["doc_id"]: r["rejection_reason"] for r in P.rejected(corpus, P.judge(corpus, models)).collect()}
    assert refused == {i: r for i, r in reasons.items() if r}
    again = P.judge(corpus.repartition(7), models)
    assert {r["doc_id"]: r["reason"] for r in again.collect()} == reasons


def test_incremental_curation_equals_batch(spark, models, corpus, tmp_path):
    plain = corpus.drop("url")
    for name, part in (("one", plain.where("doc_id < 3")), ("two", plain.where("doc_id >= 3"))):
        part.coalesce(1).write.json(str(tmp_path / "staging" / name))
    source = tmp_path / "in"
    source.mkdir()
    paths = {n: str(tmp_path / n) for n in ("in", "out", "ckpt")}

    def publish(name):
        [part] = [p for p in (tmp_path / "staging" / name).iterdir() if p.suffix == ".json"]
        (source / f"{name}.json").write_bytes(part.read_bytes())

    def run():
        curate_incrementally(spark, paths["in"], paths["out"], paths["ckpt"], models)
        return sorted(
            json.loads(line)["doc_id"] for p in (tmp_path / "out" / "documents").rglob("*.json") for line in p.read_text().splitlines()
        )

    publish("one")
    assert run() == [0]
    publish("two")
    assert run() == [0, 6]
    assert run() == [0, 6]  # nothing new
    batch = {r["doc_id"]: r["text"] for r in P.curate(plain, models).collect()}
    streamed = {r["doc_id"]: r["text"] for r in spark.read.json(str(tmp_path / "out" / "documents")).collect()}
    assert streamed == batch
    reported = spark.read.json(str(tmp_path / "out" / "reports")).where("source = 'ALL'").agg(F.sum("total")).first()[0]
    assert reported == 7
    whole = {tuple(r) for r in reports.filter_report_by_source(P.judge(plain, models, keep=("source",))).collect()}
    names = reports.filter_report_by_source(P.judge(plain, models, keep=("source",))).columns

    def merged():
        return {tuple(r) for r in streamed_report(spark, paths["out"]).select(*names).collect()}

    assert merged() == whole
    curate_incrementally(spark, paths["in"], paths["out"], paths["ckpt"] + "-lost", models, files_per_batch=1)
    assert merged() == whole  # batches that run again replace their counters


LANGUAGE_ROWS = [
    ("en", "the history of the town and the river with all of its bridges that were built"),
    ("fr", "la ville et son histoire avec tous les ponts que nous avons construits sur le fleuve"),
    ("de", "die geschichte der stadt und des flusses mit allen brücken die gebaut wurden"),
    ("es", "la historia de la ciudad y del río con todos los puentes que se construyeron"),
] * 3


def test_languages(spark):
    model = L.train_languages(spark.createDataFrame(LANGUAGE_ROWS, "lang string, text string"))
    asked = [
        (1, "the bridges of the town\n"), (2, "欢迎来到我们的网站"), (3, "добро пожаловать на наш сайт"), (4, "日本語のページへようこそ"),
        (5, "die brücken der stadt"), (6, ""), (7, "καλώς ήρθατε στη σελίδα μας"), (8, "웹사이트에 오신 것을 환영합니다"),
    ]
    df = spark.createDataFrame(asked, "doc_id long, text string")
    got = {r["doc_id"]: (r["label"], r["score"]) for r in L.identify(df, model).collect()}
    assert {i: got[i][0] for i in (1, 2, 3, 4, 5, 7, 8)} == {1: "en", 2: "zh", 3: "ru", 4: "ja", 5: "de", 7: "el", 8: "ko"}
    assert all(0 < s <= 1 for _, s in got.values()) and len(got) == len(asked)
    assert [r["doc_id"] for r in english.english_documents(df, model).collect()] == [1]


def _prose(r, language, n):
    return " ".join(r.choice(language.split()) for _ in range(n))


def test_open_languages_are_calibrated(spark):
    """A language that no training row names is not taken for its neighbour with confidence."""
    r = random.Random(2)
    es = "la historia de ciudad y del río con todos los puentes que se construyeron para gente mucho tiempo después cuando llegaron nuevos años"
    en = "the history of town and river with all bridges that were built for people much later when new years came again"
    it = "questo è il testo della nostra città con tutti i ponti che furono costruiti per molta gente dopo tanto tempo nella quale anche gli altri"
    rows = [(i, _prose(r, es if i % 2 else en, 60), "es" if i % 2 else "en") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.calibrate(L.train_languages(docs.where("doc_id < 80")), docs.where("doc_id >= 80"))
    assert model.classes == ("en", "es") and set(model.typical) == {"en", "es"} and model.temperature > L.TEMPERATURE
    asked = spark.createDataFrame([(0, _prose(r, it, 60)), (1, _prose(r, es, 60)), (2, _prose(r, en, 60)), (3, None)], "doc_id long, text string")
    found = {x["doc_id"]: (x["label"], x["score"]) for x in L.identify(asked, model).collect()}
    assert found[0][1] < 0.7 and found[1] == ("es", pytest.approx(1, abs=0.3)) and found[2] == ("en", pytest.approx(1, abs=0.3)) and 3 in found
    with pytest.raises(ValueError, match="no languages"):
        L.train_languages(docs.where("false"))


def test_softmax_rounds_never_raise_the_loss(spark):
    r = random.Random(4)
    texts = {"a": "red green blue light dark", "b": "one two three light many", "c": "cat dog bird many dark"}
    rows = [(i, _prose(r, texts[c], r.randrange(1, 12)), c) for i, c in enumerate("abc" * 30)] + [(900, "", "a"), (901, "red", None), (902, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    losses = []
    for rounds in (0, 1, 2, 5, 12):
        model = X.train_softmax(docs, "kind", ("a", "b", "c"), rule=X.SoftmaxRule(rounds=rounds, l2=1e-4))
        found = X.softmax_scores(docs, model)
        joined = found.join(docs, "doc_id").where("kind IS NOT NULL").collect()
        wrong = [x for x in joined if x["label"] != x["kind"]]
        losses.append(sum(-math.log(x["score"] if x["label"] == x["kind"] else max(1 - x["score"], 1e-9) / 2) for x in joined))
        assert found.count() == len(rows)
    assert all(b <= a + 1e-6 for a, b in zip(losses, losses[1:])) and len(wrong) <= 12
    # the plain computation of two rounds
    model = X.train_softmax(docs, "kind", ("a", "b", "c"), rule=X.SoftmaxRule(rounds=2, l2=1e-4), features=C.WORD_NAMES)
    got = {x["feature"]: [x["w_0"] / 1e6, x["w_1"] / 1e6, x["w_2"] / 1e6] for x in model.weights.collect()}
    bags = []
    for _, t, c in rows:
        if c:
            w = (t or "").split()
            bags.append((["", *w, *[f"{a} {b}" for a, b in zip(w, w[1:])]], "abc".index(c)))
    names = sorted({f for bag, _ in bags for f in bag if f == "" or sum(b.count(f) for b, _ in bags) >= 2})
    x = np.array([[bag.count(f) for f in names] for bag, _ in bags], float)
    x /= x.sum(axis=1, keepdims=True)
    y = np.eye(3)[[c for _, c in bags]]
    w = np.zeros((len(names), 3))
    for _ in range(2):
        p = np.exp(x @ w)
        p /= p.sum(axis=1, keepdims=True)
        w -= (x.T @ (p - y) + 1e-4 * w) / (x.sum(axis=0)[:, None] / 2 + 1e-4)
    assert set(got) == set(names) and np.allclose([got[f] for f in names], w, atol=1e-4)


def test_crawl_prefilter_and_review(spark, tmp_path):
    from test_sources import record

    from siftwork.sources.files import review_blocks

    texts = ["the history of the town", "die geschichte der stadt"]
    model = L.train_languages(spark.createDataFrame(LANGUAGE_ROWS, "lang string, text string"))
    (tmp_path / "a.wet").write_bytes(b"".join(record("conversion", t.encode(), WARC_Record_ID=f"<{t[:3]}>") for t in texts))
    report = english.filter_crawl(spark, str(tmp_path / "a.wet"), model, str(tmp_path / "en")).first()
    assert (report["total_chars"], report["kept_chars"]) == (len(texts[0] + texts[1]), len(texts[0]))
    kept = spark.read.parquet(str(tmp_path / "en"))
    assert [r["text"] for r in kept.collect()] == texts[:1]
    found = L.identify(kept, model, "record_id").join(kept, "record_id")
    block = review_blocks(found, "record_id").first()["block"]
    assert "prediction: en" in block and texts[0] in block


def test_sampling(spark):
    df = spark.createDataFrame([(i, "wiki" if i % 4 == 0 else "cc") for i in range(200)], "doc_id long, label string")
    samples = [[r["doc_id"] for r in sampling.seeded_sample(df.repartition(n), "doc_id", 5).orderBy("rank").collect()] for n in (1, 7)]
    assert samples[0] == samples[1] and len(set(samples[0])) == 5
    balanced = sampling.balance_classes(df, "doc_id", "label", ("wiki", "cc"), cap=3000)
    assert {r["label"]: r["n"] for r in balanced.groupBy("label").agg(F.count("*").alias("n")).collect()} == {"wiki": 50, "cc": 50}
    capped = sampling.balance_classes(df, "doc_id", "label", ("wiki", "cc"), cap=20)
    assert capped.count() == 40
    split = Q.build_set(df.withColumn("reason", F.lit(None).cast("string")))
    assert {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 90, "valid": 10}
    with pytest.raises(ValueError):
        sampling.manifest_chunks(df, "label", 10, 4)
    with pytest.raises(RuntimeError):
        sampling.require_rows(df.limit(3), 5, "too few")


def test_balancing_finds_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(i, "wiki" if i % 4 == 0 else "cc") for i in range(200)], "doc_id long, label string")
    found = sampling.balance_classes(df.mapInArrow(count, "doc_id long, label string"), "doc_id", "label", ("wiki", "cc"), cap=20)
    assert found.count() == 40 and seen.value == 200


@pytest.mark.parametrize("dense", [1 << 22, 1])
def test_trigrams_in_the_task_are_those_of_the_rows(spark, monkeypatch, dense):
    monkeypatch.setattr(W, "_DENSE", dense)
    r = random.Random(4)
    abc = "abc d\u00e9\u00fc\u0df4\u4e2d\u6587\U00020000\U0001d400 .1\nzZ\u00c4"
    texts = ["".join(r.choice(abc) for _ in range(r.randrange(60))) for _ in range(100)]
    texts += [None, "", " ", "a", "...", "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(1000))]
    rows = [(i, t, ("en", "de", None, "fr")[i % 4]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    exploded, head = C.FeatureIds(C.TRIGRAMS.units, 3, C.TRIGRAMS.ids), C.Head("lang", ("de", "en"), 2.0)
    same = lambda a, b: sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
    if dense > 1:
        assert same(C.feature_counts(df, (head,), C.TRIGRAMS), C.feature_counts(df, (head,), exploded))
        model = C.train(df, (head,), exploded)
        for unknown, when in ((True, None), (False, None), (True, F.col("doc_id") % 3 != 0)):
            found, wanted = (C.score_sums(df, model, (head,), f, ["doc_id"], when=when, unknown=unknown) for f in (C.TRIGRAMS, exploded))
            assert same(found, wanted)
        return
    few = pa.array([t for t in texts if t][:20])  # tasks do not see the patch; here runs are sorted
    runs = W.Trigrams(few)
    sorted_counts = {int(i): int(n) for i, n in zip(*runs.counts(np.ones(20, bool)))}
    sums = runs.sums(lambda ids: [ids.view(np.int64) >> 20])[0]
    monkeypatch.setattr(W, "_DENSE", 1 << 30)
    assert sorted_counts == {int(i): int(n) for i, n in zip(*runs.counts(np.ones(20, bool)))}
    assert (sums == runs.sums(lambda ids: [ids.view(np.int64) >> 20])[0]).all()


def test_places_at_the_ends():
    top = ~np.uint64(0)
    for known in ([5, 1 << 63, int(top)], [5, 7], []):
        known = np.array(known, np.uint64)
        starts = np.searchsorted(known, np.arange(1 << C._LEADING, dtype=np.uint64) << np.uint64(64 - C._LEADING))
        found = np.array([0, 5, 6, 7, 1 << 63, int(top) - 1, int(top)], np.uint64)
        place, hit = C._places(known, starts, found)
        assert hit.tolist() == np.isin(found, known).tolist() and (known[place[hit]] == found[hit]).all()
