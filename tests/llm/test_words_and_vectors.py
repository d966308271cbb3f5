"""Language identification, spelling variants and vector codes against brute force, and on odd inputs."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest

import __spark_entry__ as entry
from siftwork.llm import languages, spelling, vector_codes

# -- languages -----------------------------------------------------------------------------------------------


def tongue(seed, n, syllables):
    r = random.Random(seed)
    return " ".join("".join(r.choice(syllables) for _ in range(r.randrange(1, 4))) for _ in range(n))


SOUNDS = {"aa": ["ba", "ko", "ri"], "bb": ["zu", "ky", "we"], "cc": ["é", "ou", "vè"]}


@pytest.fixture(scope="module")
def taught(spark):
    rows = [(i, tongue(i, 40, SOUNDS[c]), c) for i, c in enumerate(["aa"] * 40 + ["bb"] * 12 + ["cc"] * 3)]
    rows += [(900, None, "aa"), (901, "ba ko ri", None), (902, "", "bb"), (1, tongue(1, 40, SOUNDS["aa"]), "aa")]
    return languages.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_languages_of_odd_texts(spark, taught):
    texts = [None, "", " 123 ... ", "ba", "BAKO", "zuky zu", "éou vè", "qqq", "漢字", tongue(5, 30, SOUNDS["cc"]) * 2000, "x" * 100, tongue(7, 40, SOUNDS["aa"])]
    rows = [(i, t, "old", "old") for i, t in enumerate(texts + texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score string, rejected string")
    found = languages.with_language(df, taught)
    assert found.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in found.collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0, True)] * 3
    assert [got[i][0] for i in (3, 4, 5, 6, 9)] == ["aa", "aa", "bb", "cc", "cc"] and not got[11][2]
    assert got[7] == got[8] == ("aa", 0.0, True) and all(0 <= s <= 1 for _, s, _ in got.values())
    assert all(got[i] == got[i + len(texts)] for i in range(len(texts)))
    assert languages.with_language(df.where("false"), taught).count() == 0


def test_nothing_to_learn_languages_from(spark):
    empty = spark.createDataFrame([(1, None, "aa"), (2, "ba", None)], "doc_id long, text string, lang string")
    model = languages.train(empty)
    assert [tuple(r)[-3:] for r in languages.with_language(empty, model).collect()] == [("und", 0.0, True)] * 2


def test_counts_of_pieces_equal_those_of_the_whole(monkeypatch):
    data = np.frombuffer(("Ab é, " * 3000 + "zz").encode(), np.uint8)
    count = languages.Counter()
    whole = count._counts(data, np.array([0, len(data)]))
    monkeypatch.setattr(languages, "PIECE", 101)
    assert (count._counts(data, np.array([0, len(data)])) == whole).all() and whole.sum() > 0


def test_several_centroids_and_their_limits():
    r = np.random.default_rng(1)
    rows = np.abs(np.concatenate([r.normal(0, 0.05, (30, 8)) + np.eye(8)[k] for k in (0, 3, 6)]))
    rows /= np.sqrt((rows**2).sum(axis=1, keepdims=True))
    centers, nearest = languages.cluster(rows, languages.CentroidRule(centroids=3))
    assert sorted(centers.argmax(axis=1)) == [0, 3, 6] and (nearest > 0.9).all()


def test_op11_on_held_out_texts(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text").collect()}
    rows = entry.queries()["op11_language_id"](spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert sum(held) / len(held) >= 0.97


# -- spelling ------------------------------------------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def forms_by_brute_force(words, factor=5):
    out = {}
    for w, n in words.items():
        around = [(-m, v) for v, m in words.items() if near(v, w)]
        best = min(around, default=None)
        form = best[1] if best and -best[0] >= factor * n else None
        out[w] = (n, len(around), form, words[form] if form else None)
    root = lambda w: root(out[w][2]) if out[w][2] else w
    return {w: (*r, root(w)) for w, r in out.items()}


def spelled(spark, words, group):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.forms(df, group=group).collect()}


@pytest.mark.parametrize("group", [1, 3, 64])
def test_spelling_equals_brute_force(spark, group):
    r, words = random.Random(group), {}
    for base in ("abcabcabc", "aaaaaaaa", "wordlist", "prefixes", "éàéàéà", "abcdef"):
        for _ in range(25):
            w = list(base)
            for _ in range(r.randrange(0, 3)):
                at, what = r.randrange(len(w)), r.choice("abcé")
                kind = r.randrange(3)
                w[at:at + (kind > 0)] = [] if kind == 2 and len(w) > 6 else [what]
            words["".join(w)] = r.choice([5, 6, 25, 30, 125, 700])
    words.update({f"prefix{a}{b}": 5 for a in "abcdefgh" for b in "xyz"})  # crowds one chunk
    assert spelled(spark, words, group) == forms_by_brute_force(words)


def test_spelling_ties_chains_and_no_words(spark):
    words = {"chainaa": 5, "chainab": 25, "chainbb": 125, "tieaaaa": 5, "tieaaab": 30, "tieaaac": 30}
    got = spelled(spark, words, 64)
    assert got["chainaa"][2:] == ("chainab", 25, "chainbb") and got["tieaaaa"][2] == "tieaaab"
    assert spelled(spark, {"lonely": 5}, 64) == {"lonely": (5, 0, None, None, "lonely")}
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.forms(empty).count() == 0


def test_word_counts(spark, docs):
    texts = ["Abcdef abcdef, ABCDEF-abcdef x", "abcdef" + "1" + "ÀÉàéøß ÀÉàéøß" * 3, None, "", "×÷ÿþðñ " * 5, "abcde " * 9, "zzzzzz " * 4]
    found = {r["word"]: r["n"] for r in spelling.word_counts(docs(texts)).collect()}
    assert found == {"abcdef": 5, "×÷ÿþðñ": 5}
    long = docs(["longword " * 200_000])
    assert [tuple(r) for r in spelling.word_counts(long).collect()] == [("longword", 200_000)]
    assert spelling.word_counts(docs(texts).where("false")).count() == 0


# -- vector codes --------------------------------------------------------------------------------------------


def codes_by_brute_force(vectors, parts=4, entries=256, rounds=4):
    """``vectors``: whole-number rows in order of their keys."""
    x = np.array(vectors, object).reshape(len(vectors), parts, -1)
    books = [[tuple(row) for row in x[:entries, p]] for p in range(parts)]
    square = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))

    def assign():
        return [[min((square(row[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for row in x]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [x[i, p] for i, f in enumerate(found) if f[p][1] == k]
                if own:
                    books[p][k] = tuple(sum(c) // len(own) for c in zip(*own))
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [("".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for f in found], digest


@pytest.mark.parametrize("n, entries, spread", [(40, 8, 1.0), (25, 256, 1.0), (60, 6, 5000.0)])
def test_codes_equal_brute_force(spark, n, entries, spread):
    r = random.Random(n)
    rows = [(i, [r.choice([-spread, 0.0, r.uniform(-spread, spread)]) for _ in range(8)], r.choice([1, 2, None])) for i in range(n)]
    rows[5] = (5, rows[4][1], 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = {x["vec_id"]: x for x in vector_codes.report(df, vector_codes.CodeRule(entries=entries)).collect()}
    whole = [[int(np.floor(np.float64(np.float32(c)) * 1024)) for c in v] for _, v, _ in rows]
    expected, digest = codes_by_brute_force(whole, entries=entries)
    assert [(got[i]["code"], got[i]["error"]) for i in range(n)] == expected
    assert {x["codebooks_sha256"] for x in got.values()} == {digest}
    for i, (_, _, label) in enumerate(rows):
        assert got[i]["label_error"] == sum(expected[j][1] for j, w in enumerate(rows) if w[2] == label)


def test_balls_equal_the_full_search():
    r = np.random.default_rng(3)
    book = r.integers(-40, 40, (64, 4))
    book[10] = book[3]
    rows = np.concatenate([book[r.integers(0, 64, 3000)] + r.integers(-3, 4, (3000, 4)), r.integers(-40, 40, (500, 4))])
    own = r.integers(0, 64, len(rows))
    gone = ((rows - book[own]) ** 2).sum(axis=1)
    radii = np.array([gone[own == e].max(initial=0) for e in range(64)])
    full = vector_codes.Searcher(book, None)(rows, None)
    ball = vector_codes.Searcher(book, radii)(rows, own)
    assert (full[0] == ball[0]).all() and (full[1] == ball[1]).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0, -0.5, 2.0, 0.0], 1, "x"), (2, None, 1, "x"), (3, [nan, 1.0, 0.0, 0.0, 0.0], 1, "x"), (4, [inf] * 5, 1, "x"), (5, [], 1, "x"),
        (6, [1.0, None, 0.0, 0.0, 0.0], 1, "x"), (7, [1.0, 2.0], 1, "x"), (8, [1e30] * 5, None, "x"), (None, [0.5, 1.0, -0.5, 2.0, 0.0], None, "x"),
        (1, [0.5, 1.0, -0.5, 2.0, 0.0], 1, "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string")
    got = vector_codes.report(df).collect()
    assert sorted((str(r["vec_id"]), r["error"]) for r in got) == [("1", 0), ("1", 0), ("8", 0), ("None", 0)]
    assert vector_codes.report(df.where("vec_id = 2")).count() == 0 and vector_codes.report(df.where("false")).count() == 0


# -- the queries against their SQL -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op12_spelling", "op13_vector_codes"])
def test_query_equals_sql(spark, sf, name):
    from compare import connect, differences

    assert differences(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) == ""


def test_op12_deletes_by_hash(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import re
    from collections import Counter

    counts = Counter()
    for i, t in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = run.translate(brute.LOWER)
            h = zlib.crc32(f"{i}:{word}".encode())
            counts[word if h % 199 else word[:h % len(word)] + word[h % len(word) + 1:]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    found = {r["word"]: r["n"] for r in entry.queries()["op12_spelling"](spark, sf).select("word", "n").collect()}
    assert found == words
