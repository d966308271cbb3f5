import itertools
import random

import pytest

from siftwork.operators import components as G
from siftwork.operators import exact_duplicates as X
from siftwork.operators import near_duplicates as N
from siftwork.operators import similarity_join as S
from siftwork.operators import skew

MENU = [
    (1, "This service has noticed unusual traffic from your network.\n"),
    (2, "This service has noticed unusual traffic from your network.\n"),
    (3, "- start\n- list\n- up\nBody of page three\n"),
    (4, "- start\n- list\nBody of page four\n"),
    (5, "Nothing in page five occurs twice.\n"),
]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture
def tiny_salts(monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_SALT", 3)


def test_line_dedup(spark):
    got = dict(X.drop_repeated_lines(docs(spark, MENU)).collect())
    assert got == {1: "", 2: "", 3: "- up\nBody of page three\n", 4: "Body of page four\n", 5: MENU[4][1]}


def test_line_dedup_terminators_blank_lines_and_hot_lines(spark, tiny_salts):
    rows = [(1, "a\n\nb"), (2, "b\n\nc"), (3, ""), (4, None), (5, "d\nd\ne")]
    rows += [(10 + i, f"menu\nown {i}") for i in range(20)]
    got = dict(X.drop_repeated_lines(docs(spark, rows)).collect())
    assert got == {1: "a\nb", 2: "b\nc", 3: "", 4: None, 5: "e", **{10 + i: f"own {i}" for i in range(20)}}


def test_document_dedup(spark):
    rows = [(3, "Café  au lait"), (1, "CAFÉ au\nlait"), (2, "Cafe au lait"), (4, "café, au lait")]
    assert sorted(r["doc_id"] for r in X.drop_repeated_documents(docs(spark, rows)).collect()) == [1, 2, 4]
    assert X.document_dedup_report(docs(spark, rows)).first() == (4, 3, 1)


def test_salted_join_is_a_join(spark, tiny_salts):
    rng = random.Random(1)
    large = spark.createDataFrame([(rng.choice([1, 1, 1, 2, 3, 9]), i) for i in range(60)], "k int, v int")
    small = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (4, "w")], "k int, s string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = skew.salted_join(large, small, ["k"], large["v"], how)
        assert sorted(map(repr, salted.collect())) == sorted(map(repr, large.join(small, "k", how).collect()))


def test_components(spark, tiny_salts):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000, 1000 + i) for i in range(1, 40)]
    edges += [(2000 + i, 2001 + i) for i in range(30)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in G.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent}
    assert G.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("arguments", [(0, 1, 5), (10, 0, 5), (10, 2, 0), (10, 3, 5)])
def test_parameters(arguments):
    with pytest.raises(ValueError):
        N.MinHashParameters(*arguments)


def test_exact_copies(spark):
    kept = N.drop_near_duplicates(docs(spark, MENU), N.MinHashParameters(100, 10, 5, 0.8))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]


def _grams(text, n):
    words = text.split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def _brute_force(spark, rows, p):
    """Clusters by the definition: all pairs of every bucket, exact Jaccard, transitive closure."""
    signature = N.signatures(N.with_grams(docs(spark, rows), p.ngrams), p, ["doc_id"])
    members = {}
    for r in N.band_rows(signature, p, "doc_id").collect():
        members.setdefault((r["band"], r["b0"], r["b1"]), []).append(r["doc_id"])
    pairs = {tuple(sorted(c)) for m in members.values() for c in itertools.combinations(m, 2)}
    grams = {i: _grams(t, p.ngrams) for i, t in rows}
    label = {i: i for i, _ in rows}
    linked = [(a, b) for a, b in pairs if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= p.threshold]
    for _ in rows:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    sizes = {c: list(label.values()).count(c) for c in label.values()}
    return {i: c for i, c in label.items() if sizes[c] > 1}, max(map(len, members.values()))


def test_clusters_equal_brute_force_with_hot_buckets(spark, tiny_salts):
    rng = random.Random(3)
    base = [f"w{rng.randrange(40)}" for _ in range(24)]
    rows = []
    for i in range(45):  # chains of near-copies and copies that crowd the buckets
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(24)] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base)) for i in range(15)] + [(200, "too short"), (201, "")]
    p = N.MinHashParameters(num_hashes=12, num_bands=12, ngrams=2, threshold=0.75)
    expected, largest = _brute_force(spark, rows, p)
    assert largest > 20
    got = {r["doc_id"]: r["cluster_id"] for r in N.duplicate_clusters(docs(spark, rows), p).collect()}
    assert got == expected
    kept = sorted(r["doc_id"] for r in N.drop_near_duplicates(docs(spark, rows), p).collect())
    assert kept == sorted(i for i, _ in rows if expected.get(i, i) == i)


def test_candidates_are_all_pairs_of_every_bucket(spark, tiny_salts, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 3)  # buckets of many blocks
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abc") + str(j) if rng.random() < 0.1 else f"w{j}" for j in range(24))) for i in range(30)]
    rows += [(100 + i, rows[3][1]) for i in range(15)] + [(200, "too short"), (201, ""), (None, rows[3][1]), (3, rows[3][1])]
    p = N.MinHashParameters(num_hashes=12, num_bands=6, ngrams=2, threshold=0.75)
    members = {}
    for r in N.band_rows(N.signatures(N.with_grams(docs(spark, rows), p.ngrams), p, ["doc_id"]), p, "doc_id").where("doc_id IS NOT NULL").collect():
        members.setdefault((r["band"], r["b0"], r["b1"]), []).append(r["doc_id"])
    expected = {tuple(sorted(c)) for m in members.values() for c in itertools.combinations(m, 2)}
    assert len(expected) > sum(len(m) - 1 for m in members.values()) and max(map(len, members.values())) > 15
    assert sorted(map(tuple, N.candidate_links(docs(spark, rows), p).collect())) == sorted(expected)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_prefix_join_finds_all_pairs(spark, tiny_salts, threshold):
    rng = random.Random(11)
    sets = {}
    for i in range(120):  # families around few bases, and sets of all sizes
        base = [100 * (i % 6) + k for k in range(rng.randrange(1, 40))]
        sets[i] = sorted({g if rng.random() > 0.1 else rng.randrange(10_000) for g in base})
    rows = spark.createDataFrame([(i, s, i % 6) for i, s in sets.items()], "rep long, grams array<long>, component long")
    similar = {
        (a, b) for a, b in itertools.combinations(sets, 2) if len({*sets[a]} & {*sets[b]}) / len({*sets[a], *sets[b]}) >= threshold
    }
    found = {tuple(r) for r in S.candidate_pairs(rows, threshold).collect()}
    assert similar <= found and len(found) < 120 * 119 / 4 and all(a < b for a, b in found)
    between = {tuple(r) for r in S.candidate_pairs(rows, threshold, "component").collect()}
    assert {(a, b) for a, b in similar if a % 6 != b % 6} <= between and all(a % 6 != b % 6 for a, b in between)
    assert S.candidate_pairs(rows.where("false"), threshold).count() == 0


def test_links_hold_every_pair_of_a_bucket(spark, tiny_salts):
    rng = random.Random(9)
    base = [f"w{rng.randrange(40)}" for _ in range(24)]
    rows = [(i, " ".join(f"x{rng.randrange(6)}" if rng.random() < 0.1 else w for w in base)) for i in range(40)]
    rows += [(100 + i, rows[i][1].upper()) for i in range(6)]
    p = N.MinHashParameters(num_hashes=12, num_bands=12, ngrams=2, threshold=0.7)
    found = [(r["a"], r["b"], r["jaccard"]) for r in N.verified_links(docs(spark, rows), p).collect()]
    reps = {i: min(j for j, t in rows if _grams(t.lower(), 2) == _grams(u.lower(), 2)) for i, u in rows}
    buckets = {}
    for r in N.lsh_buckets(docs(spark, rows), p).collect():
        buckets.setdefault((r["band"], r["leader"]), set()).add(r["doc_id"])
    pairs = {c for m in buckets.values() for c in itertools.combinations(sorted(m), 2)}
    grams = {i: _grams(t.lower(), 2) for i, t in rows}
    expected = {
        (a, b): len(grams[a] & grams[b]) / len(grams[a] | grams[b]) for a, b in pairs if reps[a] == a and reps[b] == b
    }
    expected = {k: j for k, j in expected.items() if j >= p.threshold} | {(r, i): 1.0 for i, r in reps.items() if r != i}
    assert {(a, b): j for a, b, j in found} == pytest.approx(expected) and len(found) == len(expected)
    label = {r["node"]: r["component"] for r in G.components(spark.createDataFrame([f[:2] for f in found], "a long, b long"), "a", "b").collect()}
    assert label == {r["doc_id"]: r["cluster_id"] for r in N.duplicate_clusters(docs(spark, rows), p).collect()}


def test_fixed_point_and_partition_independence(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        text = [rng.choice(words) for _ in range(60)]
        rows.append((2 * i, " ".join(text)))
        rows.append((2 * i + 1, " ".join(text[:-1] + ["changed"])))
    p = N.MinHashParameters()
    results = [
        sorted(r["doc_id"] for r in N.drop_near_duplicates(docs(spark, rows).repartition(n), p).collect()) for n in (1, 5)
    ]
    assert results[0] == results[1] == [2 * i for i in range(12)]
    kept = [r for r in rows if r[0] in results[0]]
    assert N.drop_near_duplicates(docs(spark, kept), p).count() == len(kept)


def test_line_removal_is_linear_in_the_document(spark):
    lines = [f"line {i}" for i in range(100_000)]
    rows = [(0, "\n".join(lines)), (1, "\n".join(lines[::2]) + "\n")]
    found = X.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    # the last line of the first document has no terminator, so it differs from any other
    assert found[0]["text"] == "\n".join(lines[1::2]) and found[1]["text"] == ""


def test_two_of_three_licences_stay(spark):
    """500 hashes in 50 bands: two variants of one text are one cluster, another text of the same kind is not."""
    rng = random.Random(5)
    grant = " ".join(f"grant{rng.randrange(90)}" for _ in range(170))
    other = " ".join(f"clause{rng.randrange(200)}" for _ in range(450))
    rows = [(1, grant), (2, grant.replace("grant7 ", "grant seven ", 1) + " as is"), (3, other)]
    kept = N.drop_near_duplicates(docs(spark, rows), N.MinHashParameters(500, 50, 5, 0.8))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
