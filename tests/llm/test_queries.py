"""The registered queries against brute force, and the pipeline stage by stage."""

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline


def rows(spark, sf, name, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in entry.queries()[name](spark, sf).collect()}


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_op1(spark, sf, texts):
    first, pairs = {}, []
    for i in sorted(texts):
        w = brute.words(texts[i])
        for k in range(len(w) - 49):
            other = first.setdefault(tuple(w[k:k + 50]), i)
            if other != i:
                pairs.append((other, i))
    found = rows(spark, sf, "op1_passages", "doc_id", "class_id", "n_links")
    assert set(found) == set(texts)
    for a, b in pairs:
        assert found[a][0] == found[b][0] and found[a][1] and found[b][1]


def test_op2(spark, sf, texts):
    ids = sorted(texts)
    found = rows(spark, sf, "op2_fingerprints", "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next", "fingerprint")
    for k, i in enumerate(ids):
        text, following = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(text) // 2
        assert found[i][:2] == (len(text), brute.sha(text[:len(text) - half] + following[:half]))
        assert 0 <= found[i][2] <= 1 and 0 <= found[i][3] <= 1
    assert sum(f[2] for f in found.values()) > 2 * sum(f[3] for f in found.values())
    assert len({f[4] for f in found.values()}) == len(set(texts.values()))


def test_op3(spark, sf, texts):
    assert set(rows(spark, sf, "op3_mixing", "doc_id", "rate")) == set(texts)


def test_op4(spark, sf):
    found = rows(spark, sf, "op4_chat", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    turns = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    for c, told in turns.items():
        learned = "".join(x for r, x in told if r == "assistant")
        assert found[c] == (len(told), brute.sha("".join(f"{r}\n{x}\n" for r, x in told)), len(learned), brute.sha(learned))


def test_op5_and_op7_on_held_out_labels(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for name, label, least in (("op5_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.9)):
        found = rows(spark, folder, name, "doc_id", "held_out", "score", "predicted")
        held = [(p, labels[i][label]) for i, (h, s, p) in found.items() if h and i in labels]
        assert held and sum(p == y for p, y in held) / len(held) >= least
        assert all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p in found.values())


def test_op6(spark, sf, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    found = rows(spark, sf, "op6_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found == brute.contamination(texts, items)


def test_op8(spark, sf, texts):
    found = rows(spark, sf, "op8_secrets", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert found == {i: brute.secrets(t) for i, t in texts.items()}


def test_op9(spark, sf, texts):
    found = rows(spark, sf, "op9_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.without_repeats(texts)


def test_op10(spark, sf, texts):
    found = rows(spark, sf, "op10_ngram_join", "doc_id", "class_id")
    assert {i: c for i, (c,) in found.items()} == brute.components(brute.near_pairs(texts), texts)


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        texts = {i: r["text"] for i, r in before.items()}
        result = corpus_pipeline.saved(stage(spark, docs, sf), f"test-{name}")
        after = {r["doc_id"]: r for r in result.collect()}
        if name == "mixing":
            assert set(after) <= set(before) and all(r["rate"] > 0 for r in after.values())
            break
        assert result.columns == docs.columns
        if name == "ngram_join":
            kept = {i for i, c in brute.components(brute.near_pairs(texts), texts).items() if i == c}
            assert set(after) == kept
        elif name == "decontamination":
            assert set(after) == {i for i, r in brute.contamination(texts, items).items() if not r[-1]}
        elif name == "secret_scan":
            assert set(after) == set(before)
            for i, r in after.items():
                assert brute.secrets(r["text"])[:3] == (0, 0, 0) and r["n_chars"] == len(r["text"])
                if r["text"] != texts[i]:
                    assert "[SECRET]" in r["text"]
        else:
            assert set(after) <= set(before)
        docs = result
