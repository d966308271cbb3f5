import unicodedata

from pyspark.sql import functions as F

from siftwork.functions import pii
from siftwork.functions import text as T

SAMPLES = [
    "", " \t\n", "one", "  Two words　here\x1c and\x85more ", "Café au lait, s'il vous plaît!",
    "café CAFÉ", "Über-straße – “quoted”", "İstanbul", "a$b+c<d>e^f`g|h~i", "欢迎来到",
    "tab\tnew\nline\rend", "Å Å Å", "x̧́ ý̧",
]


def python_normal(text):
    decomposed = [c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn"]
    lowered = "".join(decomposed).lower()
    return " ".join("".join(" " if unicodedata.category(c)[0] == "P" else c for c in lowered).split())


def test_white_space_functions_agree_with_python(column):
    assert column(T.strip, SAMPLES) == [s.strip() for s in SAMPLES]
    assert column(T.flatten_ws, SAMPLES) == [" ".join(s.split()) for s in SAMPLES]
    assert column(T.word_count, SAMPLES) == [len(s.split()) for s in SAMPLES]
    assert column(T.words, SAMPLES) == [s.split() for s in SAMPLES]


def test_normal_forms_agree_with_python(column):
    assert column(T.normalize_text, SAMPLES) == [python_normal(s) for s in SAMPLES]
    exact = [" ".join(unicodedata.normalize("NFD", s).lower().split()) for s in SAMPLES]
    assert column(T.normalize_exact, SAMPLES) == exact


def test_classifier_input_and_labels(column):
    assert column(T.one_line, [" a\nb \n"]) == ["a b"]
    assert column(T.bare_label, ["__label__wiki"]) == ["wiki"]


def test_rule_tokens(column):
    [tokens] = column(T.rule_tokens, ["Don't stop... it's 3,000 re-runs, and/or e.g. (x)!"])
    assert tokens == ["Do", "n't", "stop", "...", "it", "'s", "3,000", "re-runs", ",", "and/or", "e.g", ".", "(", "x", ")", "!"]


def _masked(column, mask, texts):
    return list(zip(column(lambda c: mask(c)[0], texts), column(lambda c: mask(c)[1], texts), strict=True))


def test_emails(column):
    got = _masked(column, pii.mask_emails, [
        "Write to jo.doe+x@mail.example.org today.", "a@b.ai and c_d@e.co", "|||EMAIL_ADDRESS||| or x@y.zz", "a@b", "no at sign",
    ])
    assert got == [
        ("Write to |||EMAIL_ADDRESS||| today.", 1), ("|||EMAIL_ADDRESS||| and |||EMAIL_ADDRESS|||", 2),
        ("|||EMAIL_ADDRESS||| or |||EMAIL_ADDRESS|||", 1), ("a@b", 0), ("no at sign", 0),
    ]


def test_phones(column):
    numbers = ["2025550143", "(202)-555-0143", "(202) 555 0143", "202-555-0143", "202.555\n0143", "٢٠٢٥٥٥٠١٤٣"]
    got = _masked(column, pii.mask_phones, [f"call {n} now" for n in numbers] + ["+1 202-555-0143", "12025550143", "20255501439"])
    assert got[:6] == [("call |||PHONE_NUMBER||| now", 1)] * 6
    assert got[6:] == [("+1 |||PHONE_NUMBER|||", 1), ("12025550143", 0), ("20255501439", 0)]


def test_ips(column):
    got = _masked(column, pii.mask_ips, ["host 198.51.100.7.", "256.1.1.1", "01.2.3.4", "1.2.3.4.5", "v10.0.0.255x"])
    assert got == [
        ("host |||IP_ADDRESS|||.", 1), ("256.1.1.1", 0), ("01.2.3.4", 0), ("|||IP_ADDRESS|||.5", 1), ("v|||IP_ADDRESS|||x", 1),
    ]


def test_masking_chain_is_idempotent(spark):
    df = spark.createDataFrame([("x@y.org 202-555-0143 198.51.100.7",)], "text string")
    once = pii.with_masked(df)
    row = once.first()
    assert row["masked"] == "|||EMAIL_ADDRESS||| |||PHONE_NUMBER||| |||IP_ADDRESS|||"
    assert (row["n_email"], row["n_phone"], row["n_ip"]) == (1, 1, 1)
    again = pii.with_masked(once.select(F.col("masked").alias("text"))).first()
    assert again["masked"] == row["masked"] and again["n_email"] + again["n_phone"] + again["n_ip"] == 0


def test_strip_accents_equals_the_decomposition(column):
    import unicodedata

    texts = ["한글 텍스트 가각힣", "Éà ñ", "ক\u09cb ୋ ஔ", "plain", "e\u0301", "\ud7a3x\uac00", "", None, "漢字かな"]
    expected = [
        t if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn") for t in texts
    ]
    assert column(T.strip_accents, texts) == expected


def test_canonical_decomposition_equals_the_standard(column):
    import random

    rng = random.Random(8)
    pool = ["a", "e", " ", "é", "ệ", "Å", "각", "한", "\u0301", "\u0323", "\u0327", "\u0345", "\u093c", "ক", "\u09cb", "\u1e69", "\U0001d15e", "ﬁ", "Ω", "\u0f73", "漢", "豈"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 14))) for _ in range(300)] + [None, "", "plain", "\u0323\u0301", "q\u0307\u0323"]
    assert column(T.canonical_decompose, texts) == [t if t is None else unicodedata.normalize("NFD", t) for t in texts]
