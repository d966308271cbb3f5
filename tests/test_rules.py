import pytest

from siftwork.operators import reports, rules

PLAIN = "Sentences of ordinary words make a sensible text for readers. "


def failed(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return rules.with_rule_measures(df).select(rules.failed_rule().alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, rule",
    [
        (PLAIN * 20, None),
        ("word " * 49, "token_count"),
        ("word " * 50, None),
        ("word " * 100_000, None),
        ("word " * 100_001, "token_count"),
        ("ab " * 100, "mean_length"),
        ("abc " * 100, None),
        ("abcdefghij " * 60, None),
        ("abcdefghijk " * 60, "mean_length"),
        ("\n".join(["this line trails off..."] * 31 + ["this line stops here."] * 69), "ellipsis_lines"),
        ("\n".join(["this line trails off..."] * 30 + ["this line stops here."] * 70), None),
        ("\n".join(["this line trails off…"] * 50 + ["this line stops here."] * 50), None),
        ("letters " * 80 + "1234567 " * 20, None),
        ("letters " * 79 + "1234567 " * 21, "alphabetic"),
        ("", "token_count"),
    ],
)
def test_quality_rules(spark, text, rule):
    assert failed(spark, text) == rule


@pytest.mark.parametrize("part", ["ab-", "1,", "a.", "a/", "a_b-", "'s", "n't", "é-"])
def test_chains_of_a_megabyte(spark, part):
    text = "see " + part * (1_000_000 // len(part)) + "ab end"
    measured = rules.with_rule_measures(spark.createDataFrame([(text,)], "text string")).first()
    assert measured["n_tokens"] > 100_000 if part == "'s" else measured["n_tokens"] < 6


def test_length_reasons_and_first_match(spark):
    texts = ["", " \n ", "word " * 49, "word " * 50, "word " * 100_001, "ab " * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, stripped string")
    df = df.selectExpr("i", "trim(stripped) AS stripped")
    got = {r["i"]: r["reason"] for r in rules.with_rule_reason(df).collect()}
    assert got == {0: "empty", 1: "empty", 2: "too_short", 3: None, 4: "too_long", 5: "gopher"}


def test_reports_add_up(spark):
    rows = [("a", None, 1, 0, 0), ("a", "gopher", 5, 0, 0), ("b", None, 0, 0, 0), ("b", "toxic", 0, 0, 0), ("b", "empty", 0, 0, 0)]
    judged = spark.createDataFrame(rows, "source string, reason string, n_email int, n_phone int, n_ip int")
    total = reports.filter_report(judged).first()
    assert (total["total"], total["kept"], total["masked_emails"], total["modified_pii_documents"]) == (5, 2, 1, 1)
    assert total["kept"] + sum(total[f"rejected_{r}"] for r in rules.REASONS) == total["total"]
    assert total["keep_ratio"] == 0.4
    by_source = {r["source"]: r for r in reports.filter_report_by_source(judged).collect()}
    assert {s: r["total"] for s, r in by_source.items()} == {"ALL": 5, "a": 2, "b": 3}
    funnel = reports.filter_funnel(judged).orderBy("stage_no").collect()
    assert [(r["stage"], r["removed"], r["remaining"]) for r in funnel] == [
        ("length", 1, 4), ("rules", 1, 3), ("quality", 0, 3), ("nsfw", 0, 3), ("toxic", 1, 2),
    ]
    assert {r["version"]: r["kept"] for r in reports.baseline_vs_final(judged).collect()} == {"baseline": 4, "final": 2}
    empty = reports.filter_report(judged.where("false")).first()
    assert (empty["total"], empty["kept"], empty["keep_ratio"], empty["masked_ips"]) == (0, 0, 0.0, 0)
