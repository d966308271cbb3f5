"""Length and quality rules, and the first-match rejection reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions import text as T

# Fixed limits of the rules.
MIN_WORDS, MAX_WORDS = 50, 100_000
MIN_MEAN_LENGTH, MAX_MEAN_LENGTH = 3, 10
MAX_ELLIPSIS_SHARE = 0.3
MIN_ALPHABETIC_SHARE = 0.8

#: Rejection reasons in the order they are tested.
REASONS = ("empty", "too_short", "too_long", "gopher", "low_quality", "nsfw", "toxic")


def length_reason(n_words: Column) -> Column:
    """``empty`` / ``too_short`` / ``too_long``, or null; both limits pass."""
    return (
        F.when(n_words == 0, "empty")
        .when(n_words < MIN_WORDS, "too_short")
        .when(n_words > MAX_WORDS, "too_long")
    )


def with_rule_measures(df: DataFrame, text: str = "text", flat: str | None = None, when: Column | None = None) -> DataFrame:
    """Adds n_tokens, mean_len, ellipsis_share, alpha_share (null where ``when`` is false).

    ``flat`` names a column with the text's white space flattened, if there is one already.
    """
    if flat is None:
        df, flat = df.withColumn("_flat", T.flatten_ws(F.col(text))), "_flat"

    def wanted(c: str) -> Column:
        return F.col(c) if when is None else F.when(when, F.col(c))

    parts = df.withColumns(
        {
            "_tokens": T.rule_tokens(wanted(flat)),
            "_lines": F.split(wanted(text), "\n"),
            "_chars": T.flat_length(wanted(flat)),
        }
    )
    # tokens cover every non-space character exactly once, so their total length is the number of such characters
    measures = parts.selectExpr(
        "*",
        "if(_tokens IS NULL, NULL, size(_tokens)) AS n_tokens",
        "if(size(_tokens) > 0, _chars / size(_tokens), NULL) AS mean_len",
        "size(filter(_lines, x -> endswith(x, '...'))) / size(_lines) AS ellipsis_share",
        # most tokens begin with an ASCII letter, which two comparisons see without a pattern
        r"if(size(_tokens) > 0, size(filter(_tokens, x -> (x >= 'a' AND x < '{') OR (x >= 'A' AND x < '[') OR x rlike r'\p{L}'))"
        " / size(_tokens), NULL) AS alpha_share",
    )
    return measures.drop("_tokens", "_lines", "_chars", "_flat")


def failed_rule() -> Column:
    """Name of the first quality rule a document fails, or null."""
    return (
        F.when(~F.col("n_tokens").between(MIN_WORDS, MAX_WORDS), "token_count")
        .when(~F.col("mean_len").between(MIN_MEAN_LENGTH, MAX_MEAN_LENGTH), "mean_length")
        .when(F.col("ellipsis_share") > MAX_ELLIPSIS_SHARE, "ellipsis_lines")
        .when(F.col("alpha_share") < MIN_ALPHABETIC_SHARE, "alphabetic")
    )


def with_rule_reason(df: DataFrame, text: str = "stripped", flat_text: str | None = None) -> DataFrame:
    """Adds ``reason`` from the length and quality rules alone. Tokens are made only where the length rule passes.

    ``flat_text`` names a column that keeps the text with its white space flattened.
    """
    flat = df.withColumn("_flat_text", T.flatten_ws(F.col(text)))
    sized = flat.withColumn("_length_reason", length_reason(T.flat_word_count(F.col("_flat_text"))))
    measured = with_rule_measures(sized, text, "_flat_text", F.col("_length_reason").isNull())
    reason = F.coalesce("_length_reason", F.when(failed_rule().isNotNull(), "gopher"))
    if flat_text:
        measured = measured.withColumn(flat_text, F.col("_flat_text"))
    return measured.withColumn("reason", reason).drop(
        "_flat_text", "_length_reason", "n_tokens", "mean_len", "ellipsis_share", "alpha_share"
    )


def final_reason(
    rule_reason: Column, quality: Column | None, nsfw: Column | None, toxic: Column | None
) -> Column:
    """First matching reason over rules and classifier labels; a missing classifier never rejects."""
    reason = F.when(rule_reason.isNotNull(), rule_reason)
    for label, bad, name in ((quality, "cc", "low_quality"), (nsfw, "nsfw", "nsfw"), (toxic, "toxic", "toxic")):
        if label is not None:
            reason = reason.when(label == bad, name)
    return reason
