"""Language identification: a script rule for other scripts, character trigrams for the languages of a training table.

The classes are the languages that the training rows name. Scores are calibrated on held-out rows: a temperature makes them
probabilities among the known languages, and a text whose trigrams are less likely than those of nearly all held-out texts of its
language, as a text of a language not in the table is, has its score lowered. So a score is high only for texts that look
like the language, not just more like it than like the others.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.hashing import order_key
from siftwork.operators import classifiers as C
from siftwork.session import materialize

MIN_SCORE = 0.7
#: Languages a model can tell apart, at most: each is a column of its table.
MOST_LANGUAGES = 500
#: Sharpness of scores that are not calibrated.
TEMPERATURE = 2.0
#: Rows are dealt to folds by key: 0 for evaluation, 1 for calibration, the others for training.
FOLDS, EVALUATION, CALIBRATION = 5, 0, 1
#: Held-out texts of a language that its typical likelihood needs, and standard deviations below it that count as typical.
LEAST_TEXTS, SPREAD = 5, 3.0
#: Scripts that name a language on their own.
SCRIPTS = (("ja", r"[\p{IsHiragana}\p{IsKatakana}]"), ("ko", r"\p{IsHangul}"), ("ru", r"\p{IsCyrillic}"),
           ("el", r"\p{IsGreek}"), ("zh", r"\p{IsHan}"))
_OTHER_SCRIPT = r"[\x{370}-\x{1dff}\x{2c00}-\x{2c5f}\x{2d00}-\x{a71f}\x{a800}-\x{ab2f}\x{ab70}-\x{faff}\x{20000}-\x{323af}]"


@dataclass(frozen=True)
class Typical:
    """Mean log-likelihood per trigram of a language's held-out texts, its variances, and the weight of an unknown trigram."""

    mean: float
    text_variance: float
    trigram_variance: float
    floor: int


@dataclass(frozen=True)
class LanguageModel:
    table: DataFrame
    classes: tuple[str, ...]
    temperature: float = TEMPERATURE
    typical: dict[str, Typical] = field(default_factory=dict)

    @property
    def head(self) -> C.Head:
        return C.Head("lang", self.classes, self.temperature)


def fold(key: str) -> Column:
    """The fold of a row; it depends on its key alone."""
    return (F.conv(F.substring(order_key(F.lit("fold"), key), 1, 6), 16, 10).cast("int") % FOLDS).alias("fold")


def train_languages(df: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModel:
    """A model of every language that rows with a text name. Its scores are not calibrated yet."""
    labelled = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    classes = tuple(r[0] for r in labelled.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect())
    if not 0 < len(classes) <= MOST_LANGUAGES:
        raise ValueError(f"the training rows name {len(classes) or 'no'} languages; at most {MOST_LANGUAGES} are possible")
    return LanguageModel(C.train(labelled, (C.Head("lang", classes, TEMPERATURE),), C.TRIGRAMS), classes)


def calibrate(model: LanguageModel, held_out: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", rounds: int = 8) -> LanguageModel:
    """The model with a temperature and typical likelihoods from rows it was not trained on.

    The temperature is the one that makes the true languages likeliest, by Newton steps in one dimension; each step is one
    sum over a stored table of a few numbers per text. Rows of other languages are not used.
    """
    rows = held_out.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("text"))
    rows = rows.where(F.col("_lang").isin(*model.classes) & F.col("text").isNotNull())
    sums = materialize(C.score_sums(rows, model.table, (model.head,), C.TRIGRAMS, ["_key", "_lang"], "text", unknown=True))
    temperature = model.temperature
    for _ in range(rounds):
        slope, curvature = sums.agg(*_newton(model.head, temperature)).first()
        if not curvature or curvature <= 0:
            break
        step = min(max(temperature - slope / curvature, temperature / 4), 4 * temperature, 200.0)
        temperature = round(step, 6)
    return replace(model, temperature=temperature, typical=_typical(model, sums))


def _newton(head: C.Head, temperature: float) -> list[Column]:
    """First and second derivative of the negative log-likelihood, in whole units of 1e-9 per text."""
    means = [F.col(head.weight(i)) / (F.col("_n") * float(C.UNIT)) for i in range(len(head.classes))]
    best = F.greatest(*means, F.lit(-1e300))
    masses = [F.exp((m - best) * temperature) for m in means]
    whole = sum(masses[1:], masses[0])
    expected = sum((e * m for e, m in zip(masses[1:], means[1:])), masses[0] * means[0]) / whole
    squared = sum((e * m * m for e, m in zip(masses[1:], means[1:])), masses[0] * means[0] * means[0]) / whole
    own = F.coalesce(*[F.when(F.col("_lang") == c, m) for c, m in zip(head.classes, means)])
    unit = lambda x: F.sum(F.floor(x * 1e9 + 0.5).cast("long"))
    return [unit(expected - own), unit(squared - expected * expected)]


def _likelihood(head: C.Head, floors: Column) -> Column:
    """Mean log-likelihood per trigram of a text under its likeliest language, unknown trigrams included."""
    best = F.greatest(*[F.col(head.weight(i)) for i in range(len(head.classes))], F.lit(-(1 << 62)))
    return (best + (F.col("_all") - F.col("_n")) * floors) / (F.col("_all") * float(C.UNIT))


def _typical(model: LanguageModel, sums: DataFrame) -> dict[str, Typical]:
    head, word = model.head, ~F.expr(C.TRIGRAMS.is_bias)
    numbers = []
    for i in range(len(head.classes)):
        n, w = F.when(word, F.col(head.count(i))), F.floor(F.col(head.weight(i)) / 1000).cast("long")
        numbers += [F.sum(n).alias(f"n_{i}"), F.sum(n * w).alias(f"a_{i}"), F.sum(n * w * w).alias(f"b_{i}")]
    of = model.table.agg(F.count_if(word).alias("v"), *numbers).first()
    floors, spread = {}, {}
    for i, c in enumerate(head.classes):
        total = of[f"n_{i}"] or 0
        floors[c] = int(_half_away(_log(1 / (total + max(of["v"], 1))) * C.UNIT))
        spread[c] = of[f"b_{i}"] / total / 1e6 - (of[f"a_{i}"] / total / 1e3) ** 2 if total else 0.0
    named = sums.select("*", *C.verdicts((head,))).where("lang_label = _lang")
    value = _likelihood(head, _of_class(F.col("_lang"), floors, "long"))
    unit = lambda x: F.sum(F.floor(x * 1e6 + 0.5).cast("long"))
    found = named.select("_lang", value.alias("s")).groupBy("_lang").agg(F.count(F.lit(1)).alias("n"), unit(F.col("s")).alias("a"), unit(F.col("s") * F.col("s")).alias("b"))
    result = {}
    for r in found.where(F.col("n") >= LEAST_TEXTS).collect():  # at most one row per language
        mean = r["a"] / r["n"] / 1e6
        result[r["_lang"]] = Typical(mean, max(r["b"] / r["n"] / 1e6 - mean * mean, 0.0), max(spread[r["_lang"]], 0.0), floors[r["_lang"]])
    return result


def _log(x: float) -> float:
    from math import log

    return log(x)


def _half_away(x: float) -> float:
    """Half away from zero, as SQL rounds."""
    from math import floor

    return floor(x + 0.5) if x >= 0 else -floor(-x + 0.5)


def _of_class(label: Column, values: dict[str, float], kind: str) -> Column:
    """The value of a label from a few constants; null for other labels."""
    if not values:
        return F.lit(None).cast(kind)
    return F.coalesce(*[F.when(label == c, F.lit(v).cast(kind)) for c, v in values.items()])


def _script_share(text: Column) -> tuple[Column, Column]:
    """Language named by the script of more than half of the letters, with that share; null otherwise.

    Kana decide for Japanese as soon as they are a tenth of the letters, since Japanese also uses Han.
    """
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    label, share = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, pattern in reversed(SCRIPTS):
        part = F.regexp_count(text, F.lit(pattern)) / letters
        limit = 0.1 if name == "ja" else 0.5
        label = F.when(part > limit, name).otherwise(label)
        share = F.when(part > limit, F.when(F.lit(name == "ja"), F.lit(1.0)).otherwise(part)).otherwise(share)
    possible = text.rlike(_OTHER_SCRIPT) & (letters > 0)
    return F.when(possible, label), F.when(possible, share)


def identify(df: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, label, score)`` of every document. Texts are cleaned of newlines and outer space first."""
    label, share = _script_share(F.col(text))
    by_script = df.select(key, text, label.alias("_label"), share.alias("_share"))
    # the script verdict rides along as part of the grouping key, so no join is needed to combine both verdicts
    sums = C.score_sums(
        by_script, model.table, (model.head,), C.TRIGRAMS, [key, "_label", "_share"], text, when=F.col("_label").isNull(), unknown=True
    )
    named = sums.select("*", *C.verdicts((model.head,)))
    return named.select(
        key,
        F.coalesce("_label", "lang_label").alias("label"),
        F.coalesce(F.round("_share", 6), F.round(F.col("lang_score") * _typicality(model), 6)).alias("score"),
    )


def _typicality(model: LanguageModel) -> Column:
    """1 for a text as likely as held-out texts of its language are, falling towards 0 below; shorter texts vary more."""

    def of(name: str, kind: str = "double") -> Column:
        return _of_class(F.col("lang_label"), {c: getattr(t, name) for c, t in model.typical.items()}, kind)

    likelihood = _likelihood(model.head, of("floor", "long"))
    deviation = F.sqrt(of("text_variance") + of("trigram_variance") / F.col("_all"))
    below = (likelihood - of("mean")) / deviation + SPREAD
    return F.when(below < 0, F.exp(below)).otherwise(F.lit(1.0))


def is_confident_english(label: Column, score: Column) -> Column:
    return (label == "en") & (score >= MIN_SCORE)
