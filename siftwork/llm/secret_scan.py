"""Secrets in texts: fixed patterns, and strings whose characters are too evenly spread to be language.

Four kinds of spans are found, each leftmost and without overlaps inside its kind: ``assign`` (a value assigned to a name
such as ``password``; the span covers name and value), ``access`` (access key ids), ``hex`` (long hexadecimal strings) and
``entropy``. For ``entropy`` each candidate string is passed by a sliding window. The counts of the window's characters
change by one character in and one out, and with them the Shannon entropy; the string is reported from its first to its
last window whose entropy reaches the limit of its character class (hexadecimal or base64). Candidates on the allow list
are suppressed: plain words and numbers, identifiers such as UUIDs, placeholders, and any patterns the caller adds.

Positions are code points from 0, the end exclusive. Defined results: a null text is the empty one and has no spans;
repeated secrets are all reported; overlapping spans of different kinds are all kept.

Everything is a built-in expression of one row: no Python in tasks, no shuffle, and time in proportion to the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.llm.lets import let, running

# Names, value characters and least lengths of the patterns.
ASSIGN_HEAD = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)"""
ASSIGN_VALUE = r"([A-Za-z0-9+/_.=-]+)"
LEAST_VALUE = 6
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"

#: Marks around a match and between its head and value; while spans are counted, the same characters of a text are taken
#: for ``_OTHER``, which is as long.
_MARK, _INNER, _OTHER = "\x01", "\x02", "\x03"
#: How these characters are written while a text is rewritten, in the order in which they are read back.
_WRITTEN = ((_MARK, "\x03\x04"), (_INNER, "\x03\x05"), (_OTHER, "\x03\x06"))
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="


@dataclass(frozen=True)
class EntropyRule:
    """Window, limits in bits per character and suppressed strings of the entropy scan."""

    window: int = 20
    hex_limit: float = 3.0
    base64_limit: float = 3.9
    #: A candidate that one of these matches as a whole is suppressed. Patterns of a caller should repeat groups possessively
    #: (``(...)++``): Java repeats other groups by recursion, and a candidate of some thousand parts overflows its stack.
    allow: tuple[str, ...] = (
        r"[A-Z]?[a-z]+=*|[A-Z]+=*",  # a word
        r"[0-9]+",
        r"[a-z]++([-_/][a-z]++)++|[A-Z]++([-_/][A-Z]++)++",  # words joined by marks, however many
        r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUID
        r"[0-9]{4}-[0-9]{2}-[0-9]{2}.*",  # a date first
        r".*(?i:example|placeholder|xxxx|your[-_]).*",
    )

    @property
    def candidate(self) -> str:
        return rf"([A-Za-z0-9+/_-]{{{self.window},}}=*)"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    marked: str
    head: bool = False  # a match has a head before its value


ASSIGN_KIND = Kind("assign", ASSIGN_HEAD + ASSIGN_VALUE, f"{_MARK}$1{_INNER}$2{_MARK}", True)
ACCESS_KIND = Kind("access", ACCESS, f"{_MARK}$1{_MARK}")
HEX_KIND = Kind("hex", HEX, f"{_MARK}$1{_MARK}")
SPAN = "array<struct<start: bigint, end: bigint>>"


def _parts(text: Column, kind: Kind) -> Column:
    """The text cut at the matches of a kind: every second part is a match."""
    plain = F.translate(text, _MARK + _INNER, _OTHER + _OTHER)
    return F.split(F.regexp_replace(plain, F.lit(kind.pattern), F.lit(kind.marked)), _MARK)


def _is_match(place: Column) -> Column:
    return place % 2 == 1


def _value(part: Column, kind: Kind) -> Column:
    return F.substring_index(part, _INNER, -1) if kind.head else part


def _windows(candidate: Column, rule: EntropyRule) -> Column:
    """``(first, last)`` places of the candidate inside windows over the limit; ``first`` is -1 if there is none."""
    w, n = rule.window, len(ALPHABET)
    weight = F.array(*[F.lit(0.0 if c < 2 else c * _log2(c)) for c in range(w + 2)])
    limit = F.when(candidate.rlike("^[0-9A-Fa-f]+$"), F.lit(rule.hex_limit)).otherwise(F.lit(rule.base64_limit))
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def scan(held: Column) -> Column:
        codes, most = held["codes"], held["most"]

        def step(s: Column, i: Column) -> Column:
            entering = F.get(codes, i)
            leaving = F.when(i >= w, F.get(codes, i - w)).otherwise(F.lit(-1))
            counts = F.transform(
                s["counts"], lambda c, j: c + (j == entering).cast("int") - (j == leaving).cast("int")
            )

            def moved(c: Column) -> Column:
                old = lambda j: F.when(j >= 0, F.get(weight, F.get(s["counts"], j))).otherwise(F.lit(0.0))
                new = lambda j: F.when(j >= 0, F.get(weight, F.get(c, j))).otherwise(F.lit(0.0))
                change = F.when(entering == leaving, F.lit(0.0)).otherwise(
                    new(entering) - old(entering) + new(leaving) - old(leaving)
                )
                spread = s["spread"] + change
                high = (i >= w - 1) & (spread <= most)
                return F.struct(
                    c.alias("counts"), spread.alias("spread"),
                    F.when(high & (s["first"] < 0), i - w + 1).otherwise(s["first"]).alias("first"),
                    F.when(high, i + 1).otherwise(s["last"]).alias("last"),
                )

            return let(counts, moved)

        start = F.struct(
            F.array_repeat(F.lit(0), n).alias("counts"), F.lit(0.0).alias("spread"),
            F.lit(-1).alias("first"), F.lit(-1).alias("last"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1), start, step,
            lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")),
        )

    # entropy = log2(w) - spread / w, where spread is the sum of c * log2(c) over the window's counts
    most = (F.lit(_log2(w)) - limit) * w + 1e-9
    return let(F.struct(codes.alias("codes"), most.alias("most")), scan)


def _log2(x: float) -> float:
    from math import log2

    return log2(x)


def _allowed(candidate: Column, rule: EntropyRule) -> Column:
    return candidate.rlike("^(?:" + "|".join(f"(?:{p})" for p in rule.allow) + ")$")


def _no_window() -> Column:
    return F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("last"))


def kind_spans(text: Column, kind: Kind) -> Column:
    """Spans of one of the fixed kinds."""

    def placed(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p, i: F.length(p) - (_is_match(i) & F.lit(kind.head)).cast("int"))
        return let(
            lengths,
            lambda ls: let(
                running(ls),
                lambda starts: F.filter(
                    F.transform(
                        parts,
                        lambda p, i: F.when(
                            _is_match(i) & ((F.length(_value(p, kind)) >= LEAST_VALUE) | F.lit(not kind.head)),
                            F.struct(F.get(starts, i).alias("start"), (F.get(starts, i) + F.get(ls, i)).alias("end")),
                        ),
                    ),
                    lambda s: s.isNotNull(),
                ),
            ),
        )

    return F.when(text.rlike(kind.pattern), let(_parts(text, kind), placed)).otherwise(F.array().cast(SPAN))


def entropy_spans(text: Column, rule: EntropyRule) -> Column:
    """Spans of the candidate strings' windows over the limit."""
    kind = Kind("entropy", rule.candidate, f"{_MARK}$1{_MARK}")

    def placed(parts: Column) -> Column:
        found = F.transform(
            parts,
            lambda p, i: F.when(_is_match(i) & ~_allowed(p, rule), _windows(p, rule)).otherwise(_no_window()),
        )
        return let(
            found,
            lambda ws: F.when(F.exists(ws, lambda w: w["first"] >= 0), let(
                running(F.transform(parts, F.length)),
                lambda starts: F.filter(
                    F.transform(
                        ws,
                        lambda w, i: F.when(
                            w["first"] >= 0,
                            F.struct(
                                (F.get(starts, i) + w["first"]).alias("start"), (F.get(starts, i) + w["last"]).alias("end")
                            ),
                        ),
                    ),
                    lambda s: s.isNotNull(),
                ),
            )).otherwise(F.array().cast(SPAN)),
        )

    return F.when(text.rlike(rule.candidate), let(_parts(text, kind), placed)).otherwise(F.array().cast(SPAN))


def with_spans(df: DataFrame, text: str = "text", rule: EntropyRule = EntropyRule()) -> DataFrame:
    """``df`` with a column of spans for each kind: ``assign``, ``access``, ``hex``, ``entropy``.

    Columns of these names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = {k.name: kind_spans(whole, k) for k in (ASSIGN_KIND, ACCESS_KIND, HEX_KIND)}
    return df.withColumns({**found, "entropy": entropy_spans(whole, rule)})


def listed(*kinds: str) -> Column:
    """``kind:start:end`` of the spans of some columns by start, then kind as listed, comma-joined."""

    def ranked(rank: int, kind: str) -> Column:
        return F.transform(
            F.col(kind),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    entries = F.concat(*[ranked(i, k) for i, k in enumerate(kinds)])
    return F.array_join(
        F.transform(F.sort_array(entries), lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, rule: EntropyRule = EntropyRule(), mask: str = "[SECRET]") -> Column:
    """The text with the value of every secret replaced by ``mask``. No other character changes, control characters included."""

    def masked(value: Column, kind: Kind, secret) -> Column:
        def joined(parts: Column) -> Column:
            return F.array_join(
                F.transform(
                    parts,
                    lambda p, i: F.when(
                        _is_match(i) & secret(p),
                        F.concat(F.substring_index(p, _INNER, 1), F.lit(mask)) if kind.head else F.lit(mask),
                    ).otherwise(F.replace(p, F.lit(_INNER), F.lit("")) if kind.head else p),
                ),
                "",
            )

        return F.when(value.rlike(kind.pattern), let(_parts(value, kind), joined)).otherwise(value)

    entropy = Kind("entropy", rule.candidate, f"{_MARK}$1{_MARK}")
    always = lambda p: F.lit(True)
    steps = (
        (ASSIGN_KIND, lambda p: F.length(_value(p, ASSIGN_KIND)) >= LEAST_VALUE), (ACCESS_KIND, always), (HEX_KIND, always),
        (entropy, lambda p: ~_allowed(p, rule) & (_windows(p, rule)["first"] >= 0)),
    )

    def chain(value: Column, rest) -> Column:
        return value if not rest else let(masked(value, *rest[0]), lambda v: chain(v, rest[1:]))

    def written(value: Column) -> Column:
        for character, code in reversed(_WRITTEN):
            value = F.replace(value, F.lit(character), F.lit(code))
        return value

    def read(value: Column) -> Column:
        for character, code in _WRITTEN:
            value = F.replace(value, F.lit(code), F.lit(character))
        return value

    marked = text.rlike("[\x01-\x03]")
    return F.when(marked, let(written(text), lambda t: read(chain(t, steps)))).otherwise(let(text, lambda t: chain(t, steps)))
