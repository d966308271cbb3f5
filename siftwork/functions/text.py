"""Column functions on plain text: white space, words, normal forms, tokens.

Everything here is a built-in expression evaluated in the JVM, but for the canonical decomposition.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as a regexp class body (valid for Java and RE2) and as a list of characters.
WS_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"
WS_CHARS = "".join(
    chr(c) for c in range(0x3001) if chr(c).isspace()
)
WS = f"[{WS_CLASS}]+"
NON_ASCII = r"[^\x00-\x7f]"

#: A token of the quality rules: an ellipsis, a word with inner ' . / - (or , : before a digit), or one symbol.
#: Quantifiers are possessive: Java then repeats the group in a loop, however long a chain of parts is. A plain ``*`` repeats
#: it by recursion, and a chain of a few thousand parts would overflow the stack of the executor.
_W = r"[\p{L}\p{M}\p{N}_]"
PLAIN_TOKEN = rf"\.\.\.|{_W}++(?:['./-]{_W}++|[,:]\p{{N}}{_W}*+)*+|[^{WS_CLASS}]"
#: English clitics count as tokens of their own; they are set off by a space before tokenizing.
CLITIC = r"(?i)(n't|'(?:s|m|d|ll|re|ve))(?![\p{L}\p{N}_])"
TOKEN = rf"'(?i:s|m|d|ll|re|ve)(?![\p{{L}}\p{{N}}_])|{PLAIN_TOKEN}"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def flatten_ws(text: Column) -> Column:
    """Every run of white space becomes one space; none is left at the ends."""
    return F.btrim(F.regexp_replace(text, WS, " "), F.lit(" "))


def words(text: Column) -> Column:
    """White-space separated words; the empty array for blank text."""
    stripped = strip(text)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, WS))


def word_count(text: Column) -> Column:
    return flat_word_count(flatten_ws(text))


def flat_word_count(flat: Column) -> Column:
    """Words of a text whose white space is already flattened: one more than its spaces."""
    return F.when(flat == "", F.lit(0)).otherwise(F.length(flat) - flat_length(flat) + 1)


def flat_length(flat: Column) -> Column:
    """Characters other than white space of a flattened text."""
    return F.length(F.replace(flat, F.lit(" "), F.lit("")))


def excerpt(text: Column, length: int = 800) -> Column:
    """The first characters of a text, as shown to a reviewer."""
    return F.substring(text, 1, length)


def one_line(text: Column) -> Column:
    """Classifier input: newlines become spaces, ends are stripped."""
    return strip(F.translate(text, "\n", " "))


def bare_label(label: Column) -> Column:
    """``__label__x`` → ``x`` (the prefix has nine characters)."""
    return F.substring(label, 10, 1 << 20)


@cache
def _accent_table() -> tuple[str, str]:
    """Characters to fold onto their base character, then characters to delete (non-spacing marks)."""
    source, target, dropped = [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        char = chr(code)
        base = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if not base:
            dropped.append(char)
        elif len(base) == 1 and base[0] != char:
            source.append(char)
            target.append(base[0])
    return "".join(source) + "".join(dropped), "".join(target)


@cache
def _spread_out() -> dict[str, str]:
    """Characters other than Hangul syllables that decompose into several spacing characters."""
    found = {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) > 1:
            found[chr(code)] = base
    return found


def _jamo(syllable: Column) -> Column:
    """The two or three letters of a Hangul syllable; they follow from its number."""
    number = F.ascii(syllable) - 0xAC00
    letters = [F.array(*[F.lit(chr(first + i)) for i in range(n)]) for first, n in ((0x1100, 19), (0x1161, 21))]
    tails = F.array(F.lit(""), *[F.lit(chr(0x11A8 + i)) for i in range(27)])
    return F.concat(
        F.get(letters[0], F.floor(number / 588).cast("int")), F.get(letters[1], F.floor(number % 588 / 28).cast("int")),
        F.get(tails, (number % 28).cast("int")),
    )


def strip_accents(text: Column) -> Column:
    """Canonical decomposition without the non-spacing marks: a translation table built from the Unicode data, and for the
    texts that hold them, Hangul syllables by arithmetic and the few characters with several spacing parts one by one."""
    source, target = _accent_table()
    spread = _spread_out()
    plain = F.translate(text, source, target)
    parts = plain
    for character, base in spread.items():
        parts = F.replace(parts, F.lit(character), F.lit(base))
    plain = F.when(text.rlike(f"[{''.join(spread)}]"), parts).otherwise(plain)
    return F.when(text.rlike("[\uac00-\ud7a3]"), let(plain, lambda t: replace_each(t, "[\uac00-\ud7a3]", _jamo))).otherwise(plain)


def normalize_text(text: Column) -> Column:
    """Near-duplicate normal form: no accents, lower case, punctuation and white space runs become one space.

    ASCII texts skip the accent table and use a character class without Unicode properties.
    """
    ascii_breaks = "".join(
        f"\\x{c:02x}" for c in range(128) if chr(c).isspace() or unicodedata.category(chr(c)).startswith("P")
    )
    spaced = F.when(
        text.rlike(NON_ASCII), F.regexp_replace(F.lower(strip_accents(text)), rf"[{WS_CLASS}\p{{P}}]+", " ")
    ).otherwise(F.regexp_replace(F.lower(text), f"[{ascii_breaks}]+", " "))
    return F.btrim(spaced, F.lit(" "))


def constant_map(entries: dict[str, str]) -> Column:
    """A map of constants; it is one literal, which the optimizer turns into the map."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in entries.items())), F.lit("\x01"), F.lit("\x02"))


def replace_each(text: Column, pattern: str, change) -> Column:
    """``text`` with every match of ``pattern`` changed; each distinct match is changed once."""
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    table = F.get(F.transform(F.array(F.array_distinct(every)), lambda d: F.map_from_arrays(d, F.transform(d, change))), F.lit(0))

    def joined(found: Column) -> Column:
        after = lambda i: F.coalesce(F.try_element_at(found["table"], F.get(found["all"], i)), F.lit(""))
        return F.array_join(F.transform(F.split(text, pattern), lambda piece, i: F.concat(piece, after(i))), "")

    found = F.array(F.struct(every.alias("all"), table.alias("table")))
    return F.when(text.rlike(pattern), F.get(F.transform(found, joined), F.lit(0))).otherwise(text)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical_decompose(text: Column) -> Column:
    """Unicode NFD. Only texts that hold characters which it may change leave the JVM, once each."""

    def decomposed(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None else unicodedata.normalize("NFD", t.decode("utf-8", "replace")) for t in texts.to_pylist()], pa.string())

    changeable = text.rlike(r"[\x{c0}-\x{1fff}\x{2000}\x{2001}\x{2100}-\x{10ffff}]")
    return F.coalesce(F.arrow_udf(decomposed, "string")(F.when(changeable, F.encode(text, "UTF-8"))), text)


def normalize_exact(text: Column) -> Column:
    """Exact-duplicate normal form: NFD, lower case, white space collapsed; accents and punctuation stay."""
    return flatten_ws(F.lower(canonical_decompose(text)))


def rule_tokens(text: Column) -> Column:
    """Tokens of the quality rules (punctuation marks are tokens)."""
    spaced = F.when(F.contains(text, F.lit("'")), F.regexp_replace(text, CLITIC, " $1")).otherwise(text)
    return F.regexp_extract_all(spaced, F.lit(TOKEN), F.lit(0))
