"""Bytes → text → plain text of HTML pages."""

from __future__ import annotations

from functools import cache
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwork.functions import text as T

#: Elements dropped with their content.
HIDDEN_TAGS = ("script", "style", "head", "noscript", "template")
#: Elements set off by a blank line, and elements that start and end a line.
PARAGRAPH_TAGS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
LINE_TAGS = (
    "address", "article", "aside", "blockquote", "body", "dd", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "header", "hr", "html", "main", "nav", "ol", "option", "pre", "section", "select",
    "table", "tbody", "tfoot", "thead", "title", "tr", "ul",
)
ITEM = "  • "
# Marks for breaks while a page is taken apart; they cannot occur in a page whose white space is flattened.
_LINE, _PARAGRAPH, _ITEM = "\x01", "\x02", "\x04"


def try_decode_html(body: Column) -> Column:
    """``struct(text, error)``: strict UTF-8 where the bytes are valid; otherwise the declared charset, ignoring errors.

    A charset nobody knows counts as windows-1252. One that is known but cannot turn these bytes into text gives no text and the
    message as ``error``; it does not fail the job.
    """

    @F.pandas_udf("text string, error string")
    def by_declared_charset(batch: pd.Series) -> pd.DataFrame:
        import codecs
        import re

        import pandas as pd

        declared = re.compile(rb"charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)

        def decode(raw):
            if raw is None:
                return None, None
            found = declared.search(bytes(raw))
            name = found.group(1).decode("ascii") if found else "windows-1252"
            try:
                codecs.lookup(name)
            except LookupError:
                name = "windows-1252"
            try:
                return bytes(raw).decode(name, errors="ignore"), None
            except Exception as error:
                return None, f"{type(error).__name__}: {error}"[:200]

        return pd.DataFrame([decode(raw) for raw in batch], columns=["text", "error"], dtype=object)

    valid = F.is_valid_utf8(body.cast("string"))
    # the helper receives null for every valid page, so only the others are copied to Python
    other = by_declared_charset(F.when(~valid, body))
    return F.struct(F.coalesce(F.when(valid, body.cast("string")), other["text"]).alias("text"), other["error"].alias("error"))


def decode_html(body: Column) -> Column:
    """The text of :func:`try_decode_html`; null for bytes that cannot be decoded."""
    return try_decode_html(body)["text"]


#: A character reference: a number, or a name and what may follow it without a break.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@cache
def _references() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Characters by name, by those names that need no semicolon, and by the numbers that do not stand for themselves."""
    names = {f"&{k}": v for k, v in html5.items()}
    open_names = {k: v for k, v in names.items() if not k.endswith(";")}
    numbers = {str(n): bytes([n]).decode("cp1252", "replace").replace("\ufffd", chr(n)) for n in range(0x80, 0xA0)}
    return names, open_names, {**numbers, "0": "\ufffd", "13": "\r"}


def _numbered(reference: Column, numbers: dict[str, str]) -> Column:
    """The character of a numeric reference: none for numbers that are no character, U+FFFD for numbers out of range."""
    is_hex = F.lower(F.substring(reference, 3, 1)) == "x"
    digits = F.ltrim(F.rtrim(F.when(is_hex, F.substring(reference, 4, 1 << 20)).otherwise(F.substring(reference, 3, 1 << 20)), F.lit(";")), F.lit("0"))
    value = F.when(F.length(digits) > 8, 1 << 30).when(digits == "", 0).otherwise(
        F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("long").cast("int")
    )

    def character(n: Column) -> Column:
        nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
        known = F.try_element_at(T.constant_map(numbers), n.cast("string"))
        return F.when(known.isNotNull(), known).when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd").when(nothing, "").otherwise(
            F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        )

    return F.get(F.transform(F.array(value), character), F.lit(0))


def _named(reference: Column, names: dict[str, str], open_names: dict[str, str]) -> Column:
    """The characters of a name; else those of the longest name it begins with, and the rest; else the reference as it is."""
    begins = []
    for n in sorted({len(k) for k in open_names}, reverse=True):
        known = F.try_element_at(T.constant_map({k: v for k, v in open_names.items() if len(k) == n}), F.substring(reference, 1, n))
        begins.append(F.concat(known, F.substring(reference, n + 1, 1 << 20)))
    return F.coalesce(F.try_element_at(T.constant_map(names), reference), *begins, reference)


def unescape(text: Column) -> Column:
    """HTML character references, by name and by number, as browsers read them.

    Each distinct reference of a text is looked up once; the text between them is not touched.
    """
    names, open_names, numbers = _references()

    def value(reference: Column) -> Column:
        return F.when(F.substring(reference, 2, 1) == "#", _numbered(reference, numbers)).otherwise(_named(reference, names, open_names))

    return T.let(text, lambda t: T.replace_each(t, REFERENCE, value))


def markup_steps(drop: tuple[str, ...] = ()) -> tuple[tuple[str, str], ...]:
    """Pattern and replacement of each step from markup to text with break marks; entities stay escaped."""
    hidden = "|".join(HIDDEN_TAGS + tuple(drop))
    return (
        (r"(?s)<!--.*?-->", ""),
        (rf"(?is)<({hidden})\b[^>]*>.*?</\1\s*>", " "),
        (rf"[{T.WS_CLASS}\x01\x02\x04]+", " "),
        (r"(?i) ?<br\b[^>]*> ?", "\n"),
        (r"(?i)<li\b[^>]*>", _LINE + _ITEM),
        (r"(?i)</li\s*>", _LINE),
        (r"(?i)<t[dh]\b[^>]*>", " "),
        (rf"(?i)</?(?:{'|'.join(PARAGRAPH_TAGS)})\b[^>]*>", _PARAGRAPH),
        (rf"(?i)</?(?:{'|'.join(LINE_TAGS)})\b[^>]*>", _LINE),
        (r"<[!/?A-Za-z][^>]*>", ""),
    )


#: From break marks to line breaks: a bullet belongs to the text that follows it; a paragraph mark wins over line
#: marks next to it; at most one blank line remains.
BREAK_STEPS = (
    (r"\x04[ \n\x01\x02\x04]*", _ITEM),
    (r"[ \n\x01]*\x02[ \n\x01\x02]*", "\n\n"),
    (r"[ \x01]*\x01[ \x01]*", "\n"),
    (r" *\n *", "\n"),
    (r"\n\n\n+", "\n\n"),
    (r" +", " "),
    (r"\x04\z", ""),
)


def _apply(text: Column, steps) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def extract_text(page: Column, drop: tuple[str, ...] = ()) -> Column:
    """Plain text of a page: head and scripts dropped, navigation and hidden text kept, links kept as their text.

    Paragraphs and headings are set off by a blank line, other blocks by a line break; list items get a bullet
    (nested items are not indented further). ``drop`` names further elements to leave out with their content.
    """
    text = _apply(unescape(_apply(page, markup_steps(drop))), BREAK_STEPS)
    return F.replace(F.btrim(text, F.lit(" \n")), F.lit(_ITEM), F.lit(ITEM))
