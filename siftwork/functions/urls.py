"""URL functions: host, validity, extraction from wiki references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: they decide which URLs are found and kept.
URL = (
    r"(?U)\b(?:https?|telnet|gopher|file|wais|ftp):"
    r"[\w/#~:.?+=&%@!\-\\]+?"
    r"(?=[.:?\-]*(?:[^\w/#~:.?+=&%@!\-]|$))"
)
REFERENCE = r"&lt;ref&gt(.*)&lt;/ref&gt;"

def host(url: Column) -> Column:
    """Lower-case host without user, port and brackets; empty where there is none."""
    return F.lower(
        F.regexp_extract(url, r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*+@)*+([^/?#@:\[\]]+)", 1)
    )


def is_valid_url(url: Column) -> Column:
    """Scheme http or https and a network location with a dot; unbalanced brackets are malformed."""
    netloc = F.regexp_extract(url, r"(?i)^https?://([^/?#]*)", 1)
    balanced = F.contains(netloc, F.lit("[")) == F.contains(netloc, F.lit("]"))
    return F.coalesce(F.contains(netloc, F.lit(".")) & balanced, F.lit(False))


def urls_in(text: Column) -> Column:
    """All URLs of a text; trailing ``. : ? -`` are not part of a URL."""
    return F.regexp_extract_all(text, F.lit(URL), F.lit(0))


def reference_urls(line: Column) -> Column:
    """URLs of the references of a dump line, from its first reference to its last."""
    return urls_in(F.regexp_extract(line, REFERENCE, 0))
