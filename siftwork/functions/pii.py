"""Masking of personal data: e-mail addresses, telephone numbers, IPv4 addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import WS_CLASS

# Placeholders and patterns decide the masked text. \p{Nd} is any Unicode digit.
EMAIL_MASK = "|||EMAIL_ADDRESS|||"
PHONE_MASK = "|||PHONE_NUMBER|||"
IP_MASK = "|||IP_ADDRESS|||"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = (
    rf"(?<!\p{{Nd}})\(?\p{{Nd}}{{3}}\)?[-.{WS_CLASS}]?\(?\p{{Nd}}{{3}}\)?[-.{WS_CLASS}]?\p{{Nd}}{{4}}(?!\p{{Nd}})"
)
_OCTET = r"(?:25[0-5]|2[0-4]\p{Nd}|1\p{Nd}\p{Nd}|[1-9]?\p{Nd})"
IPV4 = rf"(?<!\p{{Nd}})(?:{_OCTET}\.){{3}}{_OCTET}(?!\p{{Nd}})"


def _mask(text: Column, pattern: str, mask: str, possible: Column) -> tuple[Column, Column]:
    """Masked text and number of replacements; ``possible`` is a cheap test that lets most texts skip the pattern."""
    masked = F.when(possible, F.regexp_replace(text, pattern, mask)).otherwise(text)
    count = F.when(possible, F.regexp_count(text, F.lit(pattern))).otherwise(F.lit(0))
    return masked, count


def mask_emails(text: Column) -> tuple[Column, Column]:
    return _mask(text, EMAIL, EMAIL_MASK, F.contains(text, F.lit("@")))


def mask_phones(text: Column) -> tuple[Column, Column]:
    return _mask(text, PHONE, PHONE_MASK, text.rlike(r"\p{Nd}{4}"))


def mask_ips(text: Column) -> tuple[Column, Column]:
    return _mask(text, IPV4, IP_MASK, text.rlike(r"\p{Nd}\.\p{Nd}"))


def with_masked(df: DataFrame, text: str = "text", masked: str = "masked") -> DataFrame:
    """Mask e-mails, then telephone numbers, then IPs, each on the result of the step before.

    Adds ``masked``, ``n_email``, ``n_phone``, ``n_ip``. Every step is its own projection, so each pattern runs
    on a column and not on a copy of the previous expression.
    """
    current = text
    for step, (name, mask) in enumerate((("n_email", mask_emails), ("n_phone", mask_phones), ("n_ip", mask_ips))):
        new_text, count = mask(F.col(current))
        result = masked if step == 2 else f"_masked_{step}"
        df = df.withColumns({result: new_text, name: count})
        current = result
    return df.drop("_masked_0", "_masked_1")
