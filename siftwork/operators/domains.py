"""Registered domains by the rules of the public suffix list.

A rule names a public suffix: ``co.uk`` itself, ``*.ck`` any label before ``ck``, and ``!www.ck`` an exception to that. Of the
rules that the end of a host matches, an exception prevails, else the one with most labels; the registered domain is that
suffix and one label more. Each ending of a host is looked up in the rule table, one broadcast join per number of labels, so rows
stay where they are and nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions.urls import host

#: The list as it comes with the libraries that Spark ships.
RESOURCE = "mozilla/public-suffix-list.txt"
#: Bound of the table that is broadcast; the published list has about ten thousand rules.
MOST_RULES = 200_000
NORMAL, WILDCARD, EXCEPTION = 1, 2, 4
ADDRESS = r"^[0-9]+(\.[0-9]+){3}$"


@dataclass(frozen=True)
class Suffixes:
    """``table``: (``suffix``, ``kind``), kinds of equal suffixes added up; ``depth``: the most labels of a suffix."""

    table: DataFrame
    depth: int


def _ascii(name: str) -> str:
    """The name as it stands in URLs of hosts with other than ASCII letters."""
    return ".".join(label.encode("idna").decode() for label in name.split("."))


def parse_rules(text: str, private: bool = False) -> dict[str, int]:
    """Kinds by suffix from the published format. The section of private domains counts only if asked for."""
    kinds: dict[str, int] = defaultdict(int)
    wanted = True
    for line in map(str.strip, text.splitlines()):
        if "===BEGIN PRIVATE DOMAINS===" in line:
            wanted = private
        elif "===BEGIN" in line:
            wanted = True
        if not wanted or not line or line.startswith("//"):
            continue
        rule = line.split()[0].lower()
        kind = EXCEPTION if rule.startswith("!") else WILDCARD if rule.startswith("*.") else NORMAL
        name = rule.removeprefix("!").removeprefix("*.")
        for written in {name, name if name.isascii() else _ascii(name)}:
            kinds[written] |= kind
    return dict(kinds)


def suffixes(spark: SparkSession, path: str | None = None, private: bool = False) -> Suffixes:
    """The rules of the file at ``path``, or of the list that comes with Spark."""
    if path:
        text = spark.read.text(path, wholetext=True).first()[0]
    else:
        stream = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResourceAsStream(RESOURCE)
        if stream is None:
            raise FileNotFoundError(f"{RESOURCE} is not among Spark's libraries; name a file with the rules")
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
    kinds = parse_rules(text, private)
    if not 0 < len(kinds) <= MOST_RULES:
        raise ValueError(f"{len(kinds)} rules; between 1 and {MOST_RULES} are expected")
    table = spark.createDataFrame(sorted(kinds.items()), "suffix string, kind int")
    return Suffixes(table, max(name.count(".") + 1 for name in kinds))


def _ending(labels: Column, n: int) -> Column:
    return F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.size(labels) - n + 1, F.lit(n)), "."))


def with_registered_domain(df: DataFrame, rules: Suffixes, url: str = "url", name: str = "domain") -> DataFrame:
    """``df`` with the registered domain of a URL; a column ``name`` is replaced.

    ``""`` for a null or empty URL, an address, a public suffix itself, and a host whose ending no rule knows.
    """
    labels, size = F.col("_labels"), F.size("_labels")
    dots = F.translate(host(F.col(url)), "。．｡", "...")
    name_ = F.rtrim(dots, F.lit("."))
    known = F.when(~name_.rlike(ADDRESS), F.split(name_, r"\."))
    result = df.drop(name).withColumn("_labels", known)
    lengths, exceptions = [], []
    for n in range(1, rules.depth + 1):
        side = rules.table.select(F.col("suffix").alias(f"_suffix_{n}"), F.col("kind").alias(f"_kind_{n}"))
        result = result.withColumn(f"_suffix_{n}", _ending(labels, n))
        result = result.join(F.broadcast(side), f"_suffix_{n}", "left").drop(f"_suffix_{n}")
        kind = F.col(f"_kind_{n}")
        lengths += [F.when(kind.bitwiseAND(NORMAL) > 0, n), F.when((kind.bitwiseAND(WILDCARD) > 0) & (size > n), n + 1)]
        exceptions.append(F.when(kind.bitwiseAND(EXCEPTION) > 0, n - 1))
    length = F.coalesce(*exceptions, F.greatest(*lengths))
    found = result.withColumn("_length", length)
    domain = F.array_join(F.slice(labels, size - F.col("_length"), F.col("_length") + 1), ".")
    found = found.withColumn(name, F.when(size > F.col("_length"), domain).otherwise(F.lit("")))
    return found.drop("_labels", "_length", *[f"_kind_{n}" for n in range(1, rules.depth + 1)])
