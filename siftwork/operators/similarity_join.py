"""All pairs of sets with a Jaccard similarity of at least a threshold, by prefix filtering.

Elements are ordered by how many sets hold them, rarest first. Two similar sets have many common elements, so the rarest common
one is among the first few of both: with ``n`` elements, of which ``m`` occur in other sets too, it is among the first
``m - ceil(t n) + 1`` of these (elements of one set only can never meet and are not even listed). So only these prefixes are
joined. A pair that meets is dropped if the sizes differ too much, or if the elements after the meeting place are too few to
reach the overlap that the threshold asks for; what is left is compared as a whole. Nothing is approximate.

An element that many prefixes hold is a hot key; it is salted by the set that meets the others. With a ``component`` per set, only
pairs between components are wanted: elements whose sets are all of one component are dropped before the join, and of
the others the sets outside the least component meet the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators.skew import salted_join
from siftwork.session import materialize

#: Keeps products such as 0.8 * 35 from being rounded up beyond the integer they stand for.
_SLACK = 1e-9


def _least_overlap(size: Column, threshold: float) -> Column:
    return F.ceil(size * threshold - _SLACK)


def prefixes(sets: DataFrame, threshold: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(rep, *keep, size, shared, element, place)``: the prefix of every set that can be similar to another one.

    ``shared`` counts the elements that occur in other sets as well, ``place`` is the rank among them from 1.
    """
    rows = sets.select("rep", F.size("grams").alias("size"), F.explode("grams").alias("element"))
    counts = materialize(rows.groupBy("element").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = salted_join(rows, counts, ["element"], F.col("rep"), counts=counts)
    ranked = met.groupBy("rep", "size").agg(F.array_sort(F.collect_list(F.struct("n", "element"))).alias("_ranked"))
    spare = F.size("_ranked") - _least_overlap(F.col("size"), threshold)
    possible = ranked.withColumn("_prefix", (spare + 1).cast("int")).where("_prefix > 0")
    if keep:
        possible = possible.join(sets.select("rep", *keep), "rep")
    return possible.select(
        "rep", *keep, "size", F.size("_ranked").alias("shared"),
        F.posexplode(F.slice("_ranked.element", F.lit(1), F.col("_prefix"))).alias("_i", "element"),
    ).select("rep", *keep, "size", "shared", "element", (F.col("_i") + 1).alias("place"))


def candidate_pairs(sets: DataFrame, threshold: float, component: str | None = None) -> DataFrame:
    """``(a, b)``, ``a < b``, distinct: pairs of ``sets`` (``rep``, ``grams``) that may reach the threshold; none that does is missing."""
    if component is None:
        component, sets = "_own", sets.withColumn("_own", F.col("rep"))
    rows = materialize(prefixes(sets, threshold, (component,)))
    groups = rows.groupBy("element").agg(F.min(component).alias("_main"), F.max(component).alias("_last"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups.where("_main <> _last").select("element", "_main", "n"))
    placed = salted_join(rows, groups.drop("n"), ["element"], F.col("rep"), counts=groups).withColumnRenamed(component, "_c")
    outside = placed.where("_c <> _main").select(
        "element", F.col("rep").alias("o_rep"), F.col("_c").alias("o_c"), F.col("size").alias("o_size"),
        F.col("shared").alias("o_shared"), F.col("place").alias("o_place"),
    )
    met = salted_join(placed.drop("_main"), outside, ["element"], F.col("rep"), counts=groups)
    smaller, larger = F.least("size", "o_size"), F.greatest("size", "o_size")
    both = F.ceil((F.col("size") + F.col("o_size")) * (threshold / (1 + threshold)) - _SLACK)
    reachable = F.least(F.col("shared") - F.col("place"), F.col("o_shared") - F.col("o_place")) + 1
    wanted = met.where((F.col("_c") != F.col("o_c")) & (smaller >= larger * threshold - _SLACK) & (reachable >= both))
    return wanted.select(F.least("rep", "o_rep").alias("a"), F.greatest("rep", "o_rep").alias("b")).distinct()
