"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs, a long paragraph being taken sentence by sentence. Each piece is hashed into a
wide vector, and the fingerprint is the sum of the vectors, each lane modulo a power of two:

* lane 0 counts the pieces, and ``DENSE`` lanes of 32 bits receive a value of every piece. They decide equality, whatever
  the order of the pieces.
* ``LEVELS x SLOTS`` lanes of 16 bits receive a value of the pieces that fall into the lane. Level 0 gets half of the
  pieces, level 1 a quarter, and so on. Where two fingerprints differ in few lanes of a level, those lanes tell how many
  pieces differ, for short and long texts alike (:func:`likeness`).

Adding or removing pieces adds or subtracts their vectors (:func:`combine`, :func:`remove`), so a stored fingerprint
follows an edit without the rest of the text, and partial fingerprints add up in any order.

Defined results: a null text is the empty one; the empty text has the fingerprint of all zeros; two empty texts are alike
(1.0), an empty and a non-empty text are not (0.0). Repeated pieces count as often as they occur.

Everything is a built-in expression: no Python runs in tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DENSE, LEVELS, SLOTS = 4, 8, 16
LANES = 1 + DENSE + LEVELS * SLOTS
WIDE, NARROW = 0xFFFFFFFF, 0xFFFF
#: A piece ends at a line break, or at a space after one of these.
SENTENCE_ENDS = ".!?"
#: A level is usable for counting differences while at most so many of its lanes differ.
READABLE = 11


def pieces(text: Column) -> Column:
    """Paragraphs of a text, long ones by sentence; empty pieces do not count."""
    text = F.coalesce(text, F.lit(""))
    for mark in SENTENCE_ENDS:
        text = F.replace(text, F.lit(mark + " "), F.lit(mark + "\n"))
    return F.filter(F.split(text, "\n"), lambda p: p != "")


def _total(values: Column) -> Column:
    # 2^31 values of 32 bits fit into a long
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, v: s + v)


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a column that later lambdas read; a plain column would be computed again in each call."""
    return df.withColumn(name, F.explode(F.array(value)))


def _hashed(seed: int | str):
    return lambda piece: F.xxhash64(F.lit(seed), piece)


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with the lanes of its texts as ``array<bigint>``; rows stay where they are."""
    found = _held(df, "_pieces", pieces(F.col(text)))
    lanes = [F.size("_pieces").cast("long")]
    for seed in range(DENSE // 2):
        hashed = F.transform("_pieces", _hashed(seed))
        lanes += [
            _total(F.transform(hashed, lambda h: h.bitwiseAND(F.lit(WIDE)))).bitwiseAND(F.lit(WIDE)),
            _total(F.transform(hashed, lambda h: F.shiftrightunsigned(h, 32))).bitwiseAND(F.lit(WIDE)),
        ]
    # eight random bits to a level: the number of leading zero bits
    level = F.array(*[F.lit((LEVELS - x.bit_length() if x else LEVELS - 1) * SLOTS) for x in range(1 << LEVELS)])
    placed = F.transform(
        F.transform("_pieces", _hashed("slot")),
        lambda h: F.shiftleft(
            F.get(level, h.bitwiseAND(F.lit((1 << LEVELS) - 1)).cast("int"))
            + F.shiftright(h, 8).bitwiseAND(F.lit(SLOTS - 1)).cast("int"), 16,
        ).bitwiseOR(F.shiftright(h, 16).bitwiseAND(F.lit(NARROW)).cast("int")),
    )
    found = _held(_held(found, "_dense", F.array(*lanes)), "_placed", placed).drop("_pieces")
    found = _held(found, "_filled", F.array_distinct(F.transform("_placed", lambda e: F.shiftright(e, 16))))
    sums = F.transform(
        "_filled",
        lambda lane: _total(
            F.transform(
                F.filter("_placed", lambda e: F.shiftright(e, 16) == lane),
                lambda e: e.bitwiseAND(F.lit(NARROW)).cast("long"),
            )
        ).bitwiseAND(F.lit(NARROW)),
    )
    found = _held(found, "_sums", F.map_from_arrays("_filled", sums)).drop("_placed", "_filled")
    slots = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS * SLOTS - 1)),
        lambda i: F.coalesce(F.try_element_at("_sums", i), F.lit(0).cast("long")),
    )
    return _held(found, name, F.concat("_dense", slots)).drop("_dense", "_sums")


def _modulo(value: Column, lane: Column) -> Column:
    return value.bitwiseAND(F.when(lane <= DENSE, F.lit(WIDE)).otherwise(F.lit(NARROW)))


def combine(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two multisets (insertion)."""
    return F.transform(F.zip_with(a, b, lambda x, y: x + y), _modulo)


def remove(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the pieces of ``b`` (deletion)."""
    return F.transform(F.zip_with(a, b, lambda x, y: x - y), _modulo)


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with the estimated share of pieces that the texts of two fingerprints have in common (0 to 1).

    The number of differing pieces is read from the finest level that is not crowded with differences; with the two piece
    counts it gives the Jaccard similarity of the multisets. Equal fingerprints have 1.0.
    """
    differing = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS - 1)),
        lambda level: _total(
            F.zip_with(
                F.slice(F.col(a), DENSE + 2 + level * SLOTS, F.lit(SLOTS)),
                F.slice(F.col(b), DENSE + 2 + level * SLOTS, F.lit(SLOTS)),
                lambda x, y: (x != y).cast("long"),
            )
        ),
    )
    df = _held(df, "_z", differing)
    first = F.coalesce(
        F.array_position(F.transform("_z", lambda z: z <= READABLE), True).cast("int"), F.lit(0)
    )
    start = F.when(first == 0, F.lit(LEVELS)).otherwise(first)
    counted = F.aggregate(
        F.slice("_z", start, F.lit(LEVELS)), F.lit(0.0),
        lambda s, z: s - SLOTS * F.log(1 - F.least(z, F.lit(SLOTS - 0.5)) / SLOTS),
    )
    differ = counted * F.pow(F.lit(2.0), start - 1)
    both = F.col(a)[0] + F.col(b)[0]
    alike = F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), (both - differ) / (both + differ)))
    )
    return df.withColumn(name, alike).drop("_z")


def text_of(fingerprint: Column) -> Column:
    """Fixed-width lower-case hex of the lanes, for output and comparison."""
    return F.lower(
        F.array_join(F.transform(fingerprint, lambda v, i: F.lpad(F.hex(v), F.when(i <= DENSE, 8).otherwise(4), F.lit("0"))), "")
    )


def from_pieces(df: DataFrame, key: str, piece: str) -> DataFrame:
    """``(key, fingerprint)`` of texts stored as rows of pieces; equal to :func:`with_fingerprint` of the joined text.

    One sum per lane with partial aggregation, so a key of any size is added up where its rows are.
    """
    lanes = with_fingerprint(df.select(key, piece), piece, "_lanes")
    summed = lanes.groupBy(key).agg(
        *[F.sum(F.col("_lanes")[i]).bitwiseAND(F.lit(WIDE if i <= DENSE else NARROW)).alias(f"l{i}") for i in range(LANES)]
    )
    return summed.select(key, F.array(*[f"l{i}" for i in range(LANES)]).alias("fingerprint"))


def _buckets(ids: DataFrame, key: str, n: int) -> list:
    """Up to ``n`` keys that cut the rows into ranges of about equal size, ascending; the least key is the first."""
    found = ids.agg(
        F.min(key).alias("least"), F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 10_000).alias("cuts")
    ).first()
    return [] if found["least"] is None else sorted({found["least"], *found["cuts"]})


def with_next(df: DataFrame, key: str, columns: list[str], prefix: str = "next_", prepare=None) -> DataFrame:
    """Each row with ``columns`` of the next row by ascending ``key``; the row after the last is the first.

    ``prepare`` adds columns to the rows just before they move, so that looking for ranges does not compute them.

    The keys are cut into ranges of about equal size (a few thousand numbers reach the driver). The least row of a range
    also goes to the range before it as its last row; then a window inside each range finds every next row. The text
    moves once, and no task sees more than a range. Rows with a null key are left out. Rows that share a key follow each
    other in the order of their columns' hash.
    """
    n = max(1, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows, prepare = df.where(F.col(key).isNotNull()), prepare or (lambda moved: moved)
    cuts = _buckets(rows.select(key), key, n)
    if not cuts:
        return prepare(rows).select("*", *[F.col(c).alias(prefix + c) for c in columns])
    step = max(1, int(len(cuts) ** 0.5))
    starts, coarse = F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts[::step]))
    below = lambda c: F.size(F.filter(c, lambda x: x <= F.col(key)))
    block = (below(coarse) - 1) * step
    bucket = (block + below(F.slice(starts, block + 1, step)) - 1).cast("int")
    tie = F.xxhash64(*rows.columns)
    firsts = rows.withColumn("_bucket", bucket).groupBy("_bucket").agg(
        F.min(F.struct(F.col(key), tie.alias("t"))).alias("_first")
    )
    # one row per range that is not empty: at most len(cuts) rows, which bounds the broadcast
    follow = sorted(firsts.collect(), key=lambda r: r["_bucket"])
    before = {r["_bucket"]: follow[i - 1]["_bucket"] for i, r in enumerate(follow)}
    table = df.sparkSession.createDataFrame(
        [(r["_bucket"], r["_first"]["t"], before[r["_bucket"]], i == 0) for i, r in enumerate(follow)],
        f"_bucket int, _t long, _before int, _least boolean",
    )
    firsts_key = df.sparkSession.createDataFrame(
        [(r["_bucket"], r["_first"][key]) for r in follow], f"_bucket int, _k {dict(df.dtypes)[key]}"
    )
    table = table.join(firsts_key, "_bucket")
    placed = rows.withColumn("_bucket", bucket).withColumn("_tie", tie).join(F.broadcast(table), "_bucket")
    is_first = (F.col(key) == F.col("_k")) & (F.col("_tie") == F.col("_t"))
    dealt = placed.withColumn(
        "_place",
        F.explode(
            F.when(
                is_first,
                F.array(
                    F.struct(F.col("_bucket").alias("at"), F.lit(False).alias("guest")),
                    F.struct(F.col("_before").alias("at"), F.lit(True).alias("guest")),
                ),
            ).otherwise(F.array(F.struct(F.col("_bucket").alias("at"), F.lit(False).alias("guest"))))
        ),
    ).select(*df.columns, "_tie", F.col("_place.at").alias("_at"), F.col("_place.guest").alias("_guest"))
    dealt = prepare(dealt)
    kept = [c for c in dealt.columns if c not in ("_tie", "_at", "_guest")]
    order = Window.partitionBy("_at").orderBy("_guest", key, "_tie")
    following = [F.lead(c).over(order).alias(prefix + c) for c in columns]
    return dealt.select(*kept, "_guest", *following).where("not _guest").drop("_guest")
