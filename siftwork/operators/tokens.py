"""Corpus → token ids → one ordered token stream → training windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.text import WS_CLASS
from siftwork.session import materialize

#: Token ids must fit 16 bits: one id per byte, then the vocabulary, and one id for the end of a document.
BYTE_IDS = 256
MAX_VOCABULARY = 65_535 - BYTE_IDS
EOS_ID = 65_535
WINDOW = 512
#: Pre-tokens that a task looks up at a time, and texts that it reads back at a time; a longer document is worked on alone.
PIECES, TEXTS = 1 << 18, 64
#: A pre-token is a word, a number or a run of symbols with the space before it, or a run of white space.
PRETOKEN = rf" ?\p{{L}}+| ?\p{{N}}+| ?[^{WS_CLASS}\p{{L}}\p{{N}}]+|[{WS_CLASS}]+"


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN), F.lit(0))


def build_vocabulary(df: DataFrame, text: str = "text", size: int = MAX_VOCABULARY) -> DataFrame:
    """``(token, id)`` of the most frequent pre-tokens, ties by token; the bound makes it safe to broadcast.

    The ids of the format have 16 bits. Pre-tokens beyond them are not lost: they are spelled as bytes.
    """
    if not 0 < size <= MAX_VOCABULARY:
        raise ValueError(f"vocabulary size must be between 1 and {MAX_VOCABULARY}")
    counts = df.select(F.explode(pretokens(F.col(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(size)
    return top.select("token", (F.row_number().over(Window.orderBy(F.desc("n"), "token")) - 1 + BYTE_IDS).alias("id"))


def tokenize(df: DataFrame, vocabulary: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *keep, tokens)``: ids in text order with the end-of-document id last, also for empty texts.

    ``vocabulary`` is a table of at most ``MAX_VOCABULARY`` rows. A pre-token it does not have becomes the ids of its UTF-8
    bytes, so every text can be read back (:func:`detokenize`). Ids are looked up by whole batches inside the row's task, so
    nothing is shuffled.
    """
    names = vocabulary.where("token <> ''").select("token", F.col("id").cast("int")).toArrow()  # at most MAX_VOCABULARY rows
    end = EOS_ID

    known, ids = names["token"].combine_chunks(), names["id"].to_numpy()

    def looked_up(batch):
        pieces = batch.column("_pieces")
        flat = pieces.flatten()
        place = pc.index_in(flat, value_set=known)
        missing = place.is_null().to_numpy(zero_copy_only=False)
        sizes = np.where(missing, pc.binary_length(flat).to_numpy(zero_copy_only=False), 1).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        # every document's end follows its pieces
        ends = np.concatenate([[0], np.cumsum(pieces.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        owner = np.repeat(np.arange(len(pieces)), np.diff(ends))
        tokens = np.full(at[-1] + len(pieces), end, np.int32)
        start = at[:-1] + owner
        if len(ids):
            tokens[start[~missing]] = ids[place.fill_null(0).to_numpy()[~missing]]
        spelled = np.frombuffer("".join(flat.filter(pa.array(missing)).to_pylist()).encode(), np.uint8)
        sizes = sizes[missing]
        inner = np.arange(len(spelled)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tokens[np.repeat(start[missing], sizes) + inner] = spelled
        offsets = (at[ends] + np.arange(len(pieces) + 1)).astype(np.int32)
        columns = [batch.column(c) for c in batch.schema.names if c != "_pieces"]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens))], names=schema.names)

    def look_up(batches):
        for batch in batches:
            # a few rows at a time, so that memory does not follow the size of a batch
            many = np.cumsum(batch.column("_pieces").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(many, (many[first - 1] if first else 0) + PIECES, "right")))
                yield looked_up(batch.slice(first, last - first))
                first = last

    cut = df.select(key, *keep, pretokens(F.coalesce(F.col(text), F.lit(""))).alias("_pieces"))
    schema = cut.select(key, *keep, F.lit(None).cast("array<int>").alias("tokens")).schema
    return cut.mapInArrow(look_up, schema)


def detokenize(tokenized: DataFrame, vocabulary: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, text)`` of ``(key, tokens)``: the texts that were tokenized, character for character.

    The spellings of all ids are sent to every task (``vocabulary`` has at most ``MAX_VOCABULARY`` rows), so a token never becomes
    a row. Only token arrays are shuffled, to meet those of the same key: rows of one key are read together, place by place.
    """
    names = vocabulary.select(F.col("id").cast("int").alias("id"), F.encode("token", "UTF-8").alias("token")).toArrow()
    spelled = dict(zip(names["id"].to_pylist(), names["token"].to_pylist())) | {i: bytes([i]) for i in range(BYTE_IDS)} | {EOS_ID: b""}
    texts = TEXTS

    def read(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, texts):
                part, found = batch.slice(first, texts), []
                for rows in part.column("_tokens"):
                    rows = [r.values.to_pylist() for r in rows.values]
                    if len(rows) == 1:
                        parts = [spelled[t] for t in rows[0] if t in spelled]
                    else:
                        parts = [s for _, s in sorted((p, spelled[t]) for r in rows for p, t in enumerate(r) if t in spelled)]
                    found.append(b"".join(parts).decode("utf-8", "replace") if parts else None)
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(found, pa.string())], names=[key, "text"])

    gathered = tokenized.where("tokens IS NOT NULL").groupBy(key).agg(F.collect_list("tokens").alias("_tokens"))
    return gathered.mapInArrow(read, tokenized.select(key, F.lit("").alias("text")).schema).where("text IS NOT NULL")


def check_uint16(tokens: Column) -> Column:
    """The tokens, or an error if one does not fit 16 bits."""
    fits = (F.array_min(tokens) >= 0) & (F.array_max(tokens) <= 65_535)
    return F.when(F.coalesce(fits, F.lit(True)), tokens).otherwise(
        F.raise_error(F.lit("token id outside 0..65535")).cast("array<int>")
    )


def token_offsets(lengths: DataFrame, order: list[str], length: str = "n_tokens") -> DataFrame:
    """Adds ``offset``: the number of tokens before each document in the global order.

    Documents are range-partitioned by ``order`` and written out once with their range number, so both passes
    see the same ranges. Sums per range (one row each) are accumulated and broadcast; inside a range the running
    sum is a window of its own. No task sees more than one range.
    """
    ranges = materialize(
        lengths.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    )
    sums = ranges.groupBy("_range").agg(F.sum(length).alias("_sum"))
    before = sums.select(
        "_range",
        F.coalesce(
            F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("_inside", F.coalesce(F.sum(length).over(inside), F.lit(0)))
        .join(F.broadcast(before), "_range")
        .withColumn("offset", F.col("_before") + F.col("_inside"))
        .drop("_range", "_before", "_inside")
    )


def token_report(tokenized: DataFrame) -> DataFrame:
    """documents, tokens (with the end marks), bytes on disk, dtype and end id."""
    return tokenized.agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("tokens")
    ).select(
        "documents", "tokens", (F.col("tokens") * 2).alias("output_bytes"), F.lit("uint16").alias("dtype"),
        F.lit(EOS_ID).alias("eos_token_id"),
    )


def pack_sequences(tokenized: DataFrame, offsets: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``(seq_id, x, y)``: consecutive windows of the stream and the same windows shifted by one token.

    A document is cut into the pieces of the windows it touches; a window gathers at most ``window + 1`` tokens.
    The stream's last window may be shorter; its arrays then end with the stream.
    """
    placed = tokenized.select(key, "tokens").join(offsets.select(key, "offset"), key)
    first = F.floor(F.greatest(F.col("offset") - 1, F.lit(0)) / window)
    last = F.floor((F.col("offset") + F.size("tokens") - 1) / window)

    def piece(w: Column) -> Column:
        start = F.greatest(F.col("offset"), w * window)
        stop = F.least(F.col("offset") + F.size("tokens"), w * window + window + 1)
        return F.struct(
            w.alias("seq_id"),
            start.alias("at"),
            F.slice("tokens", (start - F.col("offset") + 1).cast("int"), F.greatest(stop - start, F.lit(0)).cast("int")).alias("part"),
        )

    pieces = placed.select(F.inline(F.transform(F.sequence(first, last), piece))).where(F.size("part") > 0)
    stream = F.flatten(F.col("_parts.part"))
    return (
        pieces.groupBy("seq_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("_parts"))
        .select("seq_id", stream.alias("_stream"))
        .where(F.size("_stream") > 1)
        .select(
            "seq_id", F.slice("_stream", F.lit(1), F.size("_stream") - 1).alias("x"),
            F.slice("_stream", F.lit(2), F.size("_stream") - 1).alias("y"),
        )
    )
