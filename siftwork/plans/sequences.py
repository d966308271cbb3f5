"""From texts to training windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.operators import tokens as K
from siftwork.session import materialize


def corpus_to_sequences(docs: DataFrame, order: list[str], key: str = "doc_id", text: str = "text", window: int = K.WINDOW) -> DataFrame:
    """Vocabulary, tokens, global offsets and packed windows. The token table is written once and read twice."""
    tokenized = materialize(K.tokenize(docs, K.build_vocabulary(docs, text), key, text, tuple(c for c in order if c != key)))
    lengths = tokenized.select(key, *[c for c in order if c != key], F.size("tokens").alias("n_tokens"))
    return K.pack_sequences(tokenized, K.token_offsets(lengths, order), key, window)
