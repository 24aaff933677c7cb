"""Token counts of every prefix.

For each whole text the exact number of tokens of every prefix is found by
dynamic programming over the last token (``bpe.Vocabulary.piece_counts``) and
kept as one 16-bit step per code point. Truncation and budget questions are
then sums over the stored steps; nothing is tokenized again.

A null text is empty: no bytes, no tokens, no steps. Repeated rows and null
ids keep their rows. An empty table gives an empty result. Only id and text
are read, so other columns cannot clash. Words not met before are worked out
together, over arrays, for a few megabytes of texts at a time. A task holds one
Arrow batch, a bounded memo and, for the texts at hand, two bytes a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe

_state: dict[str, bpe.PrefixCounter] = {}

#: Texts whose new words are worked out together.
RUN_BYTES = 4 << 20


def vocabulary_text(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast (a few megabytes, whatever the input)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def prefix_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        tokenizer: str | None = None, store: bool = True) -> DataFrame:
    """(id, n_bytes, n_tokens, steps): ``steps`` holds the count's change at
    every code point (little-endian int16); with ``store=False`` it is null
    and only its total is kept."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    shared = vocabulary_text(docs.sparkSession, path)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _state:
            _state.clear()
            _state[path] = bpe.PrefixCounter(bpe.Vocabulary(shared.value))
        counter = _state[path]
        for batch in batches:
            column, first = batch.column("text"), 0
            size = pc.binary_length(column).fill_null(0)
            ends = np.cumsum(np.asarray(size, np.int64))
            while first < len(column):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + RUN_BYTES, "right")))
                texts = [t or "" for t in column.slice(first, last - first).to_pylist()]
                n_tokens, kept = [], []
                for s in counter.all_steps(texts):
                    n_tokens.append(int(s.sum(dtype=np.int64)))
                    kept.append(s.tobytes() if store else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, last - first), size.slice(first, last - first).cast(pa.int64()),
                     pa.array(n_tokens, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_tokens", "steps"])
                first = last

    out = T.StructType([slim.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("steps", T.BinaryType())])
    return slim.mapInArrow(run, out)


def prefix_count(steps: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` code points, from stored steps."""
    @F.pandas_udf("bigint")
    def at(s, n):
        import pandas as pd
        return pd.Series([int(np.frombuffer(x, "<i2")[:k].sum(dtype=np.int64)) if x is not None else None
                          for x, k in zip(s, n, strict=True)], dtype="Int64")
    return at(steps, n_chars.cast("bigint"))


def chars_within(steps: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens, from stored steps."""
    @F.pandas_udf("bigint")
    def most(s, b):
        import pandas as pd
        return pd.Series([bpe.longest_prefix(x, int(k)) if x is not None else None
                          for x, k in zip(s, b, strict=True)], dtype="Int64")
    return most(steps, budget.cast("bigint"))
