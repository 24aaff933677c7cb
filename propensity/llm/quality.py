"""Quality classifier: hashed word n-grams, follow-the-regularised-leader.

A text's words (runs of letters, digits and non-ASCII bytes) and marks (runs
of other visible characters) give unigrams and bigrams, hashed into ``2 **
bits`` weights; a word that follows itself gives one shared feature, whatever
the word, and so does a word all in capitals. A feature's value is
``log(1 + count)``, and a text's values have length 1.

Logistic regression is learned with FTRL-proximal updates (per-coordinate
rates, L1 and L2 regularisation). The sample is dealt to ``shards`` tasks;
each round every task goes through its rows from the common state, and the
states are averaged between rounds. A score is the logistic of the sparse dot
product.

Learning reads at most about ``max_rows`` labelled texts (a seeded sample, the
bound is a parameter), so the model's cost does not follow the corpus; every
text is scored whole, in one pass without a shuffle. Labels, language, source
and id are never inputs of a score.

A null or empty text has no features and scores by the intercept. Repeated
rows and null ids are scored. Repeated or conflicting label rows are merged
by majority. With no labelled texts every score is 0.5, with one class only
it is near that class. An empty table gives an empty result. Columns other
than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ragged import LOWER, mix, span_keys, spans, text_blocks
from .tables import bounded_sample, highest_kept, labelled, written

BITS = 18

#: Byte kinds: 0 white space and controls, 1 word bytes, 2 marks.
KIND = np.full(256, 2, np.uint8)
KIND[:33] = 0
KIND[127] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PAIR = np.uint64(0x9FB21C651E98DF25)
_SAME, _CAPITALS = np.uint64(1), np.uint64(2)


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first feature of each text, feature numbers, values of unit length)."""
    kind = KIND[data]
    ws, we = spans(kind == 1, offsets)
    ms, me = spans(kind == 2, offsets)
    s, e = np.concatenate([ws, ms]), np.concatenate([we, me])
    order = np.argsort(s, kind="stable")
    s, e = s[order], e[order]
    n_texts = len(offsets) - 1
    text = np.searchsorted(offsets, s, "right") - 1
    key = span_keys(LOWER[data], s, e)
    capitals = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shouted = (capitals[e] - capitals[s] == e - s) & (e - s > 1)
    pair = mix(key[:-1] * _PAIR ^ key[1:]) if len(key) else key
    joined = text[1:] == text[:-1]
    word = np.flatnonzero(kind[s] == 1)
    again = word[1:][(key[word[1:]] == key[word[:-1]]) & (text[word[1:]] == text[word[:-1]])]
    keys = np.concatenate([key, pair[joined], np.full(len(again), _SAME), np.full(int(shouted.sum()), _CAPITALS)])
    texts = np.concatenate([text, text[1:][joined], text[again], text[shouted]])
    slot = (texts.astype(np.uint64) << np.uint64(bits)) | (mix(keys) >> np.uint64(64 - bits))
    slot, count = np.unique(slot, return_counts=True)
    texts = (slot >> np.uint64(bits)).astype(np.int64)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(texts, value * value, n_texts))
    first = np.searchsorted(texts, np.arange(n_texts + 1))
    return first, (slot & np.uint64((1 << bits) - 1)).astype(np.int32), (value / norm[texts]).astype(np.float32)


def weights(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL's weights from its sums: zero where |z| is within L1."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def ftrl_pass(rows: list[tuple], z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> None:
    """One pass of per-row updates of (z, n), in place; a row is (features, values, label)."""
    for idx, val, y in rows:
        zi, ni = z[idx], n[idx]
        w = weights(zi, ni, alpha, beta, l1, l2)
        p = 1 / (1 + np.exp(-np.clip(float(w @ val), -30, 30)))
        g = (p - y) * val
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
        z[idx] = zi + g - sigma * w
        n[idx] = ni + g * g


def _learner(state, slot: int, *rates: float):
    """A shard's task: one pass from the common state over its rows in turn."""
    def learn(part: pd.DataFrame) -> pd.DataFrame:
        z, n = (x.copy() for x in state.value)
        part = part.sort_values("turn")
        rows = [(np.append(i, slot), np.append(v, np.float32(1.0)), y) for i, v, y in zip(part.idx, part.val, part.y, strict=True)]
        ftrl_pass(rows, z, n, *rates)
        return pd.DataFrame({"z": [z.astype("<f8").tobytes()], "n": [n.astype("<f8").tobytes()]})
    return learn


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          usable: Column | None = None, max_rows: int = 16384, shards: int = 4, rounds: int = 6, bits: int = BITS,
          alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 5) -> np.ndarray:
    """Weights (the last is the intercept's) from at most about ``max_rows``
    labelled texts: ids are sampled first, then the texts found under them, as
    an id may have several; equal rows of an id are learned from once."""
    rows = labelled(labels.where(usable) if usable is not None else labels, label, id_col)
    rows = written(bounded_sample(rows.withColumn("all", F.lit(1)), F.col(id_col), "all", max_rows, seed)
                   .select(F.col(id_col).alias("l_id"), "y"), "label-sample")
    # the sample has a bounded number of rows, so it is broadcast to the texts
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(rows), F.col("id") == F.col("l_id"))
    h = F.xxhash64("id", "text", F.lit(seed))
    texts = texts.select("text", "y", h.alias("turn"))
    n_rows, n_texts = texts.agg(F.count("turn"), F.count_distinct("turn")).first()  # hashes only: no text moves
    texts = texts.where(F.xxhash64("turn", F.lit(seed)) <= F.lit(highest_kept(max_rows, n_texts)).cast("bigint"))
    if n_rows > n_texts:
        texts = texts.dropDuplicates(["turn"])
    slot = 1 << bits

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column("text")):
                at, idx, val = features(data, offsets, bits)
                part = batch.slice(first, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("shard"), part.column("turn"), part.column("y"), pa.ListArray.from_arrays(at.astype(np.int32), idx),
                     pa.ListArray.from_arrays(at.astype(np.int32), val)], ["shard", "turn", "y", "idx", "val"])

    sample = written(texts.select(F.pmod("turn", F.lit(shards)).cast("int").alias("shard"), "turn", "y", "text")
                     .mapInArrow(featurise, "shard int, turn bigint, y int, idx array<int>, val array<float>"), "labelled-features")
    # every round reads the same shards, so they are exchanged once and kept (lost ones are read again from the table)
    sample = sample.repartition(shards, "shard").persist(StorageLevel.MEMORY_AND_DISK)
    z, n = np.zeros(slot + 1), np.zeros(slot + 1)
    try:
        for _ in range(rounds):
            learn = _learner(sample.sparkSession.sparkContext.broadcast((z, n)), slot, alpha, beta, l1, l2)
            # a few states of fixed size come back, one a shard
            states = sample.groupBy("shard").applyInPandas(learn, "z binary, n binary").collect()
            if not states:
                break
            z, n = (np.mean([np.frombuffer(s[k], "<f8") for s in states], axis=0) for k in ("z", "n"))
    finally:
        sample.unpersist()
    return weights(z, n, alpha, beta, l1, l2).astype(np.float32)


def score(docs: DataFrame, w: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score): every whole text's probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(w)
    bits = (len(w) - 1).bit_length() - 1
    slim = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            out = [np.empty(0)]
            for _, data, offsets in text_blocks(batch.column("text")):
                first, idx, val = features(data, offsets, bits)
                dot = np.bincount(np.repeat(np.arange(len(offsets) - 1), np.diff(first)), w[idx] * val, len(offsets) - 1)
                out.append(1 / (1 + np.exp(-np.clip(dot + w[-1], -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.concatenate(out))], ["key", "score"])

    return slim.mapInArrow(run, T.StructType([slim.schema["key"], T.StructField("score", T.DoubleType())])).withColumnRenamed("key", id_col)
