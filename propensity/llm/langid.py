"""Language identification by multilingual mixture inference.

Each learned language has a model of byte trigrams within words (with their
borders), smoothed and hashed into ``2 ** bits`` cells. A text is a mixture:
every word comes from one of the languages, with proportions of the text's
own. Expectation-maximisation estimates the proportions from the words'
likelihoods. The text's language set is then chosen among the nested sets of
its 1, 2, ... strongest languages, up to all of them, by penalised likelihood
(half the logarithm of the number of words for each further language), with the
proportions estimated again within each set. A text is left at the size from
which no proportions at all could pay the penalty. The prediction is the strongest
language of the chosen set, its score that language's proportion.

Learning reads at most about ``max_rows`` texts of each language (a seeded
sample, the bound is a parameter); languages are few and their models have a
fixed size, so they are broadcast. Every text is scored whole, without a
shuffle. Language, source and id are never inputs of a prediction.

A text that is null or has no letter is ``und`` with score 0, as is every
text if nothing was learned. A null language is not learned from. Ties go to
the language first by name. Repeated rows and null ids are scored. An empty
table gives an empty result. Columns other than id, text and language are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ragged import BLOCK, LOWER, spans, text_blocks
from .tables import bounded_sample, written

BITS = 16

#: Bytes of words: ASCII letters and everything beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def trigrams(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell of the trigram around each byte of a word, first of them for each
    word, word's text, first word of each text)."""
    inside = LETTER[data]
    s, e = spans(inside, offsets)
    low = np.where(inside, LOWER[data], 32).astype(np.uint32)
    left, right = np.empty_like(low), np.empty_like(low)
    left[1:], right[:-1] = low[:-1], low[1:]
    edges = offsets[offsets < len(low)]
    left[edges] = 32
    right[offsets[1:][offsets[1:] > 0] - 1] = 32
    code = (left << np.uint32(16) | low << np.uint32(8) | right)[inside]
    cell = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
    first = np.concatenate([[0], np.cumsum(e - s)])[:-1]
    return cell, first, np.searchsorted(offsets, s, "right") - 1, np.searchsorted(s, offsets)


@dataclass
class Model:
    names: list[str]
    log_p: np.ndarray  # languages x cells

    def word_likelihoods(self, cell: np.ndarray, first: np.ndarray) -> np.ndarray:
        """words x languages."""
        return np.column_stack([np.add.reduceat(p[cell], first) for p in self.log_p]) if len(first) else np.empty((0, len(self.names)))


def proportions(like: np.ndarray, text: np.ndarray, n_texts: int, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM: each text's proportions over its allowed languages, and the
    logarithm of its likelihood (both up to what ``like`` was scaled by)."""
    theta = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    n = np.maximum(np.bincount(text, minlength=n_texts), 1)[:, None]
    for _ in range(steps):
        r = like * theta[text]
        r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
        theta = np.column_stack([np.bincount(text, r[:, k], n_texts) for k in range(like.shape[1])]) / n
    total = np.log(np.maximum((like * theta[text]).sum(1), 1e-300))
    return theta, np.bincount(text, total, n_texts)


def most_likelihood(like: np.ndarray, text: np.ndarray, theta: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What no proportions can exceed: by concavity, log-likelihood lies within
    n log(max over languages of the mean of like / mixture) of that of ``theta``."""
    share = like / np.maximum((like * theta[text]).sum(1, keepdims=True), 1e-300)
    gain = np.column_stack([np.bincount(text, share[:, k], len(n)) for k in range(like.shape[1])]).max(1) / np.maximum(n, 1)
    return total + n * np.log(np.maximum(gain, 1.0)) + 1e-9 * (1 + np.abs(total))


def infer(model: Model, data: np.ndarray, offsets: np.ndarray, max_set: int | None, steps: int, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strongest language, its proportion, size of the set) of each text; -1
    without words. ``max_set`` None: as many languages as there are."""
    n_texts = len(offsets) - 1
    cell, first, text, word = trigrams(data, offsets, int(np.log2(model.log_p.shape[1])))
    logs = model.word_likelihoods(cell, first)
    like = np.exp(logs - logs.max(1, keepdims=True)) if len(logs) else logs
    n = np.diff(word)
    theta, total = proportions(like, text, n_texts, np.ones((n_texts, len(model.names))), steps)
    most = most_likelihood(like, text, theta, total, n)
    rank = np.argsort(np.argsort(-theta, axis=1, kind="stable"), axis=1, kind="stable")
    best = np.full(n_texts, -np.inf)
    lang, share, size = np.full(n_texts, -1), np.zeros(n_texts), np.zeros(n_texts, int)
    for k in range(1, min(max_set or len(model.names), len(model.names)) + 1):
        open_ = (n > 0) & (most - penalty * k * np.log(n + 1) > best)
        at = np.flatnonzero(open_)
        if not len(at):
            break
        rows = open_[text]
        own, total = proportions(like[rows], (np.cumsum(open_) - 1)[text[rows]], len(at), (rank[at] < k).astype(float), steps if k > 1 else 0)
        value = total - penalty * k * np.log(n[at] + 1)
        better = value > best[at]
        to = at[better]
        best[to] = value[better]
        lang[to], share[to], size[to] = own.argmax(1)[better], own.max(1)[better], k
    return lang, share, size


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          usable: Column | None = None, max_rows: int = 2000, bits: int = BITS, seed: int = 3) -> Model:
    """The models from at most about ``max_rows`` texts of each language."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = (rows.where(usable) if usable is not None else rows).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sample = bounded_sample(rows, F.coalesce(F.col("id").cast("string"), F.lit("")), "lang", max_rows, seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, data, offsets in text_blocks(batch.column("text")):
                cell, start, text, _ = trigrams(data, offsets, bits)
                of = np.repeat(text, np.diff(np.append(start, len(cell))))
                for name in set(langs[first:first + len(offsets) - 1]):
                    own = cell[(langs[first:first + len(offsets) - 1] == name)[of]]
                    seen[name] = seen.get(name, 0) + np.bincount(own, minlength=1 << bits)
        for name, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())],
                                             ["lang", "cell", "n"])

    # languages x cells sums, of fixed size for each language
    sums = sample.select("lang", "text").mapInArrow(count, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = written(sums, "trigram-counts").toPandas()
    names = sorted(table["lang"].unique())
    counts = np.zeros((len(names), 1 << bits))
    counts[np.searchsorted(names, table["lang"].to_numpy(str)) if names else [], table["cell"].to_numpy(int)] = table["n"].to_numpy(float)
    # an unseen trigram is a tenth of an occurrence of its share in all languages
    pooled = (counts.sum(0) + 0.1) / (counts.sum() + 0.1 * (1 << bits))
    p = (counts + 200.0 * pooled) / (counts.sum(1, keepdims=True) + 200.0)
    return Model(names, np.log(p).astype(np.float32))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", max_set: int | None = None,
            steps: int = 8, penalty: float = 0.5) -> DataFrame:
    """(id_col, lang_pred, score, n_langs): every whole text's strongest
    language, its proportion and the size of its language set."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.names, "und"], object)
        for batch in batches:
            out = [(np.empty(0, int), np.empty(0), np.empty(0, int))]
            if m.names:
                out += [infer(m, data, offsets, max_set, steps, penalty)
                        for _, data, offsets in text_blocks(batch.column("text"), max(BLOCK * 4 // len(m.names), 1 << 14))]
            else:
                out.append((np.full(batch.num_rows, -1), np.zeros(batch.num_rows), np.zeros(batch.num_rows, int)))
            lang, share, size = (np.concatenate(x) for x in zip(*out, strict=True))
            ok = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool) & (lang >= 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names[np.where(ok, lang, -1)], pa.string()), pa.array(np.where(ok, share, 0.0)),
                 pa.array(np.where(ok, size, 0).astype(np.int32))], ["key", "lang_pred", "score", "n_langs"])

    schema = T.StructType([slim.schema["key"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("n_langs", T.IntegerType())])
    return slim.mapInArrow(run, schema).withColumnRenamed("key", id_col)
