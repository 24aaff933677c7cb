"""Toxicity by class-conditional Kneser-Ney models.

Two word models, one of toxic and one of ordinary texts, share everything
below their own counts: a word's probability under a class is its discounted
count there plus the class's backoff weight times the probability under the
word's spelling prefix, and a prefix's is its discounted count plus the
backoff weight times a probability that both classes share. A bigram's is its
discounted share of its first word plus the backoff weight times the pooled
bigram, in the proportion of the class's word to the pooled word. So an expression that one class never showed costs that class only
the shared probability, a rare one is smoothed toward how its prefix behaves,
and what both classes never showed says nothing. Discounts
are absolute, by count 1, 2 and 3 or more, estimated from counts of counts and
then raised as far as makes the labels of texts kept out of the counts likeliest
(few toxic texts make one text's words too telling; bigrams, rarer still, have
the most: a bigram of one text is left to its words); counts are of distinct texts,
and lower orders use continuation counts (distinct words before) of both classes.

A text's log-likelihood ratio is normalised by length twice: over the whole
text, and over the most toxic run of ``run_words`` words, because a few words
decide in a long text. A logistic curve of both and of the logarithm of the
text's words (a longer text has more runs to choose the worst from), fitted on
training texts that were kept out of the counts, gives a score in 0 to 1.

Learning reads at most about ``max_rows`` labelled texts and ``max_chars``
characters of each class (a seeded sample of whole texts, the bounds are
parameters; a class with fewer is taken whole), so the model has a bounded size whatever the corpus and can be broadcast;
every text is scored whole. Labels, language, source and id are never inputs.

A null or empty text, or one without words, has ratio 0 in both features.
Null ids are scored. Repeated rows each get their score; repeated or
conflicting label rows are merged by majority. With no labelled texts, or one
class only, every score is the share of toxic labels (0 if there are none). If
the texts kept out of the counts lack a class (few labels), the curve is fitted
on all labelled texts. An empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ragged import LOWER, Counter64, KeyTable, mix, span_keys, spans, text_blocks
from .tables import bounded_sample, labelled, written

#: Bytes of words: ASCII letters and digits and everything beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

PREFIX_BYTES = 4
_PREFIX = np.uint64(0xA24BAED4963EE407)
_PAIR = np.uint64(0x9FB21C651E98DF25)


def text_keys(data: np.ndarray, offsets: np.ndarray):
    """Keys of each word, its spelling prefix, the word before it (0 at a
    text's start) and the two together; and each text's first word."""
    data = LOWER[data]
    s, e = spans(WORD_BYTE[data], offsets)
    word = span_keys(data, s, e)
    first = np.searchsorted(s, offsets)
    prefix = mix(span_keys(data, s, np.minimum(e, s + PREFIX_BYTES)) ^ _PREFIX)
    before = np.zeros(len(word), np.uint64)
    before[1:] = word[:-1]
    before[first[:-1][first[:-1] < first[1:]]] = 0
    return word, prefix, before, mix(before * _PAIR ^ word), first


@dataclass
class Model:
    """Log-likelihood ratios, toxic against ordinary: of known bigrams, of
    known words (and of their backoff weights as contexts), of known
    prefixes, and of the backoff weights below words and below prefixes; the
    discounts' strength and the loss of the labels kept out of the counts."""
    pair_keys: np.ndarray
    pair_ratio: np.ndarray
    word_keys: np.ndarray
    word_ratio: np.ndarray
    word_backoff: np.ndarray
    prefix_keys: np.ndarray
    prefix_ratio: np.ndarray
    backoff: tuple = (0.0, 0.0)
    curve: tuple = (0.0, 0.0, 0.0, 0.0)
    constant: float | None = None
    strength: float = 1.0
    loss: float = 0.0

    def tables(self):
        if not hasattr(self, "_tables"):
            self._tables = [KeyTable(k) for k in (self.pair_keys, self.word_keys, self.prefix_keys)]
        return self._tables

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def word_ratios(self, word, prefix, before, pair) -> np.ndarray:
        pairs, words, prefixes = self.tables()
        row = pairs.rows(pair)
        out = np.zeros(len(word))
        out[row >= 0] = self.pair_ratio[row[row >= 0]]
        rest = np.flatnonzero(row < 0)
        row = words.rows(word[rest])
        out[rest[row >= 0]] = self.word_ratio[row[row >= 0]]
        context = words.rows(before[rest])
        out[rest[context >= 0]] += self.word_backoff[context[context >= 0]]
        new = rest[row < 0]
        row = prefixes.rows(prefix[new])
        out[new] += self.backoff[0]
        out[new[row >= 0]] += self.prefix_ratio[row[row >= 0]]
        out[new[row < 0]] += self.backoff[1]
        return out

    def features(self, data: np.ndarray, offsets: np.ndarray, run_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mean ratio of the text, mean ratio of its most toxic run, log of 1 + its words)."""
        word, prefix, before, pair, first = text_keys(data, offsets)
        sums = np.concatenate([[0.0], np.cumsum(self.word_ratios(word, prefix, before, pair))])
        n = np.diff(first)
        mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)
        best = np.zeros(len(n))
        if len(word):
            text = np.repeat(np.arange(len(n)), n)
            end = np.minimum(np.arange(len(word)) + run_words, first[1:][text])
            # a text shorter than a run is one run; later starts near the end add nothing new
            run = (sums[end] - sums[:-1]) / run_words
            has = np.flatnonzero(n)
            best[has] = np.maximum.reduceat(run, first[:-1][has])
        return mean, best, np.log1p(n)


#: What a discount may take at most of counts 1, 2 and 3 or more.
MOST = np.array([0.0, 1.0, 1.9, 2.75])

#: How far discounts of words and prefixes are moved from the estimate towards the most; training
#: takes the one under which texts kept out of the counts have their labels likeliest.
STRENGTHS = (1.0, 0.75, 0.5, 0.25, 0.0)


def _discount(counts: np.ndarray, strength: float) -> np.ndarray:
    """Each count's absolute discount, by count 1, 2 and 3 or more: the
    modified Kneser-Ney estimate from how many counts are 1, 2, 3 and 4 (where
    none has a count, its share of all is taken off in proportion), moved
    towards the most by ``strength``."""
    n = np.bincount(np.minimum(counts, 5).astype(int), minlength=6).astype(float)
    common = n[1] / max(n[1] + 2 * n[2], 1)
    d = [0.0] + [k - (k + 1) * common * n[k + 1] / n[k] if n[k] else k * common for k in (1, 2, 3)]
    d = np.clip(d, 0, MOST)
    return (d + strength * (MOST - d))[np.minimum(counts, 3).astype(int)]


def _beyond_discount(counts: DataFrame) -> DataFrame:
    """Counts without the bigrams of one text: their discount is the most in
    both classes and in both pooled and takes such a count whole, so the bigram
    has exactly the ratio that the backoff gives to one the model does not hold.
    They are most of all bigrams and would fill the driver."""
    return counts.where(f"kind != 2 or toxic + ordinary > {int(MOST[1])}")


def _discounted(counts: np.ndarray, strength: float) -> tuple[np.ndarray, float]:
    """Discounted shares of the counts' sum, and what the discounts leave."""
    d = _discount(counts, strength)
    total = max(counts.sum(), 1)
    share = np.maximum(counts - d, 0) / total
    return share, max(1 - share.sum(), 1e-9)


def _context_shares(c: np.ndarray, words: np.ndarray, pairs: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bigram's discounted share of its first word's count, and what
    that leaves for words not seen after it."""
    d = _discount(c[pairs], 1.0)
    share = np.maximum(c[pairs] - d, 0) / np.maximum(c[words][before], 1)
    taken = np.bincount(before, share, len(words))
    over = np.maximum(taken / 0.95, 1.0)  # several texts may share both words in more ways than the word has texts
    return share / over[before], 1 - taken / over


def _model(rows: dict, strength: float) -> Model:
    """The model from count rows (kind, key, parent, word, toxic, ordinary):
    kind 0 a prefix; 1 a word (parent: its prefix); 2 a bigram (parent: the
    word before); 3 a word's number of distinct words before it (in toxic)."""
    kind, key, parent, word = (rows[c].view(np.uint64) if c != "kind" else rows[c] for c in ("kind", "key", "parent", "word"))
    counts = np.stack([rows["toxic"], rows["ordinary"]]).astype(float)
    prefixes, words, pairs, contexts_of = (np.flatnonzero(kind == k) for k in range(4))
    word_row, prefix_row = KeyTable(key[words]), KeyTable(key[prefixes])
    of_prefix = prefix_row.rows(parent[words])
    contexts = np.full(len(words), 0.5)
    contexts[word_row.rows(key[contexts_of])] += counts[0][contexts_of]
    # what both classes share: a prefix's share of contexts, a word's share of its prefix's
    by_prefix = np.bincount(of_prefix, contexts, len(prefixes))
    shared_prefix, shared_word = by_prefix / max(by_prefix.sum(), 1), contexts / by_prefix[of_prefix]
    before, last = word_row.rows(parent[pairs]), word_row.rows(word[pairs])
    pairs, before, last = (x[before >= 0] for x in (pairs, before, last))  # a text's first word has no context
    # the bigram both classes share: pooled shares, what is left by the pooled words
    pooled = counts.sum(0)
    share, left = _discounted(pooled[words], strength)
    p_any = share + left * shared_prefix[of_prefix] * shared_word
    share, left = _context_shares(pooled, words, pairs, before)
    p_any_pair = share + left[before] * p_any[last]
    logs = {"pair": [], "word": [], "context": [], "prefix": [], "backoff": []}
    for c in counts:
        share, left_prefix = _discounted(c[prefixes], strength)
        p_prefix = share + left_prefix * shared_prefix
        share, left_word = _discounted(c[words], strength)
        p_word = share + left_word * p_prefix[of_prefix] * shared_word
        share, left = _context_shares(c, words, pairs, before)
        p_pair = share + left[before] * p_any_pair * (p_word / p_any)[last]
        for name, p in (("pair", p_pair), ("word", p_word), ("context", left), ("prefix", p_prefix), ("backoff", np.array([left_word, left_prefix]))):
            logs[name].append(np.log(np.maximum(p, 1e-300)))
    r = {k: (a - b).astype(np.float32) for k, (a, b) in logs.items()}
    return Model(key[pairs], r["pair"], key[words], r["word"], r["context"], key[prefixes], r["prefix"], tuple(r["backoff"].tolist()))


def _constant(score: float) -> Model:
    """Gives every text the same score."""
    empty = np.empty(0, np.uint64), np.empty(0, np.float32)
    return Model(*empty, *empty, empty[1], *empty, constant=score)


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.02) -> tuple:
    """Logistic regression of a few columns by Newton steps with a ridge."""
    a = np.column_stack([np.ones(len(x)), x])
    scale = np.concatenate([[1.0], np.maximum(np.abs(a[:, 1:]).max(0), 1e-9)])
    a = a / scale
    w = np.zeros(a.shape[1])
    pull = ridge * np.array([0.0] + [1.0] * x.shape[1])  # none on the intercept
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + pull * w
        hess = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + np.diag(pull + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    return tuple((w / scale).tolist())


def _loss(x: np.ndarray, y: np.ndarray, weight: np.ndarray, curve: tuple) -> float:
    """The weighted mean of the labels' negative log-likelihood."""
    z = curve[0] + x @ np.array(curve[1:])
    return float((weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum())


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          usable: Column | None = None, max_rows: int = 4096, max_chars: int = 1 << 25, run_words: int = 2, seed: int = 7) -> Model:
    """The model from labelled texts of each class, at most about ``max_rows``
    ids and ``max_chars`` characters (whole texts by a seeded hash); ``usable``
    (over ``labels``) says which labels may be learned from."""
    rows = labelled(labels.where(usable) if usable is not None else labels, label, id_col)
    rows = written(bounded_sample(rows, F.col(id_col), "y", max_rows, seed), "label-sample")
    found = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    if len(found) < 2:
        return _constant(float(next(iter(found), 0)))
    # the sample has a bounded number of rows, so it is broadcast to the texts
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(rows.withColumnRenamed(id_col, "l_id")), F.col("id") == F.col("l_id")).select(
        "y", (F.pmod(F.xxhash64("text", F.lit(seed + 1)), F.lit(4)) == 0).alias("held"), "text").dropDuplicates(["text", "y"])
    texts = written(texts, "labelled-texts")
    texts = bounded_sample(texts, F.xxhash64("text"), "y", max_chars, seed, F.length("text"))
    # each class by its share of the labels, not of the sample
    share = {r[0]: r[1] for r in labelled(labels.where(usable) if usable is not None else labels, label, id_col)
             .groupBy("y").count().collect()}
    kept = {(r[0], r[1]) for r in texts.select("y", "held").distinct().collect()}
    if len({y for y, _ in kept}) < 2:
        return _constant(share[1] / (share[0] + share[1]))
    curve_texts = texts.where("held") if {(0, True), (1, True)} <= kept else texts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter64(1 << 19)
        names = ["kind", "key", "parent", "word", "toxic", "ordinary"]

        def out(merged):
            _, n, kind, key, parent, word, toxic = merged
            return pa.RecordBatch.from_arrays([pa.array(kind), *(pa.array(x.view(np.int64)) for x in (key, parent, word)),
                                               pa.array(np.where(toxic, n, 0)), pa.array(np.where(toxic, 0, n))], names)
        for batch in batches:
            ys = batch.column("y").to_numpy(zero_copy_only=False).astype(bool)
            for first, data, offsets in text_blocks(batch.column("text")):
                word, prefix, before, pair, start = text_keys(data, offsets)
                toxic = np.repeat(ys[first:first + len(offsets) - 1], np.diff(start))
                none = np.zeros_like(word)
                text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(start)) * _PAIR
                for kind, key, parent, own in ((2, pair, before, word), (1, word, prefix, none), (0, prefix, none, none)):
                    _, once = np.unique(mix(key ^ text), return_index=True)  # a text counts once
                    # one counter holds both classes: the class is folded into its key
                    full = counter.add(key[once] ^ (toxic[once].astype(np.uint64) << np.uint64(63)), None,
                                       np.full(len(once), kind, np.int32), key[once], parent[once], own[once], toxic[once])
                    if full:
                        yield out(full)
        full = counter.drain()
        if full:
            yield out(full)

    counts = written(texts.where("not held").select("y", "text")
                     .mapInArrow(count, "kind int, key bigint, parent bigint, word bigint, toxic bigint, ordinary bigint")
                     .groupBy("kind", "key").agg(F.first("parent").alias("parent"), F.first("word").alias("word"),
                                                 F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "class-counts")
    contexts = (counts.where("kind = 2").groupBy("word").agg(F.count(F.lit(1)).alias("toxic"))
                .select(F.lit(3).alias("kind"), F.col("word").alias("key"), F.lit(0).cast("bigint").alias("parent"), "word", "toxic",
                        F.lit(0).cast("bigint").alias("ordinary")))
    table = _beyond_discount(counts).unionByName(contexts).toArrow()
    rows = {c: table.column(c).to_numpy() for c in table.column_names}
    best = None
    for strength in STRENGTHS:
        model = _model(rows, strength)
        scored = _features(curve_texts.select("y", "text"), "y", "text", model, run_words).toArrow()
        y = scored.column("y").to_numpy().astype(float)
        x = np.column_stack([scored.column(c).to_numpy() for c in ("mean", "best", "log_words")])
        weight = np.where(y == 1, share[1] / max((y == 1).sum(), 1), share[0] / max((y == 0).sum(), 1))
        weight = weight * len(y) / weight.sum()
        model.curve, model.strength = _fit_curve(x, y, weight), strength
        model.loss = _loss(x, y, weight, model.curve)
        if best is None or model.loss < best.loss:
            best = model
    return best


def _features(rows: DataFrame, key: str, text: str, model: Model, run_words: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            parts = [(np.empty(0),) * 3]
            parts += [m.features(data, offsets, run_words) for _, data, offsets in text_blocks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))],
                                             ["key", "mean", "best", "log_words"])

    slim = rows.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, T.StructType([slim.schema["key"], T.StructField("mean", T.DoubleType()),
                                              T.StructField("best", T.DoubleType()),
                                              T.StructField("log_words", T.DoubleType())])).withColumnRenamed("key", key)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", run_words: int = 2) -> DataFrame:
    """(id_col, mean, best, log_words, score): every whole text's features and score."""
    out = _features(docs, id_col, text_col, model, run_words)
    if model.constant is not None:
        return out.withColumn("score", F.lit(model.constant))
    z = F.lit(model.curve[0])
    for weight, name in zip(model.curve[1:], ("mean", "best", "log_words"), strict=True):
        z = z + F.lit(weight) * F.col(name)
    return out.withColumn("score", 1 / (1 + F.exp(-z)))


def ordinary(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5, run_words: int = 2) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            keep = [np.empty(0, bool)]
            for _, data, offsets in text_blocks(batch.column(at)):
                x = m.features(data, offsets, run_words)
                z = m.curve[0] + sum(w * v for w, v in zip(m.curve[1:], x, strict=True))
                p = np.full(len(z), m.constant) if m.constant is not None else 1 / (1 + np.exp(-z))
                keep.append(p < threshold)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
