"""Language-model scoring by Brown classes.

``P(text) = product of P(class | class before) * P(word | class)``. Classes
come from exchange clustering: every unit starts in a class by rank, and is
moved to the class that raises the training text's class-bigram likelihood
most, given where the others are; half of the units move in one sweep, so
that sweeps can run as jobs. Units are the words that training has at least
``min_count`` times, so their number follows the corpus, up to those with
``1 / head`` of all tokens (the proven bound of what is broadcast, about a
million), and for all other words, known or not, ``shapes`` groups by their
last bytes: every word has a class, and one that training never saw has too.

Counts of words, of class transitions and of words a class emits are over all
training texts. A text's words are scored where they are read for transitions
and for words with at least ``1 / wide`` of all tokens (at most ``wide``,
broadcast); the counts of the rest are joined by word, as many times as a text
has a word. Emissions add ``delta`` to each count, with one unknown type a
class; transitions mix with the class frequencies. The end of a text is a
token with a class of its own.

Words are compared by a 64-bit key of their bytes, A-Z lower-cased.

A null or empty text is one token, the end. Ids may be null; repeated rows are
scored each (and train each). Without training texts the model knows nothing:
N = V = 0 and every word is unknown. An empty table gives an empty result.
Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ragged import LOWER, NOT_SPACE, Counter64, KeyTable, span_keys, spans, text_blocks
from .tables import written

#: Unit 0 is the border of texts: what stands before the first word and the end token.
END = 0


def words(data: np.ndarray, offsets: np.ndarray, shapes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key and shape of each word, first word of each text)."""
    data = LOWER[data]
    s, e = spans(NOT_SPACE[data], offsets)
    tail = np.zeros(len(s), np.uint64)
    for back in (3, 2, 1):
        at = np.maximum(e - back, s)
        tail = tail * np.uint64(257) + np.where(e - back >= s, data[at], 0).astype(np.uint64)
    shape = ((tail * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % shapes
    return span_keys(data, s, e), shape.astype(np.int32), np.searchsorted(s, offsets)


@dataclass
class Model:
    vocabulary: DataFrame  # (key, shape, n): every training word but the end
    n_tokens: int
    n_types: int
    head_keys: np.ndarray  # words with units of their own; unit 1 + i
    class_of_unit: np.ndarray  # units: border, head words, shapes
    log_next: np.ndarray  # classes x classes
    class_tokens: np.ndarray
    class_types: np.ndarray
    wide_keys: np.ndarray
    wide_counts: np.ndarray
    wide: int
    shapes: int
    delta: float
    history: list  # log-likelihood of the class bigrams after each sweep

    def shared(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("vocabulary", "history")}


def _units(key: np.ndarray, shape: np.ndarray, head: KeyTable, n_head: int) -> np.ndarray:
    row = head.rows(key)
    return np.where(row >= 0, 1 + row, 1 + n_head + shape)


def _with_borders(units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit before and unit at every token, the ends included."""
    n = np.diff(first)
    at = np.insert(units, first[1:], END)
    before = np.concatenate([[END], at[:-1]]) if len(at) else at
    return before, at


def _counts(docs: DataFrame, shapes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter64()

        def out(t):
            return pa.RecordBatch.from_arrays([pa.array(t[0].view(np.int64)), pa.array(t[2]), pa.array(t[1])], ["key", "shape", "n"])
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column("text")):
                key, shape, _ = words(data, offsets, shapes)
                if full := counter.add(key, None, shape):
                    yield out(full)
        if full := counter.drain():
            yield out(full)
    return (docs.mapInArrow(run, "key bigint, shape int, n bigint").groupBy("key")
            .agg(F.first("shape").alias("shape"), F.sum("n").alias("n")))


def _unit_bigrams(docs: DataFrame, head_keys: np.ndarray, shapes: int) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(head_keys)
    size = 1 + len(head_keys) + shapes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, counter = KeyTable(shared.value), Counter64()

        def out(t):
            return pa.RecordBatch.from_arrays([pa.array((t[0] // size).astype(np.int32)), pa.array((t[0] % size).astype(np.int32)),
                                               pa.array(t[1])], ["u", "v", "n"])
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column("text")):
                key, shape, first = words(data, offsets, shapes)
                before, at = _with_borders(_units(key, shape, head, len(head_keys)), first)
                if full := counter.add(before * size + at):
                    yield out(full)
        if full := counter.drain():
            yield out(full)
    return docs.mapInArrow(run, "u int, v int, n bigint").groupBy("u", "v").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


#: Counts up to this have their gains looked up, as most of a unit's counts with one class are small.
SMALL = 32
#: Units whose moves are worked out together.
TOGETHER = 64


def _grown(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    return _xlogx(x + n) - _xlogx(x)


def _side(pairs: np.ndarray, small: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, self_n: np.ndarray) -> np.ndarray:
    """What row b of ``pairs`` gains if the counts ``after`` join it, for each
    unit and class b. The unit is first taken out of its own class: only that
    class's row and column differ from ``pairs``."""
    i = np.arange(len(own))
    others = after.copy()
    others[i, own] = 0
    unit, cls = np.nonzero(others)
    n = others[unit, cls].astype(np.int64)
    terms = small[np.minimum(n, SMALL) - 1, cls]
    large = n > SMALL
    terms[large] = _grown(pairs[:, cls[large]].T, n[large, None])
    out = np.zeros_like(after)
    first = np.flatnonzero(np.diff(unit, prepend=-1))
    if len(first):
        out[unit[first]] = np.add.reduceat(terms, first, axis=0)
    out += _grown(pairs[:, own].T - before, after[i, own][:, None])
    row = pairs[own] - after
    row[i, own] -= before[i, own] + self_n
    out[i, own] = _grown(row, after).sum(1)
    return out


def best_classes(pairs: np.ndarray, units: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, self_n: np.ndarray) -> np.ndarray:
    """The best class of each unit, the others staying. ``pairs`` is classes x
    classes; ``left`` and ``right`` hold the unit's counts with the classes
    before and after it, ``self_n`` with itself. Class 0 is the border's."""
    out = own.copy()
    up_to = np.arange(1, SMALL + 1)[:, None, None]
    small_after, small_before = _grown(pairs.T[None], up_to), _grown(pairs[None], up_to)
    row_n, col_n = pairs.sum(1), pairs.sum(0)
    for at in range(0, len(units), TOGETHER):
        a, s = own[at:at + TOGETHER], self_n[at:at + TOGETHER]
        lt, rt = left[at:at + TOGETHER].copy(), right[at:at + TOGETHER].copy()
        i = np.arange(len(a))
        lt[i, a] -= s
        rt[i, a] -= s
        gain = _side(pairs, small_after, a, rt, lt, s) + _side(pairs.T, small_before, a, lt, rt, s)
        diag = np.tile(pairs.diagonal(), (len(a), 1))
        diag[i, a] -= lt[i, a] + rt[i, a] + s
        gain += _xlogx(diag + rt + lt + s[:, None]) - _xlogx(diag + rt) - _xlogx(diag + lt) + _xlogx(diag)
        for total, n in ((row_n, rt.sum(1) + s), (col_n, lt.sum(1) + s)):
            rest = np.tile(total, (len(a), 1))  # the unit's neighbours keep their own counts
            rest[i, a] -= n
            gain -= _grown(rest, n[:, None])
        gain[:, 0] = -np.inf
        best = gain.argmax(1)
        out[at:at + TOGETHER] = np.where(gain[i, best] > gain[i, a] + 1e-9, best, a)
    return out


#: Neighbours that a task sums by class at once.
ENTRIES = 1 << 20


def _neighbours(bigrams: DataFrame) -> DataFrame:
    """A row for each unit: the units before and after it, with their counts.
    Sweeps sum these lists by class where they lie, without a join or shuffle.
    A list is at most as long as the unit table."""
    both = F.explode(F.array(F.struct((F.col("v").cast("bigint") * 2).alias("at"), F.col("u").alias("other"), "n"),
                             F.struct((F.col("u").cast("bigint") * 2 + 1).alias("at"), F.col("v").alias("other"), "n")))
    ends = bigrams.select(both.alias("x")).select("x.*")

    def lists(at: np.ndarray, other: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        units = np.unique(at >> 1)
        cols = []
        for side in (0, 1):
            mine = np.flatnonzero(at & 1 == side)
            cut = np.searchsorted(at[mine] >> 1, np.append(units, at[-1] + 1)).astype(np.int32)
            cols += [pa.ListArray.from_arrays(cut, pa.array(x[mine])) for x in (other, n)]
        return pa.RecordBatch.from_arrays([pa.array(units.astype(np.int32)), *cols], ["unit", "before", "before_n", "after", "after_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # of the last unit, whose rows may go on in the next batch
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("at", "other", "n")]
            if not len(cols[0]):
                continue
            last = np.searchsorted(cols[0], cols[0][-1] >> 1 << 1)
            if held and (last or held[0][0][0] >> 1 != cols[0][0] >> 1):
                held.append([c[:last] for c in cols])
                yield lists(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held = []
            elif last:
                yield lists(*(c[:last] for c in cols))
            held.append([c[last:] for c in cols])
        if held:
            yield lists(*(np.concatenate(c) for c in zip(*held, strict=True)))
    return (ends.repartition(F.shiftright("at", 1)).sortWithinPartitions("at")
            .mapInArrow(run, "unit int, before array<int>, before_n array<bigint>, after array<int>, after_n array<bigint>"))


def _pieces(batch: pa.RecordBatch, *lists: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``lists`` hold about ``ENTRIES`` together; a longer row is a run of its own."""
    held = np.cumsum(sum(np.diff(batch.column(c).offsets.to_numpy()) for c in lists))
    first = 0
    while first < len(held):
        last = max(first + 1, int(np.searchsorted(held, (held[first - 1] if first else 0) + ENTRIES, "right")))
        yield batch.slice(first, last - first)
        first = last


def _entries(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, neighbour, count) of every neighbour on ``side``."""
    lists = batch.column(side)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return row, lists.flatten().to_numpy(), batch.column(f"{side}_n").flatten().to_numpy()


def _chooser(classes, pairs, k: int):
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_of, n = classes.value, pairs.value
        for batch in batches:
            for part in _pieces(batch, "before", "after"):
                units = part.column("unit").to_numpy()
                sums = []
                for side in ("before", "after"):
                    row, other, times = _entries(part, side)
                    sums.append(np.bincount(row * k + own_of[other], times, len(units) * k).reshape(len(units), k).astype(float))
                alone = other == units[row]
                self_n = np.bincount(row[alone], times[alone], len(units)).astype(float)
                cls = best_classes(n, units, own_of[units], *sums, self_n)
                yield pa.RecordBatch.from_arrays([pa.array(units), pa.array(cls.astype(np.int32))], ["unit", "cls"])
    return choose


def _class_pairs(near: DataFrame, own: np.ndarray, k: int) -> np.ndarray:
    """Class-bigram counts: k x k sums."""
    classes = near.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_of, total = classes.value, np.zeros(k * k)
        for batch in batches:
            for part in _pieces(batch, "after"):
                row, other, times = _entries(part, "after")
                total += np.bincount(own_of[part.column("unit").to_numpy()][row] * k + own_of[other], times, k * k)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((some // k).astype(np.int32)), pa.array((some % k).astype(np.int32)),
                                          pa.array(total[some].astype(np.int64))], ["cu", "cv", "n"])
    sums = (near.select("unit", "after", "after_n").mapInArrow(run, "cu int, cv int, n bigint")
            .groupBy("cu", "cv").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros((k, k))
    out[sums["cu"], sums["cv"]] = sums["n"]
    return out


def _log_likelihood(pairs: np.ndarray) -> float:
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(1)).sum() - _xlogx(pairs.sum(0)).sum())


def exchange(bigrams: DataFrame, n_units: int, classes: int, sweeps: int) -> tuple[np.ndarray, np.ndarray, list]:
    """(class of each unit, class-bigram counts, log-likelihood by sweep). The
    unit table (at most head + shapes rows) and the k x k counts are of fixed
    size; the units' neighbours, written once for all sweeps, stay in tasks."""
    spark = bigrams.sparkSession
    near = written(_neighbours(bigrams), "unit-neighbours")
    own = np.concatenate([[0], 1 + np.arange(n_units - 1) % (classes - 1)]).astype(np.int64)
    pairs = _class_pairs(near, own, classes)
    history = [_log_likelihood(pairs)]
    for sweep in range(sweeps):
        moving = F.pmod(F.xxhash64("unit", F.lit(sweep // 2)) + F.lit(sweep), F.lit(2)) == 0
        choose = _chooser(spark.sparkContext.broadcast(own), spark.sparkContext.broadcast(pairs), classes)
        moved = near.where((F.col("unit") != END) & moving).mapInArrow(choose, "unit int, cls int").toPandas()
        trial = own.copy()
        trial[moved["unit"].to_numpy()] = moved["cls"].to_numpy()
        now = _class_pairs(near, trial, classes)
        value = _log_likelihood(now)
        if value > history[-1]:  # moves made at once can spoil each other; such a sweep is not kept
            own, pairs = trial, now
            history.append(value)
    return own, pairs, history


def train(docs: DataFrame, text_col: str = "text", usable: Column | None = None, classes: int = 64, head: int = 1 << 20,
          min_count: int = 20, shapes: int = 2048, wide: int = 1 << 20, sweeps: int = 8, delta: float = 0.5) -> Model:
    """The model from all texts that ``usable`` (over ``docs``) selects."""
    texts = (docs.where(usable) if usable is not None else docs).select(F.col(text_col).alias("text"))
    vocabulary = written(_counts(texts, shapes), "word-counts")
    n_texts = texts.count()
    sums = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_tokens, n_types = (sums[0] or 0) + n_texts, sums[1] + (n_texts > 0)
    # words with a share of all tokens: at most head, or wide, of them whatever the corpus
    frequent = lambda share: vocabulary.where(F.col("n") * F.lit(share) >= F.lit(max(n_tokens, 1)))
    ranked = frequent(head).where(F.col("n") >= min_count).select("key", "n").orderBy(F.desc("n"), "key").toArrow()
    head_keys = ranked.column("key").to_numpy().view(np.uint64).copy()
    n_units = 1 + len(head_keys) + shapes
    own, pairs, history = exchange(_unit_bigrams(texts, head_keys, shapes), n_units, classes, sweeps)
    share = (pairs.sum(0) + 1) / (pairs.sum() + classes)
    log_next = np.log10((pairs + classes * share[None, :]) / (pairs.sum(1, keepdims=True) + classes))
    # what each class emits: its tokens and its distinct words
    spark = docs.sparkSession
    units = pd.DataFrame({"unit": np.arange(1 + len(head_keys), n_units, dtype=np.int32), "cls": own[1 + len(head_keys):].astype(np.int32)})
    units["shape"] = (units["unit"] - 1 - len(head_keys)).astype(np.int32)
    heads = pd.DataFrame({"head": head_keys.view(np.int64), "head_cls": own[1:1 + len(head_keys)].astype(np.int32)})
    head_frame = spark.createDataFrame(heads, "head bigint, head_cls int")
    by_class = (vocabulary.join(F.broadcast(spark.createDataFrame(units[["shape", "cls"]], "shape int, cls int")), "shape")
                .join(F.broadcast(head_frame), F.col("key") == F.col("head"), "left")
                .groupBy(F.coalesce("head_cls", "cls").alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"))).toPandas()
    tokens, types = np.zeros(classes), np.zeros(classes)
    tokens[by_class["c"]], types[by_class["c"]] = by_class["n"], by_class["types"]
    wide_table = frequent(wide).select("key", "n").toArrow()
    return Model(vocabulary, int(n_tokens), int(n_types), head_keys, own, log_next, tokens, types,
                 wide_table.column("key").to_numpy().view(np.uint64).copy(), wide_table.column("n").to_numpy().copy(), wide, shapes, delta, history)


def _emission(m: dict, cls: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 P(word | class) of words with training count ``n``."""
    return np.log10((n + m["delta"]) / (m["class_tokens"][cls] + m["delta"] * (m["class_types"][cls] + 1)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity): base_score is
    the add-one unigram model's log10 probability, score the class model's."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.shared())
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    floor = np.log10(model.n_tokens + model.n_types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        head, wide = KeyTable(m["head_keys"]), KeyTable(m["wide_keys"])
        counts = np.append(m["wide_counts"], 0)
        task, seen = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            parts = []
            for first_row, data, offsets in text_blocks(batch.column("text")):
                key, shape, first = words(data, offsets, m["shapes"])
                n_texts, n_words = len(offsets) - 1, np.diff(first)
                units = _units(key, shape, head, len(m["head_keys"]))
                before, at = _with_borders(units, first)
                c = m["class_of_unit"]
                token_text = np.repeat(np.arange(n_texts), n_words + 1)
                total = np.bincount(token_text, m["log_next"][c[before], c[at]], n_texts)
                row = wide.rows(key)
                known = row >= 0
                text = np.repeat(np.arange(n_texts), n_words)
                total += np.bincount(text[known], _emission(m, c[units[known]], counts[row[known]]), n_texts)
                base = np.bincount(text[known], np.log10(counts[row[known]] + 1.0) - floor, n_texts).astype(float)
                n_known = np.bincount(text[known], minlength=n_texts)
                rare = ~known
                t, k, w = text[rare], key[rare], c[units[rare]].astype(np.int32)
                order = np.lexsort((k, t))
                t, k, w = t[order], k[order], w[order]
                new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])) if len(t) else np.empty(0, int)
                times = np.diff(np.append(new, len(t))).astype(np.int32)
                cut = np.searchsorted(t[new], np.arange(n_texts + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (k[new].view(np.int64), w[new], times)]
                parts.append(pa.RecordBatch.from_arrays(
                    [pa.array(task + seen + np.arange(n_texts)), batch.column("id").slice(first_row, n_texts), pa.array(n_words.astype(np.int64)),
                     pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(total), *lists],
                    ["row", "id", "n_words", "known", "base", "total", "keys", "classes", "times"]))
                seen += n_texts
            yield from parts

    schema = T.StructType([T.StructField("row", T.LongType()), slim.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("total", T.DoubleType()),
                           T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("classes", T.ArrayType(T.IntegerType())),
                           T.StructField("times", T.ArrayType(T.IntegerType()))])
    rows = written(slim.mapInArrow(run, schema), "text-scores")
    # the rare words: one row for each text and word, joined with their counts
    tail = rows.select("row", F.explode(F.arrays_zip("keys", "classes", "times")).alias("w")).select(
        "row", F.col("w.keys").alias("tail"), F.col("w.classes").alias("cls"), F.col("w.times").alias("times"))
    counts = model.vocabulary.where(F.col("n") * F.lit(model.wide) < F.lit(max(model.n_tokens, 1))).select("key", "n")
    n = F.coalesce("n", F.lit(0))
    per_class = spark.createDataFrame(pd.DataFrame({"c": np.arange(len(model.class_tokens), dtype=np.int32),
                                                    "room": np.log10(model.class_tokens + model.delta * (model.class_types + 1))}))
    sums = (tail.join(counts, F.col("tail") == F.col("key"), "left").join(F.broadcast(per_class), F.col("cls") == F.col("c"))
            .groupBy(F.col("row").alias("t_row")).agg(
                F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("t_known"),
                F.sum(F.col("times") * (F.log10(n + F.lit(1.0)) - F.lit(float(floor)))).alias("t_base"),
                F.sum(F.col("times") * (F.log10(n + F.lit(model.delta)) - F.col("room"))).alias("t_total")))
    n_ends = round(float(model.n_tokens - model.class_tokens.sum()))
    end_base = float(np.log10(n_ends + 1) - floor)
    out = rows.drop("keys", "classes", "times").join(sums, F.col("row") == F.col("t_row"), "left")
    zero = F.lit(0)
    return out.select(
        "id", (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("t_known", zero) + F.lit(1 if n_ends else 0)).cast("bigint").alias("n_known"),
        (F.col("base") + F.coalesce("t_base", F.lit(0.0)) + F.lit(end_base)).alias("base_score"),
        (F.col("total") + F.coalesce("t_total", F.lit(0.0))).alias("score")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
