"""Row ids, sampling, train/test splits and folds.

Two families:

* ``method="seeded"``: Spark's own samplers (``sample``, ``randomSplit``,
  ``sampleBy`` + anti join), as the reference job uses them.
* ``method="hash"``: md5 of ``"<seed>:<purpose>:<row key>"`` decides;
  reproducible in any SQL engine, independent of partitioning, and it tags
  every row with its part in one projection, so no join is needed. The
  purpose (sample, split, fold) keeps the decisions independent of each
  other, and fractions are compared with the whole 32-bit value.

The exact stratified split and stratified folds need each row's rank inside
its class. A window over a whole class would put half the table in one
task: the exact split searches its boundary in the hash space, and folds
number rows inside equal hash ranges and add prefix sums over the ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import md5_u32
from ..session import BROADCAST_MAX_ROWS, broadcast_if_bounded, cut_lineage

HASH_BITS = 32


def attach_row_id(df: DataFrame, id_col: str | None = None, name: str = "_row_id") -> DataFrame:
    """P5: a unique 64-bit id; the natural key when there is one.

    ``monotonically_increasing_id`` depends on the partitioning, so callers
    persist or checkpoint the result before using the id twice."""
    if id_col:
        return df if id_col == name else df.withColumn(name, F.col(id_col))
    return df.withColumn(name, F.monotonically_increasing_id())


def hash_limit(fraction: float) -> int:
    """The 32-bit values below this are a ``fraction`` of all."""
    return int(math.floor(fraction * (1 << HASH_BITS)))


def _hash_keep(key: str, seed, fraction: float, purpose: str) -> F.Column:
    return md5_u32(key, f"{seed}:{purpose}") < F.lit(hash_limit(fraction))


# ---------------------------------------------------------------- sampling
def sample(df: DataFrame, fraction: float, seed: int = 42, method: str = "seeded",
           key: str | None = None) -> DataFrame:
    """Bernoulli subsample."""
    if fraction >= 1.0:
        return df
    if method == "hash":
        return df.where(_hash_keep(key, seed, fraction, "sample"))
    return df.sample(fraction=fraction, seed=seed)


# ---------------------------------------------------------------- splits
def tag_random_split(df: DataFrame, train_frac: float = 0.8, seed: int = 42,
                     key: str = "_row_id", col: str = "split") -> DataFrame:
    """X2, hash form: ``split`` = 'train' / 'test'."""
    return df.withColumn(col, F.when(_hash_keep(key, seed, train_frac, "split"), "train").otherwise("test"))


def tag_stratified_split(df: DataFrame, target: str, fractions: dict, seed: int = 42,
                         key: str = "_row_id", col: str = "split") -> DataFrame:
    """X3, hash form: per-class Bernoulli with the class's fraction; a class
    without a fraction (including a null target) goes to test, as in
    ``sampleBy``."""
    t = F.col(target)
    frac = None
    for cls, f in fractions.items():
        frac = (F.when(t == F.lit(cls), F.lit(hash_limit(f))) if frac is None
                else frac.when(t == F.lit(cls), F.lit(hash_limit(f))))
    keep = md5_u32(key, f"{seed}:split") < F.coalesce(frac.otherwise(F.lit(0)), F.lit(0))
    return df.withColumn(col, F.when(keep, "train").otherwise("test"))


def split_parts(tagged: DataFrame, col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (tagged.where(F.col(col) == "train").drop(col),
            tagged.where(F.col(col) == "test").drop(col))


def random_split(df: DataFrame, train_frac: float = 0.8, seed: int = 42,
                 method: str = "seeded", key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Not stratified."""
    if method == "hash":
        return split_parts(tag_random_split(df, train_frac, seed, key))
    a, b = df.randomSplit([train_frac, 1.0 - train_frac], seed=seed)
    return a, b


def anti_join_split(df_with_id: DataFrame, train: DataFrame, id_col: str = "_row_id") -> DataFrame:
    """Rows of ``df_with_id`` whose id is not in ``train``.

    Joined on the id only (joining on all columns would drop duplicates).
    ``train`` is a sample of the same table, so no side is small enough to
    broadcast in general; AQE picks the strategy at run time."""
    return df_with_id.join(train.select(id_col), id_col, "left_anti")


def stratified_split(df: DataFrame, target: str, train_frac: float = 0.8, seed: int = 42,
                     method: str = "seeded", key: str | None = None,
                     classes=(0, 1)) -> tuple[DataFrame, DataFrame]:
    """Per-class Bernoulli split. ``seeded``: ``sampleBy`` + anti join on
    a row id (the reference's form); ``hash``: one tagging projection."""
    fractions = {c: train_frac for c in classes}
    if method == "hash":
        return split_parts(tag_stratified_split(df, target, fractions, seed, key))
    # the ids must not change between the sample and the anti join: a
    # reliable checkpoint fixes them (and survives executor loss)
    with_id = cut_lineage(attach_row_id(df, key, "_row_id"))
    train = with_id.sampleBy(target, fractions=fractions, seed=seed)
    test = anti_join_split(with_id, train, "_row_id")
    drop = [] if key == "_row_id" else ["_row_id"]
    return train.drop(*drop), test.drop(*drop)


# ------------------------------------------------------------- class ranks
def _refine(lo: int, width: int, below: int, need: int, rows, bits: int) -> tuple:
    """Pick, among the counted sub-ranges of [lo, lo+width), the one where
    the class's ``need``-th row falls: (lo, width, rows below, need, rows in)."""
    shift = max(0, (width.bit_length() - 1) - bits)
    acc = below
    for b, n in sorted(rows):
        if acc + n >= need:
            return lo + (b << shift), 1 << shift, acc, need, n
        acc += n
    return lo + width, 0, acc, need, 0


def tag_exact_stratified_split(df: DataFrame, target: str, train_frac: float = 0.8,
                               seed: int = 42, key: str = "_row_id", col: str = "split",
                               bits_per_pass: int = 12, max_rank_rows: int = 1_000_000) -> DataFrame:
    """Inside each class, the first ``floor(frac*n + 0.5)`` rows in
    (md5, key) order go to train, the rest to test; null targets go to test.

    The boundary between train and test is searched in the 32-bit md5
    space. Each pass counts rows per (class, one of 2^bits_per_pass
    sub-ranges of the class's current boundary range), so the shuffle carries
    at most classes x 4096 rows whatever the table size, and keeps the
    sub-range holding the boundary. Once that range holds at most
    ``max_rank_rows`` rows (after one pass below ~4e9 rows per class), its
    (md5, key) pairs are ranked to find the class's last train row; the
    result is then one projection that compares every row with that pair, so
    its plan scans the source once. Row keys must be unique (repeats of the
    last train row's key would all go to train)."""
    d = df.withColumn("_h", md5_u32(key, f"{seed}:split"))
    t, hcol = F.col(target), F.col("_h")
    first = (d.where(t.isNotNull())
              .groupBy(t.alias("_t"), F.shiftright(hcol, HASH_BITS - bits_per_pass).alias("_b"))
              .agg(F.count(F.lit(1)).alias("_n")).collect())
    rows: dict = {}
    for r in first:
        rows.setdefault(r["_t"], []).append((r["_b"], r["_n"]))
    state = {}
    for c, rs in rows.items():
        n = sum(x for _, x in rs)
        state[c] = _refine(0, 1 << HASH_BITS, 0, int(math.floor(n * train_frac + 0.5)), rs, bits_per_pass)
    while True:
        todo = {c: v for c, v in state.items() if v[4] > max_rank_rows and v[1] > 1}
        if not todo:
            break
        lo_c = shift_c = scope = None
        for c, (lo, width, *_x) in todo.items():
            cond = t == F.lit(c)
            shift = max(0, (width.bit_length() - 1) - bits_per_pass)
            lo_c = F.when(cond, F.lit(lo)) if lo_c is None else lo_c.when(cond, F.lit(lo))
            shift_c = F.when(cond, F.lit(shift)) if shift_c is None else shift_c.when(cond, F.lit(shift))
            rng = cond & (hcol >= F.lit(lo)) & (hcol < F.lit(lo + width))
            scope = rng if scope is None else scope | rng
        sub = F.call_function("shiftright", hcol - lo_c, shift_c)  # per-class shift
        counts = (d.where(scope).groupBy(t.alias("_t"), sub.alias("_b"))
                   .agg(F.count(F.lit(1)).alias("_n")).collect())
        rows = {}
        for r in counts:
            rows.setdefault(r["_t"], []).append((r["_b"], r["_n"]))
        for c, (lo, width, below, need, _n) in todo.items():
            state[c] = _refine(lo, width, below, need, rows.get(c, []), bits_per_pass)
    if not state:
        return d.withColumn(col, F.lit("test")).drop("_h")
    ranges = need_c = None
    for c, (lo, width, below, need, _n) in state.items():
        cond = (t == F.lit(c)) & (hcol >= F.lit(lo)) & (hcol < F.lit(lo + width))
        ranges = cond if ranges is None else ranges | cond
        left = F.when(t == F.lit(c), F.lit(need - below))
        need_c = left if need_c is None else F.coalesce(need_c, left)
    rn = F.row_number().over(Window.partitionBy("_t").orderBy("_h", "_k"))
    last = (d.where(ranges).select(t.alias("_t"), "_h", F.col(key).alias("_k"), need_c.alias("_need"))
             .withColumn("_rn", rn).where(F.col("_rn") == F.col("_need")).collect())  # one row per class
    cut = {r["_t"]: (r["_h"], r["_k"]) for r in last}
    keep = None
    for c, (lo, _w, _below, _need, _n) in state.items():
        h_c, k_c = cut.get(c, (lo, None))  # no row of the range is needed: all below it
        inside = hcol < F.lit(h_c)
        if k_c is not None:
            inside = inside | ((hcol == F.lit(h_c)) & (F.col(key) <= F.lit(k_c)))
        part = (t == F.lit(c)) & inside
        keep = part if keep is None else keep | part
    return d.withColumn(col, F.when(keep, "train").otherwise("test")).drop("_h")


def class_rank(df: DataFrame, target: str, seed: int = 42, key: str = "_row_id",
               name: str = "_rank", partitions: int | None = None) -> DataFrame:
    """0-based rank of each row inside its class in (md5, key) order.

    The source is read once: its rows go to ``partitions`` (default: the
    session's shuffle partitions) equal ranges of the md5 value, which are
    even whatever the classes' sizes, are sorted there by (class, md5, key),
    numbered, and written to the checkpoint folder. A row's rank is then its
    class's rows in lower ranges (prefix sums over at most partitions x
    classes counts) plus its number within the range less that of the class's
    first row there; the counts are read from the written table and no row is
    shuffled again unless the offsets are too many to broadcast. Row keys
    must be unique and ``target`` a class (few values)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h = md5_u32(key, seed)
    ranges = df.withColumn("_h", h).repartitionById(n, F.shiftright(F.col("_h") * n, HASH_BITS).cast("int"))
    numbered = ranges.sortWithinPartitions(F.col(target).asc_nulls_first(), "_h", key).drop("_h")
    fixed = cut_lineage(numbered.withColumn("_at", F.monotonically_increasing_id()))  # (range, number) in one integer
    fixed = fixed.withColumns({"_p": F.shiftright("_at", 33), "_i": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at")
    lower = Window.partitionBy("_ot").orderBy("_op").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (fixed.groupBy(F.col(target).alias("_ot"), F.col("_p").alias("_op")).agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0)) - F.col("_first")).select("_ot", "_op", "_before"))
    offsets = broadcast_if_bounded(offsets, BROADCAST_MAX_ROWS)
    # null-safe: rows without a class are ranked among themselves
    return (fixed.join(offsets, F.col(target).eqNullSafe(F.col("_ot")) & (F.col("_p") == F.col("_op")), "left")
            .withColumn(name, F.col("_before") + F.col("_i")).drop("_ot", "_op", "_before", "_p", "_i"))


def assign_folds(df: DataFrame, num_folds: int = 2, seed: int = 42, key: str = "_row_id",
                 method: str = "hash", target: str | None = None, stratified: bool = False,
                 col: str = "fold") -> DataFrame:
    """Fold index column.

    unstratified hash: ``md5 % k``; seeded: ``floor(rand(seed) * k)``;
    stratified: rank inside the class modulo k (exactly balanced)."""
    if stratified:
        ranked = class_rank(df, target, f"{seed}:fold", key, "_rank")
        return ranked.withColumn(col, (F.col("_rank") % num_folds).cast("int")).drop("_rank")
    if method == "hash":
        return df.withColumn(col, (md5_u32(key, f"{seed}:fold") % num_folds).cast("int"))
    return df.withColumn(col, F.floor(F.rand(seed) * num_folds).cast("int"))
