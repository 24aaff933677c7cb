"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. Each source has a weight and a schedule, the
density with which its words are demanded over time; its integral gives the
cumulative demand ``D(t) = target * G(t)``. A source's documents are laid out
once per pass in a seeded order; a copy that starts at word ``x`` of that
layout is trained at ``t = D^-1(x)``. Sorting copies by ``t`` across sources is
the curriculum.

Targets: sources by code point (null last) weigh 1, 2, 3, repeating, and share
all words; none may take more than ``max_passes`` times its own words, and what
a stopped source leaves is shared again by weight among the others until none
is above. Written as water-filling: target = min(cap, level * weight) with one
level, found from sources sorted by cap / weight.

Whole passes take every document; the last pass takes the layout's first
documents and, for exactly one document of the source, its first words, so
that a source's taken words equal its target rounded down.

Scale: the layout's running sums are two-level. Documents fall by hash into
buckets of about ``bucket_rows`` rows of one source; bucket totals are summed
first, and only then rows within a bucket, so a source that holds a third of
all rows is never one task. Tables of sources and of buckets are the only
ones summed in order over more than a bucket.

Null text has no words; documents without words take none. A null id or
source is kept (null sources form the last source). The layout's hash is of id
and text, so texts under one id, or under none, are spread too. Repeated rows
count as documents of their own and lie side by side. An empty table gives an empty result. Extra columns
are carried only if named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded
from .tables import written

#: Weights by source rank, and for each weight the schedule's density at time
#: 0; the density is linear with integral 1, so it ends at 2 minus that.
WEIGHTS = (1, 2, 3)
START_DENSITY = (1.5, 1.0, 0.5)

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cumulative(t: Column, a: Column) -> Column:
    """G(t): integral to ``t`` of the density a + 2 (1 - a) t."""
    return a * t + (1 - a) * t * t


def inverse(u: Column, a: Column) -> Column:
    """G^-1(u) for u in [0, 1] and a in [0, 2]."""
    root = F.sqrt(F.greatest(a * a + 4 * (1 - a) * u, F.lit(0.0)))
    return F.least(F.greatest(F.when(F.abs(1 - a) < 1e-9, u).otherwise(F.coalesce(F.try_divide(2 * u, a + root), F.lit(0.0))), F.lit(0.0)), F.lit(1.0))


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS,
                   start_density: Sequence[float] = START_DENSITY, max_passes: int = 3) -> DataFrame:
    """(source, source_size, n_docs, weight, density, target) from rows (source, size)."""
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # one row per source from here on
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), (F.col("rank") % len(xs) + 1).cast("int"))
    s = s.withColumn("rank", rank).withColumn("weight", pick(weights)).withColumn("density", pick(start_density))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_passes)))
    everyone = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (s.withColumn("all_words", F.sum("source_size").over(everyone))
         .withColumn("open_weight", F.sum("weight").over(everyone) - F.sum("weight").over(upto) + F.col("weight"))
         .withColumn("capped", F.sum("cap").over(upto) - F.col("cap"))
         # the level if every source before this one is stopped and no other is
         .withColumn("level", (F.col("all_words") - F.col("capped")) / F.col("open_weight"))
         .withColumn("fits", F.col("cap") / F.col("weight") >= F.col("level") - F.abs("level") * 1e-12))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(everyone)
    s = s.withColumn("final", level["level"])
    return s.select("source", "source_size", "n_docs", "weight", "density",
                    F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"))


def layout_hash(id: Column, text: Column, seed: int) -> Column:
    """The seeded hash that orders a source's documents."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit(""))))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         keep: Sequence[str] = (), weights: Sequence[float] = WEIGHTS, start_density: Sequence[float] = START_DENSITY,
         max_passes: int = 3, bucket_rows: int = 4096, seed: int = 17) -> DataFrame:
    """(id, source, size, source_size, density, target, quota, offset, taken,
    kept columns as struct ``row``): one row per document."""
    h = layout_hash(F.col(id_col), F.col(text_col), seed).alias("h")
    size = written(docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), h,
                               F.xxhash64(text_col).alias("th"), word_count(F.col(text_col)).alias("size")), "sizes")
    targets = written(source_targets(size, weights, start_density, max_passes), "targets")
    with_target = lambda rows: (
        rows.join(broadcast_if_bounded(targets.withColumnRenamed("source", "t_source"), 100_000),
                  F.col("source").eqNullSafe(F.col("t_source")), "inner").drop("t_source"))
    # buckets are ranges of the hash, so the layout's order is the hash's order
    high = F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint")
    bucket = F.shiftright(high * F.ceil(F.col("n_docs") / F.lit(bucket_rows)), 32)
    sums = with_target(size).withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # a null source has a key too, so the join and the window below share one exchange
    key = F.xxhash64("source")
    starts = sums.select(key.alias("b_key"), F.col("bucket").alias("b_bucket"),
                         F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("bucket_start"))
    if keep:
        rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), h, F.xxhash64(text_col).alias("th"),
                           word_count(F.col(text_col)).alias("size"), F.struct(*keep).alias("row"))
    else:
        rows = size.withColumn("row", F.lit(None).cast("struct<none:int>"))
    rows = with_target(rows).withColumn("bucket", bucket).withColumn("key", key)
    rows = rows.join(starts, (F.col("key") == F.col("b_key")) & (F.col("bucket") == F.col("b_bucket")))
    within = (Window.partitionBy("key", "bucket").orderBy("h", "id", "size", "th")
              .rowsBetween(Window.unboundedPreceding, -1))
    quota = F.floor("target").cast("bigint")
    passes = F.coalesce(F.floor(F.try_divide("quota", "source_size")), F.lit(0)).cast("bigint")
    rest = F.col("quota") - F.col("passes") * F.col("source_size")
    last = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("rest") - F.col("offset")))
    return (rows.withColumn("offset", F.col("bucket_start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
            .withColumn("quota", quota).withColumn("passes", passes).withColumn("rest", rest)
            .withColumn("last_words", last).withColumn("taken", F.col("passes") * F.col("size") + F.col("last_words"))
            .select("id", "source", "size", "source_size", "density", "target", "quota", "passes", "offset", "last_words",
                    "taken", "row"))


def positions(planned: DataFrame) -> DataFrame:
    """One row per copy: ``copy`` (pass number), ``words`` taken of it and
    ``position``, the training time at which it starts."""
    n = F.col("passes") + F.when(F.col("last_words") > 0, 1).otherwise(0)
    copies = planned.where(F.col("taken") > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    start = F.col("copy") * F.col("source_size") + F.col("offset")
    return (copies.withColumn("words", F.when(F.col("copy") < F.col("passes"), F.col("size")).otherwise(F.col("last_words")))
            .withColumn("position", inverse(F.try_divide(start, F.col("quota")), F.col("density"))))


def in_order(copies: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-sorted by ``keys``: partition after partition is the training order."""
    n = partitions or int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def dealt(planned: DataFrame, partitions: int | None = None) -> DataFrame:
    """The mix by reference: the copies of a plan (without their texts), range-sorted by training position."""
    return in_order(positions(planned), ["position", "id", "copy"], partitions)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, white space as it was."""
    pieces = F.split(F.translate(text, "\t\n\x0b\f\r", "     "), " ", -1)
    end = F.aggregate(pieces, F.struct(F.lit(0).cast("bigint").alias("w"), F.lit(0).alias("e")),
                      lambda acc, x: F.when(acc["w"] >= n, acc).otherwise(F.struct(
                          (acc["w"] + F.when(x != "", 1).otherwise(0)).alias("w"),
                          (acc["e"] + F.length(x) + 1).alias("e"))))
    return F.substring(text, F.lit(1), F.greatest(end["e"] - 1, F.lit(0)))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          n_chars_col: str | None = "n_chars", partitions: int | None = None, **options) -> DataFrame:
    """The mix itself: ``docs``' columns, one row per copy, range-sorted by
    training position. A copy cut to its first words has its text (and
    ``n_chars_col``) shortened."""
    names = list(docs.columns)
    out = positions(plan(docs, id_col, text_col, source_col, keep=names, **options))
    whole = F.col("words") == F.col("size")
    text = F.when(whole, F.col("row")[text_col]).otherwise(first_words(F.col("row")[text_col], F.col("words")))
    cols = [F.col("position").alias("__position"), F.col("copy").alias("__copy"), F.col("id").alias("__id")]
    for c in names:
        value = F.col("row")[c]
        if c == text_col:
            value = text
        elif c == n_chars_col:
            value = F.when(whole, value).otherwise(F.length(text).cast(docs.schema[c].dataType))
        cols.append(value.alias(c))
    out = out.select(*cols)
    return in_order(out, ["__position", "__id", "__copy"], partitions).select(*names)
