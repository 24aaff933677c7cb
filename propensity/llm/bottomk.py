"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame
functions only.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's shingles
(``shingle`` consecutive words, lower-cased A-Z; a shorter text is one
shingle), sorted. Sketches of parts merge into the sketch of the whole: the k
smallest of their union. From them alone:

* distinct shingles: the count itself below k hashes, else (k - 1) over the
  k-th smallest as a fraction of the hash range;
* resemblance of two texts: of the k smallest hashes of both together, the
  share that is in both;
* containment of one in the other: resemblance times the union's distinct
  count over the one's.

A null or empty text, or one without words, has an empty sketch; two empty
sketches resemble fully, an empty and another not at all. Equal texts have
equal sketches. Repeated rows each keep a sketch. An empty table gives an
empty result. Only id and text are read.

``next_documents`` brings every document the text that follows it in descending
id, without collecting an order in one task: ids are range-partitioned and
linked within partitions, first and last ids of partitions link the rest, and
two shuffles by id bring the texts together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
NONE = "array<bigint>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, shingle: int = 5) -> Column:
    """One hash for each shingle, in order."""
    words = F.filter(F.split(F.translate(text, UPPER, LOWER), SPACE), lambda w: w != "")

    def of(w: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(shingle)])
        many = F.transform(F.sequence(F.lit(0), F.size(w) - shingle), at)
        return (F.when(F.size(w) >= shingle, many).when(F.size(w) > 0, F.array(F.xxhash64(F.lit(shingle), w)))
                .otherwise(F.array().cast(NONE)))
    return F.coalesce(let(words, of), F.array().cast(NONE))


def sketch(text: Column, k: int = 128, shingle: int = 5) -> Column:
    return let(shingle_hashes(text, shingle), lambda h: F.slice(F.sort_array(F.array_distinct(h)), 1, k))


def merge(a: Column, b: Column, k: int = 128) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(a: Column, k: int = 128) -> Column:
    kth = (F.element_at(a, k).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    return let(merge(a, b, k), lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.greatest(F.size(u), F.lit(1))))


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Share of ``a``'s distinct shingles that ``b`` has, at most 1."""
    union = distinct_shingles(merge(a, b, k), k)
    share = F.try_divide(resemblance(a, b, k) * union, distinct_shingles(a, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def to_string(a: Column) -> Column:
    """16 hex digits a hash, in order."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 128, shingle: int = 5) -> DataFrame:
    """(id, sketch, n_distinct)."""
    return (docs.select(F.col(id_col).alias("id"), sketch(F.col(text_col), k, shingle).alias("sketch"))
            .withColumn("n_distinct", distinct_shingles(F.col("sketch"), k)))


def merged(parts: DataFrame, by: list[str], k: int = 128) -> DataFrame:
    """(by, sketch): sketches of groups of parts (column ``sketch``). Every
    task keeps the k smallest hashes of a group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
    h = parts.select(*by, F.explode("sketch").alias("h")).distinct().withColumn("r", rank).where(F.col("r") <= k)
    return h.groupBy(*by).agg(F.sort_array(F.collect_list("h")).alias("sketch"))


def next_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, n_chars, copies, next_id, next_th): each distinct (id, text
    hash) and the one after it in descending id, then text hash; null ids come
    last; the first follows the last."""
    keys = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                        F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"))
            .groupBy("id", "th", "n_chars").agg(F.count(F.lit(1)).alias("copies")))
    order = [F.col("id").desc_nulls_last(), F.col("th").desc()]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = written(keys.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "ordered-ids")
    here = Window.partitionBy("part").orderBy(*order)
    pair = F.struct("id", "th")
    linked = written(keys.withColumn("next", F.lead(pair).over(here))
                     .withColumn("first", F.row_number().over(here) == 1), "linked-ids")
    # one row a partition from here: the first key of the next partition that has rows, round to the first
    heads = linked.where("first").select("part", pair.alias("head"))
    ends = Window.orderBy("part")
    round_to = F.first("head").over(ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = heads.select(F.col("part").alias("e_part"), F.coalesce(F.lead("head").over(ends), round_to).alias("after"))
    return (linked.join(F.broadcast(after), F.col("part") == F.col("e_part"))
            .withColumn("next", F.coalesce("next", "after"))
            .select("id", "th", "n_chars", "copies", F.col("next.id").alias("next_id"), F.col("next.th").alias("next_th")))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 128, shingle: int = 5) -> DataFrame:
    """(id, text, n_chars, edited, sketch, edited_sketch, next_sketch): each
    document, and its text with the last half of its code points replaced by
    as many (or all) first ones of the next document."""
    links = written(next_keys(docs, id_col, text_col), "next-ids")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # one exchange of the texts, by hashes of id and text (never null), serves both joins
    rows = docs.select(F.xxhash64(id_col).alias("kid"), F.xxhash64(text_col).alias("th"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).repartition(n, "kid", "th")
    # what the next document gives: its first code points, as many as half of the one before it, and its sketch
    gifts = links.select(F.xxhash64("next_id").alias("g_kid"), F.col("next_th").alias("g_th"), F.col("id").alias("to_id"),
                         F.xxhash64("id").alias("to_kid"), F.col("th").alias("to_th"),
                         F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    given = (rows.join(gifts, (F.col("kid") == F.col("g_kid")) & (F.col("th") == F.col("g_th")))
             .select("to_id", "to_kid", "to_th", F.substring("text", F.lit(1), F.col("half")).alias("start"),
                     sketch(F.col("text"), k, shingle).alias("next_sketch")))
    if links.where("copies > 1").limit(1).count():
        given = given.dropDuplicates(["to_kid", "to_th"])  # a repeated row gives once
    both = rows.join(given, (F.col("kid") == F.col("to_kid")) & (F.col("th") == F.col("to_th")))
    chars = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), chars - F.floor(chars / 2).cast("int")), F.col("start"))
    return (both.select(F.col("to_id").alias("id"), "text", chars.cast("bigint").alias("n_chars"), edited.alias("edited"), "next_sketch")
            .withColumn("sketch", sketch(F.col("text"), k, shingle))
            .withColumn("edited_sketch", sketch(F.col("edited"), k, shingle)))
