"""Benchmark decontamination by winnowed fingerprints, in DataFrame functions only.

A span of ``window`` (10) words shared by a document and a benchmark item is
contamination. Every text is hashed as word ``gram``-grams (5); of each run of
``window - gram + 1`` consecutive grams, which is one window, the minimum hash
is kept. A window that occurs in two texts has the same minimum in both, so
joining the kept hashes finds every shared window: none can be missed. Hits
are then extended word by word around the shared gram and count only where a
whole window is equal, so hash collisions add nothing.

An item shorter than a window is one window of its own length ``m``; it cannot
be found by windows of 10, so for each short length that the benchmark has
(at most 9) all ``m``-grams of documents are joined as well.

Words: A-Z lower-cased, then runs of ASCII digits, ASCII letters and any
non-ASCII characters. Texts that are null or without words have no words, no
hits and are never contaminated; items without words match nothing. Repeated
item rows count once, repeated document rows each get the document's result.
Null ids are kept as ids of their own (a null item id is left out of lists).
Empty tables give no rows, or rows without hits if only the benchmark is
empty. Columns other than id and text are ignored.

Scale: hashing is a narrow scan, and the cost of a text grows with its words
(times a logarithm where it shares many). What is joined is each text's distinct
minima (about two sevenths of its words) against the benchmark's, broadcast
only if their counted number is small, else shuffled. Only documents with a
shared hash are read again for extension. Items with the same words around a
hash are one row until the very end, so a passage that many items repeat does
not multiply the hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded
from .tables import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Rows of benchmark hashes, or of documents that share one, up to which a join may broadcast them.
MAX_BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    split = F.split(F.translate(text, UPPER, LOWER), NOT_WORD)
    return F.coalesce(F.filter(split, lambda w: w != ""), F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body`` of an array value that is computed once, although lambdas in
    the body use it at every position."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _grams(words: Column, k: int) -> Column:
    """Hash of the k-gram at each position (empty if there are fewer words)."""
    def of(w: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
        return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), at)).otherwise(
            F.array().cast("array<bigint>"))
    return let(words, of)


def _minima(grams: Column, run: int) -> Column:
    """The distinct minima of the runs of ``run`` consecutive grams."""
    def of(g: Column) -> Column:
        least = lambda i: F.least(*[F.get(g, i + j) for j in range(run)]) if run > 1 else F.get(g, i)
        low = F.transform(F.sequence(F.lit(0), F.size(g) - run), least)
        return F.when(F.size(g) >= run, F.array_distinct(low)).otherwise(F.array().cast("array<bigint>"))
    return let(grams, of)


def _short_hash(length: int, gram: Column) -> Column:
    return F.xxhash64(F.lit(length), gram)


def _short_hashes(length: int, grams: Column) -> Column:
    return F.transform(grams, lambda x: _short_hash(length, x))


def _common_starts(length: int) -> Column:
    """How many words before the shared gram a window may start that is equal
    on both sides: it starts within both texts' words around the gram."""
    def equal(b: Column) -> Column:
        mine = F.slice("d_around", F.col("d_at") - b + 1, length)
        return (F.size(mine) == length) & (mine == F.slice("around", F.col("at") - b + 1, length))
    return F.filter(F.sequence(F.lit(0), F.least("d_at", "at")), equal)


def _positions(grams: Column, wanted: Column) -> Column:
    """Where the wanted hashes stand (``grams`` is not empty). Many wanted
    hashes are sorted once and found by halving steps, so that a long text
    that shares much costs no square of its length."""
    def of(x: Column) -> Column:
        n = F.size(x)
        halving = F.transform(F.sequence(F.length(F.bin(n)) - 1, F.lit(0), F.lit(-1)), lambda j: F.pow(F.lit(2), j).cast("int"))

        def holds(steps: Column, h: Column) -> Column:
            """Whether the greatest wanted hash up to ``h`` is ``h``."""
            up_to = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
                (at + step <= n) & (F.get(x, at + step - 1) <= h), at + step).otherwise(at))
            return F.when(n <= 32, F.array_contains(x, h)).otherwise(F.get(x, up_to - 1) == h)

        return let(halving, lambda steps: let(grams, lambda g: F.filter(
            F.sequence(F.lit(0), F.size(g) - 1), lambda p: holds(steps, F.get(g, p)))))
    return let(F.sort_array(wanted), of)


def shared_windows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                   gram: int = 5) -> DataFrame:
    """(id, th, start, length, items): the places where a document has a whole
    window of some items; ``th`` is the text's hash, ``start`` counts words."""
    run = window - gram + 1
    bench = written(items.select(F.col(item_id_col).alias("item"), words_of(F.col(item_text_col)).alias("w"))
                    .where(F.size("w") > 0).distinct(), "benchmark-words")
    short = sorted(r[0] for r in bench.where(F.size("w") < window).select(F.size("w")).distinct().collect())

    # benchmark side: (hash, length of the window, words around the gram, gram's place in them, items)
    g = _grams(F.col("w"), gram)
    long_items = (bench.where(F.size("w") >= window).withColumn("g", g)
                  .withColumn("p", F.explode(_positions(F.col("g"), _minima(F.col("g"), run))))
                  .select(F.get("g", "p").alias("h"), F.lit(window).alias("length"),
                          F.greatest(F.col("p") - (run - 1), F.lit(0)).alias("from"), "p", "w", "item")
                  .select("h", "length", F.slice("w", F.col("from") + 1, F.col("p") - F.col("from") + window).alias("around"),
                          (F.col("p") - F.col("from")).alias("at"), "item"))
    hashes = long_items
    for m in short:
        hashes = hashes.unionByName(
            bench.where(F.size("w") == m).select(
                _short_hash(m, F.get(_grams(F.col("w"), m), F.lit(0))).alias("h"), F.lit(m).alias("length"),
                F.col("w").alias("around"), F.lit(0).alias("at"), "item"))
    hashes = written(hashes.groupBy("h", "length", "around", "at").agg(F.collect_set("item").alias("items")), "benchmark-hashes")
    wanted = hashes.select(F.col("h").alias("wanted")).distinct()

    # every document's kept hashes, joined with the benchmark's
    text = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), words_of(F.col(text_col)).alias("w"))
    kept = [_minima(_grams(F.col("w"), gram), run)]
    kept += [_short_hashes(m, F.array_distinct(_grams(F.col("w"), m))) for m in short]
    # explode_outer: the plain form would compute its array a second time to filter empty ones
    found = (text.select("id", "th", F.explode_outer(F.concat(*kept) if len(kept) > 1 else kept[0]).alias("h"))
             .join(broadcast_if_bounded(wanted, MAX_BROADCAST_ROWS), F.col("h") == F.col("wanted"))
             .groupBy("id", "th").agg(F.collect_set("h").alias("shared")))
    found = written(found.select(F.col("id").alias("f_id"), F.col("th").alias("f_th"), "shared"), "shared-hashes")

    # those documents again: where the hashes stand, and the words around them
    again = text.join(broadcast_if_bounded(found, MAX_BROADCAST_ROWS // 10),
                      F.col("id").eqNullSafe(F.col("f_id")) & (F.col("th") == F.col("f_th"))).dropDuplicates(["id", "th"])
    hits = None
    for m in [window, *short]:
        k = gram if m == window else m
        reach = run - 1 if m == window else 0
        place = again.withColumn("g", _grams(F.col("w"), k))
        if m != window:
            place = place.withColumn("g", _short_hashes(m, F.col("g")))
        place = (place.where(F.size("g") > 0).withColumn("p", F.explode(_positions(F.col("g"), F.col("shared"))))
                 .withColumn("from", F.greatest(F.col("p") - reach, F.lit(0)))
                 .select("id", "th", F.get("g", "p").alias("d_h"), "from", (F.col("p") - F.col("from")).alias("d_at"),
                         F.slice("w", F.col("from") + 1, F.col("p") - F.col("from") + m).alias("d_around")))
        pairs = place.join(broadcast_if_bounded(hashes, MAX_BROADCAST_ROWS // 10),
                           (F.col("d_h") == F.col("h")) & (F.col("length") == m))
        part = (pairs.withColumn("b", F.explode(_common_starts(m)))
                .select("id", "th", (F.col("from") + F.col("d_at") - F.col("b")).alias("start"),
                        F.lit(m).alias("length"), "items"))
        hits = part if hits is None else hits.unionByName(part)
    return hits


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  gram: int = 5) -> DataFrame:
    """(id, th, n_words, n_hit, item_list): one row per document row; n_hit
    counts words inside any shared window, item_list holds the item ids as
    sorted strings."""
    hits = shared_windows(docs, items, id_col, text_col, item_id_col, item_text_col, window, gram)
    covered = F.array_distinct(F.flatten(F.transform("windows", lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))
    flat = F.array_distinct(F.flatten("lists"))
    found = (hits.groupBy(F.col("id").alias("h_id"), F.col("th").alias("h_th"))
             .agg(F.collect_set(F.struct("start", "length")).alias("windows"), F.collect_set("items").alias("lists"))
             .select("h_id", "h_th", F.size(covered).cast("bigint").alias("n_hit"),
                     F.array_sort(F.transform(flat, lambda i: i.cast("string"))).alias("item_list")))
    found = written(found, "document-hits")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                       F.size(words_of(F.col(text_col))).cast("bigint").alias("n_words"))
    on = F.col("id").eqNullSafe(F.col("h_id")) & (F.col("th") == F.col("h_th"))
    return (rows.join(broadcast_if_bounded(found, MAX_BROADCAST_ROWS // 10), on, "left")
            .select("id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("item_list", F.array().cast("array<string>")).alias("item_list")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that share a whole window with an item."""
    hits = shared_windows(docs, items, id_col, text_col, **options)
    bad = written(hits.select(F.col("id").alias("__h_id"), F.col("th").alias("__h_th")).distinct(), "contaminated")
    on = F.col(id_col).eqNullSafe(F.col("__h_id")) & (F.xxhash64(text_col) == F.col("__h_th"))
    return docs.join(broadcast_if_bounded(bad, MAX_BROADCAST_ROWS // 10), on, "left_anti").select(*docs.columns)
