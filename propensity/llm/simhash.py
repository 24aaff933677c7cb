"""SimHash near-duplicate groups by segment-popcount embedding.

A text's 64-bit fingerprint sets a bit where over half of its word shingles'
XXH64 values (seed 42) have it; two texts are linked when their fingerprints
differ in at most ``max_bits`` bits, and a group is what links can reach.

Search: the fingerprint is cut into 32 segments of 2 bits and mapped to the
vector of their bit counts (0, 1 or 2). Flipping one bit moves one count by
one, so the Manhattan distance of two vectors is a lower bound of the bit
distance and pairs further apart than ``max_bits`` need no check. The vectors
live on a grid whose axes are ``2 * max_bits`` groups of segments: a Manhattan
ball of radius ``max_bits`` cannot move more than ``max_bits`` of the axes, so
two vectors within it agree on at least ``max_bits`` axes and meet in a cell
of one of the grid's ``C(2 * max_bits, max_bits)`` faces. Each distinct
fingerprint is placed in one cell per face (70 for 4 bits, whatever the size
of the corpus); cells are shuffled by key, members are compared by the
Manhattan bound and then exactly.

Exact copies are merged before the search. Inside a cell the links are found
by growing one group at a time and comparing only with members not reached
yet, so a cell of near copies costs about its size and yields a spanning
tree, never all pairs: groups come out whole, and no pair list is made.

Null and empty texts and texts without words have fingerprint zero, linked
like any other; a text of fewer words than a shingle is one shingle. Repeated
rows share their fingerprint and group. A null id takes part in linking but
never names a group (the group id is null if every id of the group is null).
An empty table gives an empty result. Columns other than id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ragged import text_blocks
from .tables import written

_ODD = 0x5555555555555555
_BLOCK_SHINGLES = 1 << 14


def _text_fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle, len(words))
    a, b = starts[:len(words) - k + 1], ends[k - 1:]
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), len(a)
    for i in range(0, total, _BLOCK_SHINGLES):
        x, y = a[i:i + _BLOCK_SHINGLES].tolist(), b[i:i + _BLOCK_SHINGLES].tolist()
        h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(x, y, strict=True)), np.uint64, len(x))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp bigint): the signed form of each whole text's 64-bit SimHash."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.zeros(batch.num_rows, np.uint64)
            for first, data, off in text_blocks(batch.column("text")):
                raw, cuts = data.tobytes(), off.tolist()
                for i in range(len(cuts) - 1):
                    fps[first + i] = _text_fingerprint(raw[cuts[i]:cuts[i + 1]], shingle, seed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], ["id", "fp"])

    return slim.mapInArrow(run, T.StructType([slim.schema["id"], T.StructField("fp", T.LongType())]))


def embed(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, each written in unary (0, 1, 3):
    the Manhattan distance of two vectors is the bit distance of these words."""
    low, high = fp & np.uint64(_ODD), (fp >> np.uint64(1)) & np.uint64(_ODD)
    return (low | high) | ((low & high) << np.uint64(1))


def face_masks(max_bits: int) -> list[int]:
    """For each choice of ``max_bits`` of the ``2 * max_bits`` grid axes, the
    mask that keeps their segments."""
    axes = max(2 * max_bits, 1)
    bounds = [round(i * 32 / axes) * 2 for i in range(axes + 1)]
    axis = [sum(1 << b for b in range(bounds[i], bounds[i + 1])) for i in range(axes)]
    return [sum(axis[i] for i in keep) for keep in combinations(range(axes), max_bits)] if max_bits else [axis[0]]


def cell_links(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the groups among distinct fingerprints of one cell."""
    left, right = [], []
    rest = fp
    todo: list = []
    while len(rest):
        if not todo:
            todo, rest = [rest[0]], rest[1:]
            continue
        p = todo.pop()
        near = np.bitwise_count(embed(rest) ^ embed(np.asarray([p], np.uint64))) <= max_bits
        near[near] = np.bitwise_count(rest[near] ^ p) <= max_bits
        if near.any():
            found = rest[near]
            left.append(np.full(len(found), p, np.uint64))
            right.append(found)
            todo.extend(found)
            rest = rest[~near]
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def _run_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys (rows sorted by key)."""
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(cut)
    two = cut[:-1][size == 2]
    a, b = fp[two], fp[two + 1]
    near = np.bitwise_count(embed(a) ^ embed(b)) <= max_bits
    a, b = a[near], b[near]
    near = np.bitwise_count(a ^ b) <= max_bits
    lefts, rights = [a[near]], [b[near]]
    for s, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
        x, y = cell_links(fp[s:s + n], max_bits)
        lefts.append(x)
        rights.append(y)
    return np.concatenate(lefts), np.concatenate(rights)


def links(fps: DataFrame, max_bits: int = 4, fp_col: str = "fp") -> DataFrame:
    """(a, b), a < b: links that span every group of the distinct
    fingerprints in ``fps``."""
    masks = np.array(face_masks(max_bits), np.uint64)
    salt = np.arange(1, len(masks) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fp), 4096):
                part = fp[i:i + 4096]
                cell = ((embed(part)[:, None] & masks) ^ salt) * np.uint64(0xD6E8FEB86659FD93)
                cell ^= cell >> np.uint64(32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((cell * np.uint64(0x9E3779B97F4A7C15)).ravel().view(np.int64)),
                     pa.array(np.repeat(part, len(masks)).view(np.int64))], ["cell", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, fp):
            a, b = (x.view(np.int64) for x in _run_links(key, fp, max_bits))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        held = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            last = int(np.searchsorted(key, key[-1], "left"))  # the last cell may go on
            if last:
                yield out(np.concatenate([*held[0], key[:last]]), np.concatenate([*held[1], fp[:last]]).view(np.uint64))
                held = [], []
            elif held[0] and held[0][-1][-1] != key[0]:
                yield out(np.concatenate(held[0]), np.concatenate(held[1]).view(np.uint64))
                held = [], []
            held[0].append(key[last:])
            held[1].append(fp[last:])
        if held[0]:
            yield out(np.concatenate(held[0]), np.concatenate(held[1]).view(np.uint64))

    cells = fps.select(F.col(fp_col).cast("bigint").alias("fp")).distinct().mapInArrow(place, "cell bigint, fp bigint")
    found = (cells.repartition("cell").sortWithinPartitions("cell", "fp")
             .mapInArrow(meet, "a bigint, b bigint"))
    return found.distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node each node of ``edges`` (a, b) can
    reach. Alternates large-star and small-star rounds, each a few
    aggregations and joins; a written table ends every round's lineage."""
    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        return (both.join(least, both.a == least.u).where("b > u")
                .select(F.col("m").alias("a"), "b").where("a < b").distinct())

    def small_star(e: DataFrame) -> DataFrame:
        least = e.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        to_least = e.join(least, e.b == least.u).select(F.col("m").alias("x"), F.col("a").alias("y"))
        return (to_least.unionByName(least.select(F.col("m").alias("x"), F.col("u").alias("y"))).where("x < y")
                .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())

    def digest(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = written(edges.select("a", "b"), "links")
    seen = digest(e)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        e = written(small_star(large_star(e)), "stars")
        now = digest(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _grouped(rows: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root): every distinct fingerprint of ``rows`` (id, fp) with the
    smallest fingerprint of its group."""
    texts = rows.select("fp").distinct()
    roots = components(links(texts, max_bits))
    return (texts.join(roots, texts.fp == roots.node, "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp, component): one row per row of ``docs``; ``component`` is the
    smallest id among the texts that links can reach."""
    rows = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    texts = rows.groupBy("fp").agg(F.min("id").alias("first_id"))  # exact copies meet here, combined before the shuffle
    roots = _grouped(rows, max_bits).withColumnRenamed("fp", "node")
    texts = texts.join(roots, F.col("fp") == F.col("node")).select("fp", "first_id", "root")
    least = texts.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component"))
    named = written(texts.join(least, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component"),
                    "fingerprint-groups")
    return rows.join(named, rows.fp == F.col("f")).select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each group: that of its smallest id (null ids
    last); where that id has several texts in the group or repeated rows, one
    of them, chosen by the text's hash."""
    keyed = docs.withColumn("__th", F.xxhash64(text_col))
    prints = fingerprints(keyed.select(F.struct(F.col(id_col).alias("id"), F.col("__th").alias("th")).alias("key"), text_col),
                          "key", text_col, shingle, seed)
    rows = written(prints.select(F.col("id.id").alias("id"), F.col("id.th").alias("th"), "fp"), "fingerprints")
    roots = _grouped(rows, max_bits).withColumnRenamed("fp", "node")
    # (fingerprint's smallest row) before the join, so copies don't meet in one task
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", "th")).alias("row"))
    best = (first.join(roots, F.col("fp") == F.col("node")).groupBy("root").agg(F.min("row").alias("row"))
            .select(F.col("row.id").alias("kept_id"), F.col("row.th").alias("kept_th")))
    same = rows.groupBy("id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    best = written(best.join(same, F.col("kept_id").eqNullSafe(F.col("id")) & (F.col("kept_th") == F.col("th")), "left")
                   .select("kept_id", "kept_th", F.coalesce("n", F.lit(1)).alias("n")).distinct(), "kept")

    def rows_of(ids: DataFrame) -> DataFrame:
        on = (F.col("__th") == F.col("kept_th")) & F.col(id_col).eqNullSafe(F.col("kept_id"))
        return keyed.join(ids, on, "left_semi")

    out = rows_of(best.where("n = 1"))
    if best.where("n > 1").limit(1).count():
        out = out.unionByName(rows_of(best.where("n > 1")).dropDuplicates([id_col, "__th"]))
    return out.select(*docs.columns)
