"""Ranked lexical search: Block-Max MaxScore over shards of an inverted index.

The documents are indexed once for the terms of a set of queries. A task turns
runs of documents (about ``SHARD_BYTES`` of text) into shards, each one row of
a written table: document ids and lengths, and for every term its postings in
blocks of 128, delta-coded in the fewest bytes, with each block's first and
last document, highest count and least document length. Global figures (N, L,
document frequencies) are sums over the shards' columns.

A search task takes its shards one after the other and keeps one list of the
``k`` best for each query across them, so later shards meet higher thresholds.
A term's bound is the highest bound of its blocks in the shard. Terms are sorted
by bound; those whose bounds together stay below the threshold are not
essential: no document can get into the list by them alone. Candidates come
from the essential lists only, a window of documents at a time. Non-essential
lists are taken from the highest bound down: a candidate goes when its score,
the bound of its block there and the bounds of the lists left cannot reach the
threshold, before that block is decompressed. Blocks once decompressed serve
the shard's other queries. Bounds are not estimates (a score grows with the
count and falls with the length), ties count as reaching, and scores are whole
numbers, so the result is exact. The tasks' lists are merged by rank windows, first
of task groups, then of all.

Memory: a task holds a shard, its decompressed blocks, ``k`` rows a query and
the queries. Queries are taken in blocks of about ``QUERY_BYTES`` of text (one
longer item is a block of its own), each with an index of its own; so what is
broadcast is bounded, and the driver holds one block and its terms' counts. No
row is shuffled but the tasks' lists. A frequent term's postings are spread over
all shards.

A null or empty text, and one without terms, is no document and no query. Null
and repeated document ids are ranked like others (nulls first among equal
scores); repeated rows are documents of their own. Equal rows (id and text) of
the queries are asked once. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ragged import LOWER, KeyTable, mix, spans, text_blocks
from .tables import ship_package, written

SHARD_BYTES = 1 << 24
QUERY_BYTES = 1 << 22
BLOCK, WINDOW = 128, 1024
#: Fixed by the ranking's definition: saturation, length share (percent) and the scales of the whole-number arithmetic.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 75

#: ASCII letters and digits and every byte of other characters make terms.
_TERM_BYTE = np.ones(256, bool)
_TERM_BYTE[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_BLOCKS = np.dtype([("first", "<i4"), ("last", "<i4"), ("n", "<i2"), ("doc_width", "u1"), ("tf_width", "u1"),
                    ("tf", "<i8"), ("length", "<i8"), ("at", "<i8")])
_WIDTHS = {1: np.dtype("<u1"), 2: np.dtype("<u2"), 4: np.dtype("<u4")}


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode().lower())


class Lexicon:
    """Numbers of a set of terms, found for whole arrays of words. A word of up
    to 24 bytes is compared as three zero-padded integers (no word holds a zero
    byte), a longer one as bytes, so no two words are ever taken for each other."""

    WORDS = 3

    def __init__(self, terms: list[bytes]):
        self.long = {t: i for i, t in enumerate(terms) if len(t) > 8 * self.WORDS}
        self.number = np.asarray([i for i, t in enumerate(terms) if len(t) <= 8 * self.WORDS], np.int32)
        self.packed = np.frombuffer(b"".join(terms[i].ljust(8 * self.WORDS, b"\0") for i in self.number), "<u8").reshape(-1, self.WORDS)
        self.seed = np.uint64(1)
        while len(np.unique(self._keys(self.packed))) < len(self.packed):
            self.seed += np.uint64(1)
        self.table = KeyTable(self._keys(self.packed))

    def _keys(self, packed: np.ndarray) -> np.ndarray:
        key = np.full(len(packed), self.seed, np.uint64)
        for j in range(self.WORDS):
            key = mix(key + packed[:, j])
        return key

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word of ``data`` (lower-cased bytes), -1 if unknown."""
        out = np.full(len(starts), -1, np.int32)
        size = ends - starts
        fits = np.flatnonzero(size <= 8 * self.WORDS)
        if len(self.number) and len(fits):
            padded = np.concatenate([data, np.zeros(8 * self.WORDS, np.uint8)])
            at_byte = np.ndarray(len(padded) - 7, "<u8", padded.data, strides=(1,))
            packed = np.empty((len(fits), self.WORDS), np.uint64)
            for j in range(self.WORDS):
                bits = (8 * np.clip(size[fits] - 8 * j, 0, 8)).astype(np.uint64)
                mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1))
                packed[:, j] = at_byte[np.minimum(starts[fits] + 8 * j, len(at_byte) - 1)] & mask
            row = self.table.rows(self._keys(packed))
            same = (row >= 0) & (self.packed[row] == packed).all(axis=1)
            out[fits[same]] = self.number[row[same]]
        if self.long:
            for i in np.flatnonzero(size > 8 * self.WORDS):
                out[i] = self.long.get(data[starts[i]:ends[i]].tobytes(), -1)
        return out


def _narrow(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bytes that the largest value of each block needs: 1, 2 or 4."""
    top = np.maximum.reduceat(values, cuts)
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4)).astype(np.uint8)


def _encoded(doc: np.ndarray, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> tuple:
    """(terms, document frequencies, block table, payload) of a shard's postings."""
    order = np.argsort(term, kind="stable")  # documents ascend within a term
    doc, term, tf = doc[order], term[order], tf[order]
    terms, first, df = np.unique(term, return_index=True, return_counts=True)
    per = -(-df // BLOCK)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    cuts = np.repeat(first, per) + nth * BLOCK
    ends = np.append(cuts[1:], len(doc))[:len(cuts)]
    table = np.zeros(len(cuts), _BLOCKS)
    if len(cuts):
        step = np.diff(doc, prepend=0)
        step[cuts] = 0  # a block counts from its first document
        table["first"], table["last"], table["n"] = doc[cuts], doc[ends - 1], ends - cuts
        table["tf"], table["length"] = np.maximum.reduceat(tf, cuts), np.minimum.reduceat(length[doc], cuts)
        table["doc_width"], table["tf_width"] = _narrow(step, cuts), _narrow(tf, cuts)
        sizes = table["n"].astype(np.int64) * (table["doc_width"].astype(np.int64) + table["tf_width"])
        table["at"] = np.cumsum(sizes) - sizes
    payload = b"".join(
        step[a:b].astype(_WIDTHS[d]).tobytes() + tf[a:b].astype(_WIDTHS[w]).tobytes()
        for a, b, d, w in zip(cuts.tolist(), ends.tolist(), table["doc_width"].tolist(), table["tf_width"].tolist(), strict=True))
    return terms, df, table, payload


def index(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n_docs, n_words, ids, lengths, terms, dfs, blocks, payload): one row a
    shard; ``n_docs`` counts documents with terms, ``terms`` are numbers."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("n_docs", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("ids", T.ArrayType(slim.schema["id"].dataType)), T.StructField("lengths", T.BinaryType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("dfs", T.ArrayType(T.LongType())),
                           T.StructField("blocks", T.BinaryType()), T.StructField("payload", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        ids, lengths, postings, size, n = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            length = np.concatenate(lengths)
            doc, term, tf = (np.concatenate(c) for c in zip(*postings, strict=True))
            numbers, df, table, payload = _encoded(doc, term, tf, length)
            keys = pa.concat_arrays(ids)
            row = [[int((length > 0).sum())], [int(length.sum())], pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                   [length.astype("<i8").tobytes()], pa.array([numbers.tolist()], pa.list_(pa.int32())),
                   pa.array([df.tolist()], pa.list_(pa.int64())), [table.tobytes()], [payload]]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in row], schema.fieldNames())

        for batch in batches:
            for first, data, offsets in text_blocks(batch.column("text")):
                data = LOWER[data]
                starts, ends = spans(_TERM_BYTE[data], offsets)
                row = np.searchsorted(offsets, starts, "right") - 1
                number = lexicon.numbers(data, starts, ends)
                known = number >= 0
                pair, tf = np.unique(row[known] * len(shared.value) + number[known], return_counts=True)
                doc, term = np.divmod(pair, max(1, len(shared.value)))
                ids.append(batch.column("id").slice(first, len(offsets) - 1))
                lengths.append(np.bincount(row, minlength=len(offsets) - 1))
                postings.append((n + doc, term, tf))
                n, size = n + len(offsets) - 1, size + len(data)
                if size >= SHARD_BYTES:
                    yield shard()
                    ids, lengths, postings, size, n = [], [], [], 0, 0
        if ids:
            yield shard()

    return slim.mapInArrow(run, schema)


class Shard:
    """A shard opened for search with the corpus figures N and L."""

    def __init__(self, lengths: bytes, terms: list[int], dfs: list[int], blocks: bytes, payload: bytes, n_docs: int, n_words: int):
        norm = lambda length: 100 - LENGTH_SHARE + (LENGTH_SHARE * length * n_docs) // n_words
        self.m = norm(np.frombuffer(lengths, "<i8"))
        self.blocks, self.payload, self.opened = np.frombuffer(blocks, _BLOCKS), payload, {}
        self.first, self.last = self.blocks["first"].astype(np.int64), self.blocks["last"].astype(np.int64)
        self.bound = self.impact(self.blocks["tf"], norm(self.blocks["length"]))
        ends = np.concatenate([[0], np.cumsum(-(-np.asarray(dfs, np.int64) // BLOCK))]).tolist()
        self.lists = {t: (a, b) for t, a, b in zip(terms, ends[:-1], ends[1:], strict=True)}
        tops = np.maximum.reduceat(self.bound, [a for a, _ in self.lists.values()]) if self.lists else []
        self.top = dict(zip(terms, map(int, tops), strict=True))

    @staticmethod
    def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """A posting's share of the score, before its term's weight."""
        return (SCALE * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + SATURATION * m)

    def postings(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a block, decompressed once."""
        if b not in self.opened:
            x = self.blocks[b]
            n, at, wide = int(x["n"]), int(x["at"]), int(x["doc_width"])
            doc = np.cumsum(np.frombuffer(self.payload, _WIDTHS[wide], n, at), dtype=np.int64) + int(x["first"])
            tf = np.frombuffer(self.payload, _WIDTHS[int(x["tf_width"])], n, at + n * wide)
            self.opened[b] = doc, self.impact(tf, self.m[doc])
        return self.opened[b]

    def search(self, query: list[tuple[int, int]], best: Best) -> None:
        """Add the shard's documents that can be among the ``best`` of a query, a
        list of (term number, weight)."""
        own = sorted((weight * self.top[t], t, weight) for t, weight in query if t in self.lists and weight > 0)
        together = np.cumsum([b for b, _, _ in own])
        for lo in range(0, len(self.m), WINDOW):
            need = best.threshold()
            idle = int(np.searchsorted(together, need))  # so many lists do not reach the threshold together
            if idle == len(own):
                return
            score = np.zeros(min(WINDOW, len(self.m) - lo), np.int64)
            for _, t, weight in own[idle:]:
                self._add_list(score, lo, *self.lists[t], weight)
            found = np.flatnonzero(score)
            for k in range(idle - 1, -1, -1):
                found = found[score[found] + together[k] >= need]
                if not len(found):
                    break
                found = self._probe(score, lo, found, *self.lists[own[k][1]], own[k][2], together[k - 1] if k else 0, need)
            found = found[score[found] >= need]
            if len(found):
                best.add(score[found], found + lo)

    def _add_list(self, score: np.ndarray, lo: int, a: int, b: int, weight: int) -> None:
        hi = lo + len(score)
        for x in range(a + int(np.searchsorted(self.last[a:b], lo)), a + int(np.searchsorted(self.first[a:b], hi))):
            doc, impact = self.postings(x)
            if doc[0] < lo or doc[-1] >= hi:
                cut = slice(*np.searchsorted(doc, [lo, hi]))
                doc, impact = doc[cut], impact[cut]
            score[doc - lo] += weight * impact

    def _probe(self, score: np.ndarray, lo: int, found: np.ndarray, a: int, b: int, weight: int, below: int, need: int) -> np.ndarray:
        """Add a non-essential list's scores to the candidates that its block bounds leave."""
        doc = found + lo
        at = np.minimum(a + np.searchsorted(self.last[a:b], doc), b - 1)
        inside = (self.first[at] <= doc) & (doc <= self.last[at])
        left = score[found] + below + np.where(inside, weight * self.bound[at], 0) >= need
        found, at = found[left], at[left]
        doc, at = found[inside[left]] + lo, at[inside[left]]
        cuts = np.flatnonzero(np.diff(at, prepend=-1))
        for i, j in zip(cuts, np.append(cuts[1:], len(at))[:len(cuts)], strict=True):
            docs, impact = self.postings(int(at[i]))
            own = doc[i:j]
            p = np.searchsorted(docs, own)
            hit = docs[p] == own  # within the block's first and last
            score[own[hit] - lo] += weight * impact[p[hit]]
        return found


class Best:
    """The k best (score, id) of a query so far."""

    def __init__(self, k: int):
        self.k, self.rows, self.ids = k, [], None

    def threshold(self) -> int:
        return max(1, -self.rows[-1][0]) if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        if len(scores) > self.k:
            cut = scores >= np.partition(scores, -self.k)[-self.k]
            scores, docs = scores[cut], docs[cut]
        new = [(-s, i is not None, i) for s, i in zip(scores.tolist(), self.ids.take(pa.array(docs)).to_pylist(), strict=True)]
        self.rows = sorted(self.rows + new, key=lambda r: (r[0], r[1], r[2] if r[1] else 0))[:self.k]


def search(shards: DataFrame, queries: list[Counter], n_terms: int, k: int) -> DataFrame:
    """(query, id, score): the k best documents of every query, a count of
    term numbers."""
    spark = shards.sparkSession
    total = shards.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = total[0] or 0, total[1] or 0
    pairs = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df"))
    weight = [0] * n_terms
    for r in pairs.collect():  # one row a term of the queries
        weight[r["terms"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    shared = spark.sparkContext.broadcast([[(t, c * weight[t]) for t, c in q.items()] for q in queries])
    id_type = shards.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType()),
                           T.StructField("part", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best, id_kind = [Best(k) for _ in asked], None
        for batch in batches:
            id_kind = batch.column("ids").type.value_type
            for i in range(batch.num_rows):
                lengths, terms, dfs, blocks, payload = (batch.column(c)[i].as_py() for c in ("lengths", "terms", "dfs", "blocks", "payload"))
                shard, ids = Shard(lengths, terms, dfs, blocks, payload, n_docs, max(1, n_words)), batch.column("ids")[i].values
                for query, top in zip(asked, best, strict=True):
                    top.ids = ids
                    shard.search(query, top)
        rows = [(q, r[2], -r[0]) for q, top in enumerate(best) for r in top.rows]
        if rows:
            q, ids, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(ids, id_kind), pa.array(scores, pa.int64()),
                                              pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32())], schema.fieldNames())

    out = shards.mapInArrow(run, schema).withColumn("part", F.floor(F.col("part") / 64))
    for keys in (["query", "part"], ["query"]):
        out = ranked(out, keys, k)
    return out.select("query", "rank", "id", "score")


def ranked(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_first())
    return lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, id, score): for each item its ``k`` highest-scoring documents with a score above 0."""
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null").distinct(), "queries")
    n_blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // query_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    parts = []
    for b in range(n_blocks):
        rows = asked.where(block == b).orderBy("item_id", "text").collect()
        counts = [Counter(terms_of(r["text"])) for r in rows]
        terms = sorted({t for c in counts for t in c})
        number = {t: i for i, t in enumerate(terms)}
        queries = [Counter({number[t]: n for t, n in c.items()}) for c in counts]
        found = search(written(index(docs, terms, id_col, text_col), "shards"), queries, len(terms), k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      T.StructType([T.StructField("query", T.IntegerType()), asked.schema["item_id"]]))
        parts.append(found.join(F.broadcast(names), "query").select("item_id", "rank", "id", "score"))
    return reduce(DataFrame.unionByName, parts)
