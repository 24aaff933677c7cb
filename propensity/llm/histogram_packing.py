"""Best-fit packing planned on the histogram of lengths.

Every document is tokenized once and ends with an end id; one that is longer
than a sequence is cut into pieces of the sequence's length, the last of which
may be shorter. Best-fit decreasing needs only how many pieces have each
length, so it runs over that histogram (at most ``capacity`` numbers, on the
driver) and not over documents: whole ranges of sequences with equal room are
filled at once. The plan is a list of runs, each saying that the pieces of one
length from some rank on go, so many a sequence, to a range of sequences at an
offset. Pieces then take their slots by their rank within their length.

The packing is the one that best-fit decreasing over single pieces gives (the
tests compare the two), over all documents at once.

Ranks are dealt without a window over a length, which may hold a third of all
rows: a task numbers the pieces of each length it makes (``seat``), and running
sums over the counts by (length, part) give every part its first rank. The
pieces are written once, before ranks are taken, so a recomputed task cannot
change them. The plan has at most 2 * capacity ranges of sequences, each with
at most sqrt(2 * capacity) lengths, hence under 2 * capacity * sqrt(2 *
capacity) runs whatever the input's size; it is broadcast.

A null or empty text is a document of the end id alone. Null and repeated ids
and repeated rows keep a place of their own. An empty table gives no rows.
Only id and text are read, so other columns cannot clash. A task holds one
Arrow batch of texts, a bounded memo, and the ids of one text.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .bpe import Memo
from .bpe import _byte_alphabet as byte_alphabet
from .packing import CapacityTree
from .tables import written
from .token_counts import vocabulary_text

_state: dict[str, ChunkEncoder] = {}

#: Ranks take the low bits of a (length, rank) key.
_RANK_BITS = 42


#: Letters that the normaliser only lower-cases (each is its own composed form), then at most one mark that
#: is a word of its own to the pre-tokenizer.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")


class ShortMemo(Memo):
    """A memo whose bound holds in bytes too: long chunks are made each time."""

    def __missing__(self, key):
        return super().__missing__(key) if len(key) <= 256 else self.make(key)


class ChunkEncoder:
    """Ids, as little-endian uint32, of texts whose tokenizer lower-cases and
    drops white space: no token spans it, so the chunks between ASCII white
    space are encoded one by one through a bounded memo.

    A chunk of plain letters goes to the tokenizer's model directly, in the
    byte alphabet its pre-tokenizer would hand over, and shares the memo with
    its other spellings; any other chunk goes through the whole tokenizer."""

    def __init__(self, file_text: str):
        self.tokenizer = Tokenizer.from_str(file_text)
        self.model = self.tokenizer.model
        stand_in = {b: c for c, b in byte_alphabet().items()}
        self.alphabet = {c: "".join(stand_in[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.memo = ShortMemo(self._encode, 500_000)

    def _encode(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        plain = _PLAIN.fullmatch(text)
        if plain is None:
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        word, mark = plain.groups()
        lower = word.lower()
        if mark:
            return self.memo[lower.encode()] + self.memo[mark.encode()]
        if lower != word:
            return self.memo[lower.encode()]
        ids = [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.alphabet))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: bytes) -> bytes:
        # special strings are matched before lower-casing, and a combining mark (U+0300 to U+037F) may join a
        # small letter but not its capital: such texts keep their capitals
        if b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()
        return b"".join(map(self.memo.__getitem__, text.split()))


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over counts: (runs, number of sequences).

    A run (length, first rank, first sequence, pieces a sequence, offset)
    holds up to the next run of its length."""
    tree, runs, made = CapacityTree(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            spot = tree.take(length)  # the least room that fits
            room, (first, n) = spot if spot else (capacity, (made, left))
            # the rest of a filled sequence is its best fit again, so it takes all it can hold
            each = min(room // length, left)
            full = min(n, left // each)
            runs.append((length, rank, first, each, capacity - room))
            if spot is None:
                made += full
            elif n > full:
                tree.add(room, (first + full, n - full))
            if room > each * length:
                tree.add(room - each * length, (first, full))
            rank, left = rank + full * each, left - full * each
    return runs, made


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
           tokenizer: str | None = None, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids, part, seat): the documents'
    pieces; ``ids`` (little-endian uint32) is null without ``with_ids``."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    shared = vocabulary_text(docs.sparkSession, path)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([slim.schema["id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()), T.StructField("seat", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _state:
            _state.clear()
            _state[path] = ChunkEncoder(shared.value)
        enc, end, wide = _state[path], np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        part, seats = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, row_of, held = [], [], 0

            def flush(batch=batch) -> pa.RecordBatch:
                keys = batch.column("id").take(pa.array(row_of, pa.int64()))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                return pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], schema.fieldNames())

            for k, text in enumerate(batch.column("text").cast(pa.large_binary())):
                raw = enc.ids(text.as_py() or b"") + end
                for n, at in enumerate(range(0, len(raw), wide)):
                    own = raw[at:at + wide]
                    length = len(own) >> 2
                    rows.append((n, at >> 2, length, zlib.crc32(own), own if with_ids else None, part, seats[length]))
                    row_of.append(k)
                    seats[length] += 1
                    held += len(own) if with_ids else 64
                if held > 1 << 24:
                    yield flush()
                    rows, row_of, held = [], [], 0
            if rows:
                yield flush()

    return slim.mapInArrow(run, schema)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
           tokenizer: str | None = None, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """``pieces`` with their slots: (id, piece, start, length, ids_crc32, ids,
    sequence_id, offset)."""
    made = written(pieces(docs, id_col, text_col, capacity, tokenizer, end_id, with_ids), "pieces")
    counts = written(made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs, _ = plan(histogram, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("first"))  # a row for each task and length
    ranked = made.join(first, ["part", "length"]).withColumn("rank", F.col("first") + F.col("seat"))
    return _seated(ranked.select("id", "piece", "start", "length", "ids_crc32", "ids", "rank"), runs)


def _seated(ranked: DataFrame, runs: list) -> DataFrame:
    """The run of each (length, rank) is the last one that starts at or before
    it; found by binary search in the broadcast plan."""
    table = np.asarray(sorted(runs), np.int64).reshape(-1, 5)
    shared = ranked.sparkSession.sparkContext.broadcast(table)
    kept = ["id", "piece", "start", "length", "ids_crc32", "ids"]
    schema = T.StructType([*ranked.select(*kept).schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        keys = (t[:, 0] << _RANK_BITS) + t[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            own = t[np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1]
            past = rank - own[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(own[:, 2] + past // own[:, 3]),
                 pa.array(own[:, 4] + past % own[:, 3] * length)], schema.fieldNames())

    return ranked.mapInArrow(run, schema)


def assembled(placed: DataFrame) -> DataFrame:
    """(sequence_id, input_ids, n_tokens, cu_seqlens, position_starts, ids,
    pieces): whole sequences from ``packed`` with ids; a group is one
    sequence, so at most ``capacity`` tokens."""
    seg = F.struct("offset", "length", "start", "id", "piece", F.col("ids").alias("raw"))
    got = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(seg), lambda a, b: F.signum(a["offset"] - b["offset"]).cast("int")).alias("s"))
    last = F.element_at("s", -1)
    total = last["offset"] + last["length"]
    return got.select("sequence_id", F.aggregate("s", F.lit(b""), lambda acc, x: F.concat(acc, x["raw"])).alias("input_ids"),
                      total.alias("n_tokens"), F.concat(F.col("s.offset"), F.array(total)).alias("cu_seqlens"),
                      F.col("s.start").alias("position_starts"), F.col("s.id").alias("ids"), F.col("s.piece").alias("pieces"))
