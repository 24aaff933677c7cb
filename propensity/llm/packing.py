"""Token ids packed into fixed-length rows: best-fit decreasing.

Every whole text is tokenized; texts longer than a row are split into
row-long pieces without losing a token, and pieces are packed into rows of
``row_tokens`` by best-fit decreasing: longest piece first, each into the row
with the least room that still fits. The row is found in a segment tree over
remaining capacities (a leaf for each capacity, holding whether some open row
has it), so a placement costs a logarithm of the row length, not of the number
of rows.

A packed row keeps its ids (little-endian uint16 or uint32), cumulative
segment lengths (0 first, tokens in use last), the position each segment
starts at (0 where a document begins, so positions reset there; a later piece
of a split document goes on at its offset), the id of each segment's document
and that segment's piece number. Ids are padded to ``row_tokens``.

``write_packed`` writes the rows by blocks: one id matrix a block (rows by
``row_tokens``, row-major, raw little-endian bytes, so a reader needs no more
than ``numpy.frombuffer``), beside it the cumulative lengths, the resets and the
documents of all its segments and where each row's begin. Tasks write them as
Parquet under Spark's commit protocol, on any storage Spark can write: a task
that is lost or runs twice leaves nothing behind, and a folder is whole or has
no ``_SUCCESS``. ``read_packed`` gives the rows of such a folder, cut from the
matrices in the JVM; ``matrix`` gives one block's matrix as an array.

Packing works on blocks of about ``block_tokens`` consecutive tokens of the
input's partitions, so a task's memory is bounded, nothing is shuffled, rows
keep the input's order at the grain of a block (a curriculum stays one), and a
recomputed task gives the same rows. Each block's least full row may stay open, so
what blocks lose against best-fit decreasing over everything is about one row a
block: 1 in 512 where partitions hold whole blocks (the default block is 512 rows),
more where a partition holds less (a partition of 15 rows loses up to 1 in 15).

A null or empty text has no tokens and no segment (``n_skipped`` of its
block's first row counts such documents; a block of only such documents gives
one row without segments). Ids may be null. Repeated rows are packed as often
as they occur. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .token_counts import vocabulary_text

_state: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts, as bytes, through a bounded memo of parts."""

    def __init__(self, rank_file: str):
        import base64
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.dtype = np.dtype("<u2") if max(ranks.values()) < 65535 else np.dtype("<u4")
        self.pad = max(ranks.values()) + 1
        self.encoding = tiktoken.Encoding("shared", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo = bpe.Memo(self._part, 200_000)

    def _part(self, part: str) -> bytes:
        return np.asarray(self.encoding.encode_ordinary(part), self.dtype).tobytes()

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, bpe.parts_of(text))) if text else b""


class CapacityTree:
    """Open rows by remaining capacity; finds the least capacity that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, capacity).bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = self.leaves + room
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the fullest open row with at least ``need`` room."""
        i = self.leaves + need
        if not self.any[i]:
            while i > 1 and (i & 1 or not self.any[i + 1]):  # up until a right sibling has rows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[i] = 0
            i >>= 1
            while i:
                self.any[i] = self.any[2 * i] | self.any[2 * i + 1]
                if self.any[i]:
                    break
                i >>= 1
        return room, row


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each row; ties keep the items' order."""
    tree, rows = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        spot = tree.take(lengths[i])
        if spot is None:
            rows.append([i])
            room, row = capacity, len(rows) - 1
        else:
            room, row = spot
            rows[row].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], row)
    return rows


def packed_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_tokens: int = 2048,
                  block_tokens: int = 1 << 20, tokenizer: str | None = None) -> DataFrame:
    """(part, block, n_rows, id_bytes, row_bytes, matrix, cu_seqlens, row_starts,
    position_starts, ids, pieces, n_skipped): one packed matrix a block. The
    arrays hold all rows' values one after the other; row k's cumulative
    lengths are those from ``row_starts[k]`` to before ``row_starts[k + 1]``,
    and it has one segment less than cumulative lengths."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.tiktoken")
    shared = vocabulary_text(docs.sparkSession, path)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("n_rows", T.IntegerType()),
        T.StructField("id_bytes", T.IntegerType()), T.StructField("row_bytes", T.IntegerType()),
        T.StructField("matrix", T.BinaryType()),
        T.StructField("cu_seqlens", ints), T.StructField("row_starts", ints), T.StructField("position_starts", longs),
        T.StructField("ids", T.ArrayType(slim.schema["id"].dataType)), T.StructField("pieces", ints),
        T.StructField("n_skipped", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _state:
            _state.clear()
            _state[path] = Encoder(shared.value)
        enc = _state[path]
        wide = enc.dtype.itemsize
        pad = np.asarray([enc.pad], enc.dtype).tobytes()
        part = TaskContext.get().partitionId()
        block, held, skipped = 0, [], 0  # held: (ids, document id, start, piece)

        def flush(arrow_type) -> Iterator[pa.RecordBatch]:
            rows = best_fit_decreasing([len(h[0]) // wide for h in held], row_tokens) or [[]]
            matrix, cu, starts = [], [], [0]
            for row in rows:
                cu.append(0)
                for i in row:
                    matrix.append(held[i][0])
                    cu.append(cu[-1] + len(held[i][0]) // wide)
                matrix.append(pad * (row_tokens - cu[-1]))
                starts.append(len(cu))
            own = [held[i] for row in rows for i in row]
            values = (part, block, len(rows), wide, row_tokens * wide, b"".join(matrix), cu, starts, [h[2] for h in own],
                      [h[1] for h in own], [h[3] for h in own], skipped)
            types = [*[pa.int32()] * 5, pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                     pa.list_(pa.int64()), pa.list_(arrow_type), pa.list_(pa.int32()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], schema.fieldNames())

        size, arrow_type = 0, None
        for batch in batches:
            arrow_type = batch.column("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                raw = enc.ids(text.as_py() or "")
                skipped += not raw
                for piece, at in enumerate(range(0, len(raw), row_tokens * wide)):
                    held.append((raw[at:at + row_tokens * wide], key, at // wide, piece))
                    size += len(held[-1][0]) // wide
                    if size >= block_tokens:
                        yield from flush(arrow_type)
                        block, held, size, skipped = block + 1, [], 0, 0
        if held or skipped:
            yield from flush(arrow_type)

    return slim.mapInArrow(run, schema)


def block_rows(blocks: DataFrame) -> DataFrame:
    """(part, block, row, input_ids, n_tokens, cu_seqlens, position_starts,
    ids, pieces, n_skipped): the rows of packed blocks."""
    rows = blocks.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)))
    at, size = F.get("row_starts", "row"), F.get("row_starts", F.col("row") + 1) - F.get("row_starts", "row")
    segments = lambda c: F.slice(c, at - F.col("row") + 1, size - 1).alias(c)
    return rows.select(
        "part", "block", "row", F.substring("matrix", F.col("row") * F.col("row_bytes") + 1, F.col("row_bytes")).alias("input_ids"),
        F.get("cu_seqlens", at + size - 1).alias("n_tokens"), F.slice("cu_seqlens", at + 1, size).alias("cu_seqlens"),
        segments("position_starts"), segments("ids"), segments("pieces"),
        F.when(F.col("row") == 0, F.col("n_skipped")).otherwise(0).alias("n_skipped"))


def packed(docs: DataFrame, **options) -> DataFrame:
    """The packed rows of ``docs`` (see ``block_rows``; options as ``packed_blocks``)."""
    return block_rows(packed_blocks(docs, **options))


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """The packed blocks of ``docs`` written under ``path``, which must not
    exist (options as ``packed_blocks``)."""
    # token ids hardly compress, and plain bytes are read without decoding
    packed_blocks(docs, **options).write.option("compression", "none").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """The packed rows that ``write_packed`` wrote under ``path``."""
    return block_rows(spark.read.parquet(path))


def matrix(block) -> np.ndarray:
    """The ids of a block read from such a folder, one row of the array a packed row."""
    return np.frombuffer(block["matrix"], f"<u{block['id_bytes']}").reshape(block["n_rows"], -1)


def position_ids(cu_seqlens: list[int], position_starts: list[int]) -> np.ndarray:
    """Positions of a row's tokens: each segment counts on from its start."""
    return np.concatenate([np.arange(b - a) + s for a, b, s in zip(cu_seqlens, cu_seqlens[1:], position_starts, strict=False)]
                          or [np.empty(0, int)])
