"""Repair of conversation structure by cheapest edits.

A sound conversation's role initials read ``(s?(ua)+)?``: an optional system
turn, then user and assistant in turns. A row may be kept (0), given the role
user or assistant (1) or deleted (2), and an empty user or assistant turn may
be inserted anywhere (5). Blank rows and repeats of an earlier row of the
conversation (same role and text) have to go; a row cut short, not ending in
``.``, ``!`` or ``?``, costs 5 more if it stays. Among the cheapest edits the
ones whose letters (D, I, K, R) read ASCII-least are taken.

The least cost from a row to the end is a vector with one number for each of
four states of that pattern (nothing yet, after s, after u, after a). Keeping
all vectors needs memory in proportion to the conversation, so a backward pass
stores them only at checkpoints, the k-th k rows before the one after it: about
sqrt(2n) checkpoints and blocks of at most sqrt(2n) rows, without knowing n. A
forward pass holds one block, recomputes its vectors from the checkpoint at its
end, and walks it by tight edits: an edit is tight if its cost and the cost
from where it leads add up to the cost from here. A letter leads to one state
only, so taking the least tight letter each time gives the least string.

Both passes stream over rows sorted by Spark within a partition, one
conversation after the other (the backward pass in descending order), so there
is a single exchange, by conversation, and the sorts spill. A task holds a
block of rows and the audit string of the conversation at hand, a byte a row.
A conversation stays in one task because its audit is one string and the hash
of its repaired text is sequential; its rows are streamed, never collected.

Rows stand by turn (nulls first), rows of one turn by role and text. Null roles
and texts are one space. A null id is a conversation of its own. Roles other
than s..., u... and a... can be deleted or given a role. Repeated rows are
duplicates. ``copies`` (default 1) says how often a row stands; a conversation
whose rows all have 0 is empty: zeros, no edits, the hash of the empty string.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import ship_package

#: ASCII white space.
SPACE = " \t\n\x0b\f\r"

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after the user or assistant turn that may come next, and that turn's role.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
_KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
_NEVER = 1 << 60
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, int, int, int]


def _with_inserts(w: list[int]) -> Vector:
    u, a = min(w[AFTER_U], INSERT + w[AFTER_A]), min(w[AFTER_A], INSERT + w[AFTER_U])
    return min(w[START], INSERT + u), min(w[AFTER_S], INSERT + u), u, a


#: Cost to finish after the last row.
END = _with_inserts([0, _NEVER, _NEVER, 0])


def keep_cost(ahead: Vector, state: int, initial: str, fault: int) -> int:
    """Cost of keeping a row and all that follows; _NEVER or more if it can't stay."""
    to = _KEPT.get((state, initial))
    return _NEVER if to is None or fault in (BLANK, DUPLICATE) else KEEP + CUT_SHORT * (fault == TRUNCATED) + ahead[to]


def rerole_cost(ahead: Vector, state: int, fault: int) -> int:
    return _NEVER if fault in (BLANK, DUPLICATE) else REROLE + CUT_SHORT * (fault == TRUNCATED) + ahead[NEXT[state]]


class Costs(dict):
    """Vectors before a row from those behind it. Vectors are looked up with
    their least number taken off, so there are only a few dozen of them."""

    def __missing__(self, key):
        initial, fault, ahead = key
        self[key] = _with_inserts([min(DELETE + ahead[q], keep_cost(ahead, q, initial, fault), rerole_cost(ahead, q, fault)) for q in range(4)])
        return self[key]

    def before(self, initial: str, fault: int, ahead: Vector) -> Vector:
        low = min(ahead)
        a, b, c, d = self[initial, fault, (ahead[0] - low, ahead[1] - low, ahead[2] - low, ahead[3] - low)]
        return a + low, b + low, c + low, d + low


def walk(block: list[tuple], state: int, ahead: Vector, costs: Costs, last: bool) -> tuple[list[tuple], int]:
    """Edits (letter, row number or None, role or None) of a block of (initial,
    fault) from ``state``, and the state behind it. ``ahead`` is the vector
    behind the block; after the conversation's ``last`` block the pattern is closed."""
    vectors = [ahead]
    for initial, fault in reversed(block):
        vectors.append(costs.before(initial, fault, vectors[-1]))
    vectors.reverse()
    out = []
    for i, (initial, fault) in enumerate(block):
        here, behind = vectors[i], vectors[i + 1]
        while DELETE + behind[state] != here[state] and INSERT + here[NEXT[state]] == here[state]:
            state = NEXT[state]
            out.append(("I", None, ROLE[state]))
        if DELETE + behind[state] == here[state]:
            out.append(("D", i, None))
        elif keep_cost(behind, state, initial, fault) == here[state]:
            out.append(("K", i, None))
            state = _KEPT[state, initial]
        else:
            state = NEXT[state]
            out.append(("R", i, ROLE[state]))
    while last and END[state]:
        state = NEXT[state]
        out.append(("I", None, ROLE[state]))
    return out, state


def _last_char(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))


def _faulted(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies_col: str | None) -> DataFrame:
    """Rows with their faults, hashed by conversation. ``nth`` counts equal
    rows, so (turn, role, text, nth) orders a conversation's rows without ties."""
    copies = F.col(copies_col).cast("int") if copies_col else F.lit(1)
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), copies.alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.when(F.col("copies") > 1, F.sequence(F.lit(1), F.col("copies"))).otherwise(
        F.array(F.greatest(F.coalesce("copies", F.lit(0)), F.lit(0)))))).withColumn("present", F.col("copy") > 0).drop("copies", "copy")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    last = _last_char(F.col("text"))
    fault = (F.when(last == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0))
    return (rows.repartition("conv_id").withColumn("nth", F.row_number().over(same))
            .withColumn("fault", fault).withColumn("initial", F.left("role", F.lit(1))))


def _checkpointed(rows: DataFrame) -> DataFrame:
    """The backward pass: ``ahead`` holds the vector before a row at every checkpoint."""
    down = rows.sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("nth"))
    schema = T.StructType([*down.schema.fields, T.StructField("ahead", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, now, vector, due, gap = Costs(), object(), END, 1, 1
        for batch in batches:
            out = []
            for conv, initial, fault, present in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "initial", "fault", "present")), strict=True):
                if conv != now:
                    now, vector, due, gap = conv, END, 1, 1
                if not present:
                    out.append(None)
                    continue
                vector = costs.before(initial, fault, vector)
                due -= 1
                out.append(None if due else vector)
                if not due:
                    gap += 1
                    due = gap
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], schema.fieldNames())

    return down.mapInArrow(run, schema)


class _Conversation:
    """The forward pass over one conversation: rows in, edits out, counts kept."""

    def __init__(self, conv, costs: Costs):
        self.conv, self.costs, self.state, self.block = conv, costs, START, []
        self.cost = self.illegal = self.rows = self.turns = self.place = 0
        self.faults = [0, 0, 0, 0]
        self.first = self.last = self.initial = None

    def add(self, turn, role: str, text: str, initial: str, fault: int, ahead) -> list[tuple]:
        done = self._walked(tuple(ahead), False) if ahead else []
        if self.rows and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.rows += 1
        self.initial = initial
        self.faults[fault] += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.block.append((turn, role, text, initial, fault))
        return done

    def close(self) -> list[tuple]:
        return self._walked(END, True)

    def _walked(self, ahead: Vector, last: bool) -> list[tuple]:
        """(place, letter, turn, role, text, fault) of the rows held."""
        edits, self.state = walk([r[3:] for r in self.block], self.state, ahead, self.costs, last)
        out = []
        for letter, i, role in edits:
            turn, own, text, _, fault = (None, None, "", None, 0) if i is None else self.block[i]
            out.append((self.place, letter, turn, role or own, text, fault))
            self.place += 1
            self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter] + CUT_SHORT * (letter in "KR" and fault == TRUNCATED)
        self.block = []
        return out

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


def _passed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, list[tuple], bool]]:
    """(conversation, further edits, whether it ends there), in order."""
    costs, own = Costs(), None
    names = ("conv_id", "turn", "role", "text", "initial", "fault", "present", "ahead")
    for batch in batches:
        for conv, turn, role, text, initial, fault, present, ahead in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if own is None or conv != own.conv:
                if own is not None:
                    yield own, own.close(), True
                own = _Conversation(conv, costs)
            if present:
                done = own.add(turn, role, text, initial, fault, ahead)
                if done:
                    yield own, done, False
    if own is not None:
        yield own, own.close(), True


def _ascending(turns: DataFrame, *cols) -> DataFrame:
    ship_package(turns.sparkSession)
    rows = _checkpointed(_faulted(turns, *cols))
    return rows.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth")


def _record(rows: list[tuple], schema: T.StructType, arrow: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)], schema.fieldNames())


def edits(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          copies_col: str | None = None) -> DataFrame:
    """(conv_id, place, edit, turn, role, text, fault): every edit in order.
    Role and text are those after the edit (of a deleted row, its own); the
    repaired conversation is the rows whose edit is not D."""
    rows = _ascending(turns, conv_col, turn_col, role_col, text_col, copies_col)
    schema = T.StructType([rows.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
                           rows.schema["turn"], T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("fault", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, out, size = [], [], 0

        def typed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                types[:] = [batch.column("conv_id").type, pa.int64(), pa.string(), batch.column("turn").type, pa.string(), pa.string(), pa.int32()]
                yield batch

        for own, done, _ in _passed(typed(batches)):
            for e in done:
                out.append((own.conv, *e))
                size += 64 + len(e[4])
                if size > 1 << 22:
                    yield _record(out, schema, types)
                    out, size = [], 0
        if out:
            yield _record(out, schema, types)

    return rows.mapInArrow(run, schema)


def summary(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            copies_col: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256, n_rows): one row for each conversation, from the same
    walk as ``edits``; the repaired text is hashed as it streams by."""
    rows = _ascending(turns, conv_col, turn_col, role_col, text_col, copies_col)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in counts), T.StructField("audit", T.StringType()),
                           T.StructField("repaired_sha256", T.StringType()), T.StructField("n_rows", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, out, size = [], [], 0
        audit, digest, begun = bytearray(), hashlib.sha256(), False

        def typed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                types[:] = [batch.column("conv_id").type, *[pa.int64()] * len(counts), pa.string(), pa.string(), pa.int64()]
                yield batch

        for own, done, over in _passed(typed(batches)):
            for _, letter, _, role, text, _ in done:
                audit += letter.encode()
                if letter != "D":
                    digest.update((f"\n{role}:{text}" if begun else f"{role}:{text}").encode())
                    begun = True
            if over:
                out.append((own.conv, own.gaps(), *own.faults[1:], own.illegal, own.cost, audit.decode(), digest.hexdigest(), own.rows))
                size += 256 + len(audit)
                audit, digest, begun = bytearray(), hashlib.sha256(), False
                if size > 1 << 22:
                    yield _record(out, schema, types)
                    out, size = [], 0
        if out:
            yield _record(out, schema, types)

    return rows.mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations damaged for the registered query, by crc32 of
    ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops the row, 1 empties
    its text, 2 removes ``.!?``, 3 doubles it, 4 makes it the user's. Columns
    conv_id, turn, role, text, copies."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
