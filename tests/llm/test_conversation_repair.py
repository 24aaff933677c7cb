import functools
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from propensity.llm import conversation_repair as CR

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, nth int"
SPACE = " \t\n\x0b\f\r"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        out.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def follow(state, initial):
    """Plain reading of (s?(ua)+)?: states are the strings read so far, shortened."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def cheapest(rows):
    """(cost, audit, repaired) by exhaustive memoised search over whole answers."""
    faults = faults_of(rows)

    @functools.lru_cache(None)
    def best(i, state, inserts):
        answers = []
        if i == len(rows) and state in ("", "a"):
            answers.append((0, "", ()))
        if inserts < 3:
            for initial, role in (("u", "user"), ("a", "assistant")):
                to = follow(state, initial)
                if to:
                    c, s, out = best(i, to, inserts + 1)
                    answers.append((5 + c, "I" + s, (f"{role}:",) + out))
        if i < len(rows):
            _, role, text = rows[i]
            c, s, out = best(i + 1, state, 0)
            answers.append((2 + c, "D" + s, out))
            if faults[i] not in (1, 2):
                extra = 5 if faults[i] == 3 else 0
                for letter, name in (("K", role), ("R", "user"), ("R", "assistant")):
                    to = follow(state, name[:1])
                    if to:
                        c, s, out = best(i + 1, to, 0)
                        answers.append(((letter == "R") + extra + c, letter + s, (f"{name}:{text}",) + out))
        return min(answers, default=(10**9, "", ()))

    return best(0, "", 0)


def digest(rows):
    """What the query has to return for rows in order."""
    faults = faults_of(rows)
    cost, audit, out = cheapest(tuple(rows))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def some_rows(rng, n):
    texts = ["Yes.", "No!", "why?", "cut", "cut ", "", " \t", "ok. \n", "\x1c", "é."]
    return [(rng.choice([None, *range(n)]), rng.choice(["user", "assistant", "system", "tool", "", "Üser", " "] if rng.random() < 0.3 else ["user", "assistant"]),
             rng.choice(texts) if rng.random() < 0.5 else f"t{rng.randrange(50)}.") for _ in range(n)]


def test_summary_and_edits_against_search(spark):
    rng = random.Random(11)
    convs = {c: some_rows(rng, rng.choice([1, 2, 3, 5, 8, 13])) for c in range(250)} | {None: some_rows(rng, 4)}
    flat = [(c, t, r, x, "clash", 7) for c, rows in convs.items() for t, r, x in rows]
    rng.shuffle(flat)
    df = spark.createDataFrame(flat, SCHEMA).repartition(4)
    got = {r.conv_id: r for r in CR.summary(df).collect()}
    assert set(got) == set(convs)
    for c, rows in convs.items():
        assert tuple(got[c][k] for k in COLUMNS) == digest(ordered(rows)), (c, ordered(rows))
    per = defaultdict(list)
    for e in CR.edits(df).collect():
        per[e.conv_id].append(e)
    for c in convs:
        es = sorted(per[c], key=lambda e: e.place)
        assert "".join(e.edit for e in es) == got[c].audit and [e.place for e in es] == list(range(len(es)))
        kept = "\n".join(f"{e.role}:{e.text}" for e in es if e.edit != "D")
        assert hashlib.sha256(kept.encode()).hexdigest() == got[c].repaired_sha256


def test_long_conversation_crosses_checkpoints_and_batches(spark):
    rng = random.Random(2)
    rows = [(t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["same.", f"n{t}.", f"n{t}", ""])) for t in range(6000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 700)
    try:
        got = CR.summary(spark.createDataFrame([(1, *r, "", 0) for r in rows] + [(2, 0, "user", "a.", "", 0)], SCHEMA)).where("conv_id = 1").first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    faults = faults_of(rows)
    letters = [(r[1][:1], f) for r, f in zip(rows, faults)]
    whole, _ = CR.walk(letters, CR.START, CR.END, CR.Costs(), True)  # one block of all rows
    assert got.audit == "".join(e[0] for e in whole) and got.n_rows == 6000
    assert (got.blank, got.duplicate, got.truncated) == tuple(faults.count(k) for k in (1, 2, 3))


def test_checkpoints_are_square_root(spark):
    df = spark.createDataFrame([(1, t, "user", f"{t}.", "", 0) for t in range(5000)], SCHEMA)
    rows = CR._checkpointed(CR._faulted(df, "conv_id", "turn", "role", "text", None)).select("turn", "ahead").collect()
    at = sorted(5000 - r.turn for r in rows if r.ahead is not None)
    assert at == [k * (k + 1) // 2 for k in range(1, len(at) + 1)] and len(at) < (2 * 5000) ** 0.5


def test_copies_nulls_and_empty(spark):
    rows = [(1, 0, "user", "a.", "", 0), (1, 1, "assistant", "b.", "", 2), (2, 5, "user", "a.", "", 0), (3, None, None, None, "", 1)]
    got = {r.conv_id: r for r in CR.summary(spark.createDataFrame(rows, SCHEMA), copies_col="nth").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert [got[2][k] for k in COLUMNS] == [0, 0, 0, 0, 0, 0, "", empty] and got[2].n_rows == 0
    assert (got[1].duplicate, got[1].cost, got[1].audit) == (1, 4, "DD")
    assert (got[3].blank, got[3].audit, got[3].cost) == (1, "D", 2)
    assert CR.summary(spark.createDataFrame([], SCHEMA)).count() == 0 and CR.edits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_exchange(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.", "", 0)], SCHEMA)
    plan = CR.summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_search(spark, sf):
    from propensity.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    got = {r.conv_id: r for r in QUERIES["op12_conversation_repair"](spark, d).collect()}
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{d}/conversations.parquet").collect():
        own, role, text = convs[r.conv_id], " " if r.role is None else r.role, " " if r.text is None else r.text
        k = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        own += [(r.turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    assert set(got) == set(convs)
    for c, rows in convs.items():
        assert tuple(got[c][k] for k in COLUMNS) == digest(ordered(rows)), c
