import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from propensity.llm import mixing as M

SCHEMA = "doc_id bigint, text string, source string, n_chars bigint, row string, offset int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = (total - sum(out.values())) / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > 3 * sizes[s]]
        if not over:
            return {**out, **{s: level * w[s] for s in open_}}
        for s in over:
            out[s] = 3.0 * sizes[s]
            open_.discard(s)
    return out


def make(spark, seed, n=400, n_sources=9):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(n_sources)] + [None, "é", ""]
    rows = []
    for i in range(n):
        s = "s0" if rng.random() < 0.4 else rng.choice(names)
        k = rng.choice([0, 1, 2, 20, 20, 300])
        rows.append((i, "".join(rng.choice(["a", "bc", "é漢"]) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(k)), s, 1, "c", 3))
    rows += [(9000, None, "s1", None, None, None), (None, "no id", "s1", None, None, None), rows[3], rows[3]]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken(spark, seed):
    rows, docs = make(spark, seed)
    size = collections.Counter()
    for r in rows:
        size[r[2]] += len(WORD.findall(r[1] or ""))
    want = brute_targets(dict(size))
    got = M.plan(docs, bucket_rows=16).collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r[0]].append(len(WORD.findall(r[1] or "")))
    for r in got:
        assert r.size in by_id[r.id] and r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) < 1.001
    again = M.plan(docs.repartition(7), bucket_rows=16).collect()
    key = lambda x: str((x.id, x.size, x.offset, x.taken))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_inverse_of_the_schedule(spark):
    for a in (0.0, 0.5, 1.0, 1.5, 2.0):
        got = spark.range(0, 101).select((F.col("id") / 100).alias("t")).select(
            "t", M.inverse(M.cumulative(F.col("t"), F.lit(a)), F.lit(a)).alias("u")).collect()
        assert all(abs(r.t - r.u) < 1e-6 for r in got)


def test_mixed_rows_follow_the_plan(spark):
    rows, docs = make(spark, 5)
    out = M.mixed(docs, bucket_rows=16, partitions=4)
    assert out.columns == docs.columns
    got = out.collect()
    words = collections.Counter()
    for r in got:
        words[r.source] += len(WORD.findall(r.text))
    plan = M.plan(docs, bucket_rows=16).collect()
    taken = collections.Counter()
    for r in plan:
        taken[r.source] += r.taken
    assert words == +taken
    texts = {r[1] for r in rows}
    cut = [r for r in got if r.text not in texts]
    assert len(cut) <= len(taken)  # one cut document a source at most
    for r in cut:
        assert any(t and t.startswith(r.text) for t in texts) and r.n_chars == len(r.text)


def test_positions_follow_demand(spark):
    _, docs = make(spark, 6, n=2000, n_sources=3)
    rows = M.positions(M.plan(docs)).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for s, rs in by.items():
        quota, a = rs[0].quota, rs[0].density
        for t in (0.25, 0.5, 0.75):
            done = sum(r.words for r in rs if r.position < t)
            assert abs(done - quota * (a * t + (1 - a) * t * t)) <= 301, s


def test_order_is_by_position(spark):
    _, docs = make(spark, 7)
    ids = [r.doc_id for r in M.mixed(docs, partitions=5).collect()]
    want = [r.id for r in M.positions(M.plan(docs)).orderBy("position", "id", "copy").collect()]
    assert ids == want


def test_query_deals_the_copies(spark, monkeypatch):
    """op2's result comes from copies dealt along the curriculum, and is in the order of their first positions."""
    from propensity.llm import queries as Q
    seen, write = {}, Q.written

    def spy(df, name):
        seen[name] = write(df, name)
        return seen[name]
    monkeypatch.setattr(Q, "written", spy)
    sf = "/root/testdata/sf0.001"
    got = Q.op2_mixing(spark, sf).collect()
    copies = seen["dealt"].select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).collect()
    first, taken, files = {}, collections.Counter(), collections.defaultdict(list)
    for r in copies:
        u = (r.copy * r.source_size + r.offset) / r.quota
        assert r.density * r.position + (1 - r.density) * r.position ** 2 == pytest.approx(u, abs=1e-6)
        first[r.id] = min(first.get(r.id, 2.0), r.position)
        taken[r.id] += r.words
        files[r.file].append((r.at, r.position))
    parts = [[p for _, p in sorted(files[f])] for f in sorted(files)]
    assert sum(parts, []) == sorted(sum(parts, []))
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count() and {r.doc_id: r.taken for r in got if r.taken} == dict(taken)
    order = [first.get(r.doc_id, 2.0) for r in got]
    assert all(r.first_position == pytest.approx(first.get(r.doc_id), abs=1e-9) for r in got)
    assert order == sorted(order) and len(set(order)) > 10


def test_texts_without_an_id_are_spread(spark):
    """A third of all rows without an id, and a third under one id, fall into buckets like any others."""
    docs = spark.createDataFrame([(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * (i % 5), "a", 1, "", 0)
                                  for i in range(900)] + [(None, None, "a", 1, "", 0)] * 2, SCHEMA)
    hashes = docs.select("doc_id", M.layout_hash(F.col("doc_id"), F.col("text"), 17).alias("h"))
    top = hashes.groupBy(F.substring("h", 1, 1).alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(top) == 16 and max(r.n for r in top) < 250
    plan = M.plan(docs, bucket_rows=16).collect()
    assert len(plan) == 902 and sum(r.taken for r in plan) == plan[0].quota


def test_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000, "a", 1, "", 0), (2, "b c", "b", 1, "", 0)], SCHEMA)
    got = {r.id: r for r in M.plan(docs).collect()}
    assert got[1].size == 300_000 and got[1].taken == 300_002 - 6 and got[2].taken == 6
    assert sorted(len(r.text.split()) for r in M.mixed(docs).collect() if r.doc_id == 1) == [299_996]


def test_empty_and_wordless(spark):
    assert M.plan(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, "a", 0, "", 0), (2, " ", None, 0, "", 0)], SCHEMA)
    assert [(r.size, r.taken) for r in M.plan(none).collect()] == [(0, 0), (0, 0)]
    assert M.mixed(none).count() == 0
