import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from propensity.llm import simhash as SH

SCHEMA = "doc_id bigint, text string, lang string, fp string, component int"


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fp = [brute_fp(t) for _, t in rows]
    at = list(range(len(rows)))

    def top(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                at[top(i)] = top(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [r[0] for k, r in enumerate(rows) if top(k) == top(i) and r[0] is not None]
        out.append((d, fp[i], min(ids) if ids else None))
    return out


def make_rows(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Été", "ÉTÉ", "漢字"]
    rows, texts = [], []
    for i in range(n):
        if texts and rng.random() < 0.5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            t = " ".join(w)
        else:
            t = " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 30, 200])))
        texts.append(t)
        rows.append((i, t))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (None, texts[0]), (None, "a b"), (5, texts[5]), (5, "other text here"),
             (1003, "A  B\x0bC\fD"), (1004, "a b c d"), (1005, "long " * 5000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = make_rows(seed)
    docs = spark.createDataFrame([(i, t, "x", "clash", 7) for i, t in rows], SCHEMA).repartition(5)
    got = [(r.id, r.fp & (2**64 - 1), r.component) for r in SH.near_duplicates(docs).select("id", "fp", "component").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_long_chains_and_near_copies_in_one_cell():
    rng = np.random.default_rng(0)
    base = np.uint64(0x0123456789ABCDEF)
    flips = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)))
    a, b = SH.cell_links(flips, 4)
    assert len(a) == len(flips) - 1  # one tree, not all pairs


def test_faces_cover_every_pair_within_the_bound():
    rng = random.Random(3)
    masks = SH.face_masks(4)
    assert len(masks) == 70
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randrange(0, 5)):
            y ^= 1 << b
        ex, ey = (int(SH.embed(np.asarray([v], np.uint64))[0]) for v in (x, y))
        assert (ex ^ ey).bit_count() <= (x ^ y).bit_count()
        assert any(ex & m == ey & m for m in masks)


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in SH.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}}


def test_empty_table(spark):
    assert SH.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert SH.keep_one(spark.createDataFrame([], SCHEMA)).columns == ["doc_id", "text", "lang", "fp", "component"]


def test_keep_one_keeps_one_row_of_each_group(spark):
    rows = make_rows(4)
    docs = spark.createDataFrame([(i, t, "x", "clash", 7) for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in SH.keep_one(docs).collect()]
    brute = brute_components(rows)
    groups = {}
    for (i, t), (_, fp, c) in zip(rows, brute, strict=True):
        groups.setdefault((fp if c is None else None, c), set()).add((i, t))
    distinct_groups = len({g for g in groups})
    assert len(kept) >= distinct_groups - 1 and len(set(kept)) == len(kept)
    for i, _ in kept:
        assert any(c == i for d, _, c in brute if d == i)


def test_query_on_small_table(spark):
    from propensity.llm.queries import QUERIES
    out = QUERIES["op10_simhash"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {d: (f"{f:016x}", c) for d, f, c in brute_components([(r.doc_id, r.text) for r in texts])}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out.collect()} == want
    assert out.where(F.col("component_id") > F.col("doc_id")).count() == 0
