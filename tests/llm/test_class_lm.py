import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.llm import class_lm as LM
from propensity.llm.tables import fold_of

SCHEMA = "doc_id bigint, text string, key int, n string, row int"


def tokens(t):
    return (t or "").encode().lower().split() + [None]


def corpus(seed=1, n=300):
    """Two kinds of texts whose words follow their own kind: classes help."""
    rng = random.Random(seed)
    kinds = [[f"{p}{i}" for i in range(40)] for p in ("ab", "zü")]
    rows = []
    for i in range(n):
        w = rng.choice(kinds)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(rng.choice(w) if rng.random() < 0.9 else f"rare{rng.randrange(3000)}" for _ in range(rng.choice([1, 8, 40]))), 1, "c", 2))
    return rows + [(9000, None, 1, "c", 2), (9001, "", 1, "c", 2), (9002, "Unknown words only", 1, "c", 2), (9003, "ab1 " * 8000, 1, "c", 2)]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = LM.train(docs, usable=fold_of(F.col("doc_id"), 7) != 2, classes=8, head=200, shapes=32, wide=400, sweeps=6)
    return rows, docs, model


def test_counts_and_scores_against_brute_force(spark, fitted):
    rows, docs, model = fitted
    train = [t for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    assert (model.n_tokens, model.n_types) == (n, v)
    # class of every word, from the model's own tables
    import pyarrow as pa

    def cls(w):
        if w is None:
            return 0
        _, data, off = next(iter(LM.text_blocks(pa.array([w.decode()]))))
        key, shape, _ = LM.words(data, off, model.shapes)
        return int(model.class_of_unit[LM._units(key, shape, LM.KeyTable(model.head_keys), len(model.head_keys))[0]])
    memo = {w: cls(w) for t in [*train, *(r[1] for r in rows)] for w in tokens(t)}
    pairs, emit, types = collections.Counter(), collections.Counter(), collections.Counter()
    for t in train:
        seq = [0] + [memo[w] for w in tokens(t)]
        pairs.update(zip(seq, seq[1:], strict=False))
    for w, k in c.items():
        emit[memo[w]] += k
        types[memo[w]] += 1
    into, out = collections.Counter(), collections.Counter()
    for (a, b), k in pairs.items():
        into[b] += k
        out[a] += k
    total = sum(pairs.values())
    got = {r.id: r for r in LM.score(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        ts = tokens(t)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts)
        s, before = 0.0, 0
        for w in ts:
            k = memo[w]
            s += math.log10((pairs[before, k] + 8 * (into[k] + 1) / (total + 8)) / (out[before] + 8))
            if w is not None:
                s += math.log10((c[w] + 0.5) / (emit[k] + 0.5 * (types[k] + 1)))
            before = k
        r = got[i]
        assert (r.n_tokens, r.n_known) == (len(ts), sum(c[w] > 0 for w in ts))
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(s, abs=1e-6), i


def test_exchange_raises_likelihood_and_helps_held_out_texts(spark, fitted):
    rows, docs, model = fitted
    assert all(b > a for a, b in zip(model.history, model.history[1:], strict=False)) and len(model.history) > 2
    held = [r for r in LM.score(docs, model).collect() if zlib.crc32(str(r.id).encode()) % 7 == 2]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_best_class_is_the_best_of_all_moves():
    rng = np.random.default_rng(0)
    n_units, k = 9, 4
    grid = rng.integers(0, 20, (n_units, n_units)).astype(float)
    own = np.array([0, 1, 2, 3, 1, 2, 3, 1, 2])

    def pairs(c):
        out = np.zeros((k, k))
        np.add.at(out, (c[:, None] + 0 * c[None, :], c[None, :] + 0 * c[:, None]), grid)
        return out
    for u in range(1, n_units):
        left, right = np.zeros((1, k)), np.zeros((1, k))
        np.add.at(left[0], own, grid[:, u])
        np.add.at(right[0], own, grid[u])
        got = LM.best_classes(pairs(own), np.array([u]), own[[u]], left, right, grid[[u], [u]])[0]
        value = {c: LM._log_likelihood(pairs(np.where(np.arange(n_units) == u, c, own))) for c in (1, 2, 3)}
        assert value[got] == pytest.approx(max(value.values()))


def test_nothing_to_learn_from_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", 0, "", 0), (None, None, 0, "", 0)], SCHEMA)
    model = LM.train(docs.limit(0), classes=4, shapes=8, sweeps=1)
    got = sorted(((r.n_tokens, r.n_known, r.base_score) for r in LM.score(docs, model).collect()))
    assert got == [(1, 0, 0.0), (3, 0, 0.0)]
    assert LM.score(docs.limit(0), model).count() == 0


def test_long_words_are_told_apart(spark):
    """Words that polynomial keys modulo 2^64 take for one another (Thue-Morse strings)."""
    def pair(n):
        bits = [bin(i).count("1") & 1 for i in range(n)]
        return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    for n in (512, 1024, 2048, 4096):
        seen, other = pair(n)
        docs = spark.createDataFrame([(1, seen, 0, "", 0), (2, other, 1, "", 0)], SCHEMA)
        model = LM.train(docs, usable=F.col("doc_id") == 1, classes=4, shapes=8, sweeps=1)
        got = {r.id: (r.n_tokens, r.n_known) for r in LM.score(docs, model).collect()}
        assert got == {1: (2, 2), 2: (2, 1)}, n


def test_clustered_words_follow_the_corpus(spark):
    """Every word seen min_count times has a unit of its own, however small its share."""
    rows = [(i, " ".join(f"w{j}" for j in range(j0, j0 + 50)) + " rare" + str(i), 0, "", 0) for i in range(200) for j0 in (50 * (i % 10),)]
    model = LM.train(spark.createDataFrame(rows, SCHEMA), classes=4, shapes=8, sweeps=1)
    assert len(model.head_keys) == 500 and model.n_types == 701
    assert len(LM.train(spark.createDataFrame(rows, SCHEMA), classes=4, shapes=8, sweeps=1, min_count=21).head_keys) == 0


def test_neighbour_lists_and_their_class_sums(spark, monkeypatch):
    """What the sweeps read instead of joining all bigrams anew: one row a unit, however
    many Arrow batches its neighbours come in, summed piece by piece."""
    rng, k = np.random.default_rng(3), 5
    pairs = {(0, v): 1 + v % 3 for v in range(1, 400)} | {(int(u), int(v)): int(n) for u, v, n in rng.integers(1, 400, (900, 3))} | {(7, 7): 4}
    own = np.concatenate([[0], rng.integers(1, k, 400)])
    bigrams = spark.createDataFrame([(u, v, n) for (u, v), n in pairs.items()], "u int, v int, n bigint").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        near = LM._neighbours(bigrams).persist()
        rows = near.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == len({r.unit for r in rows}) == len({x for p in pairs for x in p})
    assert {(r.unit, v): n for r in rows for v, n in zip(r.after, r.after_n, strict=True)} == pairs
    assert {(u, r.unit): n for r in rows for u, n in zip(r.before, r.before_n, strict=True)} == pairs
    want = np.zeros((k, k))
    for (u, v), n in pairs.items():
        want[own[u], own[v]] += n
    assert (LM._class_pairs(near, own, k) == want).all()
    monkeypatch.setattr(LM, "ENTRIES", 7)
    batch = near.where("unit > 0").toArrow().combine_chunks().to_batches()[0]
    bc = lambda x: type("Shared", (), {"value": x})
    moved = [b.to_pydict() for b in LM._chooser(bc(own), bc(want), k)([batch])]
    assert len(moved) > 100 and sum(len(m["unit"]) for m in moved) == len(rows) - 1
    left, right, alone = np.zeros((401, k)), np.zeros((401, k)), np.zeros(401)
    for (u, v), n in pairs.items():
        left[v, own[u]] += n
        right[u, own[v]] += n
        alone[u] += n * (u == v)
    for m in moved:
        at = np.array(m["unit"])
        assert m["cls"] == LM.best_classes(want, at, own[at], left[at], right[at], alone[at]).tolist()
    near.unpersist()


def test_sweeps_neither_join_nor_exchange_bigrams(spark, monkeypatch):
    """Bigrams are exchanged twice (counted, dealt by unit) however many sweeps follow."""
    seen = []
    honest = LM._neighbours
    monkeypatch.setattr(LM, "_neighbours", lambda b: seen.append(1) or honest(b))
    monkeypatch.setattr(type(spark.range(1)), "join", lambda *a, **k: pytest.fail("a sweep joins"))
    bigrams = spark.createDataFrame([(0, 1, 5), (1, 2, 5), (2, 3, 4), (3, 0, 5), (1, 3, 1)], "u int, v int, n bigint")
    own, pairs, history = LM.exchange(bigrams, 4, 3, 4)
    assert seen == [1] and pairs.sum() == 20 and own[0] == 0 and history == sorted(history)
