import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propensity.llm import quality as Q
from propensity.llm.ragged import text_blocks
from propensity.llm.tables import fold_of

DOCS = "doc_id bigint, text string, score double, y int, shard string"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(seed, n=900):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "ré") for b in ("ra", "se", "ni", "po", "x", "yn")]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.choice([6, 40, 200]))
        bad = rng.random() < 0.25
        if bad:
            kind = rng.randrange(3)
            w = [x + "###" for x in w] if kind == 0 else [w[0]] * len(w) if kind == 1 else [x.upper() for x in w]
        docs.append((i, " ".join(w), 0.0, 1, "c"))
        labels.append((i, int(not bad), 0))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(1)
    d = spark.createDataFrame(docs, DOCS)
    return labels, d, Q.train(d, spark.createDataFrame(labels, LABELS), usable=fold_of(F.col("doc_id"), 5) != 0, bits=14)


def test_held_out_accuracy(spark, fitted):
    labels, d, w = fitted
    got = {r.doc_id: (r.score, r.held) for r in Q.score(d, w).withColumn("held", fold_of(F.col("doc_id"), 5) == 0).collect()}
    assert len(got) == len(labels) and all(0 <= s <= 1 for s, _ in got.values())
    held = [(got[i][0], q) for i, q, _ in labels if got[i][1]]
    assert len(held) > 100 and sum((s >= 0.3) == bool(q) for s, q in held) / len(held) > 0.97


def test_score_is_the_sparse_dot_product(fitted):
    _, _, w = fitted
    texts = ["kara lose ### kara kara", "", None, "A BC dé", "x" * 3000]
    _, data, off = next(iter(text_blocks(pa.array(texts))))
    first, idx, val = Q.features(data, off, 14)
    for i in range(len(texts)):
        own = val[first[i]:first[i + 1]]
        assert len(own) == 0 or abs(float((own.astype(float) ** 2).sum()) - 1) < 1e-5
        alone = next(iter(text_blocks(pa.array([texts[i]]))))
        assert idx[first[i]:first[i + 1]].tolist() == Q.features(alone[1], alone[2], 14)[1].tolist()  # blocks don't leak


def test_ftrl_matches_a_plain_loop():
    rng = np.random.default_rng(0)
    rows = [(np.array([0, k + 1]), np.array([1.0, 0.5]), int(rng.random() < 0.5)) for k in rng.integers(0, 3, 50)]
    z, n = np.zeros(4), np.zeros(4)
    Q.ftrl_pass(rows, z, n, 0.5, 1.0, 0.05, 0.1)
    z2, n2 = [0.0] * 4, [0.0] * 4

    def weight(i):
        return 0.0 if abs(z2[i]) <= 0.05 else -(z2[i] - np.sign(z2[i]) * 0.05) / ((1 + n2[i] ** 0.5) / 0.5 + 0.1)
    for idx, val, y in rows:
        w = {i: weight(i) for i in idx}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(idx, val, strict=True))))
        for i, v in zip(idx, val, strict=True):
            g = (p - y) * v
            z2[i] += g - ((n2[i] + g * g) ** 0.5 - n2[i] ** 0.5) / 0.5 * w[i]
            n2[i] += g * g
    assert np.allclose(z, z2) and np.allclose(n, n2)


def test_edge_rows(spark, fitted):
    _, _, w = fitted
    rows = [(1, None, 0.0, 0, ""), (2, "", 0.0, 0, ""), (None, "kara lose", 0.0, 0, ""), (4, "kara### " * 20000, 0.0, 0, ""), (4, "kara### " * 20000, 0.0, 0, "")]
    s = [r.score for r in Q.score(spark.createDataFrame(rows, DOCS), w).collect()]
    assert s[0] == s[1] and s[3] == s[4] < 0.3 and len(s) == 5
    assert Q.score(spark.createDataFrame([], DOCS), w).count() == 0


def test_labels_missing_or_of_one_class(spark):
    docs = spark.createDataFrame([(1, "a b", 0.0, 0, ""), (2, None, 0.0, 0, "")], DOCS)
    for rows, ok in (([], lambda s: s == 0.5), ([(1, 1, 0), (None, 0, 0), (2, None, 0)], lambda s: s > 0.5), ([(1, 0, 1)], lambda s: s < 0.5)):
        w = Q.train(docs, spark.createDataFrame(rows, LABELS), bits=8)
        assert ok(Q.score(docs, w).where("doc_id = 1").first().score)


def test_sample_is_bounded_by_rows_not_ids(spark, monkeypatch):
    """Three labelled ids with thousands of texts each, every row twice."""
    rows = [(i % 3, f"word{i % 7} number{i} " * 3, 0.0, 1, "c") for i in range(6000)]
    d = spark.createDataFrame(rows + rows, DOCS)
    sizes = {}
    keep = Q.written

    def counted(df, name):
        out = keep(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(Q, "written", counted)
    Q.train(d, spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0)], LABELS), max_rows=300, bits=10, rounds=1)
    assert 200 < sizes["labelled-features"] < 400


def test_scores_are_the_logistic_of_plain_sums(spark, fitted):
    _, d, w = fitted
    bits = (len(w) - 1).bit_length() - 1
    for r in d.join(Q.score(d, w).withColumnRenamed("doc_id", "s_id").withColumnRenamed("score", "got"),
                    F.col("doc_id") == F.col("s_id")).where("doc_id < 40").select("text", "got").collect():
        _, data, offsets = next(iter(text_blocks(pa.array([r.text]))))
        first, idx, val = Q.features(data, offsets, bits)
        z = float(w[-1])
        for i, v in zip(idx[:first[1]].tolist(), val[:first[1]].tolist(), strict=True):
            z += float(w[i]) * v
        assert r.got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)
