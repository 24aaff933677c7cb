import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.llm import toxicity as X
from propensity.llm.tables import fold_of

DOCS = "doc_id bigint, text string, y int, mean double, score string, best int"
LABELS = "doc_id bigint, toxic int, quality int"


def corpus(seed, n=1200):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "se", "ni", "po") for c in ("x", "yn", "t", "dor")]
    rude = ["grunk", "vlorp", "snazzer", "Grunk"]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.choice([5, 40, 200]))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(1 + len(w) // 40):
                w.insert(rng.randrange(len(w) + 1), rng.choice(rude))
        docs.append((i, " ".join(w), 1, 0.0, "c", 2))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(toxic), 1))
    return docs, labels, rude


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels, rude = corpus(1)
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    return docs, labels, rude, d, lab, X.train(d, lab, usable=fold_of(F.col("doc_id"), 5) != 0)


def test_held_out_accuracy(spark, trained):
    docs, labels, rude, d, lab, model = trained
    truth = {i: any(r.lower() in t.lower().split() for r in rude) for i, t, *_ in docs}
    got = {r.doc_id: r.score for r in X.score(d, model).collect()}
    assert len(got) == len(docs) and all(0 <= s <= 1 for s in got.values())
    held = [i for i in got if i % 2 and i % 5]
    assert sum((got[i] >= 0.5) == truth[i] for i in held) / len(held) > 0.97


def test_filter_agrees_with_score(spark, trained):
    _, _, _, d, _, model = trained
    kept = X.ordinary(d, model)
    assert kept.schema == d.schema
    want = {r.doc_id for r in X.score(d, model).where("score < 0.5").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_edge_rows(spark, trained):
    *_, model = trained
    rows = [(1, None, 0, 0.0, "", 0), (2, "", 0, 0.0, "", 0), (3, " ,; ", 0, 0.0, "", 0), (None, "grunk", 0, 0.0, "", 0),
            (4, "kara grunk " * 20000, 0, 0.0, "", 0), (4, "kara grunk " * 20000, 0, 0.0, "", 0)]
    got = X.score(spark.createDataFrame(rows, DOCS), model).collect()
    assert len(got) == 6
    s = [r.score for r in got]
    assert s[0] == s[1] == s[2] < 0.5 and s[3] > 0.5 and s[4] == s[5] > 0.5
    assert X.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_labels_missing_or_of_one_class(spark):
    docs = spark.createDataFrame([(1, "a b", 0, 0.0, "", 0), (2, None, 0, 0.0, "", 0)], DOCS)
    for rows, want in (([], 0.0), ([(1, 1, 0), (None, 0, 0), (2, None, 0)], 1.0), ([(1, 0, 1)], 0.0)):
        m = X.train(docs, spark.createDataFrame(rows, LABELS))
        assert [r.score for r in X.score(docs, m).collect()] == [want, want]


def test_repeated_and_conflicting_labels(spark):
    docs, labels, _ = corpus(2, 600)
    d = spark.createDataFrame(docs, DOCS)
    a = X.train(d, spark.createDataFrame(labels, LABELS))
    b = X.train(d, spark.createDataFrame(labels + labels[:50], LABELS))
    assert a.curve == pytest.approx(b.curve, rel=1e-6)


def test_bigrams_of_few_texts_have_counts_of_their_own(spark):
    """Two ordinary words that only five toxic texts hold side by side."""
    docs, labels, _ = corpus(3, 800)
    docs += [
        (2000 + i, f"lorax v{i} stone river w{i}a w{i}b", 1, 0.0, "c", 2) for i in range(5)] + [
        (3000 + 2 * i + j, f"{w} w{i}c w{i}d", 1, 0.0, "c", 2) for i in range(40) for j, w in enumerate(("stone", "river"))]
    labels = labels + [(2000 + i, 1, 1) for i in range(5)] + [(3000 + i, 0, 1) for i in range(80)]
    d = spark.createDataFrame(docs, DOCS)
    m = X.train(d, spark.createDataFrame(labels, LABELS))

    def parts(text):
        data = np.frombuffer(text.encode(), np.uint8)
        word, prefix, before, pair, _ = X.text_keys(data, np.array([0, len(data)]))
        return word, prefix, before, pair
    with_pair = m.word_ratios(*parts("stone river"))[1]
    assert X.KeyTable(m.pair_keys).rows(parts("stone river")[3])[1] >= 0
    word, prefix, before, pair = parts("stone river")
    assert with_pair > m.word_ratios(word, prefix, before, ~pair)[1] + 0.5


def test_discounts_are_estimated_from_counts_of_counts():
    counts = np.array([0.0] * 5 + [1.0] * 50 + [2.0] * 20 + [3.0] * 10 + [4.0] * 5 + [9.0] * 3)
    common = 50 / (50 + 2 * 20)
    want = {0: 0.0, 1: 1 - 2 * common * 20 / 50, 2: 2 - 3 * common * 10 / 20, 3: 3 - 4 * common * 5 / 10}
    for strength in (0.0, 0.5, 1.0):
        got = X._discount(counts, strength)
        for n, d in zip(counts, got, strict=True):
            k = min(int(n), 3)
            assert d == pytest.approx(want[k] + strength * (X.MOST[k] - want[k]))
    for few in ([], [7.0], [1.0], [2.0, 2.0], [1.0, 3.0]):
        d = X._discount(np.array(few), 0.0)
        assert (d >= 0).all() and (d <= np.array(few)).all()


def test_the_strength_of_least_loss_is_taken(spark, monkeypatch):
    docs, labels, _ = corpus(4, 400)
    docs = [(r[0], f"{r[1]} once{r[0]} said{r[0] % 90}", *r[2:]) for r in docs]
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    chosen = X.train(d, lab)
    losses = {}
    for strength in X.STRENGTHS:
        monkeypatch.setattr(X, "STRENGTHS", (strength,))
        losses[strength] = X.train(d, lab).loss
    assert chosen.loss == pytest.approx(min(losses.values()), rel=1e-6) and losses[chosen.strength] == pytest.approx(chosen.loss, rel=1e-6)
    assert len(set(losses.values())) > 1


def test_sample_is_bounded_by_characters(spark):
    """Long texts of few ids: rows alone would not bound what is counted."""
    docs, labels, _ = corpus(5, 400)
    d = spark.createDataFrame([(r[0], f"{r[1]} " * 10, *r[2:]) for r in docs], DOCS)
    lab = spark.createDataFrame(labels, LABELS)
    every, some = X.train(d, lab), X.train(d, lab, max_chars=20_000)
    assert 0 < len(some.pair_keys) < len(every.pair_keys) / 2


def test_bigrams_left_to_the_backoff_change_nothing(spark, monkeypatch):
    docs, labels, _ = corpus(4, 300)
    docs = [(r[0], f"{r[1]} once{r[0]} said{r[0] % 90}", *r[2:]) for r in docs]
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    some = X.train(d, lab)
    monkeypatch.setattr(X, "_beyond_discount", lambda counts: counts)
    every = X.train(d, lab)
    assert len(every.pair_keys) > len(some.pair_keys) > 0 and every.curve == pytest.approx(some.curve, rel=1e-3)
    data = np.frombuffer(" ".join(r[1] for r in docs).encode(), np.uint8)
    parts = X.text_keys(data, np.array([0, len(data)]))[:4]
    assert np.allclose(some.word_ratios(*parts), every.word_ratios(*parts), atol=1e-5)


def test_few_labelled_texts_and_labels_without_texts(spark):
    """Labels whose documents are gone, or a handful of texts of which one side holds none of a class."""
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(40)], "doc_id bigint, toxic int")
    none = spark.createDataFrame([(100, "some words"), (101, None)], "doc_id bigint, text string")
    assert [r.score for r in X.score(none, X.train(none, labels)).collect()] == [0.25, 0.25]
    assert X.score(none.where("false"), X.train(none.where("false"), labels)).count() == 0
    for n in (1, 2, 5, 9):
        docs = spark.createDataFrame([(i, f"foul slur{i} words" if i % 4 == 0 else f"plain text{i} here") for i in range(n)],
                                     "doc_id bigint, text string")
        got = {r.doc_id: r.score for r in X.score(docs, X.train(docs, labels)).collect()}
        assert len(got) == n and all(0 <= s <= 1 for s in got.values())
        assert n < 5 or min(got[0], got[4]) > max(got[1], got[2], got[3])
    blank = spark.createDataFrame([(i, " ." * i) for i in range(8)], "doc_id bigint, text string")
    got = [r.score for r in X.score(blank, X.train(blank, labels)).collect()]
    assert len(got) == 8 and all(0 <= s < 0.5 for s in got)
