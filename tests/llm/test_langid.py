import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propensity.llm import langid as L
from propensity.llm.tables import fold_of

SCHEMA = "doc_id bigint, text string, lang string, key int, letters string"
SYLLABLES = {"aa": ["the", "ing", "tion", "er", "and"], "bb": ["über", "sch", "ung", "keit", "der"], "cc": ["ción", "mente", "os", "ña", "el"]}


def say(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.choice([1, 2, 3]))).capitalize() for _ in range(n))


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(1)
    rows = [(i, say(rng, lang := rng.choice(sorted(SYLLABLES)), rng.choice([1, 5, 50])), lang, 1, "c") for i in range(600)]
    rows += [(1000 + i, "the and", None, 1, "c") for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    return rows, docs, L.train(docs, usable=fold_of(F.col("doc_id"), 3) != 1)


def test_held_out_accuracy(spark, fitted):
    rows, docs, model = fitted
    assert model.names == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in L.predict(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    known = [(got[i].lang_pred, lang) for i, _, lang, *_ in rows if lang]
    assert sum(a == b for a, b in known) / len(known) > 0.97


def test_mixtures_find_their_languages(spark, fitted):
    _, _, model = fitted
    rng = random.Random(2)
    rows = [(1, say(rng, "aa", 60) + " " + say(rng, "bb", 30), None, 0, ""), (2, say(rng, "cc", 90), None, 0, "")]
    got = {r.doc_id: r for r in L.predict(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert (got[1].lang_pred, got[1].n_langs) == ("aa", 2) and abs(got[1].score - 2 / 3) < 0.1
    assert (got[2].lang_pred, got[2].n_langs) == ("cc", 1) and got[2].score == 1.0


def test_undecided_and_edge_rows(spark, fitted):
    _, _, model = fitted
    rows = [(1, None, "aa", 0, ""), (2, "", "aa", 0, ""), (3, "12 — 34 !", "aa", 0, ""), (None, "über keit", None, 0, ""),
            (5, "ción mente " * 20000, None, 0, ""), (5, "ción mente " * 20000, None, 0, "")]
    got = L.predict(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert [r.lang_pred for r in got] == ["und"] * 3 + ["bb", "cc", "cc"] and [r.score for r in got[:3]] == [0.0] * 3
    assert L.predict(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b", None, 0, "")], SCHEMA)
    model = L.train(docs)
    assert [(r.lang_pred, r.score) for r in L.predict(docs, model).collect()] == [("und", 0.0)]


def test_texts_of_four_languages(spark):
    rng = random.Random(4)
    more = SYLLABLES | {"dd": ["ajka", "owski", "czy", "nie"], "ee": ["välj", "ägg", "kött", "sjö"]}
    tell = lambda lang, n: " ".join("".join(rng.choices(more[lang], k=rng.choice([1, 2, 3]))) for _ in range(n))
    docs = spark.createDataFrame([(i, tell(lang := sorted(more)[i % 5], 50), lang, 1, "c") for i in range(300)], SCHEMA)
    model = L.train(docs)
    rows = [(1, " ".join(tell(x, n) for x, n in (("aa", 60), ("bb", 40), ("cc", 40), ("dd", 40))), None, 0, ""),
            (2, " ".join(tell(x, 50) for x in sorted(more)) + " " + tell("ee", 50), None, 0, ""), (3, tell("cc", 80), None, 0, "")]
    got = {r.doc_id: r for r in L.predict(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert [got[i].n_langs for i in (1, 2, 3)] == [4, 5, 1] and [got[i].lang_pred for i in (1, 2, 3)] == ["aa", "ee", "cc"]
    assert abs(got[1].score - 1 / 3) < 0.05 and abs(got[2].score - 1 / 3) < 0.05
    # stopping early changes nothing: each text's set is the best of all sizes
    _, data, offsets = next(iter(L.text_blocks(pa.array([r[1] for r in rows]))))
    lang, share, size = L.infer(model, data, offsets, None, 8, 0.5)
    never = np.full(len(rows), np.inf)
    full = L.most_likelihood
    try:
        L.most_likelihood = lambda *_: never
        assert [x.tolist() for x in L.infer(model, data, offsets, None, 8, 0.5)] == [lang.tolist(), share.tolist(), size.tolist()]
    finally:
        L.most_likelihood = full
