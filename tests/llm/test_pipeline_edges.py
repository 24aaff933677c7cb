"""Every stage on null and empty texts, repeated rows, an empty table and extra columns with clashing names."""

import pytest

import corpus_pipeline as C
from propensity.llm.tables import table, written

SF = "/root/testdata/sf0.001"
CLASH = ["id", "words", "position", "__position", "row", "h", "bucket", "key", "score", "n", "t_source", "copy"]


def stages(spark, docs):
    """What each stage leaves of ``docs``, by name."""
    out = {}
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out[name] = docs
    return out


@pytest.fixture(scope="module")
def plain(spark):
    return table(spark, SF, "documents").select(*C.COLUMNS)


def test_nulls_repeats_and_clashing_columns(spark, plain):
    rows = plain.orderBy("doc_id").limit(12).collect()
    extra = [(None, None, None, None, None), (90001, None, None, "s", None), (90002, "", "en", None, 0), (90003, " \t\n", None, "s", 3),
             tuple(rows[0]), tuple(rows[0]), (None, rows[1].text, None, None, None), (90004, "plain words " * 60_000, "en", "s", 720_000)]
    docs = plain.unionByName(spark.createDataFrame(extra, plain.schema))
    for c in CLASH:
        docs = docs.selectExpr("*", f"'x' AS `{c}`")
    after = stages(spark, docs)
    for name, _ in C.STAGES[:-1]:
        assert after[name].columns == C.COLUMNS, name
    ids = {n: [r.doc_id for r in after[n].select("doc_id").collect()] for n, _ in C.STAGES[:-1]}
    # texts without words are not toxic, and stay as one document up to the mix, which has nothing to take of them
    assert {90001, 90002, 90003} <= set(ids["toxicity"])
    assert sum(1 for r in after["near_dedup"].collect() if not (r.text or "").split()) == 1
    assert sum(1 for r in after["decontamination"].collect() if not (r.text or "").split()) == 1
    assert all((r.text or "").split() for r in after["mixing"].collect())
    # repeated rows, and the same text without an id, are one document
    assert ids["near_dedup"].count(rows[0].doc_id) <= 1
    texts = [r.text for r in after["near_dedup"].collect()]
    assert texts.count(rows[0].text) <= 1 and texts.count(rows[1].text) <= 1
    assert 90004 in ids["decontamination"] and 90004 in ids["mixing"]
    assert after["packing"].count() > 0


def test_empty_table(spark, plain):
    after = stages(spark, plain.where("false"))
    assert [d.count() for d in after.values()] == [0] * 5
    assert all(after[n].columns == C.COLUMNS for n, _ in C.STAGES[:-1])


def test_only_wordless_documents(spark, plain):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "s", 0), (2, "", None, "s", 0)], plain.schema)
    after = stages(spark, docs)
    assert [after[n].count() for n, _ in C.STAGES] == [3, 1, 1, 0, 0]
