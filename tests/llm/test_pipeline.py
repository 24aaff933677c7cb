import collections

import corpus_pipeline as C
from propensity.llm import mixing, simhash, toxicity
from propensity.llm.tables import table, written
from .test_packing import ENC, unpack
from .test_simhash import brute_components
from .test_winnowing import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    after = {}
    for name, stage in C.STAGES:
        if name != "packing":
            docs = written(stage(spark, docs, SF), name)
            assert docs.columns == C.COLUMNS
            after[name] = docs
    start = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    ids = {n: [r.doc_id for r in d.collect()] for n, d in after.items()}
    model = toxicity.train(table(spark, SF, "documents"), table(spark, SF, "labels"), usable=C.fold_of(C.F.col("doc_id"), 5) != 0)
    want = {r.doc_id for r in toxicity.score(table(spark, SF, "documents"), model).where("score < 0.5").collect()}
    assert set(ids["toxicity"]) == want and len(ids["toxicity"]) == len(want)
    rows = [(i, start[i]) for i in sorted(want)]
    want = {c for _, _, c in brute_components(rows)}
    assert sorted(ids["near_dedup"]) == sorted(want)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = [d for d, _, hit, _ in brute([(i, start[i]) for i in ids["near_dedup"]], items) if not hit]
    assert sorted(ids["decontamination"]) == sorted(want)
    taken = {r.id: r.taken for r in mixing.plan(after["decontamination"]).collect()}
    words = collections.Counter()
    for r in after["mixing"].collect():
        words[r.doc_id] += len((r.text or "").encode().split())
        assert start[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert words == collections.Counter({k: v for k, v in taken.items() if v})
    packed = unpack(C.STAGES[-1][1](spark, after["mixing"], SF).collect(), 2048)
    tokens = collections.Counter()
    for r in after["mixing"].collect():
        tokens[r.doc_id] += len(ENC.encode_ordinary(r.text))
    assert {k: sum(len(x) for _, x in v) for k, v in packed.items()} == {k: v for k, v in tokens.items() if v}


def test_run_is_the_registered_query(spark):
    import __spark_entry__
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert sum(r.n_tokens for r in out.select("n_tokens").collect()) > 0 and simhash is not None
