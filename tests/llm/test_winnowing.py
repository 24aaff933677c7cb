import random
import re
import time

import pytest
from pyspark.sql import functions as F

from propensity.llm import winnowing as W

DOCS = "doc_id bigint, text string, w string, h int, item_id int"
ITEMS = "item_id bigint, text string, doc_id int"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[j:j + 10]), set()).add(i)
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in sizes:
            for j in range(len(w) - m + 1):
                if (k := tuple(w[j:j + m])) in windows:
                    hit |= set(range(j, j + m))
                    found |= windows[k]
        out.append((d, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,short", [(1, False), (2, True), (3, True)])
def test_matches_brute_force(spark, seed, short):
    rng = random.Random(seed)
    vocab = ["a", "b", "the", "É", "é", "x9", "漢", "Word", "WORD"] + [f"v{i}" for i in range(60)]
    seps = [" ", "\n", ", ", " - ", "\t", "\x00"]
    say = lambda n: "".join(rng.choice(vocab) + rng.choice(seps) for _ in range(n))
    items = [(i, say(rng.randrange(1, 10) if short and i % 3 == 0 else rng.randrange(10, 40))) for i in range(25)]
    items += [(100, None), (101, ""), (102, " ,,"), items[1], (103, items[2][1]), (None, say(12)), (104, "a " * 14)]
    docs = []
    for i in range(120):
        t = say(rng.choice([0, 3, 12, 200]))
        for _ in range(rng.randrange(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(0, len(w) + 1)
            t += " " + " ".join(w[a:a + rng.choice([9, 10, 11, 40])]) + " " + say(rng.randrange(0, 20))
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, "a " * 3000), (None, docs[5][1]), docs[7], docs[7], (7, "other text")]
    d = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in docs], DOCS).repartition(4)
    b = spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS)
    got = [(r.id, r.n_words, r.n_hit, tuple(r.item_list)) for r in W.contamination(d, b).collect()]
    want = brute(docs, items)
    assert sorted(got, key=str) == want
    assert len({x[2] for x in want}) > 5
    kept = W.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id is None and -1 or r.doc_id for r in kept.collect()) == sorted(-1 if x[0] is None else x[0] for x in want if not x[2])


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    a = sorted(map(str, W.contamination(docs, items).collect()))
    monkeypatch.setattr(W, "MAX_BROADCAST_ROWS", 0)
    assert sorted(map(str, W.contamination(docs, items).collect())) == a


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", "", 0, 0)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert [(r.n_words, r.n_hit, r.item_list) for r in W.contamination(docs, none).collect()] == [(3, 0, [])]
    assert W.contamination(docs.limit(0), none).count() == 0
    assert W.clean(docs, none).count() == 1


def test_long_text_of_distinct_words_that_is_shared_whole(spark):
    """Every kept hash is wanted; the cost must not grow as the square of the length."""
    took = {}
    for n in (20_000, 80_000):
        text = " ".join(f"w{i}" for i in range(n))
        docs = spark.createDataFrame([(1, text, "", 0, 0), (2, "w0 " + text[-600:], "", 0, 0)], DOCS)
        items = spark.createDataFrame([(7, text, 0)], ITEMS)
        start = time.monotonic()
        out = {r.id: r for r in W.contamination(docs, items).collect()}
        took[n] = time.monotonic() - start
        assert (out[1].n_words, out[1].n_hit, out[1].item_list) == (n, n, ["7"])
        # the tail's first word is cut within
        assert out[2].n_hit == len(words(text[-600:])) - 1 and out[2].item_list == ["7"]
    assert took[80_000] < 8 * took[20_000]


def test_many_wanted_hashes_are_found_by_halving(spark):
    rng = random.Random(4)
    rows = []
    for n in (0, 1, 2, 31, 32, 33, 63, 64, 65, 200):
        wanted = rng.sample(range(-300, 300), n)
        rows.append((wanted, [rng.randrange(-320, 320) for _ in range(300)]))
    df = spark.createDataFrame(rows, "wanted array<bigint>, grams array<bigint>")
    for r in df.select("wanted", "grams", W._positions(F.col("grams"), F.col("wanted")).alias("at")).collect():
        assert r.at == [p for p, g in enumerate(r.grams) if g in set(r.wanted)]
