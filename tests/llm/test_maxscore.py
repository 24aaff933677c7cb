import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from propensity.llm import maxscore as MS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id bigint, text string, score int, item_id string"
ITEMS = "item_id bigint, text string, doc_id int"


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            if b:
                m = 25 + (75 * sum(b.values()) * n_docs) // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms(text) if b[t])
                if s > 0:
                    scores.append((-s, i is not None, i or 0))
        out += [(item, r + 1, i if has else None, -s) for r, (s, has, i) in enumerate(sorted(scores)[:k])]
    return out


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdeé漢9") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 24, 25, 40]))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_search_against_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    words = vocabulary(rng, 120)
    weights = [1 / (i + 1) for i in range(len(words))]
    make = lambda n: "".join(w + rng.choice([" ", ", ", "\n", "_"]) for w in rng.choices(words, weights, k=n)).title()
    docs = [(i, make(rng.choice([0, 1, 3, 30, 300]))) for i in range(700)]
    docs += [(1000, docs[5][1]), (1001, docs[5][1]), (5, docs[5][1]), (None, docs[6][1]), (None, None), (7000, make(40000))]
    items = [(i, make(rng.choice([1, 2, 10, 60]))) for i in range(40)] + [(77, ""), (78, None), (79, "zzzz none"), (None, docs[9][1] + " a")]
    monkeypatch.setattr(MS, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(MS, "WINDOW", 64)
    df = spark.createDataFrame([(i, t, 3, "clash") for i, t in docs], SCHEMA).repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items + items[:3]], ITEMS)
    want = Counter(brute(docs, items))
    got = MS.top_documents(df, q)
    assert got.columns == ["item_id", "rank", "id", "score"]
    assert Counter(map(tuple, got.collect())) == want
    assert Counter(map(tuple, MS.top_documents(df, q, query_bytes=2000).collect())) == want  # in several blocks of queries
    three = Counter(map(tuple, MS.top_documents(df, q, k=3).collect()))
    assert three == Counter(brute(docs, items, 3))


def built(docs, vocab):
    lex = MS.Lexicon(vocab)
    doc, term, tf, length = [], [], [], []
    for d, text in enumerate(docs):
        words = MS.terms_of(text)
        length.append(len(words))
        for t, c in Counter(words).items():
            if t in vocab:
                doc.append(d), term.append(vocab.index(t)), tf.append(c)
    length = np.asarray(length)
    t, df, table, payload = MS._encoded(*(np.asarray(x) for x in (doc, term, tf)), length)
    assert lex.numbers(np.frombuffer(b"", np.uint8), np.empty(0, int), np.empty(0, int)).tolist() == []
    return MS.Shard(length.astype("<i8").tobytes(), t.tolist(), df.tolist(), table.tobytes(), payload, len(docs), int(length.sum()))


def test_blocks_round_trip_and_bounds_hold():
    rng = random.Random(4)
    vocab = [b"a", b"b", b"c"]
    docs = [" ".join(rng.choices(["a", "b", "c", "x"], [9, 3, 0.01, 5], k=rng.randrange(1, 400))) for _ in range(5000)]
    s = built(docs, vocab)
    for t, word in enumerate("abc"):
        at = 0
        want = [(d, x.split().count(word)) for d, x in enumerate(docs) if word in x]
        for b in range(*s.lists[t]):
            doc, impact = s.postings(b)
            assert doc.tolist() == [d for d, _ in want[at:at + len(doc)]] and impact.max() <= s.bound[b] <= s.top[t]
            at += len(doc)
        assert at == len(want)


def test_non_essential_blocks_stay_closed():
    # a rare heavy word decides; once the list is full, the common word's blocks without a candidate are never opened
    docs = ["common filler"] * 20_000
    for d in range(0, 2000, 100):
        docs[d] = "rare common rare rare"
    docs[15_000] = "rare rare rare rare common"
    import pyarrow as pa
    s = built(docs, [b"common", b"rare"])
    best = MS.Best(10)
    best.ids = pa.array(range(len(docs)))
    s.search([(0, 30), (1, 9000)], best)
    a, b = s.lists[0]
    assert best.rows[0][2] == 15_000 and len([x for x in s.opened if a <= x < b]) < (b - a) // 3


def test_candidates_outside_every_block():
    import pyarrow as pa
    docs = ["common"] * 300 + ["rare filler"] * 20 + ["common"] * 100
    s = built(docs, [b"common", b"rare"])
    best = MS.Best(10)
    best.ids = pa.array(range(len(docs)))
    for _ in range(2):  # the second time, only the rare list is essential
        s.search([(0, 1), (1, 9000)], best)
    assert {r[2] for r in best.rows} <= set(range(300, 320)) and len(best.rows) == 10


def test_words_are_never_confused():
    lex = MS.Lexicon([b"abc", b"abcdefgh", b"a" * 24, b"a" * 25, "é漢".encode()])
    text = b"abc abcd abcdefgh " + b"a" * 24 + b" " + b"a" * 25 + b" " + b"a" * 26 + b" " + "é漢".encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends = MS.spans(MS._TERM_BYTE[data], np.asarray([0, len(data)]))
    assert lex.numbers(data, starts, ends).tolist() == [0, -1, 1, 2, 3, -1, 4]
    assert MS.Lexicon([]).numbers(data, starts, ends).tolist() == [-1] * 7


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", 0, "")], SCHEMA), spark.createDataFrame([(1, "a", 0)], ITEMS)
    assert MS.top_documents(docs.limit(0), items).count() == 0
    assert MS.top_documents(docs, items.limit(0)).count() == 0
    assert MS.top_documents(spark.createDataFrame([(1, None, 0, "")], SCHEMA), items).count() == 0
