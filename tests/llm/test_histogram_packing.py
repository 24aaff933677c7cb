import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from propensity.llm import histogram_packing as HP
from .test_packing import brute_bfd

TOK = Tokenizer.from_file(P.path("word_bpe_49k.json"))
SCHEMA = "doc_id bigint, text string, part int, length string"


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_decreasing_over_pieces(seed):
    rng = random.Random(seed)
    cap = rng.choice([1, 7, 64, 100, 4096])
    lengths = [rng.randrange(1, cap + 1) if rng.random() < 0.7 else max(1, cap // 3) for _ in range(600)]
    hist = Counter(lengths)
    runs, n = HP.plan(hist, cap)
    rooms = [cap] * n
    starts = defaultdict(list)
    for r in sorted(runs):
        starts[r[0]].append(r)
    for length, count in sorted(hist.items(), reverse=True):
        own = starts[length] + [(length, count)]
        for (_, rank, first, each, offset), nxt in zip(own, own[1:]):
            for i in range(nxt[1] - rank):
                s = first + i // each
                assert cap - rooms[s] == offset + i % each * length  # gapless, in the plan's order
                rooms[s] -= length
    assert sorted(rooms) == sorted(brute_bfd(lengths, cap))


def test_plan_follows_lengths_not_documents():
    hist = {n: 10**9 + n for n in range(1, 4097)}
    runs, n = HP.plan(hist, 4096)
    assert len(runs) < 2 * 4096 * (2 * 4096) ** 0.5
    assert n * 4096 >= sum(a * b for a, b in hist.items()) > (n - 4096) * 4096 * 0.99
    assert HP.plan({}, 4096) == ([], 0)


def check(rows, docs, cap):
    """rows (id, piece, start, length, ids_crc32, sequence_id, offset) against the documents' ids."""
    seqs, own = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        own[r.id].append(r)
    for spots in seqs.values():
        at = 0
        for o, n in sorted(spots):
            assert o == at
            at += n
        assert at <= cap
    assert set(own) == {d for d, _ in docs}
    want = defaultdict(list)
    for d, text in docs:
        ids = ids_of(text)
        for k, at in enumerate(range(0, len(ids), cap)):
            cut = ids[at:at + cap]
            want[d].append((k, at, len(cut), zlib.crc32(np.asarray(cut, "<u4").tobytes())))
    for d in want:
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in own[d]) == sorted(want[d])
    assert len(seqs) == len(brute_bfd([r.length for r in rows], cap))


def test_packing_round_trip(spark):
    rng = random.Random(3)
    words = ["the ", "Café ", "é", "́ x", "漢字", "\n", "don't ", "<|endoftext|>", " <|STARTOFTEXT|> ", "\x1c", " ", "İ", "Σας ", "123 ", "z" * 300 + " "]
    texts = ["".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 400]))) for _ in range(120)]
    texts += [None, "", "  ", "a b " * 3000, "ab" * 20000]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 9, "clash") for i, t in docs], SCHEMA).repartition(5)
    got = HP.packed(df, capacity=64)
    rows = got.collect()
    check(rows, docs, 64)
    whole = {r.sequence_id: r for r in HP.assembled(got).collect()}
    for r in rows:
        s = whole[r.sequence_id]
        k = s.cu_seqlens.index(r.offset)
        assert (s.ids[k], s.pieces[k], s.position_starts[k]) == (r.id, r.piece, r.start)
        assert s.input_ids[4 * r.offset:4 * (r.offset + r.length)] == r.ids and s.cu_seqlens[-1] * 4 == len(s.input_ids)


def test_null_and_repeated_rows_and_empty(spark):
    rows = [(1, "a b c", 1, "x")] * 3 + [(None, "d e", 2, "y"), (None, None, 2, "y")]
    got = HP.packed(spark.createDataFrame(rows, SCHEMA).repartition(2), capacity=8).collect()
    assert Counter(r.id for r in got) == {1: 3, None: 2}
    assert len({(r.sequence_id, r.offset) for r in got}) == 5
    assert HP.packed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_whole_texts(spark):
    from propensity.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    got = QUERIES["op11_best_fit_packing"](spark, d)
    assert got.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    check(got.withColumnRenamed("doc_id", "id").collect(), docs, 4096)
