import base64
import collections
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from propensity.llm import packing as PK

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
SCHEMA = "doc_id bigint, text string, part int, ids string"


def brute_bfd(lengths, cap):
    rooms, rows = [], []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fit = [(r, k) for k, r in enumerate(rooms) if r >= lengths[i]]
        if fit:
            k = min(fit)[1]
            rooms[k] -= lengths[i]
            rows[k].append(i)
        else:
            rooms.append(cap - lengths[i])
            rows.append([i])
    return rooms


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing_equals_linear_search(seed):
    rng = random.Random(seed)
    cap = rng.choice([1, 7, 64, 100, 2048])
    lengths = [rng.randrange(1, cap + 1) for _ in range(400)]
    rows = PK.best_fit_decreasing(lengths, cap)
    assert sorted(i for r in rows for i in r) == list(range(400))
    assert sorted(cap - sum(lengths[i] for i in r) for r in rows) == sorted(brute_bfd(lengths, cap))


def unpack(rows, cap):
    docs = collections.defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == cap and (ids[r.n_tokens:] == 50256).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == len(r.ids) + 1
        for a, b, key, piece, start in zip(r.cu_seqlens, r.cu_seqlens[1:], r.ids, r.pieces, r.position_starts, strict=False):
            assert start == piece * cap
            docs[key].append((piece, ids[a:b].tolist()))
        pos = PK.position_ids(r.cu_seqlens, r.position_starts)
        assert len(pos) == r.n_tokens
    return docs


def test_round_trip(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["the ", "漢字", "\n", "worthless ", "<|endoftext|>", "é "]) for _ in range(rng.choice([0, 1, 5, 50, 900])))
             for _ in range(150)] + [None, "a b " * 5000]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    out = PK.packed(spark.createDataFrame(rows, SCHEMA).repartition(3), row_tokens=64, block_tokens=2000).collect()
    docs = unpack(out, 64)
    for i, t in enumerate(texts):
        want = ENC.encode_ordinary(t or "")
        assert [x for _, p in sorted(docs.get(i, [])) for x in p] == want
    assert sum(r.n_skipped for r in out) == sum(not t for t in texts)
    assert sum(r.n_tokens for r in out) / (64 * len(out)) > 0.9


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, "a b c", 1, "x"), (1, "a b c", 1, "x"), (None, "d e", 2, "y"), (2, "", 2, "y")]
    out = PK.packed(spark.createDataFrame(rows, SCHEMA).coalesce(1), row_tokens=16).collect()
    assert sorted((str(k) for r in out for k in r.ids)) == ["1", "1", "None"] and out[0].n_skipped == 1
    assert PK.packed(spark.createDataFrame([], SCHEMA)).count() == 0
    none = PK.packed(spark.createDataFrame([(5, None, 0, "")], SCHEMA)).collect()
    assert [(r.n_tokens, r.n_skipped, r.cu_seqlens) for r in none] == [(0, 1, [0])]


def test_query_round_trip(spark):
    from propensity.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    docs = unpack(QUERIES["op9_packing"](spark, d).collect(), 2048)
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        assert [x for _, p in sorted(docs.get(r.doc_id, [])) for x in p] == ENC.encode_ordinary(r.text or "")


def test_written_blocks_read_back(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    path = str(tmp_path / "packed")
    PK.write_packed(docs, path, row_tokens=512, block_tokens=20_000)
    rows = PK.read_packed(spark, path).collect()
    want = {r.doc_id: ENC.encode_ordinary(r.text or "") for r in docs.collect()}
    got = {k: [i for _, ids in sorted(v) for i in ids] for k, v in unpack(rows, 512).items()}
    assert got == {k: v for k, v in want.items() if v}
    by_place = {(r.part, r.block, r.row): r for r in rows}
    blocks = spark.read.parquet(path).collect()
    assert len(blocks) > 3 and sum(b.n_rows for b in blocks) == len(rows) == len(by_place)
    for b in blocks:
        ids = PK.matrix(b)
        assert ids.shape == (b.n_rows, 512)
        for k in range(b.n_rows):
            row = by_place[b.part, b.block, k]
            cu = b.cu_seqlens[b.row_starts[k]:b.row_starts[k + 1]]
            assert ids[k].tobytes() == bytes(row.input_ids) and cu == row.cu_seqlens


def test_written_edges_read_back(spark, tmp_path):
    rows = [(1, None, 0, "x"), (2, "", 0, "x"), (None, "the end", 0, "x"), (3, "the end", 0, "x"), (3, "the end", 0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    path = str(tmp_path / "packed")
    PK.write_packed(docs, path, row_tokens=4, block_tokens=4)
    out = PK.read_packed(spark, path).collect()
    assert sorted(str(k) for r in out for k in r.ids) == ["3", "3", "None"] and sum(r.n_skipped for r in out) == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        PK.write_packed(docs, path)
    PK.write_packed(docs.limit(0), path + "2")
    assert PK.read_packed(spark, path + "2").count() == 0
