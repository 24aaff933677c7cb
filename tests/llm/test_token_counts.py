import random

import pytest
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from propensity.llm import bpe
from propensity.llm import token_counts as TC

PATH = P.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
VOC = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
CTR = bpe.PrefixCounter(VOC, memo_size=50)
SCHEMA = "doc_id bigint, text string, id string, n_tokens int"


def library(t):
    return len(TOK.encode(t, add_special_tokens=False).ids)


def check_all_prefixes(t):
    got = bpe.counts_at(CTR.steps(t).tobytes()).tolist()
    assert len(got) == len(t) + 1
    want = [library(t[:i]) for i in range(len(t) + 1)]
    assert got == want, t
    # the batch path: words worked out together
    assert bpe.counts_at(next(CTR.all_steps([t])).tobytes()).tolist() == want, t


PIECES = ["the", " ", "  ", "\n", "\t", "'s", "'", "'re", "'ll", "'LL", "don", "n't", "1", "2024", "Ünï", "漢字", "é", "!", "...", "<|endoftext|>",
          "<|endo", "\x1c", " ", "　", "😀", "é", "=====", "tion", "worthless", "\r\n", " '", "a", "aaaa", "\x85", "²", "Ⅷ"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_every_prefix_equals_the_library(t):
    check_all_prefixes(t)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(t):
    t = t.encode("utf-8", "ignore").decode()
    check_all_prefixes(t)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aeéÉßñthionsA.!#'\n ", max_size=12), max_size=8).map(" ".join))
def test_words_marks_and_lines(t):
    check_all_prefixes(t)


def test_words_in_one_go():
    rng = random.Random(5)
    words = list({"".join(rng.choice(["the", "in", "é", "q", "Z", "tion", "ss", " "]) for _ in range(rng.randrange(1, 9))).strip() or "x" for _ in range(3000)})
    raws = [w.encode() for w in words if len(w.encode()) <= 24]
    fresh = bpe.WordCounts(VOC)
    for raw, row in zip(raws, fresh.counts(raws).tolist(), strict=True):
        assert row[:len(raw) + 1] == VOC.piece_counts(raw), raw
    assert fresh.counts([]).shape == (0, 25)


def test_long_runs():
    for t in ["a" * 700, " " * 300 + "x", "=" * 500, "ab" * 300, "\n" * 200, "x" + " " * 150]:
        check_all_prefixes(t)


def test_every_code_point_is_cut_alike():
    for lo in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(lo, lo + 64) if not 0xD800 <= c < 0xE000]
        if not chars or lo > 0x32000 and lo < 0xE0000:
            continue
        t = "a" + "".join(f"{c}b{c}1 " for c in chars)
        assert int(CTR.steps(t).sum()) == library(t), hex(lo)


def test_budget_questions(spark):
    rng = random.Random(0)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 40))) for _ in range(60)] + [None, "", "the " * 20000]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "no id", "y", 2), (3, texts[3], "z", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = TC.prefix_token_counts(docs)
    got = (out.withColumn("cut", TC.chars_within(F.col("steps"), F.lit(5)))
           .withColumn("first3", TC.prefix_count(F.col("steps"), F.lit(3))).collect())
    assert len(got) == len(rows)
    by = {r.id: r for r in got if r.id is not None}
    for i, t in enumerate(texts):
        t = t or ""
        r = by[i]
        assert (r.n_bytes, r.n_tokens, r.first3) == (len(t.encode()), library(t), library(t[:3]))
        assert library(t[:r.cut]) <= 5 and (len(t) > 300 or all(library(t[:k]) > 5 for k in range(r.cut + 1, len(t) + 1)))


def test_empty_table(spark):
    assert TC.prefix_token_counts(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    from propensity.llm.queries import QUERIES
    d = f"/root/testdata/{sf}"
    got = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, d).collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        n = library(r.text)
        own = got[r.doc_id]
        assert (own.n_bytes, own.n_tokens, own.over_limit) == (len(r.text.encode()), n, n > 1024)
        assert own.chars_in_limit == len(r.text) if n <= 1024 else library(r.text[:own.chars_in_limit]) <= 1024
