"""The corpus pipeline: documents to packed training data.

``STAGES`` lists (name, function) in order. Each function takes (spark, docs,
sf_dir), works on every row its predecessor kept and, but for the last,
returns the columns of documents; each stage's result is written as Parquet
and read again as the next one's input.

1. toxicity: documents that score as toxic go.
2. near_dedup: one document of each group of SimHash near-duplicates stays.
3. decontamination: documents that share a window with the benchmark go.
4. mixing: sources are mixed to their targets; a document appears as often as
   the mix takes it, in training order (one document of a source may be cut).
5. packing: token ids in packed rows, written as id matrices with their lengths
   and resets beside them, and read back.

Null and empty texts pass stages 1 to 3 (as one group in stage 2) and are not
taken by the mix, having no words. An empty table gives an empty result.
Columns beyond those of documents are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm import mixing, packing, simhash, toxicity, winnowing
from propensity.llm.tables import fold_of, scratch, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", usable=fold_of(F.col("doc_id"), 5) != 0)
    return toxicity.ordinary(docs.select(*COLUMNS), model, threshold=0.5)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs.select(*COLUMNS), shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), window=10, gram=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "packed")
    packing.write_packed(docs, path, row_tokens=2048, tokenizer=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.read_packed(spark, path)


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mix), ("packing", pack)]

#: Learned scores, fingerprints and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
