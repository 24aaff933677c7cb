"""The registered queries of the operators: each applies its operator, with
production parameters, to the whole of its table and digests the output into
the columns asked for. ``ORACLES`` holds DuckDB SQL where SQL can express a
result; the other queries are tested against brute force in ``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bottomk, class_lm, conversation_repair, histogram_packing, langid, maxscore, mixing, packing
from . import quality, simhash, token_counts, toxicity, winnowing
from .tables import fold_of, scratch, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = written(token_counts.prefix_token_counts(table(spark, sf_dir, "documents"), store=True,
                                                      tokenizer=public_tokenizers.path("byte_bpe_50k.json")), "prefix_counts")
    # the budget answer is read from the stored counts: the characters of the longest prefix of at most 1,024 tokens
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"),
                         token_counts.chars_within(F.col("steps"), F.lit(1024)).alias("chars_in_limit"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
c AS (SELECT *, source_size * 3.0 AS cap, source_size * 3.0 / weight AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
      FROM c WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT arg_min(level, ratio) AS level FROM l WHERE ratio >= level - abs(level) * 1e-12),
t AS (SELECT source, source_size, 2 - weight / 2 AS a, least(cap, coalesce((SELECT level FROM f) * weight, cap)) AS target FROM c),
q AS (SELECT *, CAST(floor(target) AS BIGINT) AS quota FROM t),
x AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.quota, q.a,
             CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
y AS (SELECT *, CAST(CASE WHEN source_size = 0 THEN 0 ELSE (quota // source_size) * size
                     + greatest(0, least(size, quota % source_size - start)) END AS BIGINT) AS taken,
             CASE WHEN quota > 0 THEN CAST(start AS DOUBLE) / quota END AS u FROM x)
SELECT doc_id, size, source_size, round(target, 4) AS target, taken,
       -- the first copy starts where the demand a t + (1 - a) t^2 has reached the words before it
       CASE WHEN taken > 0 THEN round(CASE WHEN a = 1 THEN u WHEN u = 0 THEN 0.0
            ELSE 2 * u / (a + sqrt(a * a + 4 * (1 - a) * u)) END, 9) END AS first_position
FROM y"""


@query("op2_mixing", OP2_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = written(mixing.plan(table(spark, sf_dir, "documents")).drop("row"), "plan")
    copies = written(mixing.dealt(planned), "dealt")
    # documents with words have offsets of their own within a source; those the mix does not take have no copy
    doc = ["source", "offset", "id", "size", "source_size", "target"]
    used = copies.groupBy(*doc).agg(F.sum("words").alias("taken"), F.min("position").alias("first_position"))
    unused = planned.where("taken = 0").select(*doc, "taken", F.lit(None).cast("double").alias("first_position"))
    out = used.unionByName(unused).orderBy(F.col("first_position").asc_nulls_last(), "id")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 4).alias("target"), "taken",
                      F.round("first_position", 9).alias("first_position"))


@query("op3_class_lm")
def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = class_lm.train(docs, usable=fold_of(F.col("doc_id"), 7) != 2)
    return class_lm.score(docs, model).select(
        F.col("id").alias("doc_id"), (fold_of(F.col("id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score", "perplexity")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, w[s : s + least(len(w), 10) - 1] AS win
      FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM g),
p AS (SELECT d.doc_id, s, m, w[s : s + m - 1] AS win
      FROM d, sizes, unnest(range(1, len(w) - m + 2)) AS u(s)),
hit AS (SELECT p.doc_id, p.s, p.m, g.item_id FROM p JOIN g ON p.m = g.m AND p.win = g.win),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM hit, unnest(range(s, s + m)) AS u(pos) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""


@query("op4_decontamination", OP4_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10, gram=5)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_list").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("item_list", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    w = quality.train(docs, labels, "quality", usable=fold_of(F.col("doc_id"), 5) != 0)
    return quality.score(docs, w).select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bottomk.edited_pairs(table(spark, sf_dir, "documents"), k=128, shingle=5)
    return out.select(F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      bottomk.to_string(F.col("sketch")).alias("fingerprint"),
                      bottomk.to_string(F.col("edited_sketch")).alias("edited_fingerprint"),
                      bottomk.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                      bottomk.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, "toxic", usable=fold_of(F.col("doc_id"), 5) != 0)
    return toxicity.score(docs, model).select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                                              (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op8_langid")
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, usable=fold_of(F.col("doc_id"), 3) != 1)
    return langid.predict(docs, model).select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "n_langs")


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "packed")
    packing.write_packed(table(spark, sf_dir, "documents"), path, row_tokens=2048,
                         tokenizer=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.read_packed(spark, path)


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = histogram_packing.packed(table(spark, sf_dir, "documents"), capacity=4096, end_id=1,
                                   tokenizer=public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return out.drop("ids").withColumnRenamed("id", "doc_id")


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.summary(conversation_repair.damaged(table(spark, sf_dir, "conversations")), copies_col="copies").drop("n_rows")


OP13_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM t WHERE len(w) > 0),
q AS (SELECT item_id, x AS term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM benchmark) GROUP BY ALL),
p AS (SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM t)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY term),
s AS (SELECT item_id, d, any_value(doc_id) AS doc_id,
             CAST(sum(repeats * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words)))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term), g
      GROUP BY item_id, d)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
WHERE rank <= 10"""


@query("op13_ranked_search", OP13_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10).withColumnRenamed("id", "doc_id")
