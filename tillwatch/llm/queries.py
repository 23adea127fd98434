"""Registered queries of the operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import jaccard, lm, mixing, neighbours, packing, phrases, pii, quality, repair, substrings, token_files, toxicity, transducer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op6_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mix(table(spark, folder, "documents"), carry=False)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("takes")).alias("taken"),
                      F.transform("takes", lambda t: t["shard"]).alias("shards"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit(table(spark, folder, "documents"), with_ids=False).drop("ids")


@query("op8_token_files")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    files = token_files.write(docs)
    return files.read(token_files.keys_of(docs), with_ids=False).drop("copy", "ids")


@query("op4_quality_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(toxicity.in_fold("doc_id", 3, 1), F.lit(False))
    model = toxicity.fit(docs, table(spark, folder, "labels").filter(~held))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op3_lm_scoring")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    held = toxicity.in_fold("doc_id", 7, 2)
    return lm.score(table(spark, folder, "documents"), ~held, held)


@query("op9_nearest_neighbours")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op5_personal_data")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.find(docs, pii.fit(docs))

    def listed(column: str):
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [counted(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    talks = table(spark, folder, "conversations")
    return repair.digest(repair.damage(talks), talks)


@query("op12_token_counts")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return transducer.count_tokens(table(spark, folder, "documents"))


_PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS k FROM i),
f AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS ws FROM f WHERE a >= 100),
inner_ AS (SELECT lang, a, unnest([array_to_string(ws[1:k - 1], ' '), array_to_string(ws[2:k], ' ')]) AS phrase FROM c WHERE k > 2),
kept AS (SELECT * FROM c WHERE k > 1 AND NOT EXISTS (
           SELECT 1 FROM inner_ WHERE inner_.lang = c.lang AND inner_.phrase = c.phrase AND inner_.a = c.a)),
j AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
s AS (SELECT j.lang, j.phrase, j.a, j.cut, x.a AS l, y.a AS r, t.n,
             CAST((CAST(1000 AS HUGEINT) * j.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM j JOIN t ON t.lang = j.lang
      JOIN f x ON x.lang = j.lang AND x.phrase = array_to_string(j.ws[1:cut], ' ')
      JOIN f y ON y.lang = j.lang AND y.phrase = array_to_string(j.ws[cut + 1:j.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000"""


@query("op13_phrase_mining", _PHRASES)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))
