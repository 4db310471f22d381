"""The queries of this subpackage, and the SQL that says what some of them return."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, langid, minhash, packing, pii, quality_nbsvm, quality_rules, secrets, toxicity
from ._common import crc_mod, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A public tokenizer's file: LEXWEFT_TOKENIZERS names its folder, else the installed package does."""
    folder = os.environ.get("LEXWEFT_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    profiles = langid.learn(docs.where(~held_out))
    return langid.identify(docs, profiles, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(), ["doc_id"])
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.filter_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups, _ = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return out.select("doc_id", *[_count("spans", k) for k in secrets.BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    model = toxicity.train(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return model.score(docs, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    out = packing.pack(docs, tokenizer_path(), ["doc_id"])
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pii.train(docs).find(docs, ["doc_id"])
    return out.select("doc_id", *[_count("base", k) for k in pii.KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    model = quality_nbsvm.train(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    return model.score(docs, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_bpe, op3_quality_rules, op4_exact_dedup, op5_secrets, op6_minhash, op7_toxicity, op8_packing, op9_pii, op10_quality, pipeline)}

ORACLE_SQL = {
    "op4_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size,
               row_number() OVER (PARTITION BY d.t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    "op6_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(words) = 0 THEN []
                WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingle
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
        link AS (SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
        two AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
        reach AS (SELECT a, b FROM two UNION SELECT reach.a, two.b FROM reach JOIN two ON reach.b = two.a),
        least_ AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
               w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least_ ON least_.a = w.doc_id""",
}
