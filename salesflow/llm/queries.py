"""Corpus queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from salesflow.llm import (
    bpe, dac, exact_dedup, langid, negatives, packing, pieces, quality, repeats, secrets, simhash, spelling, toxicity,
)
from salesflow.llm.common import table


def op1_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_secret_scan(spark, sf_dir):
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op3_simhash(spark, sf_dir):
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.quality_verdicts(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = langid.language_fold(F.col("doc_id"))
    return langid.predict_languages(docs, langid.train(docs, held_out)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_repeated_substrings(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.toxicity_fold(F.col("doc_id"))
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), held_out)
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_token_file(spark, sf_dir):
    return dac.token_file(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark, sf_dir):
    return pieces.piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_hard_negatives(spark, sf_dir):
    seventh = F.col("vec_id") % 7 == 0
    label = F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_byte_bpe, op2_secret_scan, op3_simhash, op4_quality, op5_language, op6_repeated_substrings, op7_toxicity, op8_exact_dedup, op9_token_file,
    op10_best_fit_packing, op11_sentencepiece, op12_hard_negatives, op13_spelling_variants)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE = {
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        d AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n),
        g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op12_hard_negatives": """
        WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * x::DOUBLE) for x in embedding] AS parts FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.parts) = len(b.parts) WHERE a.vec_id % 50 = 0),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score,
            score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
        QUALIFY row_number() OVER w <= 3""",
}
