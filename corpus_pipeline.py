"""From raw documents to packed sequences: poor documents go, copies go, secrets are masked, the rest is packed.

Each stage does with nulls, empty and long texts, repeated rows and empty tables what its operator says: a document without
words is rejected by the first; of equal rows one stays after the second; a null doc_id goes through all of them; an empty
table gives an empty result. Other columns than those of `documents` are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesflow.llm import exact_dedup, packing, quality, secrets, simhash
from salesflow.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fitted trees reject go."""
    return quality.drop_poor(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    return secrets.redact_secrets(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("simhash_near_dedup", near_copies),
          ("secret_scans", secret_masks), ("best_fit_packing", best_fit)]

#: SQL can express neither the fitted trees nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
