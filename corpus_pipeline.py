"""From raw documents to packed sequences: stages that each work on what the stage before kept.

All stages take texts whole, whatever their length, and an empty table; extra columns of the first table are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import langid, packing, secretscan, simhash
from docflow.llm.shared import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes if no language is at least so likely, as told by its words.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows stay; lang becomes the predicted language.

    Texts that are null, empty or without a letter go, as does every document if none is labelled. Equal scores go to the
    language that is first in alphabetic order. Rows with null or repeated ids stay as they are.
    """
    model = langid.fit(docs)
    named = langid.predict(docs, model, keep=["text", "source", "n_chars"])
    sure = named.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return sure.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar sets of five-word shingles the one with the smallest id stays.

    Null, empty and blank texts are one group. Rows that repeat an id are one; rows with a null id stay.
    """
    return simhash.first_of_each(docs.select(*COLUMNS), words=5, similarity=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, null and repeated ids too; secrets in them are replaced by their kind in brackets. A null text stays null and keeps its n_chars."""
    clean = secretscan.redact(docs, secretscan.fit(docs), COLUMNS)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its sequence and place. A null text counts as empty; repeated rows are packed as often as they stand, a null id stays null."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, capacity=1024, end_id=2)


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("secret scans", secret_scan), ("best-fit packing", best_fit_packing)]

#: SQL has neither the tokenizer nor the models of the stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
