"""The corpus pipeline: language ID, exact dedup, near-duplicate join, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as the next stage's documents.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toxloom.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from toxloom.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is null or has no letter go, as no language can be told. Those kept get the predicted language.

    Repeated rows and texts of any length are kept as they are. Where nothing can be learned, as from an empty table, nothing stays.
    """
    own = docs.select(*COLUMNS)
    found = language_id.identify(own, language_id.train(own.where(~language_id.held_out("doc_id", 4, 2))), COLUMNS)
    return found.where("lang_pred <> 'und'").select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def row_id() -> Column:
    """Joins of whole documents go by id and text, as ids may be null or repeat. Made on call: a column needs a session."""
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest id stays.

    The groups travel as hashes. Texts move once, to meet the rows that stay; of rows that repeat id and text one is taken. Null, empty
    and very long texts are texts like others: null and empty ones are equal. An empty table gives an empty one.
    """
    stay = exact_dedup.exact_groups(docs).where("kept").select(row_id().alias("_id"), F.col("text_sha256").alias("_sha"))
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    keyed = docs.select(*COLUMNS, row_id().alias("_id"), F.sha2(lower.cast("binary"), 256).alias("_sha"))
    once = F.row_number().over(Window.partitionBy("_id", "_sha").orderBy("source", "lang", "text"))
    return keyed.join(stay, ["_id", "_sha"]).withColumn("_n", once).where("_n = 1").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of a similarity of 0.8 or more connect, the one with the smallest id stays.

    Texts without words have no links, so null, empty and blank ones stay, each; so do texts of any length that are like no other. Of rows
    that repeat id and text, all stay or all go: the stage before has left one. An empty table gives an empty one.
    """
    go = jaccard_join.jaccard_groups(docs).where("not kept").select(row_id().alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.select(*COLUMNS, row_id().alias("_id"), F.xxhash64("text").alias("_hash")).join(go, ["_id", "_hash"], "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row for each part of a document in each slot drawn, with the words that stand there.

    Null, empty and blank texts have no words and give no rows. Repeated rows are documents of their own, a null source is one source, and a
    very long text is many parts. An empty table gives an empty one; the same rows in other files give the same mix.
    """
    parts = mixing.mixture(docs, columns=["doc_id", "lang", "source"], keep_text=True).texts()
    return parts.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens. Null and empty texts are one token, repeated rows are packed each, an empty table gives an empty one."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_languages), ("exact_dedup", drop_copies), ("jaccard_join", drop_near_copies), ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]
#: Permutations, models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
