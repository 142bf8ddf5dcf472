"""Registered queries of the subpackage and the SQL they agree with, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.llm import conversation_repair, exact_dedup, jaccard_join, language_id, mixing, ngram_trie, packing, passages, secret_scan, token_counts, toxicity, vector_search, whitening
from toxloom.session import staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register()
def op1_mix_sources(spark, sf_dir):
    """Mix of all documents by source weights 1, 2, 3: what each document gives."""
    return mixing.mixture(table(spark, sf_dir, "documents")).taken()


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register(f"""
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
        sha256(t) AS text_sha256
    FROM (SELECT doc_id, {LOWER} AS t FROM documents) WINDOW w AS (PARTITION BY t)""")
def op2_exact_dedup(spark, sf_dir):
    """Groups of equal texts by chunk recipes."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@register()
def op6_token_counts(spark, sf_dir):
    """Exact token counts by prefix tables."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=4096)


@register()
def op10_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of 1,024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register()
def op7_language_id(spark, sf_dir):
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out("doc_id", 4, 2))
    return language_id.identify(docs, language_id.train(docs.where("not held_out")), ["doc_id", "held_out"])


@register()
def op9_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from labels of two thirds of the ids."""
    out = language_id.held_out("doc_id", 3, 1)
    docs = table(spark, sf_dir, "documents").withColumn("held_out", out)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs, model, ["doc_id", "held_out"])


@register()
def op8_jaccard_join(spark, sf_dir):
    """Class and number of links of every document: five-word shingles, similarity of 0.8 or more."""
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


@register()
def op4_vector_search(spark, sf_dir):
    """Ten nearest of all vectors for each whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    return vector_search.search(rows, rows.where("vec_id % 100 = 0"))


@register()
def op5_ngram_trie(spark, sf_dir):
    """Log probability of every document under a trigram model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out("doc_id", 7, 2))
    return ngram_trie.score(docs, ngram_trie.train(docs.where("not held_out")), ["doc_id", "held_out"])


@register()
def op3_shared_passages(spark, sf_dir):
    """Passages of 50 words or more that documents share."""
    return passages.shared_passages(table(spark, sf_dir, "documents"))


@register()
def op13_conversation_repair(spark, sf_dir):
    """Faults and the cheapest repair of every conversation, after a fixed part of its rows is damaged."""
    rows = table(spark, sf_dir, "conversations")
    marked = staged(conversation_repair.faults(conversation_repair.damaged(rows)), "faults")
    told = conversation_repair.digest(conversation_repair.repair(marked))
    every = rows.select("conv_id").distinct()  # those that lost all rows too
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(told, every["conv_id"].eqNullSafe(told["conv"]), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@register()
def op11_embedding_whitening(spark, sf_dir):
    """All embeddings in their first 16 principal components, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register()
def op12_secret_scan(spark, sf_dir):
    """Secrets of every document: pattern matches, and what a character network trained on them adds."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    base = F.filter("findings", lambda f: f["kind"] != "model")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    return found.select(
        "doc_id", *map(count, secret_scan.BASE), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"),
    )
