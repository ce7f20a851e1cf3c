"""A corpus pipeline: quality rules, exact dedup, near dedup, a source mix and byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept
and returns a DataFrame; all but the last return the columns of documents, and
carry further columns, whatever their names, along. Null texts count as empty,
so quality rules reject them; null levels are leaves of their own; very long
texts are read whole; an empty table stays empty. Of rows that repeat id and
text one stays from exact dedup on; ties go to the smallest id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ascenta.llm import bpe, exact, mixing, near, rules
from ascenta.storage import new_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Near duplicates share four fifths of their five-word shingles.
NEAR = near.Similarity(words=5, percent=80)
#: The mix: tokens kept of those that come in, the tree from its root, and the weights of its named nodes.
MIX_SHARE, MIX_SEED = (9, 10), 42
MIX_WEIGHTS = {"lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep; each row is judged alone, so repeated rows stay or go together."""
    return rules.drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal but for white space: the longest, then that of the smallest id (null ids last)."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by near duplicates: that of the smallest id; texts without words link with nothing and stay."""
    return near.drop_near_duplicates(docs, NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the budgets of genres, languages and sources; each at most once, rows that repeat id and length together."""
    levels = {"domain": F.expr(mixing.GENRE), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.mix_sources(docs, levels, MIX_SHARE, MIX_WEIGHTS, max_epochs=1, seed=MIX_SEED).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number and a hash of the token ids of each document, and a hash of the bytes they decode to; an empty text has no ids."""
    ids = bpe.encode_bpe(docs, RANKS, public_tokenizers.PATTERN, decode=True)
    return ids.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mix), ("byte bpe", encode)]
#: Near duplicates and BPE are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's rows written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
