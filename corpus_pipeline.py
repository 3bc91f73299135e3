"""A corpus cleaned and encoded: five stages over the documents table.

Each stage calls one operator of ``tessera.llm`` and works on all that the
stage before kept; the driver of the pipeline writes every stage's rows as
Parquet and reads them as the next one's documents. All but the last return
the columns of the documents.

SQL can't express the vote model, the connected components and the
encoding, so there is no ORACLE_SQL; tests hold the rows against brute
force.

Documents without an id pass the stages like others, but are no candidates
for near-dedup. A null text fails the quality rules. An empty table stays
empty. Other columns pass through up to the last stage, which returns its
own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, pii, quality, simhash
from tessera.llm.common import stored, table

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.deduplicated(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut from the texts."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is generalised and terms that disclose it go."""
    return pii.sanitised(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers, and the text that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, into="token_ids")
    back = bpe.decoded(encoded.drop("text"), ranks, public_tokenizers.PATTERN, "token_ids", into="decoded")
    return back.select(
        "doc_id", "lang", "source", F.decode("decoded", "utf-8").alias("text"),
        F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
    )


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
