"""A corpus pipeline over ``documents``: quality, near-duplicates, repeated passages, mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; its result is written
as Parquet below the shared checkpoint folder and read again as the next stage's ``docs``.

* quality: documents that the base rule or the outlier rule rejects go.
* near_dedup: one document (the smallest id) of each group of near copies stays.
* substring_dedup: repeated 20-word windows go from the texts; documents left empty go.
* mixing: documents come as often as the mix of sources takes them.
* tokens: byte-level BPE ids of each document, encoded and decoded again, as counts and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, mixing, neardup, quality, substringdedup
from strata.llm.storage import materialize, table


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    import public_tokenizers as tokenizers

    return bpe.digest(docs, tokenizers.path(bpe.VOCABULARY), tokenizers.PATTERN)


STAGES = [
    ("quality", quality.passing_documents),
    ("near_dedup", neardup.one_of_each),
    ("substring_dedup", substringdedup.without_repeats),
    ("mixing", mixing.mixed_documents),
    ("tokens", tokens),
]

#: Robust fits, random ranks and merges can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
