"""A training corpus from raw documents: quality rules, exact and near deduplication, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents, so a stage sees
just what its predecessor kept or changed:

* quality drops documents that fail the base rules or the trees;
* exact_dedup keeps one document of each text;
* near_dedup keeps one document of each group of near copies (five-word shingles, 0.8);
* secrets masks live-looking values in the text; copied examples stay;
* packing returns the sequences' pieces.

No stage fails on nulls in any column, empty or very long texts, ties, repeated rows, an empty table
or further columns of any name; each function says what it does with them, its operator in detail.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import common, exact_dedup, near_dedup, packing, quality, secrets
from quillstone.llm.queries import WORD_MODEL


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass; null and empty texts fail, a repeated row is judged as often as it stands, an empty table stays empty."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text without its white space: the longest as written, then the smallest doc_id (null last), then any one of repeated rows; null and empty texts are one group."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group; texts without words and rows without doc_id stay, and rows that repeat a kept doc_id."""
    return near_dedup.keep_one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; a null or empty text stays as it is, and of values at one place the longest is masked first."""
    return secrets.mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row, null and empty texts as one piece of the end id; a text longer than a sequence is cut."""
    return packing.pack(docs, public_tokenizers.path(WORD_MODEL))


STAGES = [
    ("quality", quality_rules),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: SQL can't express the trees, the tokenizer or the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
