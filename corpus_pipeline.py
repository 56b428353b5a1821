"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, mix, token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.decontaminate import without_leaks
from quarry.llm.mixing import mix
from quarry.llm.near_dup import without_near_duplicates
from quarry.llm.quality import keep_sampled
from quarry.llm.shared import stored
from quarry.llm.token_files import read_token_files, write_token_files
from quarry.session import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the documents labelled good; rejected documents go."""
    return keep_sampled(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays (five words, similarity 0.8)."""
    return without_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary files, read back as (doc_id, start, n_tokens, ids_crc32)."""
    return read_token_files(write_token_files(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("token_files", token_files)]

#: A fitted model, MinHash and a tokenizer are not SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another on ``documents``; every stage but the last is written as Parquet in
    the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
