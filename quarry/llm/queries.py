"""Queries of the training-data operators: thin calls on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing, oracles
from quarry.llm.ann import nearest
from quarry.llm.decontaminate import leaks
from quarry.llm.html_text import page_texts
from quarry.llm.line_dedup import repeated_lines
from quarry.llm.near_dup import near_duplicates
from quarry.llm.packing import pack
from quarry.llm.periodic import periodic_runs
from quarry.llm.quality import resample
from quarry.llm.token_count import token_counts
from quarry.llm.token_files import read_token_files, write_token_files
from quarry.llm.toxicity import toxicity
from quarry.llm.variants import spelling_variants, word_counts
from quarry.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_ann")
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(read_table(spark, sf_dir, "documents"),
                                              public_tokenizers.path("word_bpe_49k.json")))


@query("op7_html_text")
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(read_table(spark, sf_dir, "pages"))


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(read_table(spark, sf_dir, "documents"))


@query("op9_near_dup")
def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op10_mixing", mixing.ORACLE)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read_table(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Plants periods: where ``h`` = crc32 of doc_id divides by 10, the words from the a-th on become the
    first p of them over and over (a, p from ``h``); texts without words and null ids stay."""
    given = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    n = F.size("w").cast("long")
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, given).alias("w"))
    rows = rows.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", (F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int"))
    rest = F.col("n").cast("int") - F.col("a")
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    over = F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(over, F.lit(1), rest)), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The contract's columns from the runs and the collapsed text."""
    better = "x.length * b.period > b.length * x.period"
    best = F.expr(f"aggregate(runs, runs[0], (b, x) -> IF({better}, x, b))")  # runs go by start, period
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length DIV best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query("op11_periodic_runs", oracles.PERIODIC_RUNS)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_repeats(read_table(spark, sf_dir, "documents"))))


@query("op12_spelling_variants", oracles.SPELLING_VARIANTS)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(read_table(spark, sf_dir, "documents"), typos=199))


@query("op13_packing")
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
