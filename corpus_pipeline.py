"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark
decontamination, byte-level BPE.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir), works on all
rows its predecessor kept and returns the rows for the next stage: the columns of
documents, but for the last stage, which returns a row of token counts and digests per
document. ``run`` writes each stage's result as Parquet in the shared folder and reads
it back, so that a lost executor repeats one stage at most.

Edge cases are those of the operators. A document whose lines were all removed goes on
with an empty text, and SimHash keeps one such document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import byte_bpe, decontaminate, line_dedup, quality_rules, simhash
from orderlens.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier line; no document goes."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, digests of the ids and of the decoded text."""
    return byte_bpe.round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("byte_bpe", tokens),
]

#: Line similarity, XXH64 and BPE have no SQL form; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
