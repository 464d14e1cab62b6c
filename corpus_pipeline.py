"""From raw documents to a weighted training mixture, in stages that each write Parquet.

Every stage works on all that the one before kept and gives the columns of ``documents``; the last adds ``tokens``, ``posterior``,
``rate`` and ``copies``. Rows without doc_id pass the near-duplicate, suffix and benchmark stages unchanged, null texts are
empty texts, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.llm import decontamination, jaccard_join, mixing, quality, queries, suffix_dedup
from idweave.runtime import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not likelier bad than good, by their text and their site."""
    host, path = quality.host_of(F.col("source")), quality.path_of(F.col("source"), F.col("lang"))
    return quality.score_quality(docs.select(COLUMNS), queries.quality_model(docs, sf_dir), host, path).where("keep").select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, directly or over others, the one with the least id. Equal rows
    count once; unlike rows of one id all stay or go."""
    found = jaccard_join.near_duplicates(docs, jaccard_join.Join(n=5, percent=80))
    gone = Workspace(spark).store(found.where("component_id < doc_id").select("doc_id"), "copies")
    kept = decontamination.without(docs.select(COLUMNS), gone)
    again = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return kept if again.isEmpty() else kept.distinct()


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that stand anywhere else too, nor the characters they were a part of; those of which nothing is left go."""
    cut = suffix_dedup.deduplicated(docs.select(COLUMNS), carry=("text", "lang", "source", "n_chars"), decoded=True)
    changed = F.size("spans") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    kept = cut.select("doc_id", text.alias("text"), "lang", "source", F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"), changed.alias("_changed"))
    return kept.where("not _changed or length(trim(text)) > 0").select(COLUMNS)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontamination.decontaminated(docs.select(COLUMNS), queries.table(spark, sf_dir, "benchmark"))


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the rate at which they are taken; those with a rate of 0 go."""
    seen, posterior = queries.domain_posterior(docs.select(COLUMNS), sf_dir)
    mixed = mixing.mixed(seen, posterior, queries.TARGETS, carry=tuple(COLUMNS))
    return mixed.where("rate > 0").select(*COLUMNS, "tokens", "posterior", "rate", "copies")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_benchmarks),
    ("mixing", weighted),
]

#: The stages fit classifiers and join by set similarity, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each reads what the one before has written."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name)
    return docs
