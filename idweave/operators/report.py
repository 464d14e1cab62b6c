"""Counts of a linkage run; all stay DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.operators.cascade import LABEL


def label_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy(LABEL).agg(F.count(F.lit(1)).alias("count"))


def total(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))


def _size(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias(LABEL), "count")


def outcome_summary(
    matched: DataFrame, deterministic: DataFrame, unresolved: DataFrame, validated: DataFrame
) -> DataFrame:
    """Matches per label, then the totals of the run."""
    exact = deterministic.select(F.lit(1).alias("exact"), F.lit(0).alias("all"))
    every = matched.select(F.lit(0).alias("exact"), F.lit(1).alias("all"))
    sums = exact.unionByName(every).agg(
        F.coalesce(F.sum("exact"), F.lit(0)).alias("e"), F.coalesce(F.sum("all"), F.lit(0)).alias("a")
    )
    named = F.array(
        F.struct(F.lit("total deterministico").alias(LABEL), F.col("e").alias("count")),
        F.struct(F.lit("total difuso").alias(LABEL), (F.col("a") - F.col("e")).alias("count")),
        F.struct(F.lit("total encontrados").alias(LABEL), F.col("a").alias("count")),
    )
    parts = [
        label_counts(matched),
        sums.select(F.inline(named)),
        _size(unresolved, "No encontrados"),
        _size(validated, "Validados"),
    ]
    return reduce(DataFrame.unionByName, parts)
