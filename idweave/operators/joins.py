"""Joins whose hot and null keys can be split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 4096


def spread(key: str) -> Column:
    """A second join key that follows from the first.

    An aggregate by a join key is read without another exchange, and such a side cannot be split. A join
    on this key too has an exchange of its own, of the folded rows, which the adaptive skew join splits.
    """
    return F.pmod(F.xxhash64(key), F.lit(NULL_SPREAD).cast("long"))


def shuffled_join(df: DataFrame, table: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by exchange and sort, whatever size ``table`` is taken for.

    Spark measures a stored table by its compressed files and takes no note of rows that an unfolding adds, so
    a table of a few MB may be a broadcast of a GB, which passes through the driver. For sides that grow with
    the input.
    """
    return df.join(table.hint("merge"), on, how)


def left_lookup(df: DataFrame, table: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``df`` LEFT JOIN ``table`` on ``key``.

    Null keys never match, but a plain left join would still send all of them to one task.
    Here they are spread by a hash of ``spread_by``; hot real keys are left to the adaptive
    skew join, which can split the ``df`` side.
    """
    nulls = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPREAD).cast("long"))
    left = df.withColumn("_spread", F.when(F.col(key).isNull(), nulls).otherwise(spread(key)))
    right = table.where(F.col(key).isNotNull()).withColumn("_spread", spread(key))
    joined = left.join(right, [key, "_spread"], "left")
    return joined.select(*df.columns, *[c for c in table.columns if c not in df.columns])
