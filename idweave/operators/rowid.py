"""A unique, repeatable row key that needs no global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of one row are numbered in chunks of this many, so that a row copied a billion
# times is unfolded by many tasks.
COPY_CHUNK = 1_000


def _canonical(columns: list[str]) -> Column:
    """One text per row content: each value behind its length, nulls apart from empty text."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat_ws(",", *parts)


def unfold_copies(df: DataFrame, copies: str, number: str) -> DataFrame:
    """Turn each row into ``copies`` rows numbered from 1.

    Rows copied very often are first cut into chunks that go to different tasks; all other
    rows unfold in place. Both branches read the same upstream shuffle.
    """
    rest = [c for c in df.columns if c != copies]
    n = F.col(copies)

    def numbers(part: DataFrame, first: Column) -> DataFrame:
        last = F.least(first + COPY_CHUNK - 1, n)
        return part.select(*rest, F.explode(F.sequence(first, last)).alias(number))

    few = numbers(df.where(n <= COPY_CHUNK), F.lit(1).cast("long"))
    starts = F.sequence(F.lit(1).cast("long"), n, F.lit(COPY_CHUNK).cast("long"))
    many = df.where(n > COPY_CHUNK).select(*rest, copies, F.explode(starts).alias("_start"))
    # A number of partitions is given because chunks are few bytes: they would be put together in one task, which
    # then unfolds them all.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(partitions, F.xxhash64(*rest), "_start")
    return few.unionByName(numbers(many, F.col("_start")))


def with_row_id(df: DataFrame, key: str = "id_hash", unique: bool = False, out: str = "p_idp") -> DataFrame:
    """Add ``out``, a unique text.

    With ``unique`` the key itself serves and nothing is shuffled. Otherwise equal rows are
    counted (partially before the shuffle, so a hot key or row stays cheap), and the id is
    key, content digest and copy number.
    """
    columns = df.columns
    if unique:
        return df.select(F.col(key).cast("string").alias(out), *columns)
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    base = F.concat_ws("-", F.col(key).cast("string"), F.sha2(_canonical(columns), 256))
    return unfold_copies(counted, "_copies", "_copy").select(
        F.concat_ws("-", base, F.col("_copy").cast("string")).alias(out), *columns
    )
