"""Column clean-up: names, initials, dates. Native expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL, GIVEN, FAMILY, INITIALS = "p_nombres_apellidos", "p_nombres", "p_apellidos", "iniciales"


def full_name(given: Column, family: Column) -> Column:
    """Surnames first. A null part is skipped; two null parts give an empty string."""
    return F.concat_ws(" ", family, given)


def full_name_or(given_full: Column, built: Column) -> Column:
    """The given full name, unless it is null or empty."""
    return F.coalesce(F.nullif(given_full, F.lit("")), built)


def initials(name: Column) -> Column:
    """First character of each word, upper-cased. Words end at any Unicode blank."""
    words = F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")
    return F.when(
        F.length(name) > 0,
        F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), ""),
    )


def normalize_date(value: Column) -> Column:
    """Date of a text that may carry a time of day; null when it does not parse."""
    text = F.regexp_replace(value.cast("string"), r"\d\d:\d\d:.*", "")
    text = F.regexp_replace(text, r"\s+", "")
    return F.try_to_timestamp(text).cast("date")


def with_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: normalize_date(F.col(c)) for c in present}) if present else df


def with_full_name(df: DataFrame) -> DataFrame:
    """Build or complete the full name when both parts are there."""
    if GIVEN not in df.columns or FAMILY not in df.columns:
        return df
    built = full_name(F.col(GIVEN), F.col(FAMILY))
    if FULL in df.columns:
        built = full_name_or(F.col(FULL), built)
    return df.withColumn(FULL, built)


def with_initials(df: DataFrame) -> DataFrame:
    """Add initials of the full name, unless the column exists or there is no full name."""
    if INITIALS in df.columns or FULL not in df.columns:
        return df
    return df.withColumn(INITIALS, initials(F.col(FULL)))
