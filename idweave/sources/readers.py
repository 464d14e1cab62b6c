"""Registry and pivot scans. Addresses and credentials always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """Where a table comes from.

    ``format``     "table" for a catalog table, else a reader format ("parquet", "jdbc", "csv", ...)
    ``location``   table name or path; for JDBC the table, or a query in parentheses with alias
    ``options``    passed to the reader as they are (url, user, driver, header, ...)
    ``split_on``   JDBC only: numeric, date or timestamp column to read by, with its bounds and
                   the number of parallel reads
    ``predicates`` JDBC only: conditions in the database's SQL, one parallel read for each (see
                   ``range_predicates`` and ``modulo_predicates``, for text keys); together they must hold
                   every row once

    With neither, one task reads everything.
    """

    format: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)
    split_on: tuple[str, str, str, int] | None = None
    predicates: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if (self.split_on or self.predicates) and self.format != "jdbc":
            raise ValueError("only JDBC reads are split by the caller; files and tables split by themselves")
        if self.split_on and self.predicates:
            raise ValueError("split_on and predicates exclude each other")
        if self.predicates and "url" not in self.options:
            raise ValueError("a JDBC read needs the option url")

    def reader_options(self) -> dict[str, str]:
        options = dict(self.options)
        if self.format != "jdbc":
            return options
        options["dbtable"] = self.location
        if self.split_on:
            column, low, high, parts = self.split_on
            options |= {
                "partitionColumn": column,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(parts),
            }
        return options


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def range_predicates(column: str, bounds: Sequence[str]) -> tuple[str, ...]:
    """Conditions that cut a text column at ``bounds``; every row meets exactly one, null keys the first.

    A part excludes all parts before it by name and does not rely on the bounds being in order, so
    a collation that sorts otherwise than the caller makes parts uneven, and never loses or repeats a row.
    """
    if not bounds:
        return (f"({column} is null or {column} is not null)",)
    parts = [f"({column} is null or {column} < {_text(bounds[0])})"]
    for i, bound in enumerate(bounds[1:], 1):
        before = " and ".join(f"{column} >= {_text(b)}" for b in bounds[:i])
        parts.append(f"({before} and {column} < {_text(bound)})")
    parts.append("(" + " and ".join(f"{column} >= {_text(b)}" for b in bounds) + ")")
    return tuple(parts)


def prefix_bounds(parts: int, alphabet: str = "0123456789") -> list[str]:
    """Bounds that cut keys over ``alphabet`` (in ascending order) into ``parts`` of equal width, as short as they can be."""
    width = 1
    while len(alphabet) ** width < parts:
        width += 1
    bounds = []
    for i in range(1, parts):
        place, text = i * len(alphabet) ** width // parts, ""
        for _ in range(width):
            place, digit = divmod(place, len(alphabet))
            text = alphabet[digit] + text
        bounds.append(text)
    return bounds


def modulo_predicates(number: str, parts: int) -> tuple[str, ...]:
    """Conditions by the remainder of ``number``, an integer expression in the database's SQL such as a hash of
    a text key; every row meets exactly one, nulls the first. Negative numbers are taken care of."""
    remainder = f"mod(mod({number}, {parts}) + {parts}, {parts})"
    return tuple(f"({number} is null or {remainder} = 0)" if i == 0 else f"({remainder} = {i})" for i in range(parts))


def read(spark: SparkSession, source: Source) -> DataFrame:
    if source.format == "table":
        return spark.read.table(source.location)
    if source.predicates:
        options = dict(source.options)
        return spark.read.jdbc(options.pop("url"), source.location, predicates=list(source.predicates), properties=options)
    reader = spark.read.format(source.format).options(**source.reader_options())
    return reader.load() if source.format == "jdbc" else reader.load(source.location)


def read_registry(spark: SparkSession, source: Source) -> DataFrame:
    return read(spark, source)


def read_pivot(spark: SparkSession, source: Source) -> DataFrame:
    return read(spark, source)
