"""From physical tables to concepts: mapping rows, job selection, source filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions.normalize import FAMILY, FULL, GIVEN, INITIALS
from idweave.spec import LABEL_NOT_FOUND

# Tables whose people are one part of the registry, and that part's key prefix.
SCOPED_TABLES = {"rc02_revit_nor": "00101"}

# What stands in for a mapped column the table does not have.
DEFAULTS: dict[str, str | None] = {"p_nombres": None, "p_apellidos": None, "p_sexo": "2"}

# The narrow registry projection.
REGISTRY_COLUMNS = (
    "p_cedula",
    "p_nombres",
    "p_apellidos",
    "p_nombres_apellidos",
    "p_sexo",
    "p_fecha_nac",
    "p_identidad_mad",
    "p_identidad_pad",
)


class JobError(ValueError):
    """The control tables do not name exactly one table to link."""


@dataclass(frozen=True)
class MappedColumn:
    """One mapping row: a physical column and its concept. ``missing`` marks a stand-in."""

    physical: str
    concept: str | None
    missing: bool = False


def load_mapping(mapping: DataFrame, table: str, most: int = 10_000) -> list[MappedColumn]:
    """Mapping rows of one table, as a small list. A table has a handful of mapped columns; more than ``most`` mean that
    the mapping table is not one, and raise an error."""
    rows = (
        mapping.where(F.col("tabla_entrada") == table)
        .select("variables_tabla", "concepto")
        .limit(most + 1)
        .collect()
    )
    if not rows:
        raise JobError(f"no mapping rows for table {table!r}")
    if len(rows) > most:
        raise JobError(f"more than {most} mapping rows for table {table!r}")
    return [MappedColumn(r.variables_tabla, r.concepto) for r in rows]


def select_job(control: DataFrame) -> str:
    """The one table flagged for linkage."""
    rows = control.where(F.col("precision") == "TRUE").select("tabla_escritura").limit(2).collect()
    if len(rows) != 1:
        raise JobError("expected exactly one flagged table, found " + ("none" if not rows else "several"))
    return rows[0].tabla_escritura


def select_job_like(mapping: DataFrame, pattern: str) -> str:
    """The one mapped table whose name matches ``pattern``."""
    names = mapping.where(F.col("tabla_entrada").rlike(pattern)).select("tabla_entrada").distinct()
    rows = names.limit(2).collect()
    if len(rows) != 1:
        raise JobError("expected exactly one table name to match, found " + ("none" if not rows else "several"))
    return rows[0].tabla_entrada


def with_defaults(mapping: Sequence[MappedColumn], columns: Sequence[str]) -> list[MappedColumn]:
    """Mark mapped columns the table lacks; only some concepts have a stand-in.

    All columns of a concept take the stand-in when one of them is missing.
    """
    have = set(columns)
    lacking = {m.concept for m in mapping if m.physical not in have}
    unknown = sorted(m.physical for m in mapping if m.physical not in have and m.concept not in DEFAULTS)
    if unknown:
        raise ValueError(f"mapped columns not in the table: {unknown}")
    return [
        MappedColumn(m.physical, m.concept, missing=m.concept in lacking and m.concept in DEFAULTS)
        for m in mapping
    ]


def project_concepts(df: DataFrame, mapping: Sequence[MappedColumn], row_key: str = "id_hash") -> DataFrame:
    """Mapped columns under their concept names, plus the row key."""
    columns = []
    for m in mapping:
        if m.concept is None:
            continue
        column = F.lit(DEFAULTS[m.concept]).cast("string") if m.missing else F.col(m.physical)
        columns.append(column.alias(m.concept))
    return df.select(*columns, row_key)


def pending_only(df: DataFrame) -> DataFrame:
    """Rows not yet identified; all rows when the table was never processed."""
    if "id_etiqueta" not in df.columns:
        return df
    label = F.col("id_etiqueta")
    return df.where((label == LABEL_NOT_FOUND) | label.isNull())


def registry_scope(registry: DataFrame, table: str) -> DataFrame:
    """The part of the registry a table is linked to; a prefix test the scan can push down."""
    prefix = SCOPED_TABLES.get(table)
    return registry.where(F.col("id_hash_rp").startswith(prefix)) if prefix else registry


def registry_pruned(registry: DataFrame, columns: Sequence[str] = REGISTRY_COLUMNS) -> DataFrame:
    return registry.select(*columns)


def linkage_columns(mapping: Sequence[MappedColumn]) -> list[str]:
    """Concepts to link on. Names make the initials and the full name available too."""
    concepts = [m.concept for m in mapping if m.concept is not None]
    if FULL in concepts or {GIVEN, FAMILY} <= set(concepts):
        concepts += [INITIALS, FULL]
    return list(dict.fromkeys(concepts))
