"""Write-back: fold the outcomes of a linkage into the source table as one left join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.operators.joins import left_lookup
from idweave.sources.mapping import MappedColumn

# Result column that feeds each concept, and text columns every target has.
RESULT_COLUMNS = {
    "p_cedula": "p_idr",
    "p_nombres": "p_nombres_reg",
    "p_apellidos": "p_apellidos_reg",
    "p_nombres_apellidos": "p_nombres_apellidos_reg",
}
TARGET_COLUMNS = ("id_etiqueta", "estado_identidad", "p_nombres_apellidos")

# The update steps in their order. Each names its outcome, the state it
# writes, which rows it takes (names known, names null, or all) and which concepts it sets.
EVERY = tuple(RESULT_COLUMNS)
ID_ONLY = ("p_cedula", "p_nombres_apellidos")
STEPS: tuple[tuple[str, str, str, str, tuple[str, ...]], ...] = (
    ("validated", "validated", "validados", "all", EVERY),
    ("not_found", "not_found", "no encontrado", "all", ()),
    ("recovered", "matched", "recuperado", "known", EVERY),
    ("recovered_no_names", "matched", "recuperado", "null", ID_ONLY),
    ("residual", "residual", "residuales", "known", EVERY),
    ("residual_no_names", "residual", "residuales", "null", ID_ONLY),
)


def with_target_columns(source: DataFrame) -> DataFrame:
    """Add the text columns the write-back fills, where absent."""
    absent = [c for c in TARGET_COLUMNS if c not in source.columns]
    return source.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else source


def result_columns(mapping: Sequence[MappedColumn]) -> list[tuple[str, str]]:
    """(physical column, concept) pairs to fill. The full name has a column of its own when
    the mapping does not name one."""
    pairs = [(m.physical, m.concept) for m in mapping if m.concept in RESULT_COLUMNS]
    if all(concept != "p_nombres_apellidos" for _, concept in pairs):
        pairs.append(("p_nombres_apellidos", "p_nombres_apellidos"))
    return pairs


def _taken(rows: str) -> Column:
    given, family = F.col("p_nombres_reg"), F.col("p_apellidos_reg")
    return {
        "all": F.lit(True),
        "known": given.isNotNull() & family.isNotNull(),
        "null": given.isNull() & family.isNull(),
    }[rows]


FIELDS = ("p_idr", "id_etiqueta", "p_nombres_reg", "p_apellidos_reg", "p_nombres_apellidos_reg")
SCORE = "semidifuso"


def ordered_steps(outcomes: Iterable[str], steps: Sequence[str] | None, validated_wins: bool) -> list[tuple]:
    """The steps that apply, in the order in which they write."""
    outcomes = set(outcomes)
    order = [s for s in STEPS if (steps is None or s[0] in steps) and s[1] in outcomes]
    return sorted(order, key=lambda s: s[0] == "validated") if validated_wins else order


def chosen_rows(outcomes: Mapping[str, DataFrame], order: Sequence[tuple], row_key: str = "id_hash") -> DataFrame:
    """One row for each key, with the result row of each step as a struct ``_<step>``.

    Where a step has several rows for one key, the lowest score decides (an outcome without scores has
    none), then the lowest person id, nulls last. All steps share one grouping by key, folded before
    the shuffle.
    """
    parts = []
    for outcome in dict.fromkeys(s[1] for s in order):
        df = outcomes[outcome]
        score = F.col(SCORE).cast("double") if SCORE in df.columns else F.lit(None).cast("double")
        parts.append(df.select(row_key, *FIELDS, score.alias(SCORE), F.lit(outcome).alias("_outcome")))
    rows = reduce(DataFrame.unionByName, parts).where(F.col(row_key).isNotNull())
    ranked = F.struct(F.col(SCORE).isNull(), SCORE, F.col("p_idr").isNull(), *FIELDS)
    step_rows = [
        F.min(F.when((F.col("_outcome") == outcome) & _taken(taken), ranked)).alias(f"_{name}")
        for name, outcome, _, taken, _ in order
    ]
    return rows.groupBy(row_key).agg(*step_rows)


def assignments(
    order: Sequence[tuple], mapping: Sequence[MappedColumn], columns: Sequence[str], target: str = "", updates: str = ""
) -> dict[str, Column]:
    """New value of each column of the target that the steps may write: that of the last step that applies
    and writes it, its own otherwise. ``target`` and ``updates`` qualify the columns of the two sides."""
    target, updates = (f"{side}." if side else "" for side in (target, updates))

    def last(writes, value, column: str) -> Column:
        result = F.col(f"{target}`{column}`")
        for name, _, state, _, concepts in order:
            if writes(concepts):
                result = F.when(F.col(f"{updates}_{name}").isNotNull(), value(name, state)).otherwise(result)
        return result

    new = {
        "id_etiqueta": last(lambda c: True, lambda n, s: F.col(f"{updates}_{n}.id_etiqueta"), "id_etiqueta"),
        "estado_identidad": last(lambda c: True, lambda n, s: F.lit(s), "estado_identidad"),
    }
    for physical, concept in result_columns(mapping):
        if physical in columns:
            field = RESULT_COLUMNS[concept]
            new[physical] = last(
                lambda concepts, concept=concept: concept in concepts,
                lambda n, s, field=field: F.col(f"{updates}_{n}.{field}"),
                physical,
            )
    return new


def merge_results(
    source: DataFrame,
    outcomes: Mapping[str, DataFrame],
    mapping: Sequence[MappedColumn],
    steps: Sequence[str] | None = None,
    validated_wins: bool = False,
    row_key: str = "id_hash",
) -> DataFrame:
    """Source with the outcomes applied.

    Steps run in the order of ``STEPS`` and a later one wins, column by column: a step that
    leaves a column alone keeps what an earlier step wrote. ``validated_wins`` applies the validated
    rows last. See ``chosen_rows`` for keys with several result rows.
    """
    order = ordered_steps(outcomes, steps, validated_wins)
    target = with_target_columns(source)
    if not order:
        return target
    chosen = chosen_rows(outcomes, order, row_key)
    joined = left_lookup(target, chosen, row_key, [c for c in target.columns if c != row_key])
    new = assignments(order, mapping, target.columns)
    return joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in target.columns])


def merge_bucketed(
    source: DataFrame,
    outcomes: Mapping[str, DataFrame],
    mapping: Sequence[MappedColumn],
    validated_wins: bool = False,
    row_key: str = "id_hash",
) -> DataFrame:
    """``merge_results`` for tables that are all bucketed alike by the row key (``Sink.buckets``): outcomes and
    source meet bucket by bucket, without an exchange. Rows without a key take no part and pass by."""
    order = ordered_steps(outcomes, None, validated_wins)
    target = with_target_columns(source)
    joined = target
    for outcome in dict.fromkeys(s[1] for s in order):
        # A union of the outcomes would lose their buckets, so each is folded and met by itself.
        chosen = chosen_rows(outcomes, [s for s in order if s[1] == outcome], row_key).withColumnRenamed(row_key, "_key")
        joined = joined.join(chosen, F.col(row_key) == F.col("_key"), "left").drop("_key")
    new = assignments(order, mapping, target.columns)
    return joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in target.columns])


def merge_statement(
    outcomes: Mapping[str, DataFrame],
    mapping: Sequence[MappedColumn],
    table: str,
    columns: Sequence[str],
    validated_wins: bool = False,
    row_key: str = "id_hash",
) -> tuple[DataFrame, Column, dict[str, Column]]:
    """The parts of one row-level merge: the rows to merge (alias ``updates``), the condition on which they meet
    ``table``, and what a met row is set to. The table must have the columns of ``TARGET_COLUMNS``."""
    absent = [c for c in TARGET_COLUMNS if c not in columns]
    if absent:
        raise ValueError(f"the table lacks {absent}; add them first")
    order = ordered_steps(outcomes, None, validated_wins)
    condition = F.col(f"{table}.`{row_key}`") == F.col(f"updates.`{row_key}`")
    return chosen_rows(outcomes, order, row_key).alias("updates"), condition, assignments(order, mapping, columns, table, "updates")


def merge_into(
    outcomes: Mapping[str, DataFrame],
    mapping: Sequence[MappedColumn],
    table: str,
    columns: Sequence[str],
    validated_wins: bool = False,
    row_key: str = "id_hash",
) -> None:
    """Merge the outcomes into a table whose format updates rows in place. For other formats write the result of
    ``merge_results`` to a new place (``plans.run.write_updated``)."""
    updates, condition, new = merge_statement(outcomes, mapping, table, columns, validated_wins, row_key)
    updates.mergeInto(table, condition).whenMatched().update(new).merge()
