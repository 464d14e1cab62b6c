"""Registry rows whose key occurs once, without gathering a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.operators.rowid import unfold_copies
from idweave.runtime import Workspace
from idweave.spec import Rule

COPIES, NUMBER, LAST = "copies", "row_no", "last_stage"


def _in_groups(df: DataFrame, columns: Sequence[str], wanted: str) -> DataFrame:
    """Rows whose group, nulls together, has a size ``_n`` as ``wanted``.

    Groups are counted on the map side first, and only their keys come back: the semi join on
    null-safe keys has an exchange of its own on either side, so hot keys stay splittable.
    """
    groups = df.groupBy(*columns).agg(F.expr("count(*) as _n")).where(wanted)
    groups = groups.selectExpr(*[f"{c} as _k_{c}" for c in columns])
    same = " and ".join(f"{c} <=> _k_{c}" for c in columns)
    return df.join(groups, F.expr(same), "left_semi")


def unique_on(df: DataFrame, columns: Sequence[str], null_key_is_duplicate: bool = True) -> DataFrame:
    """Rows alone on their key; nulls in the key group together, or are all kept."""
    if null_key_is_duplicate:
        return _in_groups(df, columns, "_n = 1")
    null_key = " or ".join(f"{c} is null" for c in columns)
    return _in_groups(df.where(f"not ({null_key})"), columns, "_n = 1").unionByName(df.where(null_key))


def ambiguous_on(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row."""
    return _in_groups(df, columns, "_n > 1")


def compact(df: DataFrame) -> DataFrame:
    """Fold equal rows into one, with their number in ``copies``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def expand(df: DataFrame) -> DataFrame:
    """Undo ``compact``."""
    return unfold_copies(df, COPIES, "_copy").drop("_copy")


def staged_registry(
    registry: DataFrame, rules: Sequence[Rule], work: Workspace, null_key_is_duplicate: bool = True
) -> DataFrame:
    """The registry with ``last_stage``: how many uniqueness checks, taken in rule order, each row survives.

    The checks are cumulative: a row dropped by one neither counts nor returns later. How the
    registry shrinks depends on which rules apply and never on pivot rows, so all of it can
    be known before anything is matched. A check moves row numbers and one key, nothing else:
    a group of one *is* its row, so the least row number of the group names it, and a hot or
    null key is one row per task at the shuffle. Survivors are stored after each check (row numbers
    only), so that a lost executor costs one check; they are dropped once the registry is stored.
    ``registry`` comes from ``compact``.
    """
    checks = [rule for rule in rules if rule.unique]
    columns = registry.columns
    if not checks:
        return work.store(registry.withColumn(LAST, F.lit(0)), "registry")
    base = work.store(registry.withColumn(NUMBER, F.monotonically_increasing_id()), "registry0")
    survivors: list[DataFrame] = []
    for i, rule in enumerate(checks):
        rows = base.select(NUMBER, COPIES, *rule.keys)
        if survivors:
            rows = rows.join(survivors[-1], NUMBER, "left_semi")
        null_key = " or ".join(f"{c} is null" for c in rule.keys)
        counted = rows if null_key_is_duplicate else rows.where(f"not ({null_key})")
        groups = counted.groupBy(*rule.keys).agg(F.sum(COPIES).alias("_n"), F.min(NUMBER).alias(NUMBER))
        alone = groups.where("_n = 1").select(NUMBER)
        if not null_key_is_duplicate:
            alone = alone.unionByName(rows.where(null_key).select(NUMBER))
        survivors.append(work.store(alone, f"check{i}"))
    passed = reduce(DataFrame.unionByName, survivors).groupBy(NUMBER).agg(F.count(F.lit(1)).cast("int").alias(LAST))
    staged = base.join(passed, NUMBER, "left").select(*columns, F.coalesce(LAST, F.lit(0)).alias(LAST))
    staged = work.store(staged, "registry")
    work.drop("registry0", *[f"check{i}" for i in range(len(checks))])
    return staged


def at_stage(registry: DataFrame, stage: int) -> DataFrame:
    """The rows of a staged registry that are left after ``stage`` checks."""
    return registry.where(f"{LAST} >= {stage}").drop(LAST)


def stage_of(rules: Sequence[Rule]) -> list[int]:
    """For each rule, the number of checks its registry rows have to survive."""
    passed, out = 0, []
    for rule in rules:
        passed += rule.unique
        out.append(passed)
    return out
