"""Exact composite-key matching: one rule, the stepwise cascade, and the single-pass cascade."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.operators.joins import shuffled_join, spread
from idweave.operators.keyfilter import KEY_BITS, key_bitmap, maybe_among
from idweave.operators.uniqueness import COPIES, LAST, expand, stage_of, unique_on
from idweave.runtime import Workspace
from idweave.spec import Rule

LABEL = "id_etiqueta"
PERSON, ROW = "p_idr", "p_idp"


def match_exact(registry: DataFrame, pivot: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Every registry row that agrees on all keys: person id, pivot columns, label."""
    people = registry.select(PERSON, *keys)
    columns = [c for c in pivot.columns if c != PERSON]
    return people.join(pivot.select(*columns), list(keys), "inner").select(
        PERSON, *columns, F.lit(label).alias(LABEL)
    )


def unmatched(pivot: DataFrame, matches: DataFrame) -> DataFrame:
    """Pivot rows that no match used. Row ids are unique, so one narrow key decides."""
    return pivot.join(matches.select(ROW), ROW, "left_anti")


def without_people(registry: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct registry rows whose person was not matched."""
    matched = matches.select(PERSON).distinct().withColumn("_spread", spread(PERSON))
    people = registry.distinct().withColumn("_spread", spread(PERSON))
    return people.join(matched, [PERSON, "_spread"], "left_anti").select(*registry.columns)


def cascade_stepwise(
    registry: DataFrame,
    pivot: DataFrame,
    rules: Sequence[Rule],
    work: Workspace,
    null_key_is_duplicate: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One rule after the other: (matches, rest of the pivot, shrunk registry).

    The plain reading of the cascade. It shuffles both tables for every rule and stores the
    state after each, so it serves as the model the single-pass form is tested against.
    """
    parts = []
    for i, rule in enumerate(rules):
        if rule.unique:
            registry = unique_on(registry, rule.keys, null_key_is_duplicate)
        matches = work.store(match_exact(registry, pivot, rule.keys, rule.label), f"step{i}_matches")
        pivot = work.store(unmatched(pivot, matches), f"step{i}_rest")
        parts.append(matches)
    return reduce(DataFrame.unionByName, parts), pivot, registry


def key_text(columns: Sequence[str]) -> str:
    """One text per key value: one-to-one, null when any part is null."""
    parts = [f"length(cast({c} as string)), ':', cast({c} as string)" for c in columns]
    return f"concat({', '.join(parts)})"


def _unfold_keys(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str], allowed: Sequence[str] = ()) -> DataFrame:
    """One row per rule the row can take part in: kept columns, rule number, key text.

    ``allowed`` gives for each rule a condition on the row, or an empty text."""
    keys = [key_text(rule.keys) for rule in rules]
    keys = [f"if({ok}, {key}, null)" if ok else key for key, ok in zip(keys, allowed or [""] * len(keys), strict=True)]
    entries = [f"named_struct('rule_no', {i}, 'rule_key', {key})" for i, key in enumerate(keys)]
    unfolded = df.selectExpr(*keep, f"inline(array({', '.join(entries)}))")
    return unfolded.where("rule_key is not null")


def registry_keys(registry: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a staged registry unfolded by rule, in one scan; a rule gets the rows that survive its checks."""
    allowed = [f"{LAST} >= {stage}" if stage else "" for stage in stage_of(rules)]
    return _unfold_keys(registry, rules, keep, allowed)


def assign_rules(
    registry: DataFrame, pivot: DataFrame, rules: Sequence[Rule], bits: int = KEY_BITS
) -> DataFrame:
    """Pivot with the number of the first rule that finds anyone (null: none) and its key.

    All rules are tried in one semi join on (rule, key). Only ids and keys travel, keys that the registry
    cannot have stay where they are (``keyfilter``), and a key found many times on the registry side stays
    one row, so no pairs arise before the winning rule is known.
    """
    key = ["rule_no", "rule_key"]
    found = registry_keys(registry, rules)
    tried = maybe_among(_unfold_keys(pivot, rules, [ROW]), key, key_bitmap(found, key, bits), bits)
    found = found.distinct().withColumn("_spread", spread("rule_key"))
    met = shuffled_join(tried.withColumn("_spread", spread("rule_key")), found, [*key, "_spread"], "left_semi")
    first = met.groupBy(ROW).agg(F.min("rule_no").alias("rule_no"))
    return pivot.join(first, ROW, "left")


def matched_pairs(
    registry: DataFrame, assigned: DataFrame, rules: Sequence[Rule], copies: bool = True
) -> DataFrame:
    """All people found by the winning rule of each assigned pivot row.

    ``copies`` = False gives each (row, person) pair once, for callers that want distinct
    matches: the registry side is made distinct before the join, not the wide pairs after it.
    Otherwise folded registry rows are unfolded there too, so that the join runs once.
    """
    keys = " ".join(f"when {i} then {key_text(r.keys)}" for i, r in enumerate(rules))
    labels = ", ".join(f"'{r.label}'" for r in rules)
    columns = [c for c in assigned.columns if c not in (PERSON, "rule_no")]
    won = assigned.where("rule_no is not null").selectExpr("*", f"case rule_no {keys} end as rule_key")
    if copies:
        people = expand(registry_keys(registry, rules, [PERSON, COPIES]))
    else:
        people = registry_keys(registry, rules, [PERSON]).distinct()
    pairs = shuffled_join(won, people, ["rule_no", "rule_key"])
    return pairs.selectExpr(PERSON, *columns, f"element_at(array({labels}), rule_no + 1) as {LABEL}")


def cascade(
    registry: DataFrame, pivot: DataFrame, rules: Sequence[Rule], work: Workspace, copies: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Single-pass cascade: (matches, rest of the pivot).

    ``registry`` comes from ``staged_registry``: what each rule may see of it is known beforehand, so all
    rules can be tried at once.
    """
    if not rules:
        empty = pivot.where(F.lit(False))
        columns = [c for c in pivot.columns if c != PERSON]
        nothing = F.lit(None).cast("string")
        return empty.select(nothing.alias(PERSON), *columns, nothing.alias(LABEL)), pivot
    assigned = work.store(assign_rules(registry, pivot, rules), "assigned")
    rest = assigned.where("rule_no is null").drop("rule_no")
    return matched_pairs(registry, assigned, rules, copies), rest
