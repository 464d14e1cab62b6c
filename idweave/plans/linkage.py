"""The whole linkage: prepare, exact cascade, validation, fuzzy search, residual by id."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from idweave.functions.normalize import FAMILY, FULL, GIVEN, with_dates, with_full_name, with_initials
from idweave.functions.similarity import has_parts
from idweave.operators.cascade import LABEL, PERSON, ROW, cascade, unmatched, without_people
from idweave.operators.fuzzy import fuzzy_match, searches, used_once
from idweave.operators.residual import not_found, residual_join, residual_matches, score_residual
from idweave.operators.rowid import with_row_id
from idweave.operators.uniqueness import COPIES, at_stage, compact, expand, staged_registry
from idweave.operators.validate import (
    SCORE,
    attach_names,
    registry_names,
    score_matches,
    validate,
)
from idweave.runtime import Workspace
from idweave.spec import FuzzyRule, LinkageSpec, applicable, applicable_fuzzy, usable

PAIR = "_pair"


@dataclass(frozen=True)
class LinkageResult:
    """The four outcomes, what is left of the registry, and the stored tables behind them.

    ``labels`` are those a match can have, ``exact_labels`` those of exact rules; ``unresolved_rows`` is
    the size of ``unresolved``, counted while it was stored. Call ``release`` once the outcomes are written.
    """

    matched: DataFrame
    not_found: DataFrame
    validated: DataFrame
    residual: DataFrame
    deterministic: DataFrame
    unresolved: DataFrame
    registry_left: DataFrame
    work: Workspace
    labels: tuple[str, ...] = ()
    exact_labels: tuple[str, ...] = ()
    unresolved_rows: int = 0

    def release(self) -> None:
        self.work.release()


def prepare_registry(registry: DataFrame, spec: LinkageSpec) -> DataFrame:
    """Registry with person id, initials and typed dates."""
    missing = [c for c in ("p_cedula", GIVEN, FAMILY, FULL) if c not in registry.columns]
    if missing:
        raise ValueError(f"the registry lacks {missing}")
    registry = registry.withColumn(PERSON, F.col("p_cedula").cast("string"))
    return with_initials(with_dates(registry, spec.time_columns))


def prepare_pivot(pivot: DataFrame, registry: DataFrame, spec: LinkageSpec) -> DataFrame:
    """Pivot cut to row id, usable concepts and row key, with names, initials and dates."""
    columns = usable(spec.columns, pivot.columns, registry.columns)
    if not columns:
        raise ValueError("no linkage columns: the mapping yields none that both tables have")
    pivot = with_row_id(pivot.select(*columns, spec.row_key), spec.row_key, spec.row_key_unique, ROW)
    return with_dates(with_initials(with_full_name(pivot)), spec.time_columns)


def index_registry(registry: DataFrame, pivot_columns: list[str], spec: LinkageSpec) -> DataFrame:
    """Registry columns the linkage uses, equal rows folded."""
    rules = applicable(spec.rules, pivot_columns)
    fuzzy = applicable_fuzzy(spec.fuzzy_rules, pivot_columns)
    used = {GIVEN, FAMILY, FULL, *(k for r in rules for k in r.keys), *(k for f in fuzzy for k in (*f.block, *f.names))}
    return compact(registry.select(PERSON, *[c for c in registry.columns if c in used]))


def _named_parts(rule: FuzzyRule, columns: list[str]) -> bool:
    """Whether the pivot has the rule's given names and surnames beside the full name."""
    return has_parts(columns) if rule.names == (GIVEN, FAMILY, FULL) else set(rule.names) <= set(columns)


def _whole_rows(registry: DataFrame, kept: DataFrame) -> DataFrame:
    """Distinct registry rows, with all their columns, whose linkage columns are in ``kept``."""
    renamed = kept.select(*[F.col(c).alias(f"_k_{c}") for c in kept.columns])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in kept.columns])
    return registry.join(renamed, same, "left_semi").distinct()


def link(registry: DataFrame, pivot: DataFrame, spec: LinkageSpec) -> LinkageResult:
    """Find the person of each pivot row.

    ``registry`` and ``pivot`` carry concept names (see ``sources.mapping``). Tables that
    several later steps read are stored once in the shared folder of the session; the
    outcomes are lazy frames over them. A step that fails takes its tables with it.
    """
    work = Workspace(pivot.sparkSession, codec="zstd")  # row ids and names, stored two or three times
    try:
        return _link(registry, pivot, spec, work)
    except Exception:
        work.release()
        raise


def _link(registry: DataFrame, pivot: DataFrame, spec: LinkageSpec, work: Workspace) -> LinkageResult:
    full_registry = prepare_registry(registry, spec)
    rows = prepare_pivot(pivot, full_registry, spec)
    if not spec.row_key_unique:
        rows = work.store(rows, "pivot")
    rules = applicable(spec.rules, rows.columns)
    fuzzy_rules = applicable_fuzzy(spec.fuzzy_rules, rows.columns)
    parts = has_parts(rows.columns)

    index = index_registry(full_registry, rows.columns, spec)
    staged = staged_registry(index, rules, work, spec.null_key_is_duplicate)
    checks = sum(rule.unique for rule in rules)
    left = at_stage(staged, checks)
    source = at_stage(staged, checks if spec.names_from == "shrunk" else 0)
    names = registry_names(source).distinct()

    # Exact cascade, each pair once. Pairs are numbered as they are stored: what is not validated is
    # then found by number, without comparing whole rows.
    found, rest = cascade(staged, rows, rules, work, copies=False)
    work.clean()  # here and below: shuffle files behind stored tables go before the next step writes its own
    scored = score_matches(attach_names(found, names), parts).withColumn(PAIR, F.monotonically_increasing_id())
    scored = work.store(scored, "scored")
    work.clean()
    validated = work.store(validate(scored, spec.threshold), "validated")
    work.clean()
    deterministic = scored.join(validated.select(PAIR), PAIR, "left_anti").drop(SCORE, PAIR)

    if spec.drop_matched:
        left = work.store(without_people(left, scored), "registry_left")

    # Fuzzy search among the rest.
    matched = deterministic
    for i, group in enumerate(searches(fuzzy_rules)):
        both = _named_parts(group[0], rows.columns)
        close = fuzzy_match(left, rest, group, both, spec.threshold, work=work, name=f"search{i}")
        close = work.store(close, f"fuzzy{i}")
        work.drop(f"search{i}_people", f"search{i}_rows", f"search{i}_best")
        work.clean()
        copies = names if spec.drop_matched else expand(registry_names(source, COPIES))
        named = attach_names(close.drop(SCORE), copies)
        matched = matched.unionByName(named.select(*deterministic.columns))
        rest = unmatched(rest, close)
        if spec.drop_matched:
            ranged = close.where(F.col(LABEL).isin([r.label for r in group if r.days > 0]))
            left = left.join(used_once(ranged).select(PERSON), PERSON, "left_anti")

    seen = Observation()
    unresolved = score_residual(residual_join(rest, names), parts).observe(seen, F.count(F.lit(1)).alias("rows"))
    unresolved = work.store(unresolved, "unresolved")
    work.clean()
    # The score is stored, so each outcome ranks and shuffles its own rows only.
    near, far = (unresolved.where(f"{SCORE} {sign} {spec.threshold}D") for sign in ("<", ">="))
    return LinkageResult(
        matched=matched,
        not_found=not_found(far, spec.threshold),
        validated=validated.drop(PAIR),
        residual=residual_matches(near, spec.threshold),
        deterministic=deterministic,
        unresolved=unresolved,
        registry_left=_whole_rows(full_registry, left.drop(COPIES)),
        work=work,
        labels=tuple(dict.fromkeys(r.label for r in (*rules, *fuzzy_rules))),
        exact_labels=tuple(r.label for r in rules),
        unresolved_rows=seen.get["rows"],
    )
