"""One table from source to outcomes: the steps around ``link``, and the whole job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from idweave.operators.merge import merge_bucketed, merge_results
from idweave.plans.linkage import LinkageResult, link
from idweave.sources.mapping import (
    MappedColumn,
    linkage_columns,
    load_mapping,
    pending_only,
    project_concepts,
    registry_pruned,
    registry_scope,
    select_job,
    select_job_like,
    with_defaults,
)
from idweave.sources.readers import Source, read, read_pivot, read_registry
from idweave.sources.writers import OUTCOMES, Sink, log_event, read_outcomes, write_results
from idweave.spec import LinkageSpec


def link_table(
    registry: DataFrame,
    source: DataFrame,
    mapping: Sequence[MappedColumn],
    table: str,
    spec: LinkageSpec | None = None,
) -> LinkageResult:
    """Link the pending rows of ``source``. ``spec.columns`` is filled from the mapping."""
    spec = replace(spec or LinkageSpec(columns=()), columns=tuple(linkage_columns(mapping)))
    pivot = project_concepts(pending_only(source), with_defaults(mapping, source.columns), spec.row_key)
    return link(registry_scope(registry, table), pivot, spec)


def updated_source(
    source: DataFrame,
    result: LinkageResult,
    mapping: Sequence[MappedColumn],
    validated_wins: bool = False,
) -> DataFrame:
    """Source with all outcomes applied."""
    outcomes = {name: getattr(result, name) for name in OUTCOMES}
    return merge_results(source, outcomes, mapping, validated_wins=validated_wins)


def write_updated(updated: DataFrame, sink: Sink, name: str) -> None:
    """Write the updated source to a place that does not exist yet: it is computed from the old one, which must
    not be overwritten while it is read."""
    sink.write(updated, name, "errorifexists")


def merge_written(spark: SparkSession, source: DataFrame, mapping: Sequence[MappedColumn], table: str, sink: Sink, validated_wins: bool = False) -> DataFrame:
    """Source with the outcomes that ``write_results`` left in the tables of ``sink``; nothing is linked again.

    With ``sink.buckets``, and a source bucketed alike, source and outcomes meet without an exchange."""
    outcomes = read_outcomes(spark, table, sink)
    merge = merge_bucketed if sink.buckets else merge_results
    return merge(source, outcomes, mapping, validated_wins=validated_wins)


@dataclass(frozen=True)
class Job:
    """A linkage run from control tables to written results.

    ``mapping``   table of mapping rows
    ``control``   table that flags the one table to link; without it ``pattern`` picks the one mapped table
                  whose name matches
    ``source``    where tables to link lie: its ``location`` is a schema or folder, or empty
    ``pruned``    read only the narrow set of registry columns
    ``target``    where the updated source goes, under ``<table><target_suffix>``; None: results only
    ``log``       where the run log ``log_name`` is appended to; None: no log
    """

    registry: Source
    mapping: Source
    source: Source
    results: Sink
    control: Source | None = None
    pattern: str | None = None
    pruned: bool = False
    target: Sink | None = None
    target_suffix: str = "_actualizada"
    log: Sink | None = None
    log_name: str = "log_ratore"
    spec: LinkageSpec | None = None
    validated_wins: bool = False

    def __post_init__(self) -> None:
        if (self.control is None) == (self.pattern is None):
            raise ValueError("a job is picked by a control table or by a name pattern")


def run_job(spark: SparkSession, job: Job) -> dict[str, int]:
    """Select, map, link, write, merge, log. Returns the counts of the run.

    Any failure ends the run: nothing is merged from results that this run did not write, and the
    closing log row is missing."""
    rows = read(spark, job.mapping)
    table = select_job(read(spark, job.control)) if job.control else select_job_like(rows, job.pattern)
    mapping = load_mapping(rows, table)

    def log(stage: str) -> None:
        if job.log:
            log_event(spark, job.log, table, stage, datetime.now(), job.log_name)

    log("inicio")
    registry = read_registry(spark, job.registry)
    if job.pruned:
        registry = registry_pruned(registry)
    place = job.source.location
    joint = "." if job.source.format in ("table", "jdbc") else "/"
    source = read_pivot(spark, replace(job.source, location=f"{place.rstrip('/')}{joint}{table}" if place else table))
    result = link_table(registry, source, mapping, table, job.spec)
    try:
        counts = write_results(result, table, job.results)
        if job.target:
            # The linkage is not run again where the written tables can be read back.
            if job.results.format == "table":
                updated = merge_written(spark, source, mapping, table, replace(job.results, buckets=0), job.validated_wins)
            else:
                updated = updated_source(source, result, mapping, job.validated_wins)
            write_updated(updated, job.target, f"{table}{job.target_suffix}")
    finally:
        result.release()
    log("guardado")
    return counts
