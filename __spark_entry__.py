"""

All queries run over the whole registry and pivot tables that ``linkage_fixtures`` derives
from ``customer`` and ``orders``.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import linkage_fixtures as fixtures  # noqa: E402
import linkage_oracles as oracles  # noqa: E402
from idweave.functions import normalize, similarity  # noqa: E402
from idweave.operators import cascade as casc  # noqa: E402
from idweave.operators import fuzzy, merge, report, residual, uniqueness, validate  # noqa: E402
from idweave.operators.rowid import with_row_id  # noqa: E402
from idweave.plans.linkage import LinkageResult, link, prepare_pivot, prepare_registry  # noqa: E402
from idweave.plans.run import merge_written  # noqa: E402
from idweave.runtime import Workspace  # noqa: E402
from idweave.sources import mapping as mapped  # noqa: E402
from idweave.sources.writers import OUTCOMES, Sink  # noqa: E402
from idweave.spec import FUZZY_RULES, RULES, FuzzyRule, LinkageSpec, Rule  # noqa: E402

try:
    import corpus_pipeline
    from idweave.llm import queries as llm
except ImportError as missing:
    print(f"training-data queries left out: {missing}", file=sys.stderr)
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
NAMES = similarity.REGISTRY_NAMES
REG_NAMES = list(NAMES.values())

# The fixture's row key is unique by construction (one row per order), so single-operator
# queries use it as it is. ``n03`` and the two ``j01`` queries take the general path.
KEYED = LinkageSpec(columns=tuple(mapped.linkage_columns(fixtures.MAPPING)), row_key_unique=True)
GENERAL = LinkageSpec(columns=KEYED.columns)


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["p_idr", *[m.concept for m in fixtures.MAPPING], "iniciales"]
    return prepare_registry(fixtures.registry(spark, sf_dir), KEYED).select(*columns)


def _pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mapped.project_concepts(fixtures.pv(spark, sf_dir), fixtures.MAPPING)
    return prepare_pivot(rows, _registry(spark, sf_dir), KEYED)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# --- sources and normalisation ---------------------------------------------------------


def s03(spark, sf):
    return mapped.project_concepts(fixtures.pv(spark, sf), fixtures.MAPPING)


def s04(spark, sf):
    source = fixtures.pv(spark, sf).select("id_hash", "cedula", "apellidos")
    wanted = [mapped.MappedColumn(c, f"p_{c}") for c in ("cedula", "nombres", "apellidos", "sexo")]
    return mapped.project_concepts(source, mapped.with_defaults(wanted, source.columns))


def s05(spark, sf):
    return mapped.project_concepts(mapped.pending_only(fixtures.pv(spark, sf)), fixtures.MAPPING)


def s06(spark, sf):
    return mapped.registry_scope(fixtures.registry(spark, sf), "rc02_revit_nor")


def s07(spark, sf):
    wide = fixtures.registry(spark, sf).withColumnsRenamed(
        {"p_cedula_mad": "p_identidad_mad", "p_cedula_pad": "p_identidad_pad"}
    )
    return mapped.registry_pruned(wide)


def n03(spark, sf):
    shared = fixtures.pv(spark, sf).select(F.concat(F.lit("k"), F.expr("right(id_hash, 2)")).alias("id_hash"), "sexo")
    ids = with_row_id(shared)
    return ids.groupBy("id_hash").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("p_idp").alias("id_count")
    )


def n05(spark, sf):
    return fixtures.pv(spark, sf).select(
        "id_hash", normalize.full_name(F.col("nombres"), F.col("apellidos")).alias("full_name")
    )


def n06(spark, sf):
    built = normalize.full_name(F.col("nombres"), F.col("apellidos"))
    return fixtures.pv(spark, sf).select(
        "id_hash", normalize.full_name_or(F.col("nombres_apellidos"), built).alias("full_name")
    )


def n07(spark, sf):
    return n06(spark, sf).select("id_hash", normalize.initials(F.col("full_name")).alias("iniciales"))


def n08(spark, sf):
    return fixtures.pv(spark, sf).select("id_hash", normalize.normalize_date(F.col("fecha_nac")).alias("p_fecha_nac"))


# --- exact rules -----------------------------------------------------------------------


def exact(rule: Rule, spark, sf):
    registry = _registry(spark, sf)
    if rule.unique:
        registry = uniqueness.unique_on(registry, rule.keys)
    return casc.match_exact(registry, _pivot(spark, sf), rule.keys, rule.label).drop("p_idp")


def u01(spark, sf):
    return uniqueness.unique_on(_registry(spark, sf), RULES[6].keys)


def u02(spark, sf):
    return uniqueness.ambiguous_on(_registry(spark, sf), RULES[6].keys)


def _cascade(spark, sf):
    """Matches, rest, registry after all uniqueness checks."""
    work = Workspace(spark)
    staged = uniqueness.staged_registry(uniqueness.compact(_registry(spark, sf)), RULES, work)
    matches, rest = casc.cascade(staged, _pivot(spark, sf), RULES, work)
    return matches, rest, uniqueness.at_stage(staged, sum(rule.unique for rule in RULES)), work


def c01(spark, sf):
    return _cascade(spark, sf)[1].drop("p_idp")


def c04(spark, sf):
    registry, rule = _registry(spark, sf), RULES[9]
    return casc.without_people(registry, casc.match_exact(registry, _pivot(spark, sf), rule.keys, rule.label))


def j00(spark, sf):
    return _cascade(spark, sf)[0].drop("p_idp")


# --- names -----------------------------------------------------------------------------


def _truth_pairs(spark, sf):
    """Each pivot row beside the person it was made from."""
    truth = fixtures.pv(spark, sf).selectExpr("id_hash", "truth as p_idr")
    rows = _pivot(spark, sf).join(truth, "id_hash")
    return validate.attach_names(rows, validate.registry_names(_registry(spark, sf)))


def m01(spark, sf):
    grams = similarity.bigrams("p_nombres_apellidos")
    return _registry(spark, sf).selectExpr("p_idr", f"array_join({grams}, '|') as grams")


def m02(spark, sf):
    prepared = similarity.with_grams(_registry(spark, sf), {"g": "p_nombres_apellidos"})
    return prepared.selectExpr(
        "p_idr", "cast(size(g_u) + size(g_x) as bigint) as n_grams", "round(sqrt(g_n2), 6) as norm"
    )


def m03(spark, sf):
    pairs = {"d_nombres": "p_nombres", "d_apellidos": "p_apellidos", "d_full": "p_nombres_apellidos"}
    scored = similarity.with_distance(_truth_pairs(spark, sf), {d: (c, NAMES[c]) for d, c in pairs.items()})
    return _rounded(scored.select("id_hash", "p_idr", *pairs), *pairs)


def m04(spark, sf):
    cosine = similarity.set_cosine("p_nombres_apellidos", "p_nombres_apellidos_reg")
    return _truth_pairs(spark, sf).selectExpr("id_hash", "p_idr", f"round({cosine}, 6) as set_cosine")


def m05(spark, sf):
    w_n, w_a = similarity.name_weights("p_nombres", "p_nombres_reg", "p_apellidos", "p_apellidos_reg")
    return _truth_pairs(spark, sf).selectExpr(
        "id_hash", "p_idr", f"round({w_n}, 6) as w_n", f"round({w_a}, 6) as w_a"
    )


def name_score(parts: bool, spark, sf):
    scored = similarity.with_name_score(_truth_pairs(spark, sf), "semidifuso", parts)
    return _rounded(scored.select("id_hash", "p_idr", "semidifuso"), "semidifuso")


# --- validation, fuzzy search, residual --------------------------------------------------


def v01(spark, sf):
    matches, _, registry, _ = _cascade(spark, sf)
    named = validate.attach_names(matches, validate.registry_names(registry))
    return named.select("p_idr", "id_hash", "id_etiqueta", *REG_NAMES)


def _validated(spark, sf):
    matches, _, registry, work = _cascade(spark, sf)
    named = validate.attach_names(matches, validate.registry_names(registry))
    scored = work.store(validate.score_matches(named, True), "scored")
    return scored.drop(validate.SCORE), work.store(validate.validate(scored), "validated")


def v02(spark, sf):
    return _validated(spark, sf)[1].drop("p_idp")


def v03(spark, sf):
    return validate.recovered(*_validated(spark, sf)).drop("p_idp")


def f01(spark, sf):
    found = fuzzy.fuzzy_block(_registry(spark, sf), _pivot(spark, sf), FUZZY_RULES[0], True)
    return _rounded(found.select("p_idr", "id_hash", "id_etiqueta", "semidifuso"), "semidifuso")


def _ranged(spark, sf):
    return fuzzy.fuzzy_range(_registry(spark, sf), _pivot(spark, sf), FUZZY_RULES[1], True)


def f02(spark, sf):
    return _rounded(_ranged(spark, sf).select("p_idr", "id_hash", "id_etiqueta", "semidifuso"), "semidifuso")


def f03(spark, sf):
    registry, rule = _registry(spark, sf), RULES[4]
    matches = casc.match_exact(registry, _pivot(spark, sf), rule.keys, rule.label)
    scored = validate.score_matches(validate.attach_names(matches, validate.registry_names(registry)), True)
    best = validate.best_candidate(scored)
    return _rounded(best.select("p_idr", "id_hash", "semidifuso"), "semidifuso")


CUSTOM = FuzzyRule(
    "idif_sexo_inicial_fna_30", equal=("p_sexo", "inicial"), days=30, names=("alias_n", "alias_a", "alias_na")
)


def f06(spark, sf):
    """A rule with three block columns and name columns of its own."""

    def own(df):
        aliases = zip(CUSTOM.names, ("p_nombres", "p_apellidos", "p_nombres_apellidos"), strict=True)
        return df.withColumns({a: F.lower(c) for a, c in aliases} | {"inicial": F.substring("p_nombres", 1, 1)})

    found = fuzzy.fuzzy_range(own(_registry(spark, sf)), own(_pivot(spark, sf)), CUSTOM, True)
    return _rounded(found.select("p_idr", "id_hash", "id_etiqueta", "inicial", "semidifuso"), "semidifuso")


def f05(spark, sf):
    """The matches are stored: how often a person occurs and the rows themselves are two readings of them."""
    matches = Workspace(spark).store(_ranged(spark, sf).select("p_idr", "id_hash"), "ranged")
    return fuzzy.used_once(matches).select("p_idr", "id_hash")


def r01(spark, sf):
    joined = residual.residual_join(_pivot(spark, sf), validate.registry_names(_registry(spark, sf)))
    return joined.select("p_idr", "id_hash", *REG_NAMES)


def settled(settle, spark, sf):
    joined = residual.residual_join(_pivot(spark, sf), validate.registry_names(_registry(spark, sf)))
    return _rounded(settle(residual.score_residual(joined, True)), "semidifuso").drop("p_idp")


# --- whole linkage, reports, write-back --------------------------------------------------


def _link(spark, sf, spec: LinkageSpec = KEYED) -> LinkageResult:
    rows = mapped.project_concepts(fixtures.pv(spark, sf), fixtures.MAPPING)
    return link(fixtures.registry(spark, sf), rows, spec)


def _outcomes(result: LinkageResult) -> DataFrame:
    frames = []
    for name in OUTCOMES:
        df = getattr(result, name).withColumn("outcome", F.lit(name)).drop("p_idp")
        score = F.round(F.col("semidifuso").cast("double"), 6) if "semidifuso" in df.columns else F.lit(None)
        frames.append(df.withColumn("semidifuso", score.cast("double")))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def j01(spark, sf):
    return _outcomes(_link(spark, sf, GENERAL))


def j01_full(spark, sf):
    rows = mapped.project_concepts(fixtures.pv_full(spark, sf), fixtures.MAPPING_FULL)
    spec = LinkageSpec(columns=tuple(mapped.linkage_columns(fixtures.MAPPING_FULL)))
    return _outcomes(link(fixtures.registry(spark, sf), rows, spec))


def j02(spark, sf):
    """Matched people leave the registry before the fuzzy stage."""
    return _outcomes(_link(spark, sf, replace(KEYED, drop_matched=True)))


def a01(spark, sf):
    return report.label_counts(validate.recovered(*_validated(spark, sf)))


def a02(spark, sf):
    return report.total(a01(spark, sf))


def a03(spark, sf):
    result = _link(spark, sf)
    return report.outcome_summary(result.matched, result.deterministic, result.unresolved, result.validated)


def w01(spark, sf):
    grown = merge.with_target_columns(fixtures.pv(spark, sf))
    return grown.select("id_hash", "cedula", *merge.TARGET_COLUMNS)


def merged(steps, spark, sf):
    result = _link(spark, sf)
    outcomes = {name: getattr(result, name) for name in OUTCOMES}
    return merge.merge_results(fixtures.pv(spark, sf).drop("truth"), outcomes, fixtures.MAPPING, steps)


def w10(spark, sf):
    """The outcomes written to bucketed tables, the source bucketed alike, and merged from there."""
    result, run = _link(spark, sf), uuid.uuid4().hex
    sink = Sink("table", "", {"path": result.work.path}, buckets=8)
    table = f"w10_{run}_"
    source = fixtures.pv(spark, sf).drop("truth")
    for name, write in ((f"{table}source", source), *((f"{table}{s}", getattr(result, o)) for o, s in OUTCOMES.items())):
        replace(sink, options={"path": f"{result.work.path}/{name}"}).write(write, name, "overwrite")
    return merge_written(spark, spark.read.table(f"{table}source"), fixtures.MAPPING, table, sink)


def w12(spark, sf):
    """Row keys that many rows share: the lowest score, then the lowest person decides."""
    source = fixtures.pv_repeated(spark, sf)
    rows = mapped.project_concepts(source, fixtures.MAPPING)
    result = link(fixtures.registry(spark, sf), rows, GENERAL)
    outcomes = {name: getattr(result, name) for name in OUTCOMES}
    return merge.merge_results(source.drop("truth"), outcomes, fixtures.MAPPING)


def entry(spark: SparkSession) -> DataFrame:
    """Whole linkage on the smallest tables."""
    return j01(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "s03_mapped_projection": s03,
        "s04_missing_defaults": s04,
        "s05_pending_filter": s05,
        "s06_registry_scope": s06,
        "s07_registry_pruned": s07,
        "n03_row_id": n03,
        "n05_full_name": n05,
        "n06_full_name_fallback": n06,
        "n07_initials": n07,
        "n08_normalize_date": n08,
    }
    for i, rule in enumerate(RULES):
        out[f"d{i + 1:02d}_{rule.label}"] = partial(exact, rule)
    out |= {
        "u01_unique_key": u01,
        "u02_ambiguous_key": u02,
        "c01_unmatched": c01,
        "c04_registry_remaining": c04,
        "j00_cascade": j00,
        "m01_bigrams": m01,
        "m02_norm": m02,
        "m03_cosine_distance": m03,
        "m04_set_cosine": m04,
        "m05_name_weights": m05,
        "m06_name_score": partial(name_score, True),
        "m07_full_name_score": partial(name_score, False),
        "v01_attach_names": v01,
        "v02_validated": v02,
        "v03_recovered": v03,
        "f01_fuzzy_block": f01,
        "f02_fuzzy_range": f02,
        "f03_best_candidate": f03,
        "f05_unico": f05,
        "f06_custom_block": f06,
        "r01_residual_join": r01,
        "r02_residuals": partial(settled, residual.residual_matches),
        "r03_not_found": partial(settled, residual.not_found),
        "j01_full_linkage": j01,
        "j01_full_name_pivot": j01_full,
        "j02_drop_matched": j02,
        "a01_label_counts": a01,
        "a02_total": a02,
        "a03_outcome_summary": a03,
        "w01_schema_growth": w01,
        "w03_validated": partial(merged, ["validated"]),
        "w04_not_found": partial(merged, ["not_found"]),
        "w05_recovered": partial(merged, ["recovered"]),
        "w06_recovered_no_names": partial(merged, ["recovered_no_names"]),
        "w07_residual": partial(merged, ["residual"]),
        "w08_residual_no_names": partial(merged, ["residual_no_names"]),
        "w09_merged": partial(merged, None),
        "w10_from_written": w10,
        "w12_repeated_key": w12,
    }
    if llm:
        out |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    out = oracles.all_sql()
    if llm:
        out |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
