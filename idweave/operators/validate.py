"""Check the names of what was found, and keep the best match of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.functions.normalize import FAMILY, FULL, GIVEN
from idweave.functions.similarity import REGISTRY_NAMES, with_name_score
from idweave.operators.cascade import LABEL, PERSON, ROW
from idweave.operators.joins import left_lookup
from idweave.spec import THRESHOLD

SCORE = "semidifuso"
NAMES = [REGISTRY_NAMES[c] for c in (GIVEN, FAMILY, FULL)]


def registry_names(registry: DataFrame, *more: str) -> DataFrame:
    """Person id and names, the names renamed for use beside pivot columns."""
    renamed = [f"{c} as {REGISTRY_NAMES[c]}" for c in (GIVEN, FAMILY, FULL)]
    return registry.selectExpr(PERSON, *renamed, *more)


def attach_names(matches: DataFrame, names: DataFrame) -> DataFrame:
    """Matches LEFT JOIN registry names on the person id."""
    return left_lookup(matches, names, PERSON, [ROW])


def best_candidate(df: DataFrame, accept: str = "true", score: str = SCORE, by: str = ROW) -> DataFrame:
    """The accepted row with the lowest score of each ``by``; ties go to the lowest person id.

    Ranks are cut to the first one before the shuffle too, so a row with very many candidates sends one
    per task. Accepted rows rank first and are tested after the ranking: a filter below it would make
    the optimizer copy the whole score expression.
    """
    columns = df.columns
    rest = [c for c in columns if c not in (by, score, PERSON)]
    order = [score, PERSON, *[c for c in NAMES if c in rest], *[c for c in rest if c not in NAMES]]
    first = Window.partitionBy(by).orderBy(F.expr(f"not coalesce({accept}, false)"), *order)
    ranked = df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
    return ranked.where(accept).select(*columns)


def validate(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Best accepted match of each pivot row."""
    return best_candidate(scored, f"{SCORE} < {threshold}D").drop(SCORE)


def recovered(matches: DataFrame, validated: DataFrame) -> DataFrame:
    """Distinct matches without the validated ones.

    Pivot columns follow from the row id, so row id, person, label and the attached names
    stand for whole rows.
    """
    keys = [PERSON, LABEL, *NAMES]
    chosen = validated.selectExpr(*[f"{c} as _v_{c}" for c in (ROW, *keys)])
    same = " and ".join([f"{ROW} = _v_{ROW}", *[f"{c} <=> _v_{c}" for c in keys]])
    return matches.join(chosen, F.expr(same), "left_anti").distinct()


def score_matches(matches: DataFrame, parts: bool) -> DataFrame:
    return with_name_score(matches, SCORE, parts)
