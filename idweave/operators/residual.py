"""What is left: the bare id decides together with the names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.functions.similarity import with_name_score
from idweave.operators.cascade import LABEL, PERSON
from idweave.operators.validate import SCORE, attach_names, best_candidate
from idweave.spec import LABEL_NOT_FOUND, LABEL_RESIDUAL, THRESHOLD


def residual_join(pivot: DataFrame, names: DataFrame) -> DataFrame:
    """Pivot with its own id taken as the person, and the names of that person if known."""
    own = F.col("p_cedula") if "p_cedula" in pivot.columns else F.lit(None)
    columns = [c for c in pivot.columns if c != PERSON]
    return attach_names(pivot.select(own.cast("string").alias(PERSON), *columns), names)


def _settle(scored: DataFrame, accepted: str, label: str) -> DataFrame:
    best = best_candidate(scored, accepted)
    return best.select(*[c for c in scored.columns if c != SCORE], F.lit(label).alias(LABEL), SCORE)


def residual_matches(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return _settle(scored, f"{SCORE} < {threshold}D", LABEL_RESIDUAL)


def not_found(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return _settle(scored, f"{SCORE} >= {threshold}D", LABEL_NOT_FOUND)


def score_residual(joined: DataFrame, parts: bool) -> DataFrame:
    return with_name_score(joined, SCORE, parts)
