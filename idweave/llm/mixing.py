"""Rates at which documents are taken so that the corpus has wanted shares of domains.

Method: soft-membership mixing. A classifier fitted on the table of labels gives each document a posterior
over domains; its tokens count for each domain by that share. Nonnegative rates of documents are fitted by projected
gradient steps on the squared distance between the expected tokens of the domains and their targets, from rates of 1.

Every step is one aggregation over narrow rows. A document's rate follows from its posterior and the steps'
gradients (one number for each domain), so no rates are stored between steps and a lost executor costs a re-read. With each domain
scaled by its own mass and each document by its tokens the steps have a length of 1.

The total of tokens stays: the targets are shares of it. Targets that no rates can reach are met as nearly as least
squares can. A domain without mass can't be filled and is left out. Null and empty texts have no tokens; they
keep the rate that their posterior gives. Repeated rows count as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.runtime import Workspace

STEPS = 60
#: The steps end when no domain's share is off its target by more, or when shares change by less than a tenth of it.
TOLERANCE = 1e-4


def rate_column(posterior: Column, gradients: list[np.ndarray]) -> Column:
    """The rate after these steps."""
    rate = F.lit(1.0)
    for g in gradients:
        down = sum((posterior[k] * float(g[k]) for k in range(1, len(g))), posterior[0] * float(g[0]))
        rate = F.greatest(F.lit(0.0), rate - down)
    return rate


def fit_gradients(rows: DataFrame, targets: list[float], steps: int = STEPS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """``rows`` (stored) has ``tokens`` and ``posterior``, an array as long as ``targets``. The gradients of
    the steps, and the shares of the domains before each of them."""
    k = len(targets)
    if not k or min(targets) < 0 or not sum(targets):
        raise ValueError("targets are nonnegative and not all zero")
    wanted = np.array(targets) / sum(targets)

    def masses(gradients: list[np.ndarray]) -> np.ndarray:
        rate = rate_column(F.col("posterior"), gradients)
        taken = rows.select(*[(F.col("tokens") * F.col("posterior")[i] * rate).alias(f"d{i}") for i in range(k)])
        return np.array(taken.agg(*[F.coalesce(F.sum(f"d{i}"), F.lit(0.0)) for i in range(k)]).first(), float)

    start = masses([])
    total = start.sum()
    if not total:
        return [], [start]
    known = start > 0
    wanted = np.where(known, wanted, 0)
    wanted = wanted / wanted.sum() if wanted.sum() else start / total
    gradients: list[np.ndarray] = []
    mass, history = start, [start / total]
    for _ in range(steps):
        off = mass / total - wanted
        if np.abs(off).max() <= TOLERANCE:
            break
        gradients.append(np.where(known, off * total / np.where(known, start, 1), 0))
        mass = masses(gradients)
        history.append(mass / total)
        if np.abs(history[-1] - history[-2]).max() <= TOLERANCE / 10:
            break
    return gradients, history


def copies_column(rate: Column, id: Column) -> Column:
    """Whole copies whose mean is the rate: the fraction is decided by a hash of the id."""
    chance = F.pmod(F.xxhash64(id, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, posterior: Column, targets: list[float], tokens: Column | None = None, id: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, tokens, posterior, rate, copies`` of all documents, after the columns named by ``carry``."""
    work = Workspace(docs.sparkSession)
    tokens = word_tokens(F.col("text")) if tokens is None else tokens
    rows = work.store(docs.select(*[c for c in carry if c != id], F.col(id), tokens.alias("tokens"), posterior.alias("posterior")), "posteriors")
    gradients, _ = fit_gradients(rows, targets)
    rate = rate_column(F.col("posterior"), gradients)
    return rows.withColumn("rate", rate).withColumn("copies", copies_column(F.col("rate"), F.col(id)))
