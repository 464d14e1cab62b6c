"""Small linear models, fitted on a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on, at most. The rest of the corpus is only scored.
MAX_TRAIN = 6000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, rows: int = MAX_TRAIN, id: str = "doc_id") -> DataFrame:
    """At most ``rows`` documents with their ``label``, spread evenly by a hash of the id. Rows of one
    id with unlike labels count as the larger one; rows without id or label are left out.

    The chosen ids are ``rows`` at most, so this side of the join may be sent to all executors."""
    known = labels.select(F.col(id).alias("_id"), label.alias("label")).where("_id is not null and label is not null")
    known = known.groupBy("_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return docs.join(F.broadcast(chosen), docs[id] == chosen["_id"]).drop("_id")


def fit_dense(x: np.ndarray, y: np.ndarray, classes: int = 2, ridge: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Softmax regression with a last row of intercepts, by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    target = np.eye(classes)[y]
    w = v = np.zeros((x.shape[1], classes))
    if not len(x):
        return w
    step = 2 / (np.linalg.norm(x.T @ x / len(x), 2) + ridge)
    for k in range(steps):
        grad = x.T @ (softmax(x @ v) - target) / len(x) + ridge * v
        after = v - step * grad
        w, v = after, after + k / (k + 3) * (after - w)
    return w


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_sparse(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, n_cols: int, ridge: float = 3e-5, steps: int = 1000) -> tuple[np.ndarray, float]:
    """Logistic regression over entries ``(row, column, value)``: weights and intercept."""
    n = max(1, len(y))
    base = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    size = np.bincount(rows, values**2, minlength=n) + 1
    step = 1 / (0.25 * np.percentile(size, 99) + ridge)
    w = v = np.zeros(n_cols + 1)
    for k in range(steps):
        z = base + v[-1] + np.bincount(rows, values * v[cols], minlength=n)
        error = (sigmoid(z) - y) / n
        grad = np.append(np.bincount(cols, values * error[rows], minlength=n_cols), error.sum())
        after = v - step * (grad + ridge * np.append(v[:-1], 0))
        w, v = after, after + k / (k + 3) * (after - w)
    return w[:-1], float(base + w[-1])
