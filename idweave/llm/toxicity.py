"""Toxicity of texts, learned from labelled ones.

Method: a linear classifier over character n-grams. Each n-gram that a text contains counts once and is
scaled by its naive Bayes log-count ratio: the logarithm of how much more often it occurs in toxic than
in other labelled texts. Logistic regression weighs the scaled features.

Counts of n-grams come from Spark over the whole labelled sample; the ``MAX_FEATURES`` with the
strongest evidence are kept, which bounds the model. Texts are lower-cased (ASCII and Latin-1) and read whole;
n-grams are of code points, between one line start or blank and the text's end they may hold anything.

Null and empty texts have no n-gram: their score is that of the intercept. Without labelled rows all scores are
0.5; with labels of one kind only they lean to that kind. Rows are scored one by one, so ties, repeated rows, empty tables and further
columns need no rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.llm import linear
from idweave.llm.arrays import LOWER, Ranges, chunks
from idweave.runtime import Workspace

SIZES = (4, 5, 7)
MAX_FEATURES = 20_000
#: Labelled texts in which an n-gram must occur to be a feature.
SUPPORT = 5
SMOOTHING = 0.5
#: Table of the leading bits of the features' hashes, for a quick first look.
BITS = 20


def lowered(raw: np.ndarray) -> np.ndarray:
    """ASCII and two-byte Latin-1 letters in lower case."""
    out = LOWER[raw]
    at = np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = raw[at]
    out[at] = np.where((second >= 0x80) & (second <= 0x9E) & (second != 0x97), second + 0x20, second)
    return out


def ngrams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: the hash of each n-gram of a chunk and the row it belongs to."""
    raw = lowered(raw)
    lead = (raw & 0xC0) != 0x80
    start = np.flatnonzero(lead)
    # A code point's value: its bytes in order. Control characters read as blanks.
    value = np.where(raw[start] < 0x20, 0x20, raw[start]).astype(np.uint64)
    wide = np.flatnonzero(raw[start] >= 0x80)
    if len(wide):
        end = np.append(start[1:], len(raw))
        for k in (1, 2, 3):
            wide = wide[start[wide] + k < end[wide]]
            value[wide] = value[wide] * np.uint64(256) + raw[start[wide] + k]
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes = Ranges(value)
    for n in SIZES:
        h = hashes.windows(n)
        if len(h):
            inside = row[: len(h)] == row[n - 1 :]
            yield h[inside], row[: len(h)][inside]


@dataclass(frozen=True)
class Model:
    """Hashes of the features in order, what each adds to the logit, and the intercept."""

    keys: np.ndarray
    weights: np.ndarray
    intercept: float = 0.0

    def look_up(self) -> np.ndarray:
        table = np.zeros(1 << BITS, bool)
        table[self.keys >> np.uint64(64 - BITS)] = True
        return table

    def hits(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and features, each feature once for a row."""
        found = []
        for h, row in ngrams(raw, offsets):
            near = np.flatnonzero(table[h >> np.uint64(64 - BITS)])
            at = np.searchsorted(self.keys, h[near])
            at[at == len(self.keys)] = 0
            exact = self.keys[at] == h[near]
            found.append(row[near][exact].astype(np.int64) * len(self.keys) + at[exact])
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return both // len(self.keys), both % len(self.keys)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each n-gram of a labelled batch: texts with it, of either label."""
    for batch in batches:
        for part, raw, offsets in chunks(batch, "text"):
            label = part.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            keys, rows = [], []
            for h, row in ngrams(raw, offsets):
                keys.append(h)
                rows.append(row)
            if not keys:
                continue
            h, row = np.concatenate(keys), np.concatenate(rows)
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, toxic = h[once], label[row[once]]
            new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            if len(new):
                n = np.diff(np.append(new, len(h)))
                ones = np.add.reduceat(toxic, new)
                yield pa.RecordBatch.from_pydict({"key": h[new].view(np.int64), "ones": ones, "zeros": n - ones})


def fit(labelled: DataFrame) -> Model:
    """``labelled``: ``text`` and ``label`` (0 or 1), of a bounded number of rows."""
    work = Workspace(labelled.sparkSession)
    rows = work.store(labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label")), "labelled")
    n, n_ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    counts = rows.mapInArrow(_grams, "key long, ones long, zeros long").groupBy("key")
    counts = counts.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).where(F.col("ones") + F.col("zeros") >= SUPPORT)
    ratio = F.log((F.col("ones") + SMOOTHING) / (n_ones + 2 * SMOOTHING)) - F.log((F.col("zeros") + SMOOTHING) / (n - n_ones + 2 * SMOOTHING))
    strength = F.abs("ratio") * F.sqrt(F.least("ones", "zeros") + F.abs(F.col("ones") * (n - n_ones) - F.col("zeros") * n_ones) / max(n, 1))
    chosen = counts.withColumn("ratio", ratio).orderBy(F.desc(strength), "key").limit(MAX_FEATURES).select("key", "ratio").toPandas()
    keys = chosen["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, ratio = keys[order], chosen["ratio"].to_numpy(np.float64)[order]
    if not n or not len(keys):
        return Model(np.zeros(1, np.uint64), np.zeros(1), float(np.log((n_ones + 0.5) / (n - n_ones + 0.5))) if n else 0.0)
    plain = Model(keys, ratio)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plain.look_up()
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                row, feature = plain.hits(raw, offsets, table)
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"label": part.column("label"), "features": lists})

    # A bounded sample with a bounded number of features each.
    sample = rows.mapInArrow(entries, "label int, features array<int>").toArrow()
    y = sample["label"].to_numpy().astype(np.float64)
    features = sample["features"].combine_chunks()
    cols = features.flatten().to_numpy()
    of = np.repeat(np.arange(len(y)), np.diff(features.offsets.to_numpy()))
    weights, intercept = linear.fit_sparse(of, cols, ratio[cols], y, len(keys))
    used = weights != 0
    return Model(keys[used], (weights * ratio)[used], intercept) if used.any() else Model(keys, ratio * 0, intercept)


def score(text: Column, model: Model) -> Column:
    """Between 0 and 1; higher where toxicity is likelier."""

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.look_up()
        for column in texts:
            out = []
            for _, raw, offsets in chunks(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
                row, feature = model.hits(raw, offsets, table)
                out.append(model.intercept + np.bincount(row, model.weights[feature], minlength=len(offsets) - 1))
            yield pa.array(linear.sigmoid(np.concatenate(out)) if out else np.zeros(0))

    return scored(text)
