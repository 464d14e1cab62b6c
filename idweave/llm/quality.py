"""Quality of documents, from their own text and from the sites they stand on.

Method: hierarchical empirical Bayes. A classifier fitted on labelled texts gives every document evidence of
its own: shares of words of certain shapes, and the mean log-ratio of its byte trigrams (hashed), whose rates in good and bad texts
are learned. For fitting, that ratio is taken from the half of the sample a text is not in, or it would look better than it is. Its posteriors are summed over each path and each host in grouped aggregations; the rate of a host is shrunk
toward the global rate and that of a path toward its host, by as much as a site is sparse. The strength of
the shrinkage is estimated from the spread of the sites' rates (method of moments). A document's final log-odds are
its own plus those by which its path differs from the global rate.

The sums leave the document itself out, so that its evidence does not count twice. Sums are folded before they are
shuffled. Documents meet the table of sites by a broadcast while it is small (its size is checked), otherwise in a join
that adaptive execution can split, so a site may hold a third of all rows.

Null and empty texts have the features of an empty text. A null host or path is a site of its own. Without
labelled rows of both kinds nothing is known: the document evidence is that of the labelled share, 0.5 if there
is none. Repeated rows count as often as they occur. An empty table gives an empty result; further columns stay, whatever their
names, unless these are the names of the result's columns, which they then make way for. Very long texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idweave.llm import linear
from idweave.llm.arrays import Words, chunks, mix
from idweave.runtime import Workspace

#: A document is rejected only if it is likelier than this to be bad.
REJECT = 0.5
#: Bounds of the shrinkage, in documents: how many a site's prior counts for.
PRIOR_RANGE = (10.0, 10_000.0)
#: Words of the blocks whose worst share is a feature beside that of the whole text.
BLOCK = 32
#: Up to so many sites their table (some 100 bytes a row) is sent to all executors; beyond, it is joined by a shuffle.
BROADCAST_SITES = 100_000
#: Trigrams are told apart by so many hash values.
TRIGRAMS = 1 << 12
RESULT = ("doc_quality", "site_quality", "quality", "keep")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER = _table(bytes(range(65, 91)))
LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(0x80, 0x100)]))
DIGIT = _table(b"0123456789")
SYMBOL = _table(b"#$%&*@^~=+<>{}[]_")
PIPE = _table(b"|")
MARK = _table(b"!")


def _per_word(tables: list[np.ndarray], words: Words) -> list[np.ndarray]:
    """For each table the number of a word's bytes that it marks. Counts stand side by side in one number, in fields that hold
    the longest word's length, so the text is summed once for as many tables as there is room for."""
    width = max(1, int((words.end - words.start).max(initial=0)).bit_length())
    room = 63 // width
    out = []
    for i in range(0, len(tables), room):
        group = tables[i : i + room]
        packed = np.zeros(256, np.int64)
        for k, table in enumerate(group):
            packed |= table.astype(np.int64) << (width * k)
        total = np.zeros(len(words.raw) + 1, np.int64)
        # Sums may wrap; differences over a word don't.
        np.cumsum(packed[words.raw], out=total[1:])
        counts = total[words.end] - total[words.start]
        out += [counts >> (width * k) & ((1 << width) - 1) for k in range(len(group))]
    return out


def _shares(flag: np.ndarray, words: Words) -> list[np.ndarray]:
    """Share of a row's words with the flag, and the largest share in any block of words."""
    first = words.first
    n = np.diff(first)
    total = np.zeros(len(flag) + 1)
    np.cumsum(flag, out=total[1:])
    whole = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)
    # Blocks start anew in each row.
    blocks = -(-n // BLOCK)
    row = np.repeat(np.arange(len(n)), blocks)
    at = first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
    end = np.minimum(at + BLOCK, first[row + 1])
    share = (total[end] - total[at]) / np.maximum(end - at, BLOCK // 2)
    most = np.zeros(len(n))
    np.maximum.at(most, row, share)
    return [whole, most]


def _codes(raw: np.ndarray) -> np.ndarray:
    """The hash of the trigram that starts at each byte but the last two."""
    wide = raw.astype(np.uint16)
    code = wide[:-2] * np.uint16(40503)
    code += wide[1:-1] * np.uint16(30011)
    code ^= code >> np.uint16(7)
    code += wide[2:] * np.uint16(52711)
    code >>= np.uint16(16 - 12)
    return code


def trigrams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each row that has a byte trigram, and how often it has each hash."""
    code = _codes(raw)
    for i in np.flatnonzero(np.diff(offsets) > 2):
        yield i, np.bincount(code[offsets[i] : offsets[i + 1] - 2], minlength=TRIGRAMS)


def trigram_ratio(raw: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The mean log-ratio of each row's trigrams; 0 without any."""
    out = np.zeros(len(offsets) - 1)
    for i, counts in trigrams(raw, offsets):
        out[i] = counts @ ratios / (offsets[i + 1] - offsets[i] - 2)
    return out


def features(raw: np.ndarray, offsets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """One row of numbers for each text of a chunk."""
    words = Words(raw, offsets)
    h, n = words.hashes(), np.diff(words.first)
    row = np.repeat(np.arange(len(n)), n)
    letters, upper, symbols, pipes, marks, digits = _per_word([LETTER, UPPER, SYMBOL, PIPE, MARK, DIGIT], words)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    size = words.end - words.start
    flags = [
        (upper > 1) & (upper * 2 > letters),
        symbols > 0,
        pipes > 0,
        marks > 1,
        digits > 0,
        same,
        size > 24,
        size < 4,
    ]
    columns = [c for f in flags for c in _shares(f, words)]
    distinct = np.bincount(np.unique(mix(h, 1) ^ mix(row.astype(np.uint64), 2), return_index=True)[1], minlength=len(h)) if len(h) else np.zeros(0)
    columns.append(_shares(distinct == 0, words)[0])
    columns.append(np.log1p(n))
    columns.append((n < 5).astype(float))
    x = np.stack(columns, axis=1)
    return np.hstack([x, np.sqrt(x[:, : 2 * len(flags)]), trigram_ratio(raw, offsets, ratios)[:, None]])


N_FEATURES = 8 * 2 * 2 + 4


def _fold(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """0 or 1 for each text, by its bytes."""
    total = np.concatenate([[0], np.cumsum(raw.astype(np.int64) * (1 + np.arange(len(raw)) % 251))])
    shifted = total[offsets[1:]] - total[offsets[:-1]] + 7 * np.diff(offsets)
    return (mix(shifted.astype(np.uint64), 3) & np.uint64(1)).astype(np.int64)


def feature_column(text: Column, ratios: np.ndarray) -> Column:
    """``ratios`` has one row, or one for each fold that a text may be in."""

    @F.arrow_udf("array<double>")
    def made(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            parts = []
            for _, raw, offsets in chunks(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
                x = features(raw, offsets, ratios[0])
                if len(ratios) > 1:
                    x[:, -1] = np.where(_fold(raw, offsets) == 0, x[:, -1], trigram_ratio(raw, offsets, ratios[1]))
                parts.append(x)
            x = np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES), pa.array(x.ravel()))

    return made(text)


def _trigram_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each fold and label that a task has: the number of texts, and the sum of their trigram shares."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for part, raw, offsets in chunks(batch, "text"):
            fold, label = _fold(raw, offsets), part.column("label").to_numpy()
            for i, counts in trigrams(raw, offsets):
                total = sums.setdefault((int(fold[i]), int(label[i])), np.zeros(TRIGRAMS))
                total += counts / counts.sum()
    for (fold, label), total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([fold]), pa.array([label]), pa.array([total])], ["fold", "label", "shares"])


def _ratios(sums: np.ndarray) -> np.ndarray:
    """Log-ratio of each trigram between label 1 and the others, from summed shares by label."""
    rate = (sums + 0.5 / TRIGRAMS) / (sums.sum(axis=1, keepdims=True) + 0.5)
    return np.log(rate[1] / rate[0])


@dataclass(frozen=True)
class Model:
    """Weights on standardised features, one column for each class; the log-ratio of each trigram."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    ratios: np.ndarray


def fit(labelled: DataFrame, classes: int = 2) -> Model:
    """``labelled``: a bounded number of rows with ``text`` and an integer ``label`` below ``classes``."""
    sample = Workspace(labelled.sparkSession).store(labelled.select("text", F.col("label").cast("int").alias("label")), "labelled")
    sums = np.zeros((2, 2, TRIGRAMS))
    # One row a task, fold and label, of a sample that is bounded.
    for r in sample.mapInArrow(_trigram_sums, "fold long, label long, shares array<double>").collect():
        sums[r["fold"], int(r["label"] == 1)] += r["shares"]
    crossed = np.stack([_ratios(sums[1]), _ratios(sums[0])])
    rows = sample.select(feature_column(F.col("text"), crossed).alias("x"), "label").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES)
    y = rows["label"].to_numpy()
    mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
    scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(N_FEATURES)
    return Model(mean, scale, linear.fit_dense((x - mean) / scale, y, classes), _ratios(sums.sum(axis=0)))


def posteriors(text: Column, model: Model) -> Column:
    """Probability of each class, as an array."""

    classes = model.weights.shape[1]

    @F.arrow_udf("array<double>")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            out = []
            for _, raw, offsets in chunks(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
                x = (features(raw, offsets, model.ratios) - model.mean) / model.scale
                out.append(linear.softmax(np.hstack([x, np.ones((len(x), 1))]) @ model.weights))
            p = np.concatenate(out) if out else np.zeros((0, classes))
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * classes), pa.array(p.ravel()))

    return scored(text)


def host_of(source: Column) -> Column:
    """The host of a URL; any other text is a site by itself."""
    return F.coalesce(F.nullif(F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")), source)


def path_of(source: Column, other: Column) -> Column:
    """The first step of a URL's path; for other texts ``other``."""
    return F.coalesce(F.nullif(F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1), F.lit("")), other)


def _logit(p: Column) -> Column:
    return F.log(p) - F.log(1 - p)


def _prior_size(n: Column, mean: Column, overall: float) -> Column:
    """Documents that a site's prior counts for: of a beta whose spread is that of the sites' rates, less what
    chance alone makes."""
    variance = overall * (1 - overall)
    spread = F.sum(n * (mean - overall) ** 2) - F.count(F.lit(1)) * variance
    between = F.greatest(spread / F.sum(n), F.lit(1e-9))
    return F.least(F.greatest(variance / between - 1, F.lit(PRIOR_RANGE[0])), F.lit(PRIOR_RANGE[1]))


def score_quality(docs: DataFrame, model: Model, host: Column, path: Column, text: str = "text", reject: float = REJECT) -> DataFrame:
    """``docs`` with ``doc_quality``, ``site_quality`` (the shrunk rate of its path without itself), ``quality`` (both
    combined) and ``keep``. The model is one for two classes, 1 being good."""
    work = Workspace(docs.sparkSession)
    rest = [c for c in docs.columns if c not in RESULT]
    # The evidence is made twice, for the sums and for the result: that costs less than a stored copy of all texts.
    narrow = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), posteriors(F.col(text), model)[1])).alias("_p"), host.alias("_host"), path.alias("_path"))
    paths = narrow.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum("_p").alias("s"))
    paths = work.store(paths, "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    n, total = paths.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("s"), F.lit(0.0))).first()
    overall = min(max((total + 0.5) / (n + 1), 1e-4), 1 - 1e-4)
    host_prior = hosts.agg(_prior_size(F.col("host_n"), F.col("host_s") / F.col("host_n"), overall)).first()[0] or PRIOR_RANGE[1]
    path_prior = paths.agg(_prior_size(F.col("n"), F.col("s") / F.col("n"), overall)).first()[0] or PRIOR_RANGE[1]
    sites = paths.join(hosts.withColumnRenamed("_host", "_h"), F.col("_host").eqNullSafe(F.col("_h")))
    sites = work.store(sites.select(F.col("_host").alias("_h"), F.col("_path").alias("_q"), "n", "s", "host_n", "host_s"), "sites")
    if sites.count() <= BROADCAST_SITES:
        sites = F.broadcast(sites)
    joined = narrow.join(sites, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_q")))
    p = F.col("_p")
    host_rate = (F.col("host_s") - p + host_prior * overall) / (F.col("host_n") - 1 + host_prior)
    path_rate = (F.col("s") - p + path_prior * host_rate) / (F.col("n") - 1 + path_prior)
    final = _logit(p) + _logit(path_rate) - float(np.log(overall / (1 - overall)))
    scored = joined.withColumn("_site", path_rate).withColumn("_quality", 1 / (1 + F.exp(-final)))
    return scored.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in rest],
        p.alias("doc_quality"),
        F.col("_site").alias("site_quality"),
        F.col("_quality").alias("quality"),
        (F.col("_quality") >= 1 - reject).alias("keep"),
    )
