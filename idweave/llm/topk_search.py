"""Exact nearest neighbours by inner product.

Method: distributed histogram selection. Vectors and queries are dealt into cells (block of queries x block of
vectors); every cell scores all its pairs. Round after round the cells count scores in the bins of
each query's interval, the counts are added up, and the interval shrinks to the bin that holds the
k-th best score, until it is one value. Then every score at or above that value is kept and ties go to the
smaller id. A cell reports only what can matter: the bins of its own k best scores, and of equal scores
the k smallest ids, so that many equal vectors cost nothing. Scores are exact integers.

A vector that is null, empty, or holds null or non-finite components takes no part. Rows with the id of a query
are no candidates of it; of rows that repeat a query's id the smallest vector is the query, all rows
are candidates of other queries. Vectors of another length than the query score by their common length.
Null ids take no part. An empty table gives an empty result. Scores that may reach 2**53 are made in whole numbers; an error
is raised where they could reach 2**62. Very long vectors are held whole, a cell of them at a time. Further columns are
left alone, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.runtime import Workspace

#: Rows of a cell: vectors and queries. A cell is all that a task holds at once.
VECTOR_BLOCK = 8192
QUERY_BLOCK = 4096
BINS = 512
SCALE = 256
#: Scores made at once within a cell.
TILE = 1 << 21
#: Marks the query itself; below any score.
NONE = np.iinfo(np.int64).min


def quantized(vector: Column) -> Column:
    """Components as ``floor(SCALE * x)``; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    ok = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))
    return F.when(ok, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


def _scores(vectors: pa.Table, queries: pa.Table, large: bool) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of queries, with their scores against all vectors of the cell and the vectors' ids.

    Sums that stay below 2**53 are exact in floating point; ``large`` ones are made in whole numbers."""
    width = max(max(pa.compute.list_value_length(t["v"]).to_pylist()) for t in (vectors, queries))
    ids = vectors["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    v, ids = _matrix(vectors["v"], width)[order], ids[order]
    q, own = _matrix(queries["v"], width), queries["id"].to_numpy()
    if large:
        v, q = v.astype(np.int64), q.astype(np.int64)
    step = max(1, TILE // len(ids))
    for at in range(0, len(q), step):
        part = slice(at, min(len(q), at + step))
        s = (q[part] @ v.T).astype(np.int64)
        lo = np.searchsorted(ids, own[part], side="left")
        hi = np.searchsorted(ids, own[part], side="right")
        for i in np.flatnonzero(hi > lo):
            s[i, lo[i] : hi[i]] = NONE
        yield part, s, ids


def _kth(s: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each row, or the least."""
    k = min(k, s.shape[1])
    return np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]


def _counts(k: int, large: bool):
    def cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        ids, bins, n = [], [], []
        if vectors.num_rows and queries.num_rows:
            lo, width = queries["lo"].to_numpy(), queries["width"].to_numpy()
            own = queries["id"].to_numpy()
            for part, s, _ in _scores(vectors, queries, large):
                floor = np.maximum(_kth(s, k), lo[part])
                first = lo[part] + (floor - lo[part]) // width[part] * width[part]
                r, c = np.nonzero(s >= first[:, None])
                b = (s[r, c] - lo[part][r]) // width[part][r]
                key, count = np.unique(r * np.int64(1 << 40) + np.minimum(b, (1 << 40) - 1), return_counts=True)
                ids.append(own[part][key >> 40])
                bins.append(key & ((1 << 40) - 1))
                n.append(count)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(ids), "bin": cat(bins), "n": cat(n).astype(np.int64)})

    return cell


def _best(k: int, large: bool):
    def cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            least, own = queries["lo"].to_numpy(), queries["id"].to_numpy()
            for part, s, ids in _scores(vectors, queries, large):
                floor = np.maximum(_kth(s, k), least[part])
                for i in np.flatnonzero(s.max(axis=1) >= floor):
                    at = np.flatnonzero(s[i] >= floor[i])
                    at = at[np.argsort(-s[i, at], kind="stable")][:k]  # ids ascend, so ties keep the smaller
                    out.append((np.full(len(at), own[part][i]), ids[at], s[i, at]))
        cat = lambda j: np.concatenate([x[j] for x in out]) if out else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(0), "vec_id": cat(1), "score": cat(2)})

    return cell


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query, fewer if there are fewer."""
    if k < 1:
        raise ValueError("k is 1 or more")
    work = Workspace(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("id"), quantized(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = work.store(rows.where("id is not null and v is not null"), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, n_queries, far = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max(norm)).first()
    blocks = max(1, math.ceil(n / VECTOR_BLOCK))
    query_blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    reach = math.ceil((far or 0) * (1 + 1e-9)) + 1  # no score is larger or smaller than this
    if reach >= 1 << 62:
        raise ValueError("scores could reach 2**62: scale the vectors down")
    large = reach >= 1 << 53
    deal = lambda c, salt, of: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(of))
    dealt = rows.withColumn("vb", deal(F.monotonically_increasing_id(), 1, blocks).cast("int"))
    dealt = dealt.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).select("qb", "vb", "id", "v")
    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("qb", deal(F.col("id"), 2, query_blocks).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def cells(bounds: DataFrame, function, schema: str) -> DataFrame:
        asked = bounds.withColumn("vb", copies)
        return dealt.groupBy("qb", "vb").cogroup(asked.groupBy("qb", "vb")).applyInArrow(function, schema)

    width = max(1, math.ceil((2 * reach + 1) / BINS))
    bounds = queries.withColumns({"lo": F.lit(-reach).cast("long"), "width": F.lit(width).cast("long")})
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    step = 0
    while True:
        counts = cells(bounds, _counts(k, large), "query_id long, bin long, n long")
        summed = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        # The first bin from above that brings the count to k; the last of all if none does.
        found = summed.withColumn("upto", F.sum("n").over(down)).groupBy("query_id").agg(
            F.coalesce(F.max(F.when(F.col("upto") >= k, F.col("bin"))), F.min("bin")).alias("bin")
        )
        narrower = max(1, math.ceil(width / BINS))
        bounds = bounds.join(found.withColumnRenamed("query_id", "id"), "id").select(
            "id", "v", "qb", (F.col("lo") + F.col("bin") * F.col("width")).alias("lo"), F.lit(narrower).cast("long").alias("width")
        )
        bounds = work.store(bounds, f"bounds{step}")
        step += 1
        if width == 1:
            break
        width = narrower
    kept = cells(bounds.drop("width"), _best(k, large), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
