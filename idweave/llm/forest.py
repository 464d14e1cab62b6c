"""Approximate nearest neighbours by cosine.

Method: a forest of random-projection trees. Every inner node holds a random unit direction and the median, on the
node's part of a sample, of the vectors' projections on it. The trees are fitted on a bounded sample; all vectors are then passed
down all of them, so every row is in one leaf of each tree. A query searches the trees through one shared priority queue:
the node whose half-spaces the query violates least is opened first, whichever its tree, and leaves are taken until they hold
the share of all vectors that the search needs. The candidates of the taken leaves are ranked again by their exact cosine.

That share is measured and not guessed: queries of the sample are compared with all of the sample, and the share is the one at which
``recall`` of their true neighbours are in taken leaves. On the whole table neighbours are nearer than in a sample,
so the share is on the safe side. Vectors without structure need a large share of everything; clustered ones a few leaves.

Neighbouring leaves are packed into cells of about ``CELL`` vectors, larger leaves are dealt into several, and a cell that very many
queries ask is copied for blocks of them: what a task holds is bounded, however uneven the leaves.
Equal vectors are one entry with their ``k + 1`` smallest ids, which are all that a search can return, so a vector that a third of all
rows share costs no more than another.

A vector that is null, empty or zero, or holds null or non-finite components takes no part; neither does a null id. Shorter vectors
are taken to end in zeros, so all have the length of the longest. Rows with the id of a query are no candidates of it; of rows
that repeat an id the smallest vector counts. Ties go to the smaller id. Further columns are left alone, whatever their names. An
empty table gives an empty result. A vector is at most one block of memory: sample, trees and cells shrink as vectors get longer.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.runtime import Workspace

#: Vectors that trees and share are fitted on, at most; and at most so many numbers.
SAMPLE, SAMPLE_NUMBERS = 16_384, 1 << 22
#: Queries of the sample by which the share is measured.
TRIALS = 256
#: Vectors of a cell, and queries that are compared with a cell at once.
CELL = 4096
SLACK = 1e-9


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of one depth. Nodes of a tree are numbered by level: the children of i are 2i + 1 and 2i + 2."""

    normals: np.ndarray  # tree, inner node, component
    medians: np.ndarray  # tree, inner node
    depth: int

    @property
    def trees(self) -> int:
        return len(self.normals)

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def route(self, units: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(units), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(units), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", units, self.normals[t][node]) > self.medians[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - (self.leaves - 1)
        return out

    def margins(self, units: np.ndarray) -> np.ndarray:
        """Signed distance of each vector from each inner node's plane: vector, tree, node."""
        if not self.depth:
            return np.zeros((len(units), self.trees, 0))
        return np.einsum("qc,tnc->qtn", units, self.normals, optimize=True) - self.medians

    def search(self, margins: np.ndarray, weights: np.ndarray, share: float, sizes: np.ndarray, least: int) -> Iterator[tuple[int, int, float]]:
        """Leaves of one query (tree, leaf, share of all vectors that is taken before it), best first.

        All trees wait in one queue, ordered by the squares of the distances by which the query lies outside of a node's
        half-spaces. It ends when leaves with ``share`` of all vectors (``weights``: each leaf's) are taken, and one tree alone
        has given ``least`` vectors (``sizes``)."""
        queue: list[tuple[float, int, int]] = [(0.0, t, 0) for t in range(self.trees)]
        inner, taken, own = self.leaves - 1, 0.0, [0] * self.trees
        while queue and (taken < share or max(own) < least):
            outside, t, node = heapq.heappop(queue)
            while node < inner:
                m = float(margins[t, node])
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (outside + m * m, t, 4 * node + 3 - near))
                node = near
            leaf = node - inner
            yield t, leaf, taken
            taken += float(weights[t, leaf])
            own[t] += int(sizes[t, leaf])


def fit_forest(units: np.ndarray, depth: int, trees: int, seed: int = 0) -> Forest:
    """Trees over a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    width, inner = units.shape[1], (1 << depth) - 1
    normals, medians = rng.standard_normal((trees, inner, width)), np.zeros((trees, inner))
    normals /= np.linalg.norm(normals, axis=2, keepdims=True)
    for t in range(trees):
        parts = {0: np.arange(len(units))}
        for node in range(inner):
            rows = parts.pop(node)
            p = units[rows] @ normals[t, node]
            medians[t, node] = np.median(p) if len(p) else 0.0
            side = p > medians[t, node]
            parts[2 * node + 1], parts[2 * node + 2] = rows[~side], rows[side]
    return Forest(normals, medians, depth)


def needed_share(forest: Forest, units: np.ndarray, k: int, recall: float) -> float:
    """The share of all vectors whose leaves must be searched to meet ``recall`` of the ``k`` nearest neighbours within the sample."""
    n = len(units)
    if n < 2 or not forest.depth:
        return float(forest.trees)
    leaves = forest.route(units)
    sizes = np.stack([np.bincount(leaves[:, t], minlength=forest.leaves) for t in range(forest.trees)])
    k, needs = min(k, n - 1), []
    for q in np.linspace(0, n - 1, min(TRIALS, n)).astype(int):
        s = units @ units[q]
        s[q] = -np.inf
        true = np.argpartition(-s, k - 1)[:k]
        before = np.zeros((forest.trees, forest.leaves))
        for t, leaf, taken in forest.search(forest.margins(units[q : q + 1])[0], sizes / n, math.inf, sizes, 0):
            before[t, leaf] = taken
        needs.append(before[np.arange(forest.trees), leaves[true]].min(axis=1))
    return float(np.quantile(np.concatenate(needs), recall, method="higher")) + 1 / n


def usable(vector: Column) -> Column:
    """Components as doubles; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    some = F.exists(vector, lambda x: x != 0)
    ok = vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(some, F.lit(False))
    return F.when(ok, F.transform(vector, lambda x: x.cast("double")))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, each scaled by a power of two so that squares neither overflow nor vanish."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(start, lengths)] = flat
    _, exponent = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -exponent[:, None])


def _units(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, the same for equal pairs wherever they stand."""
    norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / norms


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """``v, ids``: distinct vectors with their ``k + 1`` smallest ids."""
    by_id = Window.partitionBy("v").orderBy("id")
    first = rows.select("id", "v").withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _routed(forest: Forest, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = forest.route(_units(_matrix(batch.column("v"), width)))
                ends = pa.array(np.arange(0, leaves.size + 1, forest.trees, dtype=np.int32))
                found = pa.ListArray.from_arrays(ends, pa.array(leaves.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("ids"), found], ["v", "ids", "leaves"])

    return run


def _cells(sizes: np.ndarray, cell: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each leaf its first cell and the number of cells it is dealt into; and the number of all cells.

    Leaves of a tree that follow each other share a cell while it has room."""
    first, slices, at = np.zeros(sizes.shape, np.int64), np.ones(sizes.shape, np.int64), 0
    for t, tree in enumerate(sizes):
        filled = 0
        for leaf, size in enumerate(tree):
            if filled and filled + size > cell:
                at, filled = at + 1, 0
            first[t, leaf], slices[t, leaf] = at, max(1, -(-int(size) // cell))
            if slices[t, leaf] > 1:
                at, filled = at + int(slices[t, leaf]), 0
            else:
                filled += int(size)
        at += 1 if filled else 0
    return first, slices, at + 1


def _searched(forest: Forest, width: int, sizes: np.ndarray, first: np.ndarray, slices: np.ndarray, share: float, least: int):
    """For each query and cell that it asks: the vector and the tree-leaf numbers it asks there."""
    weights = sizes / max(1, int(sizes[0].sum()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            step = max(1, (1 << 22) // max(1, forest.normals.shape[0] * forest.normals.shape[1]))
            for at in range(0, batch.num_rows, step):
                part = vectors.slice(at, step)
                margins = forest.margins(_units(_matrix(part, width)))
                rows, cells, leaves = [], [], []
                for i in range(len(part)):
                    asked: dict[int, list[int]] = {}
                    for t, leaf, _ in forest.search(margins[i], weights, share, sizes, least):
                        for s in range(int(slices[t, leaf])):
                            asked.setdefault(int(first[t, leaf]) + s, []).append(t * forest.leaves + leaf)
                    rows += [at + i] * len(asked)
                    cells += asked.keys()
                    leaves += asked.values()
                ids = batch.column("id").take(pa.array(rows, pa.int64()))
                out = [ids, vectors.take(pa.array(rows, pa.int64())), pa.array(cells, pa.int64()), pa.array(leaves, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(out, ["id", "v", "cell", "asked"])

    return run


def _ranked(width: int, k: int):
    """The k best candidates of each query among the leaves it asks in a cell."""

    def cell(members: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        own = queries["id"].to_numpy()
        if members.num_rows and queries.num_rows:
            m, q = _matrix(members["v"], width), _matrix(queries["v"], width)
            mu, qu = _units(m), _units(q)
            asked = queries["asked"].combine_chunks()
            who = np.repeat(np.arange(len(q)), asked.value_lengths().to_numpy(zero_copy_only=False))
            what, home = asked.flatten().to_numpy(zero_copy_only=False), members["leaf"].to_numpy()
            for leaf in np.unique(home):
                at, asking = np.flatnonzero(home == leaf), who[what == leaf]
                if not len(asking):
                    continue
                s = qu[asking] @ mu[at].T
                # One more than k, for the query itself; the slack covers rounding, the exact score decides.
                j = min(k + 1, len(at))
                floor = np.partition(s, len(at) - j, axis=1)[:, len(at) - j] - SLACK
                r, c = np.nonzero(s >= floor[:, None])
                found.append((asking[r], at[c]))
        if not found:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        r, c = (np.concatenate([x[j] for x in found]) for j in (0, 1))
        score = np.concatenate([_cosines(q[r[i : i + 65536]], m[c[i : i + 65536]]) for i in range(0, len(r), 65536)])
        ids = members["ids"].combine_chunks()
        copies = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(copies)])[:-1]
        n = copies[c]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[c], n)
        vec, r, score = ids.flatten().to_numpy(zero_copy_only=False)[at], np.repeat(r, n), np.repeat(score, n)
        other = vec != own[r]
        vec, r, score = vec[other], r[other], score[other]
        order = np.lexsort((vec, -score, r))
        vec, r, score = vec[order], r[order], score[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        best = rank < k
        return pa.table({"query_id": own[r[best]], "vec_id": vec[best], "score": score[best]})

    return cell


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, recall: float = 0.97, trees: int = 4, leaf: int = 128, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, fewer if there are fewer candidates.

    ``recall`` is what the search aims at, ``leaf`` the number of vectors of a leaf as long as the sample is large enough to part them."""
    if k < 1 or trees < 1 or leaf < 1 or not 0 < recall <= 1:
        raise ValueError("k, trees and leaf are 1 or more, recall is above 0 and at most 1")
    work = Workspace(vectors.sparkSession)
    rows = vectors.select(F.col(id).cast("long").alias("id"), usable(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = work.store(rows.where("id is not null and v is not null"), "vectors")
    if not rows.groupBy("id").count().where("count > 1").isEmpty():
        rows = work.store(rows.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")), "single")
    entries = work.store(_entries(rows, k), "entries")
    n, width = entries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))

    # A sample by hash: about as many as are wanted, and no more than are allowed.
    wanted = max(2, min(SAMPLE, SAMPLE_NUMBERS // width))
    drawn = entries.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < min(1 << 30, math.ceil(1.1 * wanted / n * (1 << 30)) + 1))
    drawn = drawn.select("v").limit(wanted).toArrow()
    sample = _units(_matrix(drawn["v"], width)) if drawn.num_rows else np.zeros((0, width))
    depth = max(0, min(math.ceil(math.log2(max(1, n / leaf))), int(math.log2(max(1, len(sample) / 8))), int(math.log2(SAMPLE_NUMBERS / trees / width + 1))))
    forest = fit_forest(sample, depth, trees if depth else 1)
    share = needed_share(forest, sample, k, recall)

    routed = work.store(entries.mapInArrow(_routed(forest, width), "v array<double>, ids array<bigint>, leaves array<int>"), "routed")
    place = F.posexplode("leaves").alias("tree", "leaf")
    sizes = np.zeros((forest.trees, forest.leaves), np.int64)
    for r in routed.select(place).groupBy("tree", "leaf").count().collect():  # trees x leaves at most, both bounded
        sizes[r["tree"], r["leaf"]] = r["count"]
    cell = max(1, min(CELL, SAMPLE_NUMBERS // width))
    first, slices, _ = _cells(sizes, cell)

    table = [(t * forest.leaves + x, int(first[t, x]), int(slices[t, x])) for t in range(forest.trees) for x in range(forest.leaves)]
    places = F.broadcast(vectors.sparkSession.createDataFrame(table, "leaf int, cell long, slices long"))
    members = routed.select("v", "ids", place).withColumn("leaf", (F.col("tree") * forest.leaves + F.col("leaf")).cast("int")).join(places, "leaf")
    members = members.select((F.col("cell") + F.pmod(F.xxhash64(F.col("ids")[0]), F.col("slices"))).alias("cell"), "leaf", "v", "ids")

    search = _searched(forest, width, sizes, first, slices, share, k + 1)
    queries = rows.where("q").select("id", "v").repartition(4 * vectors.sparkSession.sparkContext.defaultParallelism, "id")
    asked = work.store(queries.mapInArrow(search, "id long, v array<double>, cell long, asked array<int>"), "asked")
    blocks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / cell).cast("long").alias("blocks"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    copies = members.join(blocks, "cell").select("cell", block, "leaf", "v", "ids")
    dealt = asked.join(blocks, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "v", "asked")
    found = copies.groupBy("cell", "block").cogroup(dealt.groupBy("cell", "block")).applyInArrow(_ranked(width, k), "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
