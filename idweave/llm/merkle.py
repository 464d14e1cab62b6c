"""Merkle manifest of a dataset: a root, and for every row a proof that it is under that root.

Method: incremental witnesses. A row's leaf is the hash of its fields. Within a group the leaves, in order, are
appended to a tree whose nodes have ``FAN`` children. An append opens a subtree with an empty witness; whenever the last of a run of siblings is
complete, the witness of every subtree under the run is extended by its siblings. Ranks come from a range
sort, so that the leaves can be dealt into aligned blocks of ``FAN ** height``: each block is appended in a stream by one
task, its root is final, and the block roots of a group are appended as the next round's nodes, again in aligned blocks. The roots of the
groups, in the order of the groups, are appended in the same way. The witness of a leaf is that of its run, then that of
its block's root, and so on up; it is put together by joins on (group, block).

A witness is kept once for each run of siblings and not for each leaf. A block holds ``FAN ** height`` leaves however large its
group is, so no group has to fit into a task.

Null fields are written as ``-``; null text, empty text and any other text thus have unlike leaves. Very long texts are hashed whole by
the scan. Rows that agree on group and order stand in the order of their leaves; rows that agree on all fields are leaves of their
own next to each other. Null groups and null orders come first. Further columns are left alone, whatever their names. A group
of one leaf has it as its root. An empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from idweave.runtime import Workspace

FAN = 8
#: Levels of a block: 4096 leaves.
HEIGHT = 4
#: Hex digits of a hash.
DIGITS = 64

Witness = tuple[list[int], list[str]]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of the fields, each behind its length in bytes, or ``-`` if null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class Tree:
    """A tree under construction: for each level the complete subtrees that wait for their siblings.

    ``runs`` has the witness of each run of leaves, in order: from the run's parent upwards, the place among the siblings and
    the siblings' hashes. The last entries are missing while subtrees are open."""

    def __init__(self) -> None:
        self.open: list[list[tuple[str, list[Witness]]]] = [[]]
        self.runs: list[Witness] = []

    def append(self, leaf: str) -> None:
        self._add(0, leaf, [])

    def _add(self, level: int, node: str, below: list[Witness]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        siblings, self.open[level] = self.open[level], []
        if level == 0:
            witnesses: list[Witness] = [([], [])]
            self.runs += witnesses
        else:
            for place, (_, below) in enumerate(siblings):
                others = "".join(node for j, (node, _) in enumerate(siblings) if j != place)
                for places, texts in below:
                    places.append(place)
                    texts.append(others)
            witnesses = [w for _, below in siblings for w in below]
        self._add(level + 1, digest("".join(node for node, _ in siblings)), witnesses)

    def close(self, height: int | None = None) -> str:
        """The root. Runs that are not full are completed as they are: up to ``height``, or until one node is left."""
        level = 0
        while True:
            waiting = self.open[level] if level < len(self.open) else []
            alone = len(waiting) == 1 and not any(self.open[level + 1 :])
            if alone if height is None else level == height:
                return waiting[0][0]
            if waiting:
                self._complete(level)
            level += 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (g, block) after the other; a block may span batches."""
    held: list[pa.RecordBatch] = []
    key: object = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column("g").to_pylist(), batch.column("block").to_pylist(), strict=True))
        at = 0
        for i in [*[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]:
            if held and key != keys[at]:
                yield pa.Table.from_batches(held)
                held = []
            key = keys[at]
            held.append(batch.slice(at, i - at))
            at = i
    if held:
        yield pa.Table.from_batches(held)


def _appended(height: int, carry: list[str]):
    """One row for each run of leaves of a block; the block's root stands at its first run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            tree, n, size = Tree(), rows.num_rows, rows["size"][0].as_py()
            for leaf in rows["node"].to_pylist():
                tree.append(leaf)
            root = tree.close(None if size <= FAN**height else height)
            first = np.arange(0, n, FAN)
            ends = pa.array(np.append(first, n).astype(np.int32))
            witnesses = tree.runs or [([], [])]
            same = lambda name: pa.repeat(rows[name][0], len(first))
            out = {"g": same("g"), "block": same("block"), "size": same("size"), "first": pa.array(first + rows["pos"][0].as_py())}
            for name in ("node", *carry):
                out[name] = pa.ListArray.from_arrays(ends, rows[name].combine_chunks())
            out["places"] = pa.array([w[0] for w in witnesses], pa.list_(pa.int32()))
            out["siblings"] = pa.array([w[1] for w in witnesses], pa.list_(pa.string()))
            out["root"] = pa.array([root, *[None] * (len(first) - 1)], pa.string())
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def _append_blocks(nodes: DataFrame, height: int, carry: list[str]) -> DataFrame:
    """``nodes`` (``g, pos, size, node`` and ``carry``), each aligned block appended to a tree of its own."""
    kinds = {f.name: f.dataType for f in nodes.schema}
    fields = [("g", kinds["g"]), ("block", LongType()), ("size", LongType()), ("first", LongType()), ("node", ArrayType(StringType()))]
    fields += [(c, ArrayType(kinds[c])) for c in carry]
    fields += [("places", ArrayType(IntegerType())), ("siblings", ArrayType(StringType())), ("root", StringType())]
    dealt = nodes.withColumn("block", F.expr(f"pos div {FAN**height}")).select("g", "block", "pos", "size", "node", *carry)
    dealt = dealt.repartition("g", "block").sortWithinPartitions("g", "block", "pos")
    return dealt.mapInArrow(_appended(height, carry), StructType([StructField(*f) for f in fields]))


def _ranked(nodes: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``nodes`` (``g, o, node`` and more) with ``pos``, their place in their group from 0, and ``size``, that of the group.

    The rows are sorted over ranges and numbered within each; what a range has to add follows from counts."""
    keys = ["g", "o", "node", "tie"]
    stored = work.store(nodes.withColumn("tie", F.monotonically_increasing_id()), f"{name}-nodes")
    ordered = stored.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    ordered = work.store(ordered.withColumn("seq", F.monotonically_increasing_id()), f"{name}-ordered")
    ordered = ordered.withColumn("part", F.shiftright("seq", 33))
    counts = ordered.groupBy("g", "part").agg(F.min("seq").alias("least"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("g")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    counts = counts.select(
        F.col("g").alias("g_"), F.col("part").alias("part_"), (before - F.col("least")).alias("shift"), F.sum("n").over(whole).alias("size")
    )
    placed = ordered.join(counts, F.expr("g <=> g_ and part = part_"))
    return placed.withColumn("pos", F.col("seq") + F.col("shift")).drop("seq", "part", "g_", "part_", "shift")


def _grown(nodes: DataFrame, work: Workspace, name: str, height: int, carry: list[str]) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rounds of runs, from the leaves up, and for each round the roots (``g, node``) of the groups that it completes."""
    rounds, done = [], []
    nodes = _ranked(nodes, work, name)
    while True:
        runs = work.store(_append_blocks(nodes, height, carry), f"{name}-runs{len(rounds)}")
        blocks = F.ceil(F.col("size") / FAN**height).cast("long")
        roots = runs.where("root is not null").select("g", F.col("block").alias("pos"), blocks.alias("size"), F.col("root").alias("node"))
        rounds.append(runs)
        done.append(roots.where("size = 1").select("g", "node"))
        nodes, carry = roots.where("size > 1"), []
        if nodes.isEmpty():
            return rounds, done


def _witnessed(rounds: list[DataFrame], done: list[DataFrame], tops: DataFrame | None, carry: list[str]) -> DataFrame:
    """The leaves of the first round with ``places, siblings`` up to the root, and ``subroot``.

    ``tops`` has the witnesses of the groups' own roots: ``g_, up_places, up_siblings, root``; without it the groups' roots are the end."""
    none = [F.array().cast("array<int>").alias("up_places"), F.array().cast("array<string>").alias("up_siblings")]
    above = None
    for runs, finished in zip(reversed(rounds), reversed(done), strict=True):
        finished = finished.select(F.col("g").alias("g_"), F.lit(0).cast("long").alias("pos_"), F.col("node").alias("subroot"), *none)
        above = finished if above is None else above.unionByName(finished)
        kept = [c for c in carry if c in runs.columns]
        met = runs.drop("root").join(above, F.expr("g <=> g_ and block = pos_"))
        leaves = met.select("*", F.posexplode(F.arrays_zip("node", *kept)).alias("place", "leaf"))
        others = F.array_join(F.filter("node", lambda x, j: j != F.col("place")), "")
        lone = F.col("size") == 1
        own_place = F.when(lone, F.array().cast("array<int>")).otherwise(F.array("place"))
        own = F.when(lone, F.array().cast("array<string>")).otherwise(F.array(others))
        above = leaves.select(
            F.col("g").alias("g_"), (F.col("first") + F.col("place")).alias("pos_"), "subroot",
            F.concat(own_place, "places", "up_places").alias("up_places"), F.concat(own, "siblings", "up_siblings").alias("up_siblings"),
            *([F.col("leaf.node").alias("node"), *[F.col(f"leaf.{c}").alias(c) for c in kept]] if runs is rounds[0] else []),
        )
    leaves = above.select(
        F.col("g_").alias("g"), F.col("pos_").alias("pos"), "node", *carry, "subroot", F.col("up_places").alias("places"), F.col("up_siblings").alias("siblings")
    )
    if tops is None:
        return leaves
    joined = leaves.join(tops, F.expr("g <=> g_"))
    return joined.select(
        "g", "pos", "node", *carry, "subroot", "root",
        F.concat("places", "up_places").alias("places"), F.concat("siblings", "up_siblings").alias("siblings"),
    )


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, also: Mapping[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """For each row: ``group, order, position, leaf, subroot, root, places, siblings`` and the columns ``also``.

    ``places`` and ``siblings`` are the row's proof, one entry for each level: the row's place among its siblings, and their
    hashes from left to right as one text. ``position`` counts the rows of a group from 0."""
    work = Workspace(docs.sparkSession)
    extra = F.struct(*[c.alias(name) for name, c in (also or {}).items()], F.lit(None).cast("string").alias("_"))
    nodes = docs.select(F.col(group).alias("g"), F.col(order).alias("o"), leaf_hash([F.col(f) for f in fields]).alias("node"), extra.alias("also"))
    carry = ["o", "also"]
    rounds, done = _grown(nodes, work, "rows", height, carry)
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    whole = subroots.select(F.lit(0).alias("g"), F.col("g").alias("o"), "node")
    top_rounds, top_done = _grown(whole, work, "groups", height, ["o"])
    tops = _witnessed(top_rounds, top_done, None, ["o"]).select(
        F.col("o").alias("g_"), F.col("places").alias("up_places"), F.col("siblings").alias("up_siblings"), F.col("subroot").alias("root")
    )
    rows = _witnessed(rounds, done, work.store(tops, "tops"), carry)
    return rows.select(
        F.col("g").alias("group"), F.col("o").alias("order"), F.col("pos").alias("position"), F.col("node").alias("leaf"),
        "subroot", "root", "places", "siblings", *[F.col(f"also.{name}").alias(name) for name in also or {}],
    )


def folded(leaf: Column, places: Column, siblings: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def parent(node: Column, level: Column) -> Column:
        at = level["places"] * DIGITS
        return F.sha2(F.concat(F.substring(level["siblings"], F.lit(1), at), node, F.substring(level["siblings"], at + 1, F.length(level["siblings"]))), 256)

    return F.aggregate(F.arrays_zip(places.alias("places"), siblings.alias("siblings")), leaf, parent)


def proof_digest(siblings: Column) -> Column:
    return F.sha2(F.array_join(siblings, ""), 256)
