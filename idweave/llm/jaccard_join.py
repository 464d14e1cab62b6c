"""Documents with nearly the same n-grams.

Method: size-banded tiles with bitmap signatures. Documents are grouped by their set of word n-grams into classes of
equal sets, and classes by size into bands, such that two sets that may link are in one band or in bands
next to each other. Within a band the n-grams are dealt by hash into more parts than linked sets can differ in n-grams, so
linked sets agree in a part: a tile is all sets of a band that agree in one part. Empty parts make no tile where a set fills
more parts than it can differ in, as it then agrees with what it links to in a part that is not empty. In each tile the set bits of hashed
bitmaps bound the overlap of two sets from above; what passes is decided by intersecting their sorted arrays.

Only the components of links are wanted, so a tile is no source of all pairs. First each set is held against the first and the
last of its tile. Tiles that hold sets of more than one component after that are compared in full, in blocks of ``BLOCK`` rows, between
components only. A set is sent to its block once, and once more for each further block of its tile, with its bitmap folded to a
quarter; each pair that passes is held against the whole bitmaps and then decided exactly. So no link
between different components is lost, and a group of near copies of any size costs about one comparison each.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. With fewer words than ``n`` the whole sequence is one n-gram.
Without words, or with a null text, a document has no n-gram and is linked with nothing. N-grams are 64-bit
hashes, equal sets are told by 128 bits. Rows without id get no component. Rows that share an id are separate
rows. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.llm import rows
from idweave.llm.arrays import Words, chunks, mix, shingles
from idweave.llm.components import connected
from idweave.operators.keyfilter import key_bitmap, maybe_among
from idweave.runtime import Workspace

#: Rows of a block of a tile; a task compares two blocks at a time.
BLOCK = 1024
#: Bits of a bitmap for each n-gram of the largest set of a band.
BITS_EACH = 8
#: Those of the folded bitmaps that tiles are compared by; sets as large as each other pass from about seven eighths of the wanted percentage on.
BLOCK_BITS_EACH = 2
MAX_SIZE = 1 << 40


@dataclass(frozen=True)
class Join:
    """Sets of ``n``-grams link when ``100 * overlap >= percent * union``; ``lower`` folds A-Z."""

    n: int = 3
    percent: int = 90
    lower: bool = True

    def bands(self) -> np.ndarray:
        """The least size of each band."""
        if not 1 <= self.percent <= 100 or self.n < 1:
            raise ValueError("percent is 1 to 100, n is 1 or more")
        out = [1]
        while out[-1] < MAX_SIZE:
            # Wider bands than needed do no harm; without the second limit there would be one for each size.
            out.append(max(out[-1] * 100 // self.percent, out[-1] * 65 // 64) + 1)
        return np.array(out)

    def parts(self, largest: int) -> int:
        """More than two linked sets of at most this size can differ in, and as many again as are likely to stay empty."""
        most = self.differ(2 * largest)
        return most + 1 + (math.ceil(4 * most * math.exp(-largest / most)) if most else 0)

    def differ(self, both: int) -> int:
        """The most n-grams that two linked sets, with so many together, can differ in."""
        return both * (100 - self.percent) // (100 + self.percent)

    def linked(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (a + b - overlap)


def _sets(raw: np.ndarray, offsets: np.ndarray, join: Join) -> list[np.ndarray]:
    h, first = shingles(Words(raw, offsets, lower=join.lower), join.n)
    return [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def _class(own: np.ndarray) -> tuple[int, int]:
    """A set's two fingerprints, as signed 64-bit numbers."""
    return tuple(int(np.add.reduce(mix(own, seed)).view(np.int64)) for seed in (11, 12))


def _describe(join: Join):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                sets = _sets(raw, offsets, join)
                marks = [_class(s) for s in sets]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "class": pa.array([m[0] for m in marks], pa.int64()),
                        "check": pa.array([m[1] for m in marks], pa.int64()),
                    }
                )

    return scan


def _tiles(join: Join):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = join.bands()
        seen: set[int] = set()
        for batch in batches:
            for _, raw, offsets in chunks(batch, "text"):
                keys, classes = [], []
                for own in _sets(raw, offsets, join):
                    if not len(own):
                        continue
                    mark = _class(own)[0]
                    # Equal sets of one task send their tiles once.
                    if mark in seen:
                        continue
                    if len(seen) >= 1 << 20:
                        seen.clear()
                    seen.add(mark)
                    band = int(np.searchsorted(bands, len(own), side="right")) - 1
                    for b in (band, band + 1):
                        largest = int(bands[b + 1]) - 1
                        n = join.parts(largest)
                        part = (own % np.uint64(n)).astype(np.int64)
                        sums = np.zeros(n, np.uint64)
                        np.add.at(sums, part, mix(own, 13))
                        tiles = mix(mix(sums ^ np.uint64(b), 14) + np.arange(n, dtype=np.uint64))
                        held = np.unique(part)
                        if len(held) > join.differ(len(own) + min(largest, len(own) * 100 // join.percent)):
                            tiles = tiles[held]
                        keys.append(tiles)
                        classes.append(np.full(len(tiles), mark))
                if keys:
                    yield pa.RecordBatch.from_pydict({"tile": np.concatenate(keys).view(np.int64), "class": np.concatenate(classes)})

    return scan


def _signatures(join: Join):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = join.bands()
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                sets = _sets(raw, offsets, join)
                # Of rows that share an id only those of the class are wanted.
                keep = [_class(s)[0] == c for s, c in zip(sets, part.column("class").to_pylist(), strict=True)]
                sets, part = [s for s, k in zip(sets, keep, strict=True) if k], part.filter(pa.array(keep, pa.bool_()))
                bits, folded = [], []
                for own in sets:
                    band = int(np.searchsorted(bands, max(1, len(own)), side="right")) - 1
                    # As wide for this band and the next, so that the two can be compared after folding.
                    width = 64
                    while width < BITS_EACH * (bands[band + 1] - 1):
                        width *= 2
                    flags = np.zeros(width, bool)
                    flags[(mix(own, 15) % np.uint64(width)).astype(np.int64)] = True
                    bits.append(np.packbits(flags).tobytes())
                    folded.append(_folded(_words(bits[-1]), max(64, width * BLOCK_BITS_EACH // BITS_EACH) // 64).tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "class": part.column("class"),
                        "size": pa.array([len(s) for s in sets], pa.int64()),
                        "bits": pa.array(bits, pa.binary()),
                        "folded": pa.array(folded, pa.binary()),
                        "grams": pa.array([s.tobytes() for s in sets], pa.binary()),
                    }
                )

    return scan


def _bound(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The most n-grams that sets with these bitmaps can share: no n-gram of one whose bit the other lacks."""
    wide = min(a.shape[-1], b.shape[-1])
    a, b = (_folded(x, wide) for x in (a, b))
    count = lambda x: np.bitwise_count(x).sum(axis=-1, dtype=np.int64)
    both = count(a & b)
    return np.minimum(n_a - (count(a) - both), n_b - (count(b) - both))


def _folded(x: np.ndarray, wide: int) -> np.ndarray:
    """A bitmap of fewer words: the hash of its positions modulo the smaller width."""
    while x.shape[-1] > wide:
        half = x.shape[-1] // 2
        x = x[..., :half] | x[..., half:]
    return x


def _words(bits: bytes) -> np.ndarray:
    return np.frombuffer(bits, np.uint64)


def _bounded(join: Join):
    """Pairs that the bitmaps let pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            most = np.array([_bound(_words(a), x, _words(b), y) for a, b, x, y in zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), n_a, n_b, strict=True)], np.int64)
            ok = join.linked(most, n_a, n_b) if len(most) else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return scan


def _decided(join: Join):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                overlap = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(bool(join.linked(overlap, len(a), len(b))))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return scan


def _compare_blocks(join: Join):
    """Rows of one block of a tile, or of two, against each other, between components, by their folded bitmaps."""

    def cell(left: pa.Table, right: pa.Table | None = None) -> pa.Table:
        pairs: list[np.ndarray] = []
        tables = [left] if right is None else [left, right]
        if all(t.num_rows for t in tables):
            get = lambda t, c: t[c].to_numpy()
            bits = [[_words(x) for x in t["folded"].to_pylist()] for t in tables]
            wide = min(len(x) for own in bits for x in own)
            bits = [np.stack([_folded(x, wide) for x in own]) for own in bits]
            one, size, group = (get(left, c) for c in ("class", "size", "component"))
            other, sizes, groups = (get(tables[-1], c) for c in ("class", "size", "component"))
            for i in range(len(one)):
                near = (groups != group[i]) & (100 * sizes >= join.percent * size[i]) & (100 * size[i] >= join.percent * sizes)
                if right is None:
                    near[: i + 1] = False
                at = np.flatnonzero(near)
                if len(at):
                    most = _bound(bits[0][i], size[i], bits[-1][at], sizes[at])
                    at = at[join.linked(most, size[i], sizes[at])]
                    pairs.append(np.stack([np.full(len(at), one[i]), other[at]], axis=1))
        p = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
        return pa.table({"a": p.max(axis=1) if len(p) else p[:, 0], "b": p.min(axis=1) if len(p) else p[:, 0]})

    return cell


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row, the component being the least doc_id that links lead to."""
    work = Workspace(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = "doc_id long, n_shingles long, class long, check long"
    described = work.store(texts.mapInArrow(_describe(join), described), "described")
    members = described.where("n_shingles > 0 and doc_id is not null").groupBy("class", "check")
    members = work.store(members.agg(F.min("doc_id").alias("doc_id")), "classes")

    # Tiles with more than one set, and for each set the first and the last of its tile.
    tiles = texts.where("doc_id is not null").mapInArrow(_tiles(join), "tile long, class long")
    same = Window.partitionBy("tile")
    shared = tiles.withColumns({"lo": F.min("class").over(same), "hi": F.max("class").over(same)}).where("lo < hi")
    shared = work.store(shared.distinct(), "tiles")
    work.clean()
    pair = lambda x, y: F.struct(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    hubs = shared.select(F.explode(F.array(pair("class", "lo"), pair("class", "hi"))).alias("p")).select("p.*").where("a <> b").distinct()
    hubs = work.store(hubs, "hubs")

    # Signatures of the sets that stand in such a tile, from one document each.
    wanted = work.store(shared.select("class").distinct().join(members, "class").select("class", "doc_id"), "wanted")
    known = rows.marked(texts.where("doc_id is not null"), wanted).where("_near").drop("_near")
    signed = known.join(wanted, "doc_id").mapInArrow(_signatures(join), "class long, size long, bits binary, folded binary, grams binary")
    signed = work.store(signed, "signatures")

    def met(pairs: DataFrame, column: str) -> DataFrame:
        """Stored ``pairs`` beside a column of both signatures. Only signatures that stand in a pair are shuffled."""
        classes = pairs.select(F.explode(F.array("a", "b")).alias("class"))
        some = maybe_among(signed.select("class", "size", column), ["class"], key_bitmap(classes, ["class"]))
        side = lambda x: some.select(F.col("class").alias(x), F.col("size").alias(f"size_{x}"), F.col(column).alias(f"{column}_{x}"))
        return pairs.join(side("a"), "a").join(side("b"), "b")

    def decided(pairs: DataFrame, name: str) -> DataFrame:
        """Of stored pairs ``a, b`` those that link, stored."""
        pairs = work.store(met(pairs, "bits").mapInArrow(_bounded(join), "a long, b long"), f"{name}-bounded")
        work.clean()
        out = work.store(met(pairs, "grams").mapInArrow(_decided(join), "a long, b long"), name)
        work.drop(f"{name}-bounded")
        work.clean()
        return out

    work.drop("wanted")
    work.clean()
    links = decided(hubs, "links")
    groups = work.store(connected(links, work, "first"), "groups")

    # Tiles that still hold more than one component, in blocks.
    placed = shared.select("tile", "class").join(groups.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    open_tiles = placed.withColumns({"lo": F.min("component").over(same), "hi": F.max("component").over(same)}).where("lo < hi")
    number = F.row_number().over(same.orderBy("class")) - 1
    rest = open_tiles.withColumn("block", F.floor(number / BLOCK))
    rest = work.store(rest.select("tile", "class", "component", "block"), "open")
    work.drop("tiles")
    work.clean()
    last = rest.groupBy("tile").agg(F.max("block").alias("last"), F.count(F.lit(1)).alias("rows"))
    small = last.where("rows = 2").select("tile")
    pairs_of_two = rest.join(small, "tile", "left_semi").groupBy("tile").agg(F.max("class").alias("a"), F.min("class").alias("b"))
    compare = _compare_blocks(join)
    folded = signed.select("class", "size", "folded")
    within = rest.join(last.where("rows > 2"), "tile", "left_semi").join(folded, "class")
    within = within.groupBy("tile", "block").applyInArrow(lambda t: compare(t), "a long, b long")
    more = rest.join(last.where("last > 0").select("tile", "last"), "tile").join(folded, "class")
    left = more.where("block < last").withColumn("other", F.explode(F.sequence(F.col("block") + 1, F.col("last"))))
    right = more.where("block > 0").withColumn("other", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other") - 1)))
    key = ["tile", "block", "other"]
    # Both sides come from one frame, so their columns are named anew.
    left, right = (x.select(*[F.col(c).alias(c) for c in (*key, "class", "component", "size", "folded")]) for x in (left, right))
    across = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(lambda x, y: compare(x, y), "a long, b long")
    untried = pairs_of_two.select("a", "b").unionByName(within).unionByName(across).distinct()
    untried = work.store(untried.join(hubs, ["a", "b"], "left_anti"), "untried")
    work.clean()
    late = decided(untried, "late")
    work.drop("signatures", "hubs", "open", "untried")
    if not late.isEmpty():
        groups = work.store(connected(links.unionByName(late), work, "second"), "all-groups")
        work.drop("groups")
    work.drop("links", "late")

    # Classes to components, components to their least document.
    placed = members.join(groups.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = placed.join(least, "component").select(F.col("class").alias("_class"), F.col("check").alias("_check"), "component_id")
    joined = described.join(placed, (F.col("class") == F.col("_class")) & (F.col("check") == F.col("_check")) & (F.col("n_shingles") > 0), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))
