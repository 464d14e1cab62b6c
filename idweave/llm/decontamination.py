"""Test items of benchmarks inside documents.

Method: size-partitioned MinHash containment search. Items are put into classes by their number of
shingles. For each class documents are read in overlapping segments, twice as long as the
class's largest item, so that an item stands within one segment and containment becomes a Jaccard similarity
with a lower bound; a segment and an item that agree in one of ``HASHES`` minima are candidates. A pair that shares
``THRESHOLD`` of the item's shingles within one segment is missed with a chance below 1 in 10,000. Candidates
are verified by exact containment of the item's distinct shingles in the whole document.

Shingles are five words in lower case, without punctuation. Items with fewer words are one shingle, which only a
document of just these words has; items and documents without words match nothing (null: none).

What goes from the items to all tasks are two bitmaps of fixed size, however many items there are. Documents meet items by
keys first; a shingle that very many documents and items have is looked up for candidates only. Sums are folded before they
are shuffled. Very long texts are read whole. Further columns are left alone, whatever their names. Rows that share a doc_id are one document, rows
without doc_id or item_id match nothing and are kept. Repeated items and rows give each pair once. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm.arrays import PUNCTUATION, Words, chunks, mix, shingles
from idweave.runtime import Workspace

WORDS = 5
THRESHOLD = 0.8
HASHES = 48
#: Each bitmap has two to this power bits.
BITS = 24
#: Up to so many document ids (8 bytes each) are sent to all executors to take documents out.
BROADCAST_IDS = 1_000_000

FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def _shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return shingles(Words(raw, offsets, lower=True, separator=PUNCTUATION), WORDS)


def _class(n: np.ndarray) -> np.ndarray:
    """Items with up to ``2**c`` shingles and more than half of it are of class c."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def _keys(minima: np.ndarray, size_class: int) -> np.ndarray:
    """Minima (one row for each hash) as keys that also tell the hash and the class."""
    seeds = mix(np.arange(HASHES, dtype=np.uint64) + np.uint64(size_class << 8), 7)
    return mix(minima ^ seeds[:, None])


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, raw, offsets in chunks(batch, "text"):
            h, first = _shingles(raw, offsets)
            ids = part.column("item_id").to_numpy(zero_copy_only=False)
            for i in range(part.num_rows):
                own = np.unique(h[first[i] : first[i + 1]])
                if len(own):
                    c = int(_class(np.array([len(own)]))[0])
                    keys = _keys((own[None, :] * FACTORS[:, None]).min(axis=1)[:, None], c).ravel()
                    yield pa.RecordBatch.from_pydict(
                        {"item_id": pa.array([ids[i]], pa.int64()), "size_class": pa.array([c], pa.int32()), "shingles": [own.view(np.int64)], "keys": [keys.view(np.int64)]}
                    )


def _hits(classes: list[int], key_bits: bytes, shingle_bits: bytes):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_key, of_shingle = (np.unpackbits(np.frombuffer(b, np.uint8)).view(bool) for b in (key_bits, shingle_bits))
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                h, first = _shingles(raw, offsets)
                if not len(h):
                    continue
                number, rows = np.diff(first), np.arange(part.num_rows)
                found_row, found_key = [], []
                minima, length = None, 0
                for c in classes:
                    blocks = -(-number // (1 << c))
                    row = np.repeat(rows, blocks)
                    inner = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    if minima is None:
                        start = first[row] + inner * (1 << c)
                        minima = np.stack([np.minimum.reduceat(h * f, start) for f in FACTORS])
                    else:
                        # Blocks of this class are runs of those of the class before.
                        before = -(-number // (1 << length))
                        start = (np.cumsum(before) - before)[row] + inner * (1 << (c - length))
                        minima = np.minimum.reduceat(minima, start, axis=1)
                    length = c
                    joined = minima.copy()
                    pair = np.flatnonzero(row[1:] == row[:-1])
                    joined[:, pair] = np.minimum(minima[:, pair], minima[:, pair + 1])
                    keys = _keys(joined, c)
                    _, at = hit = np.nonzero(of_key[_bit(keys)])
                    found_row.append(row[at])
                    found_key.append(keys[hit])
                near = np.flatnonzero(of_shingle[_bit(h)])
                row = np.concatenate([*found_row, np.searchsorted(first, near, side="right") - 1])
                value = np.concatenate([*found_key, h[near]])
                is_key = np.arange(len(row)) < len(row) - len(near)
                if len(row):
                    ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids[row], pa.int64()), "is_key": is_key, "value": value.view(np.int64)})

    return scan


def _bitmap(values: DataFrame) -> bytes:
    """Bits of the column ``value``; ``2**BITS`` of them at most come to the driver."""
    at = values.select(F.shiftrightunsigned("value", 64 - BITS).alias("at")).distinct().toArrow()["at"].to_numpy()
    bits = np.zeros(1 << BITS, np.uint8)
    bits[at.astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles``: items of which the document has ``threshold`` of the shingles.
    ``docs`` has doc_id and text, ``items`` item_id and text."""
    work = Workspace(docs.sparkSession)
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null")
    made = work.store(wanted.mapInArrow(_items, "item_id long, size_class int, shingles array<long>, keys array<long>"), "items")
    item_keys = made.select("item_id", F.explode("keys").alias("value"))
    # Rows of one item_id are one item.
    item_shingles = made.select("item_id", F.explode("shingles").alias("value")).distinct()
    sizes = item_shingles.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    classes = sorted(r[0] for r in made.select("size_class").distinct().collect())
    scan = _hits(classes, _bitmap(item_keys), _bitmap(item_shingles))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    hits = work.store(read.mapInArrow(scan, "doc_id long, is_key boolean, value long"), "hits")
    candidates = work.store(hits.where("is_key").join(item_keys, "value").select("doc_id", "item_id").distinct(), "candidates")
    # Only candidates are verified: the item's shingles, each looked up in the document.
    asked = candidates.join(item_shingles, "item_id")
    met = asked.join(hits.where("not is_key").select("doc_id", "value"), ["doc_id", "value"], "left_semi")
    shared = met.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))
    contained = shared.join(sizes, "item_id").where(F.col("n_shared") >= threshold * F.col("n_shingles"))
    return contained.select("doc_id", "item_id", "n_shared", "n_shingles")


def without(docs: DataFrame, ids: DataFrame, id: str = "doc_id") -> DataFrame:
    """``docs`` less the rows whose id is in the one column of ``ids``, a stored table."""
    gone = ids.toDF("_gone").distinct()
    if ids.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[id].cast("long") == F.col("_gone"), "left_anti")


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that hold no item."""
    work = Workspace(docs.sparkSession)
    return without(docs, work.store(matches(docs, items, threshold).select("doc_id"), "contaminated"))
