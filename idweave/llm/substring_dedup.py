"""Passages that stand in an earlier document already.

Method: fixed-block anchors. Non-overlapping blocks of ``BLOCK`` words are the reference index. They are probed with
every rolling window of that length; every passage of ``WINDOW`` words holds a whole block of its reference,
so no repeat escapes. Hits are extended to both sides: each passage of ``WINDOW`` words around a hit, of the
document and of its references, is compared by fingerprint, and what is repeated joins up to maximal exact repeats.

Rolling windows next to each other mostly share the smallest hash of their eight-word shingles. Blocks and windows meet by
that hash, one row for a run of windows, so that the probes of unique text (most of it) stay few. Only texts with a
run that meets a block are read again. Sums and minima over a hash are window functions that spill, so a passage may stand in a
third of all documents; no pairs are made.

A word is removed if a window of ``WINDOW`` words over it also starts in a document with a smaller id. Windows are those of
the input. Fingerprints have 64 bits. Null and empty texts have no words. Rows without id neither serve as
reference nor lose words. Rows that share an id are documents of the same id: neither is smaller. An
empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from idweave.llm import rows
from idweave.llm.arrays import Ranges, Words, chunks
from idweave.runtime import Workspace

WINDOW = 50
SHINGLE = 8


def block_words(window: int) -> int:
    """The longest block of which any window holds a whole one."""
    return (window + 1) // 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def _runs(window: int):
    block = block_words(window)
    shingle = min(SHINGLE, block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                words = Words(raw, offsets)
                n = np.diff(words.first)
                if not len(n) or n.max() < window:
                    continue
                least = sliding_min(Ranges(words.hashes()).windows(shingle), block - shingle + 1)
                row = np.repeat(np.arange(len(n)), n)[: len(least)]
                at = np.arange(len(least)) - words.first[row]
                ok = (at + block <= n[row]) & (n[row] >= window)
                new = ok.copy()
                new[1:] &= ~ok[:-1] | (least[1:] != least[:-1]) | (row[1:] != row[:-1])
                start = np.flatnonzero(new)
                end = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
                s, e, row = at[start], at[end], row[start]
                first_block = -(-s // block) * block
                yield pa.RecordBatch.from_pydict(
                    {
                        "least": least[start].view(np.int64),
                        "doc_id": pa.compute.take(part.column("doc_id"), pa.array(row)),
                        "part": pa.compute.take(part.column("part"), pa.array(row)),
                        "start": s.astype(np.int32),
                        "end": e.astype(np.int32),
                        "block": pa.array(first_block.astype(np.int32), mask=first_block > e),
                        "last": pa.array((e // block * block).astype(np.int32), mask=first_block > e),
                    }
                )

    return scan


def _positions(spans: list[dict], last: int) -> np.ndarray:
    """The numbers within any span, up to ``last``."""
    edge = np.zeros(last + 2, np.int64)
    for s in spans:
        lo, hi = max(0, s["lo"]), min(last, s["hi"])
        if lo <= hi:
            edge[lo] += 1
            edge[hi + 1] -= 1
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _fingerprints(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text"):
                words = Words(raw, offsets)
                h = words.hashes()
                spans = part.column("spans").to_pylist()
                hashes, row, at = [], [], []
                for i, own in enumerate(spans):
                    a, b = words.first[i], words.first[i + 1]
                    if own and b - a >= window:
                        p = _positions(own, b - a - window)
                        hashes.append(Ranges(h[a:b]).windows(window)[p])
                        row.append(np.full(len(p), i))
                        at.append(p)
                if hashes:
                    taken = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "fingerprint": np.concatenate(hashes).view(np.int64),
                            "doc_id": pa.compute.take(part.column("doc_id"), taken),
                            "part": pa.compute.take(part.column("part"), taken),
                            "at": np.concatenate(at).astype(np.int32),
                        }
                    )

    return scan


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """A stored table of ``doc_id, part, starts``: word positions of the windows that also start in a document with a
    smaller id. ``docs`` as ``rows.numbered`` gives them."""
    work = Workspace(docs.sparkSession)
    block = block_words(window)
    schema = "least long, doc_id long, part int, start int, end int, block int, last int"
    runs = docs.where("doc_id is not null").select("doc_id", "part", "text").mapInArrow(_runs(window), schema)
    same = Window.partitionBy("least")
    runs = runs.withColumns({"lo": F.min(F.when(F.col("block").isNotNull(), F.col("doc_id"))).over(same), "hi": F.max("doc_id").over(same)})
    probe = F.when(F.col("doc_id") > F.col("lo"), F.struct((F.col("start") - (window - block)).alias("lo"), F.col("end").alias("hi")))
    reference = F.when(F.col("block").isNotNull() & (F.col("doc_id") < F.col("hi")), F.struct((F.col("block") - (window - block)).alias("lo"), F.col("last").alias("hi")))
    near = runs.select("doc_id", "part", F.coalesce(probe, reference).alias("span"), F.when(probe.isNotNull(), reference).alias("more"))
    near = near.where("span is not null").groupBy("doc_id", "part").agg(F.concat(F.collect_list("span"), F.collect_list("more")).alias("spans"))
    near = work.store(near, "near")
    hits = rows.meet(docs, near).where("spans is not null")
    prints = hits.mapInArrow(_fingerprints(window), "fingerprint long, doc_id long, part int, at int")
    earliest = F.min("doc_id").over(Window.partitionBy("fingerprint"))
    found = prints.withColumn("earliest", earliest).where("earliest < doc_id").groupBy("doc_id", "part")
    return work.store(found.agg(F.collect_list("at").alias("starts")), "repeated")


def _kept(window: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = batch.column("text"), batch.column("starts")
            kept, n_words, spans = [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                words = text.encode().split() if text else []
                n_words.append(len(words))
                own = starts[i].values
                if own is None or not len(own):
                    kept.append(b" ".join(words))
                    spans.append([])
                    continue
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.unique(own.to_numpy())
                edge[at] += 1
                np.subtract.at(edge, at + window, 1)
                gone = np.cumsum(edge[:-1]) > 0
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
                turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": batch.column("part"),
                    "text": pa.array(kept, pa.binary()).cast(pa.string()),
                    "n_words": pa.array(n_words, pa.int64()),
                    "spans": pa.array(spans, span),
                }
            )

    return cut


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, part, text`` (the kept words, one blank between), ``n_words`` of the input and the removed ``spans`` of
    words. ``part`` tells rows apart that share an id."""
    if window < 2:
        raise ValueError("a window has 2 words or more")
    known = rows.numbered(docs)
    joined = rows.meet(known, repeated_windows(known, window))
    schema = "doc_id long, part int, text string, n_words long, spans array<struct<start:int,end:int>>"
    return joined.select("doc_id", "part", "text", "starts").mapInArrow(_kept(window), schema)
