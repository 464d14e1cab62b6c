"""Byte strings that stand anywhere twice.

Method: common-prefix-aware distributed merge sort of suffixes. Every task sorts its suffixes, writes them front-coded
(each as what it adds to the one before) and sends each range of the order to one task, which combines the runs by a
loser tree. A suffix carries the length of the prefix that it is known to share with the last winner, so that a
known prefix is never compared again. Neighbours of the sorted order that share ``WINDOW`` bytes or more are repeats.

Not every suffix is sorted. Every window of ``WINDOW`` bytes has an anchor, the place of the least hash among its first
``SPAN`` places; windows next to each other with one anchor form a run, and the suffix at the start of a run stands for
it. First, as in prefix doubling, fingerprints of what all windows of a run share are counted, and runs whose
fingerprint is unique (most of the corpus) take no part in the sort. What the order leaves open, windows of a run of which only a
later part is repeated, is decided window by window: fingerprints of the open windows and of their possible
partners, one run for each different text, are counted. Periodic texts, whose windows repeat a little later in the
document, are settled while they are read.

Of equal suffixes of one task two travel, the others are known repeats; counts are folded before they are shuffled; joins are on stored
tables, so adaptive execution can split them. A passage may thus stand in a third of all documents.

A byte is removed if a window over it also starts anywhere else in the input, the same document included. Matches do not
cross documents. Null and empty texts have no bytes; rows without id are left as they are and are no partners; rows that share
an id are separate texts. Fingerprints have 64 bits. An empty table gives an empty result. Further columns are
not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idweave.llm import rows
from idweave.llm.arrays import Ranges, chunks, mix, text_bytes
from idweave.llm.substring_dedup import sliding_min
from idweave.operators.keyfilter import key_bitmap, maybe_among
from idweave.runtime import Workspace

WINDOW = 400
#: Bytes whose hash makes an anchor.
GRAM = 32
#: Bytes of suffixes that a task sorts at once, and those of a range of the order.
RUN_BYTES = 16 << 20
RANGE_BYTES = 16 << 20
#: Bytes of text whose windows a task holds at once (a window takes over a hundred bytes).
PIECE = 1 << 17
#: Suffixes that are looked at to choose the ranges, and the bytes of a limit between two of them.
SAMPLE = 20_000
LIMIT_BYTES = 64

SUFFIX = "suffixes array<struct<start:int,end:int,kappa:long>>"


def span_of(window: int) -> int:
    """Places among which a window's anchor is chosen."""
    return max(1, min(window - window // 7, window - gram_of(window) + 1))


def gram_of(window: int) -> int:
    return max(1, min(GRAM, window // 3))


def _runs(window: int):
    gram, span = gram_of(window), span_of(window)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text", PIECE):
                size = np.diff(offsets)
                if not len(size) or size.max() < window:
                    continue
                hashes = Ranges(raw)
                # The hash's leading bits and the place: the least is the first of the least hash.
                bits = np.uint64(max(24, int(len(raw)).bit_length()))
                h = hashes.windows(gram)
                h = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
                n = len(raw) - window + 1
                least = sliding_min(h, span)[:n]
                anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
                row = np.repeat(np.arange(len(size), dtype=np.int32), size)[:n]
                valid = np.arange(n) + window <= offsets[1:][row]

                def starts(of: np.ndarray, valid=valid, row=row) -> np.ndarray:
                    new = valid.copy()
                    new[1:] &= ~valid[:-1] | (of[1:] != of[:-1]) | (row[1:] != row[:-1])
                    return new

                def ends(new: np.ndarray, ok: np.ndarray) -> np.ndarray:
                    return np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))

                # Runs whose anchor has the hash of the run before: the text may be periodic by their distance.
                first = np.flatnonzero(starts(anchor))
                value = least[first] >> bits
                periodic = np.append(False, (value[1:] == value[:-1]) & (row[first[1:]] == row[first[:-1]])) if len(first) else np.zeros(0, bool)
                certain = np.zeros(n, bool)
                if periodic.any():
                    last = ends(starts(anchor), valid)
                    j = np.flatnonzero(periodic)
                    step = np.repeat(anchor[first[j]] - anchor[first[j - 1]], last[j] - first[j] + 1)
                    p = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[j], last[j], strict=True)])
                    back = p - step >= offsets[row[p]]
                    p, step = p[back], step[back]
                    echo = hashes.hash(p, p + window) == hashes.hash(p - step, p - step + window)
                    certain[p[echo]] = True
                    certain[p[echo] - step[echo]] = True
                    valid = valid.copy()
                    valid[p[echo]] = False
                first = np.flatnonzero(new := starts(anchor, valid))
                last = ends(new, valid)
                kappa = hashes.hash(anchor[first], anchor[first] + window - span + 1)
                sure = certain.copy()
                sure[1:] &= ~certain[:-1] | (row[1:] != row[:-1])
                begin = np.flatnonzero(sure)
                until = np.flatnonzero(certain & np.append(sure[1:] | ~certain[1:], True))
                start, end = np.concatenate([first, begin]), np.concatenate([last, until])
                of = row[start]
                yield pa.RecordBatch.from_pydict(
                    {
                        "kappa": np.concatenate([kappa, np.zeros(len(begin), np.uint64)]).view(np.int64),
                        "doc_id": pa.compute.take(part.column("doc_id"), pa.array(of)),
                        "part": pa.compute.take(part.column("part"), pa.array(of)),
                        "start": (start - offsets[of]).astype(np.int32),
                        "end": (end - offsets[of]).astype(np.int32),
                        "certain": np.arange(len(start)) >= len(first),
                    }
                )

    return scan


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    while a[known : known + 64] == b[known : known + 64]:
        known += 64
    for x, y in zip(a[known : known + 64], b[known : known + 64], strict=False):
        if x != y:
            return known
        known += 1
    return known


def merged(runs: list[Iterator[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Combines sorted runs of ``(prefix shared with the one before in the run, string, payload)`` into one, by a loser tree.

    A loser keeps the length of the prefix that it shares with the string it lost to. Of two strings that share more
    and less with the last winner, the first is the smaller; only equal lengths need a comparison, from there on."""
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (k - len(runs))
    shared = [0] * k
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        at = common_prefix(x[1], y[1], shared[a])
        if at == len(x[1]) or (at < len(y[1]) and x[1][at] < y[1][at]):
            shared[b] = at
            return a, b
        shared[a] = at
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while (head := heads[winner]) is not None:
        yield shared[winner], head[1], head[2]
        heads[winner] = after = next(runs[winner], None)
        shared[winner] = after[0] if after else 0
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


BLOCKS = "range int, run long, sorted boolean, shared array<int>, size array<int>, rest binary, doc_id array<long>, part array<int>, start array<int>, end array<int>, kappa array<long>"
RESULT = "doc_id long, part int, start int, end int, kappa long, until int, chosen boolean"


def _strings(batch: pa.RecordBatch, window: int) -> Iterator[tuple[bytes, tuple]]:
    raw, offsets = text_bytes(batch.column("text"))
    raw = raw.tobytes()
    ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
    for i, suffixes in enumerate(batch.column("suffixes")):
        for s in suffixes.as_py() or ():
            at = int(offsets[i])
            yield raw[at + s["start"] : at + s["end"] + window], (ids[i], parts[i], s["start"], s["end"], s["kappa"])


def _sorted_runs(window: int, limits: list[bytes]):
    def block(entries: list[tuple[int, bytes, tuple]], number: int, run: int, is_sorted: bool) -> dict:
        columns = list(zip(*(e[2] for e in entries), strict=True))
        return {
            "range": number,
            "run": run,
            "sorted": is_sorted,
            "shared": [e[0] for e in entries],
            "size": [len(e[1]) for e in entries],
            "rest": b"".join(e[1][e[0] :] for e in entries) if is_sorted else b"",
            **dict(zip(("doc_id", "part", "start", "end", "kappa"), map(list, columns), strict=True)),
        }

    schema = pa.schema(
        [("range", pa.int32()), ("run", pa.int64()), ("sorted", pa.bool_()), ("shared", pa.list_(pa.int32())), ("size", pa.list_(pa.int32())), ("rest", pa.binary())]
        + [("doc_id", pa.list_(pa.int64())), *[(c, pa.list_(pa.int32())) for c in ("part", "start", "end")], ("kappa", pa.list_(pa.int64()))]
    )

    def run_of(held: list[tuple[bytes, tuple]]) -> Iterator[pa.RecordBatch]:
        held.sort()
        run = hash(held[0]) & ((1 << 62) - 1)
        known: list[tuple[int, bytes, tuple]] = []
        entries: list[tuple[int, bytes, tuple]] = []
        number, before, equal = -1, None, 0
        for text, payload in held:
            equal = equal + 1 if text == before else 0
            if equal > 1:
                # Two equal suffixes show that they repeat; further ones are repeats for certain.
                known.append((0, text, payload))
                continue
            at = bisect_right(limits, text)
            if at != number:
                if entries:
                    yield pa.RecordBatch.from_pylist([block(entries, number, run, True)], schema=schema)
                number, entries = at, []
            entries.append((common_prefix(entries[-1][1], text) if entries else 0, text, payload))
            before = text
        yield pa.RecordBatch.from_pylist([block(entries, number, run, True)], schema=schema)
        if known:
            yield pa.RecordBatch.from_pylist([block(known, run % (len(limits) + 1), run, False)], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, tuple]] = []
        size = 0
        for batch in batches:
            for text, payload in _strings(batch, window):
                held.append((text, payload))
                size += len(text)
                if size >= RUN_BYTES:
                    yield from run_of(held)
                    held, size = [], 0
        if held:
            yield from run_of(held)

    return scan


def _samples(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"limit": pa.array([t[:LIMIT_BYTES] for t, _ in _strings(batch, window)], pa.binary())})

    return scan


def _decoded(row: dict) -> Iterator[tuple[int, bytes, tuple]]:
    before, at, rest = b"", 0, row["rest"]
    payloads = zip(row["doc_id"], row["part"], row["start"], row["end"], row["kappa"], strict=True)
    for shared, size, payload in zip(row["shared"], row["size"], payloads, strict=True):
        before = before[:shared] + rest[at : at + size - shared]
        at += size - shared
        yield shared, before, payload


def _combined(window: int):
    def one(blocks: pa.Table) -> pa.Table:
        out: list[tuple] = []
        runs = [_decoded(r) for r in blocks.filter(blocks["sorted"]).to_pylist()]
        before: tuple[bytes, tuple] | None = None
        most, chosen = 0, True

        def close(after: int) -> None:
            text, (doc, part, start, end, kappa) = before
            reach = min(len(text), max(most, after)) - window
            out.append((doc, part, start, end, kappa, start + reach if reach >= 0 else -1, chosen))

        for shared, text, payload in merged(runs):
            if before is not None:
                close(shared)
            chosen = before is None or not (shared == len(text) == len(before[0]))
            before, most = (text, payload), shared
        if before is not None:
            close(0)
        for r in blocks.filter(pa.compute.invert(blocks["sorted"])).to_pylist():
            out += [(d, p, s, e, k, e, False) for d, p, s, e, k in zip(r["doc_id"], r["part"], r["start"], r["end"], r["kappa"], strict=True)]
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]
        names = ["doc_id", "part", "start", "end", "kappa", "until", "chosen"]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

    return one


def _open_windows(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in chunks(batch, "text", PIECE):
                hashes = Ranges(raw)
                own = part.column("open")
                number = np.diff(own.offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), number)
                flat = own.flatten()
                start, end, until, kappa = (flat.field(c).to_numpy() for c in ("start", "end", "until", "kappa"))
                length = (end - start + 1).astype(np.int64)
                i = np.repeat(np.arange(len(start)), length)
                at = start[i] + np.arange(len(i)) - np.repeat(np.cumsum(length) - length, length)
                p = offsets[row[i]] + at
                print_ = hashes.hash(p, p + window) ^ mix(kappa.view(np.uint64))[i]
                yield pa.RecordBatch.from_pydict(
                    {
                        "fingerprint": print_.view(np.int64),
                        "doc_id": pa.compute.take(part.column("doc_id"), pa.array(row[i])),
                        "part": pa.compute.take(part.column("part"), pa.array(row[i])),
                        "at": at.astype(np.int32),
                        "undecided": at > until[i],
                    }
                )

    return scan


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """A stored table of ``doc_id, part, spans``: ranges of byte positions (``lo`` to ``hi``, both included) where windows
    start that also start elsewhere. ``docs`` as ``rows.numbered`` gives them."""
    work = Workspace(docs.sparkSession)
    known = docs.where("doc_id is not null")
    runs = known.mapInArrow(_runs(window), "kappa long, doc_id long, part int, start int, end int, certain boolean")
    runs = work.store(runs, "runs")
    live = runs.where("not certain").groupBy("kappa").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("kappa")
    live = work.store(live, "live")
    near = runs.where("not certain").join(live, "kappa").groupBy("doc_id", "part")
    near = work.store(near.agg(F.collect_list(F.struct("start", "end", "kappa")).alias("suffixes")), "near")
    work.clean()
    at_hand = rows.meet(known, near).where("suffixes is not null").select("doc_id", "part", "text", "suffixes")

    n_suffixes, n_bytes = near.select(F.explode("suffixes").alias("s")).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("s.end") - F.col("s.start") + window), F.lit(0))).first()
    ranges = max(1, math.ceil(n_bytes / RANGE_BYTES))
    limits: list[bytes] = []
    if ranges > 1:
        share = min(1.0, SAMPLE / n_suffixes)
        chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
        some = work.store(near.where(chance), "sample")
        drawn = rows.meet(known, some).where("suffixes is not null").select("doc_id", "part", "text", "suffixes").mapInArrow(_samples(window), "limit binary")
        drawn = sorted(bytes(x) for x in drawn.toArrow()["limit"].to_pylist())
        limits = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []
    blocks = at_hand.mapInArrow(_sorted_runs(window, limits), BLOCKS)
    ordered = work.store(blocks.groupBy("range").applyInArrow(_combined(window), RESULT), "ordered")
    work.drop("near", "live")
    work.clean()

    # What the order leaves open.
    open_keys = work.store(ordered.where("chosen and until < end").select("kappa").distinct(), "open")
    partners = ordered.where("chosen").join(open_keys, "kappa").groupBy("doc_id", "part")
    partners = work.store(partners.agg(F.collect_list(F.struct("start", "end", "until", "kappa")).alias("open")), "partners")
    windows = rows.meet(known, partners).where("open is not null").select("doc_id", "part", "text", "open")
    windows = windows.mapInArrow(_open_windows(window), "fingerprint long, doc_id long, part int, at int, undecided boolean")
    windows = work.store(windows, "windows")
    work.drop("partners", "open")
    work.clean()
    twice = windows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint")
    twice = work.store(twice, "twice")
    work.clean()
    # Most windows stand alone; a bitmap keeps them from being shuffled a second time.
    maybe = maybe_among(windows.where("undecided"), ["fingerprint"], key_bitmap(twice, ["fingerprint"]))
    late = maybe.join(twice, "fingerprint").select("doc_id", "part", "at")

    span = lambda lo, hi: F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"))
    spans = (
        ordered.where("until >= start").select("doc_id", "part", span("start", "until").alias("s"))
        .unionByName(runs.where("certain").select("doc_id", "part", span("start", "end").alias("s")))
        .unionByName(late.select("doc_id", "part", span("at", "at").alias("s")))
    )
    found = work.store(spans.groupBy("doc_id", "part").agg(F.collect_list("s").alias("spans")), "repeated")
    work.drop("runs", "ordered", "windows", "twice", "sample")
    work.clean()
    return found


def _cut(window: int, carry: tuple[str, ...], decoded: bool):
    removed = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            lists = batch.column("spans")
            kept, gone = [], []
            for i in range(batch.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                own = lists[i].values
                if own is None or not len(own):
                    kept.append(text.tobytes())
                    gone.append([])
                    continue
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, own.field("lo").to_numpy(), 1)
                np.subtract.at(edge, own.field("hi").to_numpy() + window, 1)
                out = np.cumsum(edge[:-1]) > 0
                kept.append(text[~out].tobytes())
                turn = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                gone.append([{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)])
            made = {"kept": pa.array(kept, pa.binary()), "n_bytes": np.diff(offsets), "spans": pa.array(gone, removed)}
            if decoded:
                made["kept_text"] = pa.array([x.decode("utf-8", "ignore") if g else None for x, g in zip(kept, gone, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("doc_id", "part", *carry)} | made)

    return cut


def deduplicated(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """``doc_id, part, kept`` (the remaining bytes), ``n_bytes`` of the input and the removed ``spans`` of bytes, with the columns
    of the input that ``carry`` names. ``part`` tells rows apart that share an id. With ``decoded`` comes ``kept_text``: of rows with removed
    spans the remaining bytes as text, without characters of which a part is gone; null for the others."""
    if window < 2:
        raise ValueError("a window has 2 bytes or more")
    known = rows.numbered(docs, carry)
    found = repeated_windows(known.select("doc_id", "part", "text"), window)
    joined = rows.meet(known, found)
    types = dict(joined.dtypes)
    carried = "".join(f"`{c}` {types[c]}, " for c in carry)
    schema = f"doc_id long, part int, {carried}kept binary, n_bytes long, spans array<struct<start:int,end:int>>{', kept_text string' if decoded else ''}"
    return joined.mapInArrow(_cut(window, carry, decoded), schema)
