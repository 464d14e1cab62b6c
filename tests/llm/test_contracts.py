"""The registered queries on the smallest tables against their contracts, written out plainly."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from idweave.llm import queries

from .conftest import WORD, lowered

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")


def table(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in table("documents")}


def result(spark, name, *columns):
    return sorted(tuple(r) for r in queries.queries()[name](spark, DATA).select(*columns).collect())


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op3(spark):
    rows = [(r["vec_id"], [int(np.floor(256 * np.float64(np.float32(x)))) for x in r["embedding"]]) for r in table("embeddings")]
    expected = []
    for i, v in rows:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in rows if j != i)[:5]
            expected += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    assert result(spark, "op3_topk_search", "query_id", "rank", "vec_id", "score") == sorted(expected)


def test_op4(spark, texts):
    got = result(spark, "op4_toxicity", "doc_id", "held_out", "score", "predicted")
    assert [r[0] for r in got] == sorted(texts)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) and 0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in got)


def test_op5(spark, texts):
    sets = {}
    for i, text in texts.items():
        words = WORD.findall(lowered(text))
        sets[i] = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert result(spark, "op5_jaccard_join", "doc_id", "n_shingles", "component_id") == [(i, len(sets[i]), find(i)) for i in ids]


def test_op6(spark, texts):
    words = {i: WORD.findall(t) for i, t in texts.items()}
    least = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            least.setdefault(tuple(words[i][k : k + 50]), i)
    expected = []
    for i, own in sorted(words.items()):
        gone = set()
        for k in range(len(own) - 49):
            if least[tuple(own[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        expected.append((i, len(own), len(gone), sha(kept)))
    assert result(spark, "op6_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert any(r[2] for r in expected)


def test_op7(spark):
    turns = defaultdict(list)
    for r in table("conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", queries.PLANTED_CHAT), (1, "assistant", queries.PLANTED_CHAT)]
    expected = []
    for conv, own in sorted(turns.items()):
        own.sort(key=lambda t: t[0])
        loss = "".join(t for _, role, t in own if role == "assistant")
        expected.append((conv, len(own), sha("".join(f"{role}\n{t}\n" for _, role, t in own)), len(loss), sha(loss)))
    assert result(spark, "op7_chat_format", "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == expected


def test_op9(spark, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    mark = lambda b: hashlib.blake2b(b, digest_size=16).digest()
    count = Counter(mark(b[k : k + 400]) for b in raw.values() for k in range(len(b) - 399))
    expected = []
    for i, b in sorted(raw.items()):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if count[mark(b[k : k + 400])] > 1:
                gone[k : k + 400] = True
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        expected.append((i, len(b), int(gone.sum()), spans, sha(kept)))
    assert result(spark, "op9_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    assert any(r[2] for r in expected)
