"""Top-k search, token counts, chat windows, mixing against plain definitions."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import chat_format, mixing, queries, token_count, topk_search

DATA = "/root/testdata/sf0.001"

VECTORS = "vec_id long, embedding array<float>, label int"


def best(rows, k, is_query):
    made = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v in rows]
    out = {}
    for i, v in made:
        if is_query(i):
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in made if j != i)[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


@pytest.mark.parametrize("k", [5, 400])
def test_top_k_equals_all_pairs(spark, k, monkeypatch):
    monkeypatch.setattr(topk_search, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk_search, "BINS", 16)
    rng = random.Random(k)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(4)]) for i in range(150)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]
    bad = [(900, None), (901, [0.1, None, 0.2, 0.3]), (950, [float("nan"), 0.0, 0.0, 0.0]), (None, [0.1] * 4), (1000, [float("inf")] * 4), (1050, [])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], VECTORS).withColumn("score", F.lit("x"))
    found = topk_search.top_k(frame, F.col("vec_id") % 50 == 0, k=k).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got == best(rows, k, lambda i: i % 50 == 0)


def test_top_k_of_large_scores(spark):
    """Above 2**53, where floating point would round."""
    rng = random.Random(4)
    rows = [(i, [float(rng.randrange(-(10**6), 10**6)) for _ in range(4)]) for i in range(120)] + [(200, [1e6, 1e6, 1e6, 1e6])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    got = {}
    for r in topk_search.top_k(frame, F.col("vec_id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == best(rows, 5, lambda i: i % 50 == 0) and max(s for f in got.values() for _, s in f) > 2**53
    with pytest.raises(ValueError, match="scale"):
        topk_search.top_k(spark.createDataFrame([(0, [3e9], 0), (1, [3e9], 0)], VECTORS), F.col("vec_id") == 0)


def test_top_k_of_nothing_and_of_repeated_ids(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk_search.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [0.5], 0)], VECTORS)
    assert topk_search.top_k(one, F.col("vec_id") % 50 == 0).count() == 0
    rows = spark.createDataFrame([(0, [0.5], 0), (0, [0.25], 0), (1, [0.5], 0), (1, [0.5], 0)], VECTORS)
    found = topk_search.top_k(rows, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found)] == [(1, 1, 64 * 128), (2, 1, 64 * 128)]


PIECES = (("▁", -3.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("▁a", -2.5), ("aba", -5.0), ("c", -2.0), ("bc", -4.0), ("é", -6.0))


@pytest.mark.parametrize("fallback", [False, True])
def test_counts_equal_the_tokenizer(spark, fallback):
    from tokenizers import Tokenizer, models

    vocabulary = token_count.Vocabulary(PIECES, fallback)
    pieces = [("<unk>", 0.0), *PIECES] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] * fallback
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab c\néxy日") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", " ", "  ", "\n", "a" * 5000, None]
    frame = spark.createDataFrame([(t, 1) for t in texts], "text string, n_tokens int")
    got = [r["token_count"]["n_tokens"] for r in token_count.with_token_counts(frame, vocabulary).collect()]
    assert got == [len(tokenizer.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for t in texts]


@pytest.mark.skipif(not Path(queries.TOKENIZER).exists() or not Path(DATA).exists(), reason="vocabulary or tables not present")
def test_counts_of_all_documents_equal_the_public_library(spark):
    from tokenizers import Tokenizer, models

    with pytest.raises(ValueError, match="unigram"):
        token_count.load_vocabulary(queries.TOKENIZER)
    vocabulary = token_count.load_vocabulary(queries.TOKENIZER, as_unigram=True)
    pieces = [("<unk>", 0.0), *vocabulary.pieces, *[(f"<0x{i:02X}>", 0.0) for i in range(256)]]
    # The bytes are there for the fallback only; the score of unknown characters hangs on the lowest of the pieces.
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    got = dict(queries.op10_token_count(spark, DATA).select("doc_id", "n_tokens").collect())
    assert got == {i: len(tokenizer.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for i, t in texts.items()}


def test_counts_without_cuts_are_the_same():
    plain = token_count.Counter(token_count.Vocabulary(PIECES, True))
    whole = token_count.Counter(token_count.Vocabulary((*PIECES, ("b▁c", -90.0)), True))
    assert plain.by_word and not whole.by_word
    for text in ["ab c\nabc", "  a  b\n\n", "x\ny z"]:
        assert plain(text)[0] == whole(text)[0]


CHAT = "conv_id long, turn long, role string, text string, window string, tokens int"


def test_chat_windows_round_trip(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for conv in range(12):
        own = [(0, "system", "be ### good")] * (conv % 2)
        own += [(t + 1, "user" if t % 2 == 0 else "assistant", rng.choice(["\\", "###", "</turn>", "a:b", ""]) + " x" * rng.randrange(30)) for t in range(rng.randrange(1, 60))]
        expected[conv] = own
        rows += [(conv, t, r, x, "w", 1) for t, r, x in own]
    rng.shuffle(rows)
    budget = chat_format.Budget(100, 20)
    made = chat_format.windows(spark.createDataFrame(rows, CHAT), budget, run=7).orderBy("conv_id", "window").collect()
    seen, loss = {}, {}
    for w in made:
        assert w["n_tokens"] <= budget.window
        parsed = chat_format.parse(w["text"])
        assert len(parsed) == len(w["turns"]) == w["n_turns"]
        for (role, text, start, end), turn in zip(parsed, w["turns"]):
            assert (start, end) == (turn["start"], turn["end"])
            if not turn["repeated"]:
                seen.setdefault(w["conv_id"], []).append((turn["turn"], role, text))
            if turn["loss"]:
                loss.setdefault(w["conv_id"], []).append(text)
    assert seen == expected
    assert loss == {c: t for c, own in expected.items() if (t := [x for _, r, x in own if r == "assistant"])}
    assert any(t["repeated"] for w in made for t in w["turns"])
    assert all(w["turns"][0]["repeated"] or w["window"] == 0 or w["turns"][0]["turn"] > 0 for w in made if w["conv_id"] % 2)


def test_chat_nulls_ties_and_long_turns(spark):
    rows = [(None, None, None, None), (1, 1, "user", "a " * 500), (1, 1, "user", "a " * 500), (1, None, "assistant", "b"), (2, 5, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_format.windows(frame, chat_format.Budget(50, 10)).collect()
    own = [(w["conv_id"], t["turn"]) for w in made for t in w["turns"] if not t["repeated"]]
    assert sorted(own, key=str) == sorted([(None, None), (1, 1), (1, 1), (1, None), (2, 5)], key=str)
    assert chat_format.windows(frame.limit(0)).count() == 0


def test_mixing_meets_targets_like_plain_descent(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    t = rng.integers(0, 500, 300)
    rows = spark.createDataFrame([(i, "w " * int(n), [float(x) for x in q], "x") for i, (n, q) in enumerate(zip(t, p))], "doc_id long, text string, p array<double>, rate string")
    targets = [0.6, 0.3, 0.1]
    got = mixing.mixed(rows, F.col("p"), targets).orderBy("doc_id").toPandas()
    assert got["tokens"].tolist() == t.tolist()
    rate, start = np.ones(300), (t[:, None] * p).sum(0)
    for _ in range(mixing.STEPS):
        rate = np.maximum(0, rate - p @ (((t * rate)[:, None] * p).sum(0) / start - np.array(targets) * t.sum() / start))
    shares = ((t * got["rate"].to_numpy())[:, None] * p).sum(0) / t.sum()
    assert np.abs(shares - targets).max() < 5e-3 and np.abs(got["rate"] - rate).max() < 0.05 and (got["rate"] >= 0).all()
    assert abs(got["copies"].mean() - got["rate"].mean()) < 0.1


def test_mixing_of_little(spark):
    schema = "doc_id long, text string, p array<double>"
    assert mixing.mixed(spark.createDataFrame([], schema), F.col("p"), [1.0, 1.0]).count() == 0
    one = spark.createDataFrame([(1, None, [1.0, 0.0]), (1, None, [1.0, 0.0]), (2, "a b", [1.0, 0.0])], schema)
    got = mixing.mixed(one, F.col("p"), [0.5, 0.5]).collect()
    assert sorted(r["tokens"] for r in got) == [0, 0, 2] and all(r["rate"] == 1 for r in got)
    with pytest.raises(ValueError):
        mixing.mixed(one, F.col("p"), [0.0, 0.0])
