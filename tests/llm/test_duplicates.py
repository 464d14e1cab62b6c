"""Jaccard join, substring and suffix deduplication, decontamination against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from idweave.llm import decontamination, jaccard_join, rows, substring_dedup, suffix_dedup
from idweave.llm.arrays import PUNCTUATION
from idweave.llm.components import connected
from idweave.runtime import Workspace

from .conftest import WORD, lowered, sentence


def ngrams(text, n):
    words = WORD.findall(lowered(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}


def components(pairs, join):
    sets = {i: ngrams(t, join.n) for i, t in pairs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                o = len(sets[i] & sets[j])
                if 100 * o >= join.percent * (len(sets[i]) + len(sets[j]) - o):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (2, 100)])
def test_components_equal_all_pairs(spark, docs, n, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = random.Random(n)
    pairs = []
    for base in range(12):
        text = sentence(rng, rng.choice([1, 2, 4, 9, 12, 30, 120, 400]))
        pairs += [(len(pairs) + k, edited(rng, text, rng.randrange(0, 1 + len(text.split()) // 15))) for k in range(12)]
    chain = sentence(rng, 200).split()
    pairs += [(1000 + k, " ".join(chain[k * 3 : k * 3 + 140])) for k in range(15)]
    pairs += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "One Two"), (2004, "one two"), (2005, "z" * 300_000), (2006, "w " * 20_000), (2007, "w " * 20_000)]
    join = jaccard_join.Join(n, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs(pairs), join).collect()}
    assert got == components(pairs, join)


@pytest.mark.parametrize("block", [4, 1024])
def test_tiles_are_compared_by_folded_bitmaps(docs, block, monkeypatch):
    """Texts that share half of their words meet in many tiles without a link; whole bitmaps travel for pairs only, not for tiles."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    plans, widths, sizes, store = [], [], [], Workspace.store

    def spied(self, frame, name):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        out = store(self, frame, name)
        if name == "signatures":
            widths.extend(out.select(F.length("bits"), F.length("folded")).collect())
        if name == "open":
            sizes.extend(r["n"] for r in out.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect())
        return out

    monkeypatch.setattr(Workspace, "store", spied)
    rng = random.Random(8)
    shared, pairs = sentence(rng, 150, 10**6), []
    for i in range(40):
        text = f"{shared} {sentence(rng, rng.randrange(20, 150), 10**6)}"
        pairs += [(10 * i + k, edited(rng, text, k * 4)) for k in range(rng.choice([1, 1, 3]))]
    join = jaccard_join.Join(5, 80)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs(pairs), join).collect()}
    assert found == components(pairs, join)
    assert max(sizes) > 8 and len({c for _, c in found.values()}) > 30
    compared = [plan for plan in plans if "GroupsInArrow" in plan]
    assert compared and not any("bits#" in line for plan in compared for line in plan.splitlines() if "Relation" not in line)
    assert widths and all(folded * jaccard_join.BITS_EACH <= max(8 * jaccard_join.BITS_EACH, bits * jaccard_join.BLOCK_BITS_EACH) for bits, folded in widths)


def test_folded_bitmaps_bound_the_overlap():
    """However far two bitmaps are folded, what they share is never taken for less than it is."""
    rng = np.random.default_rng(5)
    join = jaccard_join.Join(5, 80)
    for n in (1, 3, 40, 300):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for kept in range(0, n + 1, max(1, n // 7)):
            b = np.concatenate([a[:kept], rng.integers(0, 1 << 63, n - kept + 1, dtype=np.uint64)])
            sets = [np.unique(x) for x in (a, b)]
            batch = pa.RecordBatch.from_pydict({"class": pa.array([0, 0]), "text": pa.array(["", ""])})
            made = []
            for own in sets:
                with pytest.MonkeyPatch.context() as m:
                    m.setattr(jaccard_join, "_sets", lambda *_, own=own: [own])
                    m.setattr(jaccard_join, "_class", lambda _: (0, 0))
                    made.append(next(jaccard_join._signatures(join)(iter([batch.slice(0, 1)]))).to_pylist()[0])
            words = [jaccard_join._words(x["folded"]) for x in made]
            bound = jaccard_join._bound(words[0], len(sets[0]), words[1], len(sets[1]))
            assert len(np.intersect1d(*sets)) <= bound <= min(len(x) for x in sets)


def test_long_words_without_a_common_place(docs):
    """The two words that differ in every letter, and that a polynomial hash modulo a power of two can't tell apart."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    pairs = [(0, word), (1, other), (2, " ".join([word, *"xy"] * 20)), (3, " ".join([other, *"xy"] * 20))]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs(pairs), jaccard_join.Join(n=3, percent=90)).collect()}
    assert found == {i: i for i in range(4)}
    assert {r["doc_id"]: r["spans"] for r in substring_dedup.deduplicated(docs(pairs)).collect()} == {i: [] for i in range(4)}


def test_join_of_nulls_repeats_and_nothing(docs):
    near = lambda pairs: sorted(map(tuple, jaccard_join.near_duplicates(docs(pairs)).collect()), key=str)
    assert near([]) == []
    assert near([(None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "a b c"), (3, "d e f")]) == [(2, 1, 2), (3, 1, 2), (3, 1, 2), (3, 1, 3), (None, 1, None)]


def test_components_of_a_long_path(spark):
    edges = spark.range(0, 300).selectExpr("id as a", "id + 1 as b").union(spark.sql("select 1000L, 2000L"))
    found = {tuple(r) for r in connected(edges, Workspace(spark)).collect()}
    assert found == {(i, 0) for i in range(301)} | {(1000, 1000), (2000, 1000)}


def removed_words(pairs, window):
    first, words = {}, {i: (t or "").encode().split() for i, t in pairs}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, own in words.items():
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(own), b" ".join(w for w, g in zip(own, gone) if not g).decode(), sum(gone))
    return out


def passages(rng, n_docs, size):
    shared = [sentence(rng, size + rng.randrange(size)) for _ in range(6)]
    pairs = []
    for i in range(n_docs):
        parts = [sentence(rng, rng.randrange(size)) for _ in range(rng.randrange(1, 4))]
        parts += rng.sample(shared, rng.randrange(0, 3))
        rng.shuffle(parts)
        pairs.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    pairs += [(n_docs + 1, pairs[0][1]), (n_docs + 2, edited(rng, pairs[1][1] + " x y", 2)), (n_docs + 3, "du " * 300), (n_docs + 4, "da " + "du " * 90)]
    return pairs + [(n_docs + 5, None), (n_docs + 6, ""), (n_docs + 7, "é" * 1000), (n_docs + 8, "ab " * 400 + shared[0])]


@pytest.mark.parametrize("window", [50, 3])
def test_substrings_equal_brute_force(docs, window):
    pairs = passages(random.Random(window), 40, window * 2)
    got = {r["doc_id"]: (r["n_words"], r["text"], sum(s["end"] - s["start"] for s in r["spans"])) for r in substring_dedup.deduplicated(docs(pairs), window).collect()}
    assert got == {i: (n, t, g) for i, (n, t, g) in removed_words(pairs, window).items()}


def test_substrings_of_nulls_repeats_and_nothing(docs):
    text = " ".join(f"w{i}" for i in range(60))
    run = lambda pairs: sorted(((r["doc_id"], r["part"], len(r["text"].split())) for r in substring_dedup.deduplicated(docs(pairs)).collect()), key=str)
    assert run([]) == []
    assert run([(5, text), (5, text), (None, text), (7, text)]) == sorted([(5, 0, 60), (5, 1, 60), (None, 0, 60), (7, 0, 0)], key=str)


def removed_bytes(pairs, window):
    raw = [(t or "").encode() for _, t in pairs]
    count = Counter(b[k : k + window] for b in raw for k in range(len(b) - window + 1))
    out = {}
    for (i, _), b in zip(pairs, raw):
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("window", [400, 60, 3])
def test_suffixes_equal_brute_force(docs, window, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 30_000)
    pairs = passages(random.Random(window), 40, max(3, window // 4))
    got = {}
    for r in suffix_dedup.deduplicated(docs(pairs, clash=True), window, carry=("lang", "kappa")).collect():
        got[r["doc_id"]] = (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"]))
        assert r["kappa"] == "x"
    assert got == removed_bytes(pairs, window)


def test_suffixes_of_nulls_repeats_and_nothing(docs):
    rng = random.Random(1)
    text = sentence(rng, 200)[:500]
    run = lambda pairs: sorted(((r["doc_id"], r["part"], len(r["kept"])) for r in suffix_dedup.deduplicated(docs(pairs)).collect()), key=str)
    assert run([]) == []
    assert run([(5, text), (None, text)]) == sorted([(5, 0, 500), (None, 0, 500)], key=str)
    assert run([(5, text), (5, text), (None, text)]) == sorted([(5, 0, 0), (5, 1, 0), (None, 0, 500)], key=str)


def test_loser_tree_orders_strings_and_knows_their_prefixes():
    rng = random.Random(2)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(8))) for _ in range(rng.randrange(30))) for _ in range(k)]
        coded = [iter([(suffix_dedup.common_prefix(a, b), b, None) for a, b in zip([b"", *r], r)]) for r in runs]
        out = list(suffix_dedup.merged(coded))
        assert [x[1] for x in out] == sorted(x for r in runs for x in r)
        assert all(y[0] == suffix_dedup.common_prefix(x[1], y[1]) for x, y in zip(out, out[1:]))


def item_shingles(text):
    words = "".join(" " if ord(c) < 128 and PUNCTUATION[ord(c)] else c for c in text or "").lower().split(" ")
    return ngrams(" ".join(words), decontamination.WORDS)


def test_leaks_equal_brute_force(spark, docs):
    rng = random.Random(4)
    items = [(i, sentence(rng, n, 5000)) for i, n in enumerate([5, 6, 9, 17, 40, 64, 65, 130])] + [(50, "Just two"), (51, ""), (52, None), (None, "a b c d e f")]
    long = [sentence(rng, 3000, 5000) for _ in range(4)]
    pairs = [(i, f"{long[i % 4]} {t.upper() if t else ''}, {long[(i + 1) % 4]}") for i, (_, t) in enumerate(items)]
    half = lambda t: " ".join(t.split()[: len(t.split()) // 2])
    nine = lambda t: " ".join(t.split()[: len(t.split()) * 9 // 10])
    pairs += [(100 + i, f"{long[0]} {half(t)} {long[1]}") for i, t in items[:8]]
    pairs += [(200 + i, f"{nine(t)} {long[2]}") for i, t in items[:8]]
    pairs += [(300, "just two"), (301, "(Just) two!"), (302, None), (303, ""), (None, items[4][1]), (304, items[4][1]), (304, items[4][1])]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("value", F.lit("x"))
    got = {tuple(r) for r in decontamination.matches(docs(pairs), table.union(table)).collect()}
    expected = set()
    for d, t in pairs:
        for i, x in items:
            own = item_shingles(x)
            n = len(own & item_shingles(t))
            if own and d is not None and i is not None and n >= decontamination.THRESHOLD * len(own):
                expected.add((d, i, n, len(own)))
    assert got == expected and len(got) > 15
    kept = decontamination.decontaminated(docs(pairs), table)
    assert sorted(str(r[0]) for r in kept.select("doc_id").collect()) == sorted(str(d) for d, _ in pairs if d not in {x[0] for x in expected})
    assert decontamination.matches(docs([]), table).count() == 0 == decontamination.matches(docs(pairs), table.limit(0)).count()


def test_common_lead_in_is_verified_for_candidates_only(spark, docs):
    """Documents and items that all begin alike: a shingle they share does not make a pair."""
    rng = random.Random(6)
    lead = "all of them begin with these same words"
    items = [(i, f"{lead} {sentence(rng, 60, 10**6)}") for i in range(60)]
    pairs = [(i, f"{lead} {sentence(rng, 300, 10**6)}") for i in range(60)] + [(100 + i, f"x y z {items[i][1]} {lead}") for i in range(5)]
    found = decontamination.matches(docs(pairs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(100 + i, i) for i in range(5)]
    # What is verified is bounded by the candidates and their shingles.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("item_id") < plan.index("LeftSemi")


def test_rows_that_share_an_id_are_numbered(docs):
    made = rows.numbered(docs([(1, "b"), (1, "a"), (2, None)]), carry=("lang", "text")).orderBy("doc_id", "part").collect()
    assert [(r["doc_id"], r["part"], r["text"]) for r in made] == [(1, 0, "a"), (1, 1, "b"), (2, 0, None)]
