"""Merkle manifest, spelling variants and forest search against plain definitions written from their contracts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from idweave.llm import forest, merkle, queries, variants

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


# --- Merkle manifest ----------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def plain_tree(nodes, fan=8):
    """The root, and for each node the siblings of its path as (place, others)."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for at in range(0, len(nodes), fan):
            run = nodes[at : at + fan]
            for place in range(len(run)):
                for leaf in under[at + place]:
                    paths[leaf].append((place, run[:place] + run[place + 1 :]))
            up.append(sha("".join(run)))
            below.append([leaf for u in under[at : at + fan] for leaf in u])
        nodes, under = up, below
    return nodes[0], paths


def null_first(x):
    return (x is not None, x.encode() if isinstance(x, str) else x or 0)


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(row)
    made = {}
    for lang, members in groups.items():
        members.sort(key=lambda r: (null_first(r["doc_id"]), plain_leaf(r)))
        made[lang] = plain_tree([plain_leaf(r) for r in members])
    langs = sorted(groups, key=null_first)
    root, tops = plain_tree([made[lang][0] for lang in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        subroot, paths = made[lang]
        for row, path in zip(groups[lang], paths, strict=True):
            path = path + top
            leaf = node = plain_leaf(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                node = plain_leaf(row | {"text": re.sub("[A-Z]", lambda m: m[0].lower(), row["text"])})
            for place, others in path:
                node = sha("".join([*others[:place], node, *others[place:]]))
            proof = sha("".join("".join(others) for _, others in path))
            out.append((row["doc_id"], leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_of(monkeypatch, frame, height):
    monkeypatch.setattr(queries, "table", lambda *_: frame)
    monkeypatch.setattr(queries.merkle, "HEIGHT", height)
    made = queries.merkle.manifest
    monkeypatch.setattr(queries.merkle, "manifest", lambda *a, **k: made(*a, height=height, **k))
    return sorted((tuple(r) for r in queries.op11_merkle_manifest(frame.sparkSession, "").select(RESULT).collect()), key=str)


@pytest.mark.parametrize("height", [1, 2])
def test_manifest_equals_plain_trees(spark, docs, monkeypatch, height):
    rng = random.Random(height)
    rows = []
    for lang, n in [("en", 150), ("de", 8), ("fr", 9), ("és", 64), (None, 1), ("", 65), ("zz", 1)]:
        for _ in range(n):
            text = rng.choice([None, "", "Ünïcode TEXT", "lower", "X" * rng.randrange(3000)])
            rows.append((rng.randrange(10**6), text, lang, rng.choice([None, "src"]), rng.choice([None, 5])))
    rows += [(None, "no id", "en", None, None)] * 2 + [(7, "Same", "en", "s", 4)] * 11 + [(7, "Same too", "en", "s", 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    clashing = frame.withColumns({c: F.lit("x") for c in ("g", "o", "node", "pos", "size", "tie", "seq", "also", "root", "block")})
    plain = plain_manifest([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r, strict=True)) for r in rows])
    assert manifest_of(monkeypatch, clashing, height) == plain


@pytest.mark.parametrize("rows", [[], [(3, "Only One", None, None, None)], [(1, None, "a", None, 1), (1, None, "a", None, 1)]])
def test_manifest_of_little(spark, monkeypatch, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plain = plain_manifest([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r, strict=True)) for r in rows]) if rows else []
    assert manifest_of(monkeypatch, frame, 4) == plain


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 513])
def test_appended_tree_equals_the_whole_one(n):
    leaves = [sha(str(i)) for i in range(n)]
    tree = merkle.Tree()
    for leaf in leaves:
        tree.append(leaf)
    root, paths = plain_tree(leaves)
    assert tree.close() == root
    for i, path in enumerate(paths[: len(paths) if n > 1 else 0]):
        places, texts = tree.runs[i // 8]
        assert [(p, "".join(o)) for p, o in path[1:]] == list(zip(places, texts, strict=True))


def test_witnesses_grow_with_later_siblings():
    tree = merkle.Tree()
    for i in range(63):
        tree.append(sha(str(i)))
    assert all(places == [] for places, _ in tree.runs) and len(tree.runs) == 7
    tree.append(sha("63"))
    assert [places for places, _ in tree.runs] == [[i] for i in range(8)]


@needs_data
def test_manifest_query_on_documents(spark):
    got = sorted((tuple(r) for r in queries.op11_merkle_manifest(spark, DATA).select(RESULT).collect()), key=str)
    assert got == plain_manifest(pq.read_table(f"{DATA}/documents.parquet").to_pylist())


# --- spelling variants --------------------------------------------------------------------


def plain_counts(rows, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 6:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(counts, ratio=5):
    by_size, near = defaultdict(list), {}
    for w in counts:
        by_size[len(w)].append(w)
    for w in counts:
        near[w] = [v for k in (-1, 0, 1) for v in by_size[len(w) + k] if one_edit(w, v)]
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]]))
    return sorted(out, key=str)


GROUP = ["word", "form", "root", "n", "n_near", "form_n"]


def groups_of(frame):
    return sorted((tuple(r) for r in frame.select(GROUP).collect()), key=str)


def test_variant_groups_equal_all_pairs(spark):
    rng = random.Random(3)
    counts = {}
    while len(counts) < 1500:
        word = "".join(rng.choice("aabé") for _ in range(rng.randrange(1, 8)))
        counts[word] = rng.choice([1, 2, 5, 30, 200, 1000])
    frame = spark.createDataFrame([*counts.items(), (None, 3)], "word string, n long").withColumn("key", F.lit("x"))
    assert groups_of(variants.spelling_groups(frame)) == plain_groups(counts)
    assert variants.spelling_groups(frame.where("false")).count() == 0


def test_forms_are_followed_to_the_end(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(words)}
    found = variants.spelling_groups(spark.createDataFrame([*counts.items()], "word string, n long"))
    assert groups_of(found) == plain_groups(counts)
    assert {r["root"] for r in found.collect()} == {"bbbbbb"}


def test_words_of_texts(spark, docs):
    long = "Alpha " * 30_000
    pairs = [(1, "École ÉCOLE x×y'don't ÿ"), (2, None), (3, ""), (None, "İstanbul Kelvin"), (4, long), (4, long)]
    got = Counter(r["word"] for r in variants.words(docs(pairs)).collect())
    expected = Counter()
    for _, text in pairs:
        expected.update(re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""))
    assert got == expected


@needs_data
def test_variant_query_on_documents(spark):
    rows = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = plain_groups(plain_counts([(r["doc_id"], r["text"]) for r in rows]))
    assert groups_of(queries.op12_spelling_variants(spark, DATA)) == expected and any(r[1] for r in expected)


@needs_data
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    frame = queries.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(str(tuple(map(str, r))) for r in frame.select(columns).collect())
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
        result = db.execute(queries.oracle_sql()[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == columns
        expected = sorted(str(tuple(str(r[names.index(c)]) for c in columns)) for r in result.fetchall())
    assert got == expected and got


# --- forest -------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>"


def plain_nearest(rows, k, is_query):
    width = max(len(v) for _, v in rows)
    m = np.array([[*v, *[0.0] * (width - len(v))] for _, v in rows])
    ids = np.array([i for i, _ in rows])
    norms = np.sqrt((m * m).sum(axis=1))
    out = {}
    for i in np.flatnonzero([is_query(x) for x in ids]):
        score = (m * m[i]).sum(axis=1) / (norms * norms[i])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found_of(frame):
    out = defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, true):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in best}) for q, best in true.items())
    return hits / sum(map(len, true.values()))


def test_full_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(forest, "CELL", 32)
    rng = np.random.default_rng(2)
    rows = [(i, list(map(float, v))) for i, v in enumerate(rng.standard_normal((400, 6)))]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(150)] + [(2000 + i, [1.0, 2.0]) for i in range(3)]
    bad = [(50_000, None), (50_050, [0.1, None]), (50_100, [float("nan"), 0.0]), (None, [0.1] * 6), (50_150, [float("inf")]), (50_200, []), (50_250, [0.0, 0.0])]
    frame = spark.createDataFrame(rows + bad, VECTORS).withColumns({c: F.lit("x") for c in ("id", "v", "q", "score", "cell", "leaf")})
    found = found_of(forest.nearest(frame, F.col("vec_id") % 50 == 0, recall=1.0, leaf=16))
    true = plain_nearest(rows, 5, lambda i: i % 50 == 0)
    assert found.keys() == true.keys()
    monkeypatch.setattr(forest, "needed_share", lambda *_: 99.0)
    found = found_of(forest.nearest(frame, F.col("vec_id") % 50 == 0, leaf=16))
    for q, best in true.items():
        assert [i for i, _ in found[q]] == [i for i, _ in best]
        assert np.allclose([s for _, s in found[q]], [s for _, s in best], rtol=0, atol=1e-12)


def test_little_and_extreme_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert forest.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [0.5])], VECTORS)
    assert forest.nearest(one, F.col("vec_id") % 50 == 0).count() == 0
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [-1.0, 0.0]), (0, [1e300, 2e300]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    found = found_of(forest.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0))
    assert [i for i, _ in found[0]] == [1, 3, 2]
    assert np.allclose([s for _, s in found[0]], [1, 0.5**0.5, -(0.5**0.5)])


@pytest.mark.parametrize("centres", [1, 40])
def test_recall_of_the_search(spark, centres):
    rng = np.random.default_rng(centres)
    m = rng.standard_normal((centres, 24))[rng.integers(0, centres, 6000)] * 3 + rng.standard_normal((6000, 24))
    rows = [(i, list(map(float, v))) for i, v in enumerate(m)]
    found = found_of(forest.nearest(spark.createDataFrame(rows, VECTORS).repartition(4), F.col("vec_id") % 50 == 0, leaf=64))
    true = plain_nearest(rows, 5, lambda i: i % 50 == 0)
    assert recall(found, true) >= 0.93 and all(len(f) == 5 for f in found.values())


@needs_data
def test_search_query_on_embeddings(spark):
    rows = [(r["vec_id"], list(map(float, r["embedding"]))) for r in pq.read_table(f"{DATA}/embeddings.parquet").to_pylist()]
    found, true = found_of(queries.op13_forest_search(spark, DATA)), plain_nearest(rows, 5, lambda i: i % 50 == 0)
    assert recall(found, true) >= 0.9
    scores = {(q, i): s for q, best in plain_nearest(rows, len(rows), lambda i: i % 50 == 0).items() for i, s in best}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, best in found.items() for i, s in best)


def test_queue_takes_leaves_best_first():
    rng = np.random.default_rng(0)
    units = rng.standard_normal((500, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    made = forest.fit_forest(units, 4, 3)
    sizes = np.stack([np.bincount(x, minlength=16) for x in made.route(units).T])
    margins = made.margins(units[:1])[0]
    taken = [(t, leaf) for t, leaf, _ in made.search(margins, sizes / 500, 99.0, sizes, 0)]
    assert len(set(taken)) == 48 and {(t, int(x)) for t, x in enumerate(made.route(units[:1])[0])} == set(taken[:3])

    def outside(t, leaf):
        node, total = leaf + 15, 0.0
        while node:
            up = (node - 1) // 2
            total += min(0.0, margins[t, up] * (1 if node == 2 * up + 2 else -1)) ** 2
            node = up
        return total

    order = [outside(*x) for x in taken]
    assert order == sorted(order)
