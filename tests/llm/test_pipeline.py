"""The pipeline on the smallest tables, stage by stage, and the contracts of queries."""

import random
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from idweave.llm import decontamination, jaccard_join
from idweave.runtime import Workspace

from .conftest import sentence
from .test_duplicates import components, item_shingles, removed_bytes

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    work = Workspace(spark)
    out = {"": spark.read.parquet(f"{DATA}/documents.parquet")}
    for name, stage in cp.STAGES:
        out[name] = work.store(stage(spark, list(out.values())[-1], DATA), name)
    return out


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_have_names_and_columns(stages):
    names = [n for n, _ in cp.STAGES]
    assert 4 <= len(names) <= 5 and all(stages[n].columns == cp.COLUMNS for n in names[:-1])
    assert stages[names[-1]].columns[:5] == cp.COLUMNS


def test_quality_follows_the_labels(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {i for i, _ in texts(stages["quality"])}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.97 * len(right)


def test_one_of_each_near_duplicate_group_stays(stages):
    before = texts(stages["quality"])
    found = components(before, jaccard_join.Join(5, 80))
    assert sorted(texts(stages["near_duplicates"])) == sorted((i, t) for i, t in before if found[i][1] == i)


def test_repeated_bytes_go(stages):
    before = texts(stages["near_duplicates"])
    expected = {i: b for i, b in removed_bytes(before, 400).items()}
    after = {i: x for (i, t) in before if (x := expected[i][3].decode("utf-8", "ignore")).strip() or not expected[i][1]}
    assert dict(texts(stages["suffix_dedup"])) == after


def test_cut_texts_are_made_where_they_are_cut(spark, docs):
    """Repeats that begin inside a character; one Python step a task, as each further one holds workers and their memory."""
    rng = random.Random(3)
    shared = sentence(rng, 200, 10**6)[:450]
    head, tail = ([sentence(rng, 30, 10**6) for _ in range(4)] for _ in range(2))
    pairs = [(i, f"{head[i]}{c}{shared}{tail[i]}") for i, c in enumerate("\u00e9\u0129")] + [(2, head[2]), (3, None), (4, shared), (5, ""), (6, f"{shared}\u00e9")]
    frame = cp.without_repeats(spark, docs(pairs), DATA)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in frame.collect()}
    raw = {i: b for i, b in removed_bytes(pairs, 400).items()}
    expected = {i: x if raw[i][1] else t for i, t in pairs if (x := raw[i][3].decode("utf-8", "ignore")).strip() or not raw[i][1]}
    assert got == {i: (t, len(t or "")) for i, t in expected.items()}
    assert raw[0][3] != got[0][0].encode() and 4 not in got


def test_documents_with_test_items_go(spark, stages):
    items = [item_shingles(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    before = texts(stages["suffix_dedup"])
    clean = [(i, t) for i, t in before if not any(s and len(s & item_shingles(t)) >= decontamination.THRESHOLD * len(s) for s in items)]
    assert sorted(texts(stages["decontamination"])) == sorted(clean)


def test_rates_meet_the_targets(stages):
    got = stages["mixing"].toPandas()
    assert len(got) == stages["decontamination"].count() and (got["rate"] > 0).all()
    total = got["tokens"].sum()
    assert (got["tokens"] * got["rate"]).sum() == pytest.approx(total, rel=0.05)


def test_stages_take_nulls_and_nothing(spark, stages):
    docs = stages[""]
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0)], docs.schema)
    for name, stage in cp.STAGES[:4]:
        assert stage(spark, odd, DATA).columns == cp.COLUMNS, name
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
    assert cp.STAGES[4][1](spark, odd, DATA).count() == 3
    assert cp.STAGES[4][1](spark, docs.limit(0), DATA).count() == 0


def test_entry_has_one_query_for_each_operator():
    names = list(entry.queries())
    assert "pipeline" in names and all(len([n for n in names if n.startswith(f"op{k}_")]) == 1 for k in range(1, 11))
