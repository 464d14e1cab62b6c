import random
from collections import Counter
from pathlib import Path

import pytest

from conftest import rows
from idweave.operators.cascade import assign_rules, cascade, cascade_stepwise, match_exact, unmatched, without_people
from idweave.operators.keyfilter import key_bitmap, maybe_among
from idweave.operators.rowid import with_row_id
from idweave.operators.uniqueness import ambiguous_on, at_stage, compact, expand, staged_registry, unique_on
from idweave.runtime import Workspace
from idweave.spec import RULES, Rule, applicable, applicable_fuzzy, FUZZY_RULES, LinkageSpec, usable

SCHEMA = "p_idr string, a string, b string, c string"


def test_unique_and_ambiguous(spark):
    data = [("1", "x", None, "p"), ("2", "x", None, "q"), ("3", "y", "k", "r"), ("4", None, None, "s")]
    df = spark.createDataFrame(data, SCHEMA)
    assert [r[0] for r in rows(unique_on(df, ["a", "b"]), "p_idr")] == ["3", "4"]
    assert [r[0] for r in rows(ambiguous_on(df, ["a", "b"]), "p_idr")] == ["1", "2"]
    spared = unique_on(df, ["a", "b"], null_key_is_duplicate=False)
    assert [r[0] for r in rows(spared, "p_idr")] == ["1", "2", "3", "4"]


def test_uniqueness_is_cumulative(spark):
    rules = [Rule("r0", ("a",), True), Rule("r1", ("b",)), Rule("r2", ("c",), True)]
    # 1 and 2 share a; once both are gone, 3 is alone on c although 2 shared it.
    data = [("1", "x", "k", "u"), ("2", "x", "k", "v"), ("3", "y", "k", "v"), ("4", "z", "k", "w"), ("4", "z", "k", "w")]
    work = Workspace(spark)
    staged = staged_registry(compact(spark.createDataFrame(data, SCHEMA)), rules, work)
    stages = [at_stage(staged, i) for i in range(3)]
    assert [[r[0] for r in rows(s, "p_idr")] for s in stages] == [["1", "2", "3", "4"], ["3"], ["3"]]
    assert expand(stages[0]).count() == 5
    assert [p.name for p in Path(work.path.removeprefix("file:")).iterdir()] == ["registry"]
    spared = staged_registry(compact(spark.createDataFrame([("1", None, "k", "u"), ("2", None, "k", "u")], SCHEMA)), rules, Workspace(spark), False)
    assert rows(spared, "p_idr", "last_stage") == [("1", 1), ("2", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_single_pass_equals_stepwise(spark, seed):
    rng = random.Random(seed)

    def value(k):
        return rng.choice([None, "", ":1", *[str(i) for i in range(k)]])

    rules = [
        Rule("r0", ("a", "b", "c")),
        Rule("r1", ("a", "b"), True),
        Rule("r2", ("b", "c")),
        Rule("r3", ("c", "a"), True),
        Rule("r4", ("a",), True),
        Rule("r5", ("c",)),
    ]
    people = [(str(rng.randrange(150)), value(9), value(9), value(6)) for _ in range(200)]
    people += people[:20]
    pivot = [(f"p{i}", value(9), value(9), value(6)) for i in range(300)]
    registry = spark.createDataFrame(people, SCHEMA)
    pivot = spark.createDataFrame(pivot, "p_idp string, a string, b string, c string")
    slow, slow_rest, slow_registry = cascade_stepwise(registry, pivot, rules, Workspace(spark))
    work = Workspace(spark)
    staged = staged_registry(compact(registry), rules, work)
    fast, fast_rest = cascade(staged, pivot, rules, work)
    columns = ["p_idr", "p_idp", "a", "b", "c", "id_etiqueta"]
    assert slow.count() > 100
    assert rows(fast, *columns) == rows(slow, *columns)
    assert rows(fast_rest, "p_idp") == rows(slow_rest, "p_idp")
    assert rows(at_stage(staged, 3), *SCHEMA.replace(" string", "").split(", ")) == rows(
        slow_registry, *SCHEMA.replace(" string", "").split(", ")
    )


def test_full_bitmap_only_costs_rows(spark):
    """Keys that are in the bitmap always pass, however full it is; the emptier it is, the fewer others do."""
    keys = spark.range(500).selectExpr("cast(id % 100 as string) k", "cast(id % 3 as int) n").unionByName(spark.sql("select cast(null as string) k, 1 n"))
    tried = spark.range(20_000).selectExpr("cast(id as string) k", "cast(id % 3 as int) n")
    there = {(r["k"], r["n"]) for r in keys.collect()}
    passed = {}
    for bits in (6, 9, 20):
        bitmap = key_bitmap(keys, ["k", "n"], bits)
        assert bitmap.count() <= 1 << (bits - 6)
        got = {(r["k"], r["n"]) for r in maybe_among(tried, ["k", "n"], bitmap, bits).collect()}
        assert {(r["k"], r["n"]) for r in tried.collect()} & there <= got
        passed[bits] = len(got)
    assert passed[6] == 20_000 > passed[9] > passed[20] and passed[20] < 150
    people = spark.createDataFrame([(str(i), str(i % 70), "b", "c") for i in range(90)], SCHEMA)
    pivot = spark.range(400).selectExpr("concat('p', id) p_idp", "cast(id % 90 as string) a", "'b' b", "'c' c")
    rules = [Rule("r0", ("a", "b"), True), Rule("r1", ("a", "c"))]
    staged = staged_registry(compact(people), rules, Workspace(spark))
    whole, full = (rows(assign_rules(staged, pivot, rules, bits), "p_idp", "rule_no") for bits in (25, 6))
    assert whole == full and {r[1] for r in whole} == {0, None}


def test_no_rule_applies(spark):
    pivot = spark.createDataFrame([("p", "x")], "p_idp string, a string")
    found, rest = cascade(None, pivot, [], Workspace(spark))
    assert found.columns == ["p_idr", "p_idp", "a", "id_etiqueta"] and found.count() == 0 and rest.count() == 1


def test_match_keeps_all_people(spark):
    people = spark.createDataFrame([("1", "x", "k", "u"), ("2", "x", "k", "v"), ("3", None, "k", "w")], SCHEMA)
    pivot = spark.createDataFrame([("p", "x", "k"), ("q", None, "k")], "p_idp string, a string, b string")
    found = match_exact(people, pivot, ["a", "b"], "L")
    assert rows(found, "p_idr", "p_idp", "id_etiqueta") == [("1", "p", "L"), ("2", "p", "L")]
    assert [r[0] for r in rows(unmatched(pivot, found), "p_idp")] == ["q"]
    assert [r[0] for r in rows(without_people(people, found), "p_idr")] == ["3"]


def test_row_ids(spark):
    data = [("h", "x"), ("h", "x"), ("h", None), ("h", ""), (None, "x"), (None, None), ("g", "x")]
    df = spark.createDataFrame(data, "id_hash string, v string")
    ids = [r.p_idp for r in with_row_id(df).collect()]
    assert len(set(ids)) == len(data)
    again = with_row_id(df.repartition(3)).select("p_idp").collect()
    assert sorted(ids) == sorted(r.p_idp for r in again)
    assert with_row_id(df, unique=True).where("p_idp <> id_hash").count() == 0


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr("idweave.operators.rowid.COPY_CHUNK", 10)
    df = spark.createDataFrame([("h", "x")] * 95 + [("g", "y")], "id_hash string, v string")
    ids = with_row_id(df).collect()
    assert len(ids) == 96 and len({r.p_idp for r in ids}) == 96
    assert Counter(r.id_hash for r in ids) == {"h": 95, "g": 1}


def test_applicable():
    columns = ["p_cedula", "p_nombres_apellidos", "p_sexo"]
    assert [r.label for r in applicable(RULES, columns)] == ["id_cedula_nombreyapllido"]
    assert applicable_fuzzy(FUZZY_RULES, columns) == []
    with pytest.raises(ValueError, match="no linkage columns"):
        applicable(RULES, [])
    assert usable(["z", "b", "a", "b"], ["a", "b"], ["b", "a", "z"]) == ["b", "a"]
    with pytest.raises(ValueError):
        LinkageSpec(columns=("a",), threshold=0.9)
    with pytest.raises(ValueError):
        LinkageSpec(columns=("a",), names_from="other")
