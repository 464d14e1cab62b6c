"""What the plans must and must not contain, and how hot keys are handled."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from idweave.operators.cascade import _unfold_keys, assign_rules, matched_pairs, without_people
from idweave.operators.fuzzy import fuzzy_match, used_once
from idweave.operators.joins import left_lookup
from idweave.operators.rowid import with_row_id
from idweave.operators.uniqueness import at_stage, compact, staged_registry, unique_on
from idweave.operators.validate import best_candidate
from idweave.runtime import Workspace
from idweave.sources.mapping import registry_scope
from idweave.spec import FUZZY_RULES, RULES, Rule

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", ["d05_id_nombreyapell_sexo_fnac", "f02_fuzzy_range", "r02_residuals", "u01_unique_key", "n03_row_id"])
def test_no_python_no_nested_loops_no_single_task(spark, name):
    import __spark_entry__ as entry

    text = plan(entry.queries()[name](spark, DATA))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "NestedLoop", "CartesianProduct"):
        assert bad not in text
    # Windows only to keep the first row of a key, cut before the exchange too.
    assert text.count("WindowGroupLimit") == 2 * len(re.findall(r"\bWindow \[", text))
    # The only single-partition exchange is the row count of the fixture's own scalar subquery.
    main = re.sub(r"Subquery subquery[\s\S]*?FileScan[^\n]*\n", "", text)
    assert "SinglePartition" not in main


@needs_data
def test_scan_reads_needed_columns_only(spark, tmp_path):
    import __spark_entry__ as entry

    text = plan(entry.queries()["n05_full_name"](spark, DATA))
    orders = next(line for line in text.splitlines() if "FileScan" in line and "o_orderkey" in line)
    assert "o_totalprice" not in orders
    spark.createDataFrame([("00101x",)], "id_hash_rp string").write.parquet(f"{tmp_path}/people")
    scoped = registry_scope(spark.read.parquet(f"{tmp_path}/people"), "rc02_revit_nor")
    assert "PushedFilters: [IsNotNull(id_hash_rp), StringStartsWith(id_hash_rp,00101)]" in plan(scoped)


def test_gram_work_is_not_repeated(spark):
    schema = "p_idr string, p_nombres string, p_apellidos string, p_nombres_apellidos string, p_sexo string, p_fecha_nac date"
    people = spark.createDataFrame([], schema)
    pivot = spark.createDataFrame([], schema.replace("p_idr", "p_idp"))
    found = fuzzy_match(people, pivot, FUZZY_RULES, True)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    # Full names are prepared once, in the stored profiles; given names and surnames of close pairs after the join.
    assert text.count("split(") == 4


def test_hot_key_is_split(spark, conf):
    """A third of the rows on one key: the adaptive join splits it, the result is whole."""
    n = 30_000
    pivot = spark.range(n).selectExpr(
        "concat('p', id) as p_idp", "if(id % 3 = 0, 'hot', concat('k', id)) as a", "repeat('x', 50) as pad", "0 as rule_no"
    )
    people = spark.range(n).selectExpr("if(id = 0, 'hot', concat('k', id)) as a", "concat('r', id) as p_idr")
    rule = [Rule("r", ("a",))]
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    with conf(**{k.replace(".", "__"): v for k, v in options.items()}):
        stages = compact(people.select("p_idr", "a")).withColumn("last_stage", F.lit(0))
        pairs = matched_pairs(stages, pivot, rule, copies=False)
        got = pairs.groupBy("p_idr").count().where("p_idr = 'r0'")
        assert got.first()["count"] == n // 3
        pairs = matched_pairs(stages, pivot, rule, copies=False)
        assert pairs.count() == n // 3 + sum(1 for i in range(1, n) if i % 3)
        people = people.selectExpr("a as k", "p_idr")
        frame = left_lookup(pivot.selectExpr("p_idp", "a as k", "pad"), people, "k", ["p_idp"])
        assert len(frame.collect()) == n
        assert "skew=true" in plan(frame)
        # Sides that are folded by the join key must not keep the other side whole.
        assigned = assign_rules(stages, pivot.drop("rule_no"), rule)
        assert len(assigned.where("rule_no = 0").collect()) == n // 3 + sum(1 for i in range(1, n) if i % 3)
        assigned = assign_rules(stages, pivot.drop("rule_no"), rule)
        assigned.collect()
        assert "skew=true" in plan(assigned)
        folded = people.groupBy("k").agg(F.min("p_idr").alias("p_idr"))
        frame = left_lookup(pivot.selectExpr("p_idp", "a as k", "pad"), folded, "k", ["p_idp"])
        assert len(frame.collect()) == n
        assert "skew=true" in plan(frame)
        registry = pivot.selectExpr("a as p_idr", "p_idp as x", "pad")
        left = without_people(registry, pivot.where("a <> 'hot'").selectExpr("a as p_idr"))
        assert len(left.collect()) == n // 3
        assert "skew=true" in plan(left)


def test_chunks_of_copies_stay_apart(spark):
    """A few rows with very many copies are unfolded by several tasks, though they are few bytes before."""
    ids = with_row_id(spark.range(40_000).selectExpr("concat('k', id % 2) as id_hash"))
    tasks = ids.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.countDistinct("p_idp").alias("ids")).collect()
    assert sum(r.n for r in tasks) == sum(r.ids for r in tasks) == 40_000
    assert len(tasks) == 4 and max(r.n for r in tasks) < 20_000


def test_unfolded_keys_are_not_broadcast(spark):
    """Keys unfolded by rule are many more rows than the files they come from let Spark expect."""
    people = spark.range(1).selectExpr("'r1' as p_idr", "concat('x', id) as a", "1L as copies", "0 as last_stage")
    rows_ = spark.range(1).selectExpr("'p1' as p_idp", "concat('x', id) as a")
    assigned = assign_rules(people, rows_, [Rule("r", ("a",))])
    pairs = matched_pairs(people, assigned, [Rule("r", ("a",))], copies=False)
    assert plan(pairs).count("SortMergeJoin") >= 2
    assert rows(pairs, "p_idr", "p_idp") == [("r1", "p1")]


def test_null_keys_are_spread(spark, conf):
    left = spark.range(1000).selectExpr("concat('p', id) p_idp", "if(id < 10, cast(id as string), null) k")
    right = spark.range(20).selectExpr("cast(id as string) k", "id v").unionByName(
        spark.sql("select cast(null as string) k, 99L v")
    )
    options = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__shuffle__partitions": "8"}
    with conf(**options):
        joined = left_lookup(left, right, "k", ["p_idp"])
        assert joined.count() == 1000 and joined.where("v is not null").count() == 10
        tasks = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 200


def test_hot_groups_fold_before_the_shuffle(spark):
    """Uniqueness groups partially on the map side, so a hot key is one row per task there."""
    df = spark.range(9000).selectExpr("cast(id as string) p_idr", "if(id % 3 = 0, null, cast(id as string)) a")
    text = plan(unique_on(df, ["a"]))
    assert "partial_count" in text and "Window" not in text
    assert unique_on(df, ["a"]).count() == 6000
    staged = staged_registry(compact(df), [Rule("r", ("a",), True)], Workspace(spark))
    assert [at_stage(staged, i).count() for i in (0, 1)] == [9000, 6000]


def test_copies_in_one_block(spark):
    """A block of equal names on a default date is compared once, and every row is answered."""
    day = dt.date(1900, 1, 1)
    names = "'ANA MARIA' p_nombres, 'PAZ VERA' p_apellidos, 'PAZ VERA ANA MARIA' p_nombres_apellidos, '2' p_sexo"
    people = spark.range(3000).selectExpr("format_string('%05d', id) p_idr", *names.split(", "), f"date'{day}' p_fecha_nac")
    pivot = people.withColumnRenamed("p_idr", "p_idp")
    found = fuzzy_match(people, pivot, FUZZY_RULES, True)
    assert rows(found.groupBy("p_idr", "id_etiqueta").count(), "p_idr", "count") == [("00000", 3000)]


def test_keys_are_one_to_one(spark):
    df = spark.createDataFrame([("1:2", "3"), ("1", "2:3"), ("", "1"), (None, "1")], "a string, b string")
    keys = [r.rule_key for r in _unfold_keys(df, [Rule("r", ("a", "b"))], ["a"]).collect()]
    assert len(keys) == 3 and len(set(keys)) == 3
    assert len({r.label for r in RULES}) == 17


@needs_data
def test_best_rows_need_no_sorted_fold(spark):
    """First rows and groups of one: no aggregate sorts whole rows, and candidates are cut before the exchange."""
    import __spark_entry__ as entry

    for name in ("f03_best_candidate", "r02_residuals", "u01_unique_key"):
        assert "SortAggregate" not in plan(entry.queries()[name](spark, DATA))
    matches = spark.range(100).selectExpr("concat('p', id) p_idp", "concat('r', id % 7) p_idr")
    assert "SortAggregate" not in plan(used_once(matches))


def test_row_with_very_many_candidates(spark):
    """They are cut to one per task before the exchange."""
    names = [f"'x' as {c}" for c in ("p_nombres_reg", "p_apellidos_reg", "p_nombres_apellidos_reg")]
    scored = spark.range(0, 40_000, 1, 8).selectExpr(
        "if(id % 2 = 0, 'hot', concat('p', id)) p_idp", "format_string('r%06d', 40000 - id) p_idr", *names, "cast(id % 5 as double) / 10 semidifuso"
    )
    best = best_candidate(scored, "semidifuso >= 0.1")
    assert best.count() == 20_001 - 4_000
    assert rows(best.where("p_idp = 'hot'"), "p_idr", "semidifuso") == [("r000004", 0.1)]
    text = plan(best)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
