import pytest
from pyspark.sql import functions as F

from idweave.operators import merge, report
from idweave.plans.run import merge_written, write_updated
from idweave.sources.writers import OUTCOMES, Sink
from idweave.sources.mapping import MappedColumn

MAPPING = [MappedColumn(c, f"p_{c}") for c in ("cedula", "nombres", "apellidos")]
OUT = (
    "id_hash string, p_idr string, id_etiqueta string, p_nombres_reg string, p_apellidos_reg string, "
    "p_nombres_apellidos_reg string"
)


def outcome(spark, *data):
    return spark.createDataFrame(list(data), OUT)


def frames(spark):
    source = spark.createDataFrame(
        [(h, "c", "n", "a") for h in ("a", "b", "c", "d", "e", "f", "f", None)],
        "id_hash string, cedula string, nombres string, apellidos string",
    )
    outcomes = {
        "validated": outcome(spark, ("a", "1", "v", "N1", "A1", "F1"), ("b", "2", "v", "N2", "A2", "F2")),
        "not_found": outcome(spark, ("c", None, "no encontrado", None, None, None)),
        "matched": outcome(
            spark,
            ("a", "9", "m", None, None, "F9"),
            ("b", "4", "m", "N4", "A4", "F4"),
            ("b", "3", "m", "N3", "A3", "F3"),
            ("d", "5", "m", "N5", None, "F5"),
            (None, "6", "m", "N6", "A6", "F6"),
        ),
        "residual": outcome(spark, ("e", "7", "r", "N7", "A7", "F7"), ("f", "8", "r", None, None, None)),
    }
    return source, outcomes


def updated(df):
    columns = ["cedula", "nombres", "apellidos", "p_nombres_apellidos", "id_etiqueta", "estado_identidad"]
    return {r.id_hash: tuple(r[c] for c in columns) for r in df.collect()}


def test_later_steps_win_column_by_column(spark):
    source, outcomes = frames(spark)
    df = merge.merge_results(source, outcomes, MAPPING)
    assert df.count() == source.count()
    assert updated(df) == {
        # The match without names sets id and full name; the validated names stay.
        "a": ("9", "N1", "A1", "F9", "m", "recuperado"),
        "b": ("3", "N3", "A3", "F3", "m", "recuperado"),
        "c": ("c", "n", "a", None, "no encontrado", "no encontrado"),
        "d": ("c", "n", "a", None, None, None),
        "e": ("7", "N7", "A7", "F7", "r", "residuales"),
        "f": ("8", "n", "a", None, "r", "residuales"),
        None: ("c", "n", "a", None, None, None),
    }


def test_validated_can_win(spark):
    source, outcomes = frames(spark)
    got = updated(merge.merge_results(source, outcomes, MAPPING, validated_wins=True))
    assert got["b"] == ("2", "N2", "A2", "F2", "v", "validados")
    assert got["a"] == ("1", "N1", "A1", "F1", "v", "validados")


def test_single_steps_and_missing_outcomes(spark):
    source, outcomes = frames(spark)
    got = updated(merge.merge_results(source, outcomes, MAPPING, steps=["recovered_no_names"]))
    assert got["a"] == ("9", "n", "a", "F9", "m", "recuperado") and got["b"][5] is None
    bare = merge.merge_results(source, {}, MAPPING)
    assert bare.columns[-3:] == list(merge.TARGET_COLUMNS) and bare.count() == source.count()


def test_columns_not_in_the_table_are_left_out(spark):
    source, outcomes = frames(spark)
    df = merge.merge_results(source.drop("nombres"), outcomes, MAPPING)
    assert "nombres" not in df.columns and df.where("id_hash = 'e'").first().apellidos == "A7"


def test_mapped_full_name_is_used(spark):
    pairs = merge.result_columns([MappedColumn("todo", "p_nombres_apellidos"), MappedColumn("s", "p_sexo")])
    assert pairs == [("todo", "p_nombres_apellidos")]


def test_reports(spark):
    _, o = frames(spark)
    counts = report.label_counts(o["matched"])
    assert [tuple(r) for r in counts.collect()] == [("m", 5)] and report.total(counts).first().total == 5
    assert report.total(report.label_counts(o["matched"].limit(0))).first().total == 0
    exact = o["matched"].where("p_idr < '5'")
    summary = report.outcome_summary(o["matched"], exact, o["not_found"], o["validated"])
    assert {r.id_etiqueta: r["count"] for r in summary.collect()} == {
        "m": 5,
        "total deterministico": 2,
        "total difuso": 3,
        "total encontrados": 5,
        "No encontrados": 1,
        "Validados": 2,
    }


def test_lowest_score_then_lowest_person_decides(spark):
    source, _ = frames(spark)
    residual = spark.createDataFrame(
        [("a", "9", "r", "N", "A", "F", 0.1), ("a", "1", "r", "N", "A", "F", 0.15), ("b", None, "r", "N", "A", "F", 0.1), ("b", "7", "r", "N", "A", "F", 0.1)],
        OUT + ", semidifuso double",
    )
    got = updated(merge.merge_results(source, {"residual": residual}, MAPPING))
    assert got["a"][0] == "9" and got["b"][0] == "7"
    matched = outcome(spark, ("a", None, "m", "N", "A", "F"), ("a", "5", "m", "N", "A", "F"), ("a", "4", "m", "N", "A", "F"))
    assert updated(merge.merge_results(source, {"matched": matched}, MAPPING))["a"][0] == "4"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_outcomes_meet_without_exchange(spark, conf):
    source, outcomes = frames(spark)
    sink = Sink("table", "", buckets=4)
    sink.write(source, "wsource", "overwrite")
    for name, suffix in OUTCOMES.items():
        sink.write(outcomes[name], f"w_{suffix}", "overwrite")
    with conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        merged = merge_written(spark, spark.table("wsource"), MAPPING, "w_", sink)
        assert merged.count() == source.count()
        assert updated(merged) == updated(merge.merge_results(source, outcomes, MAPPING))
        text = plan_of(merged)
        assert "Exchange" not in text and "SortMergeJoin" in text
    plain = merge_written(spark, spark.table("wsource"), MAPPING, "w_", Sink("table", ""), validated_wins=True)
    assert updated(plain)["b"][5] == "validados"
    with pytest.raises(ValueError, match="buckets"):
        Sink("parquet", "p", buckets=2)


def test_row_level_merge_is_built_from_the_steps(spark):
    """Condition and assignments, evaluated on a join as the table format would; no catalog is started."""
    source, outcomes = frames(spark)
    target = merge.with_target_columns(source)
    updates, condition, new = merge.merge_statement(outcomes, MAPPING, "target", target.columns)
    met = target.alias("target").join(updates, condition, "left")
    applied = met.select(*[new.get(c, F.col(f"target.{c}")).alias(c) for c in target.columns])
    assert updated(applied) == updated(merge.merge_results(source, outcomes, MAPPING))
    assert set(new) == {"id_etiqueta", "estado_identidad", "cedula", "nombres", "apellidos", "p_nombres_apellidos"}
    assert updates.groupBy("id_hash").count().where("count > 1").count() == 0
    with pytest.raises(ValueError, match="lacks"):
        merge.merge_statement(outcomes, MAPPING, "target", source.columns)


def test_updated_source_goes_to_a_new_place(spark, tmp_path):
    source, outcomes = frames(spark)
    sink = Sink("parquet", str(tmp_path))
    write_updated(merge.merge_results(source, outcomes, MAPPING), sink, "new")
    back = spark.read.parquet(f"{tmp_path}/new")
    assert updated(back) == updated(merge.merge_results(source, outcomes, MAPPING))
    with pytest.raises(Exception, match="(?i)exist"):
        write_updated(source, sink, "new")
