import datetime as dt

import pytest
from pyspark.sql import functions as F

from idweave.functions.normalize import initials, normalize_date, with_full_name, with_initials


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates(spark, conf, ansi):
    day = dt.date(1999, 1, 2)
    cases = {
        "1999-01-02": day,
        "1999-1-2": day,
        " 1999-01-02 ": day,
        "1999-01-02 10:11:12": day,
        "1999": dt.date(1999, 1, 1),
        "1999-01-02 10:11": None,
        "1999-01-02T10:11:12": None,
        "1999/01/02": None,
        "02-01-1999": None,
        "": None,
        "nada": None,
        None: None,
    }
    with conf(spark__sql__ansi__enabled=ansi):
        df = spark.createDataFrame([(c,) for c in cases], "x string")
        got = {r.x: r.d for r in df.select("x", normalize_date(F.col("x")).alias("d")).collect()}
    assert got == cases


def test_typed_dates_pass(spark):
    df = spark.sql("select timestamp'1999-01-02 03:04:05' t, date'1999-01-02' d")
    row = df.select(normalize_date(F.col("t")), normalize_date(F.col("d"))).first()
    assert tuple(row) == (dt.date(1999, 1, 2), dt.date(1999, 1, 2))


def test_initials(spark):
    cases = {
        "ana maría lópez": "AML",
        "  ana   lopez ": "AL",
        "ana lopez": "AL",
        "élan ñu": "ÉÑ",
        "ßa": "SS",
        "   ": "",
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    assert {r.x: r.i for r in df.select("x", initials(F.col("x")).alias("i")).collect()} == cases


def test_full_name(spark):
    df = spark.createDataFrame(
        [("ANA", "PAZ", "X Y"), ("ANA", "PAZ", ""), ("ANA", None, None), (None, None, None)],
        "p_nombres string, p_apellidos string, p_nombres_apellidos string",
    )
    assert [r.p_nombres_apellidos for r in with_full_name(df).collect()] == ["X Y", "PAZ ANA", "ANA", ""]
    built = with_full_name(df.drop("p_nombres_apellidos"))
    assert [r.p_nombres_apellidos for r in built.collect()] == ["PAZ ANA", "PAZ ANA", "ANA", ""]
    assert "p_nombres_apellidos" not in with_full_name(df.select("p_nombres")).columns
    assert "iniciales" not in with_initials(df.select("p_nombres")).columns
    given = df.withColumn("iniciales", F.lit("ZZ"))
    assert {r.iniciales for r in with_initials(given).collect()} == {"ZZ"}
