import datetime as dt
from types import SimpleNamespace

import pytest

from conftest import rows
from idweave.runtime import Workspace, shared_dir
from idweave.sources import mapping as m
from idweave.sources.readers import Source, modulo_predicates, prefix_bounds, range_predicates, read_pivot, read_registry
from idweave.sources.writers import Sink, log_event, write_at_once, write_registry_left, write_results

MAPPING = [
    ("t1", "ced", "p_cedula"),
    ("t1", "nom", "p_nombres"),
    ("t1", "ape", "p_apellidos"),
    ("t1", "otra", None),
    ("t2_2023", "x", "p_cedula"),
    ("t2_2024", "x", "p_cedula"),
]


def test_job_selection(spark):
    control = spark.createDataFrame([("TRUE", "t1"), ("FALSE", "t2")], "precision string, tabla_escritura string")
    assert m.select_job(control) == "t1"
    with pytest.raises(m.JobError, match="several"):
        m.select_job(control.unionByName(control))
    with pytest.raises(m.JobError, match="none"):
        m.select_job(control.where("precision = 'FALSE'"))


def test_job_selection_by_name(spark):
    mapping = spark.createDataFrame(MAPPING, "tabla_entrada string, variables_tabla string, concepto string")
    assert m.select_job_like(mapping, "^t1") == "t1"
    with pytest.raises(m.JobError, match="several"):
        m.select_job_like(mapping, "^t2")
    with pytest.raises(m.JobError, match="none"):
        m.select_job_like(mapping, "1$|^x")  if False else m.select_job_like(mapping, "^x")
    loaded = sorted(m.load_mapping(mapping, "t1"), key=lambda c: c.physical)
    assert [(c.physical, c.concept) for c in loaded] == [
        ("ape", "p_apellidos"),
        ("ced", "p_cedula"),
        ("nom", "p_nombres"),
        ("otra", None),
    ]
    with pytest.raises(m.JobError, match="no mapping"):
        m.load_mapping(mapping, "t9")


def test_linkage_columns():
    def concepts(*names):
        return m.linkage_columns([m.MappedColumn(str(n), n) for n in names])

    both = ["iniciales", "p_nombres_apellidos"]
    assert concepts("p_cedula", None) == ["p_cedula"]
    assert concepts("p_nombres", "p_cedula") == ["p_nombres", "p_cedula"]
    assert concepts("p_nombres", "p_apellidos") == ["p_nombres", "p_apellidos", *both]
    assert concepts("p_nombres_apellidos", "p_sexo") == ["p_nombres_apellidos", "p_sexo", "iniciales"]


def test_missing_columns(spark):
    df = spark.createDataFrame([("1", "h")], "ced string, id_hash string")
    wanted = [m.MappedColumn(c, f"p_{n}") for c, n in (("ced", "cedula"), ("nom", "nombres"), ("sex", "sexo"))]
    projected = m.project_concepts(df, m.with_defaults(wanted, df.columns))
    assert [tuple(r) for r in projected.collect()] == [("1", None, "2", "h")]
    with pytest.raises(ValueError, match="fec"):
        m.with_defaults([*wanted, m.MappedColumn("fec", "p_fecha_nac")], df.columns)


def test_pending_and_scope(spark):
    df = spark.createDataFrame(
        [("a", "no encontrado"), ("b", None), ("c", "x")], "id_hash_rp string, id_etiqueta string"
    )
    assert [r[0] for r in rows(m.pending_only(df), "id_hash_rp")] == ["a", "b"]
    assert m.pending_only(df.drop("id_etiqueta")).count() == 3
    scoped = spark.createDataFrame([("00101x",), ("00202x",), ("0010",)], "id_hash_rp string")
    assert rows(m.registry_scope(scoped, "rc02_revit_nor"), "id_hash_rp") == [("00101x",)]
    assert m.registry_scope(scoped, "otra").count() == 3


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([("1", "a")], "p_cedula string, v string")
    path = str(tmp_path / "people")
    df.write.parquet(path)
    assert read_registry(spark, Source("parquet", path)).collect() == df.collect()
    df.write.mode("overwrite").saveAsTable("people_table")
    assert read_pivot(spark, Source("table", "people_table")).collect() == df.collect()
    jdbc = Source("jdbc", "people", {"url": "jdbc:x"}, split_on=("id", "0", "100", 20))
    assert jdbc.reader_options() == {
        "url": "jdbc:x",
        "dbtable": "people",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "20",
    }
    assert Source("jdbc", "people", {"url": "u"}).reader_options() == {"url": "u", "dbtable": "people"}


@pytest.mark.parametrize("bounds", [[], ["5"], ["2", "5", "7"], ["7", "2", "O'Neil", "2"]])
def test_range_predicates_hold_every_row_once(spark, bounds):
    """Also when the bounds are not in order, as under another collation."""
    keys = [None, "", "0", "2", "20", "5", "6", "7", "9", "O'Neil", "é"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    found = [r["k"] for p in range_predicates("k", bounds) for r in df.where(p).collect()]
    assert sorted(found, key=str) == sorted(keys, key=str)
    assert len(range_predicates("k", bounds)) == len(bounds) + 1


def test_modulo_predicates_hold_every_row_once(spark):
    df = spark.range(-50, 50).selectExpr("id", "cast(if(id % 9 = 0, null, id * 37) as bigint) h")
    parts = modulo_predicates("h", 7)
    sizes = [df.where(p).count() for p in parts]
    assert len(parts) == 7 and sum(sizes) == 100 and min(sizes) > 0
    assert df.where(" or ".join(f"cast({a} and {b} as boolean)" for i, a in enumerate(parts) for b in parts[:i])).count() == 0


def test_prefix_bounds():
    assert prefix_bounds(1) == [] and prefix_bounds(4) == ["2", "5", "7"]
    many = prefix_bounds(32)
    assert len(many) == 31 and many == sorted(set(many)) and {len(b) for b in many} == {2}
    assert prefix_bounds(2, "ABCD") == ["C"]


def test_predicates_reach_the_reader(monkeypatch):
    calls = {}
    fake = SimpleNamespace(read=SimpleNamespace(jdbc=lambda url, table, **more: calls.update(url=url, table=table, **more)))
    parts = range_predicates("p_cedula", prefix_bounds(3))
    read_registry(fake, Source("jdbc", "people", {"url": "jdbc:x", "user": "u"}, predicates=parts))
    assert calls == {"url": "jdbc:x", "table": "people", "predicates": list(parts), "properties": {"user": "u"}}
    for wrong in ({"predicates": parts}, {"options": {"url": "u"}, "predicates": parts, "split_on": ("a", "0", "1", 2)}):
        with pytest.raises(ValueError):
            Source("jdbc", "people", **wrong)
    with pytest.raises(ValueError, match="JDBC"):
        Source("parquet", "p", {"url": "u"}, predicates=parts)


def test_outcomes_in_one_pass(spark, tmp_path):
    """One write; views give each outcome back with its own columns; counts come from the same pass."""
    one = spark.createDataFrame([("1", "a", "x"), ("2", None, "y"), ("2", None, "y")], "p_idr string, v string, id_etiqueta string")
    scored = one.selectExpr("*", "0.25D as semidifuso")
    result = SimpleNamespace(
        matched=one, not_found=scored.where("false"), validated=one.where("p_idr = '1'"), residual=scored, labels=("x", "y", "z"), exact_labels=("x",), unresolved_rows=5
    )
    expected = {"x": 1, "y": 2, "total deterministico": 1, "total difuso": 2, "total encontrados": 3, "No encontrados": 5, "Validados": 1}
    for sink, table in ((Sink("parquet", str(tmp_path)), "una_"), (Sink("table", ""), "dos_")):
        group = f"one pass {table}"
        spark.sparkContext.setJobGroup(group, group)
        assert write_at_once(result, table, sink) == expected
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) == 1
        for suffix, df in (("mach_join", one), ("mach_pivot", scored.where("false")), ("validados", one.where("p_idr = '1'")), ("residuales", scored)):
            back = spark.table(f"{table}{suffix}")
            assert back.columns == df.columns and rows(back, *df.columns) == rows(df, *df.columns)
    assert write_results(result, "tres_", Sink("parquet", str(tmp_path))) == expected
    with pytest.raises(ValueError, match="JDBC"):
        write_at_once(result, "t", Sink("jdbc", ""))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", None)], "p_idr string, v string")
    result = SimpleNamespace(matched=df, not_found=df.limit(0), validated=df, residual=df, registry_left=df)
    sink = Sink("parquet", str(tmp_path))
    write_results(result, "tabla", sink)
    write_results(result, "tabla", sink)
    for suffix, n in (("mach_join", 1), ("mach_pivot", 0), ("validados", 1), ("residuales", 1)):
        back = spark.read.parquet(f"{tmp_path}/tabla{suffix}")
        assert back.count() == n and back.columns == df.columns
    write_registry_left(result, str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/mach_reg.csv")
    assert [tuple(r) for r in back.collect()] == [("1", None)]
    write_results(result, "tab_", Sink("table", "default"))
    assert spark.table("default.tab_mach_join").count() == 1


def test_run_log(spark, tmp_path):
    sink = Sink("parquet", str(tmp_path))
    log_event(spark, sink, "t1", "inicio", dt.datetime(2024, 1, 2, 3, 4, 5), "runs")
    log_event(spark, sink, "t1", "guardado", dt.datetime(2024, 1, 2, 4, 0, 0), "runs")
    log = spark.read.parquet(f"{tmp_path}/runs")
    assert log.columns == (
        "tabla script proceso fecha nobs error id_table id_proceso codigo_ejecucion id_ejecucion".split()
    )
    assert rows(log, "tabla", "script", "proceso", "fecha", "nobs") == [
        ("t1", "05", "guardado", "2024-01-02 04:00:00", None),
        ("t1", "05", "inicio", "2024-01-02 03:04:05", None),
    ]


def test_workspace(spark):
    work = Workspace(spark)
    assert work.path.startswith(shared_dir(spark)) and shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = work.store(spark.range(3), "t")
    assert kept.count() == 3
    work.release()
    with pytest.raises(Exception, match="(?i)path|file"):
        spark.read.parquet(f"{work.path}/t").count()
