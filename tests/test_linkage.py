from pathlib import Path

import pytest

from conftest import rows
from idweave import LinkageSpec, link
from idweave.plans.run import Job, link_table, run_job, updated_source
from idweave.operators import report
from idweave.sources.mapping import JobError, MappedColumn
from idweave.sources.readers import Source
from idweave.sources.writers import Sink, write_results
from idweave.spec import FUZZY_RULES, FuzzyRule

REG = (
    "p_cedula string, p_nombres string, p_apellidos string, p_nombres_apellidos string, p_sexo string, "
    "p_fecha_nac string, id_hash_rp string"
)
PIV = "p_cedula string, p_nombres string, p_apellidos string, p_sexo string, p_fecha_nac string, id_hash string"
COLUMNS = ("p_cedula", "p_nombres", "p_apellidos", "p_sexo", "p_fecha_nac", "iniciales", "p_nombres_apellidos")
OUTCOMES = ("matched", "not_found", "validated", "residual")

PEOPLE = [
    ("01", "ANA MARIA", "PAZ VERA", "PAZ VERA ANA MARIA", "2", "1990-01-01 00:00:00", "00101a"),
    ("02", "LUIS ANDRES", "MORA LEON", "MORA LEON LUIS ANDRES", "1", "1991-02-03 00:00:00", "00101b"),
    # 03 and 04: surname, sex and date in common, so rule 7 drops both.
    ("03", "ROSA", "VEGA RUIZ", "VEGA RUIZ ROSA", "2", "1980-05-05 00:00:00", "00202c"),
    ("04", "INES", "VEGA RUIZ", "VEGA RUIZ INES", "2", "1980-05-05 00:00:00", "00202d"),
    ("05", None, "SOLO APELLIDO", "SOLO APELLIDO", "1", "1970-01-01 00:00:00", "00202e"),
]
ROWS = [
    ("01", "ANA MARIA", "PAZ VERA", "2", "1990-01-01", "exact"),
    ("02", "OTRO", "NOMBRE", "1", "1991-02-03", "by_id_and_date"),
    (None, "LUIS ANDRES", "MORA LEOM", "1", "1991-02-03", "typo"),
    (None, "LUIS ANDRES", "MORA LEOM", "1", "1991-02-20", "typo_near_date"),
    ("03", "ROSA", "VEGA RUIZ", "2", "1980-05-05", "shrunk_away"),
    ("02", "LUIS ANDRES", "MORA LEOM", "9", None, "residual"),
    ("99", "NADIE", "AQUI", "9", None, "unknown_id"),
    (None, None, None, None, "no es fecha", "empty"),
]


def frames(spark):
    return spark.createDataFrame(PEOPLE, REG), spark.createDataFrame(ROWS, PIV)


def found(result):
    return {r.id_hash: (name, r.p_idr, r.id_etiqueta) for name in OUTCOMES for r in getattr(result, name).collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_every_outcome(spark, conf, ansi):
    with conf(spark__sql__ansi__enabled=ansi):
        result = link(*frames(spark), LinkageSpec(columns=COLUMNS))
        got = found(result)
    assert got == {
        "exact": ("validated", "01", "id_cedula_nombre_apell"),
        "by_id_and_date": ("matched", "02", "id_cedula_sexo_fna"),
        "typo": ("matched", "02", "idif_sexo_fna_N_A"),
        "typo_near_date": ("matched", "02", "idif_sexo_fna_N_A_30"),
        "shrunk_away": ("matched", "03", "id_cedula_nombre_apell"),
        "residual": ("residual", "02", "match cedula"),
        "unknown_id": ("not_found", "99", "no encontrado"),
        "empty": ("not_found", None, "no encontrado"),
    }
    # The person of "shrunk_away" fell to a uniqueness check after it was found.
    assert rows(result.matched.where("id_hash = 'shrunk_away'"), "p_nombres_reg") == [(None,)]
    assert result.matched.columns[0] == "p_idr" and result.matched.columns == result.validated.columns
    assert result.residual.columns[-2:] == ["id_etiqueta", "semidifuso"]
    result.release()


def test_names_from_whole_registry(spark):
    result = link(*frames(spark), LinkageSpec(columns=COLUMNS, names_from="full"))
    assert found(result)["shrunk_away"] == ("validated", "03", "id_cedula_nombre_apell")


def test_drop_matched(spark):
    result = link(*frames(spark), LinkageSpec(columns=COLUMNS, drop_matched=True, row_key_unique=True))
    got = found(result)
    # Person 02 was taken by an exact rule, so the typos find nobody.
    assert got["exact"][0] == "validated"
    assert got["typo"][0] == "not_found" and got["typo_near_date"][0] == "not_found"
    left = result.registry_left
    assert [r[0] for r in rows(left, "p_cedula")] == ["05"] and "id_hash_rp" in left.columns


def test_fan_out_keeps_best_and_rest(spark):
    people, _ = frames(spark)
    twins = people.where("p_cedula = '01'").selectExpr("'11' as p_cedula", *people.columns[1:])
    pivot = spark.createDataFrame([("PAZ VERA ANA MARIA", "2", "1990-01-01", "h")], "n string, s string, f string, id_hash string")
    pivot = pivot.toDF("p_nombres_apellidos", "p_sexo", "p_fecha_nac", "id_hash")
    spec = LinkageSpec(columns=("p_nombres_apellidos", "p_sexo", "p_fecha_nac"))
    result = link(people.unionByName(twins), pivot, spec)
    assert rows(result.validated, "p_idr") == [("01",)] and rows(result.matched, "p_idr") == [("11",)]
    assert dict(result.residual.dtypes)["semidifuso"] == "float"


def test_repeated_ids_in_registry(spark):
    people, pivot = frames(spark)
    other = people.where("p_cedula = '01'").selectExpr(
        "p_cedula", "'ANA' p_nombres", "'PAZ' p_apellidos", "'PAZ ANA' p_nombres_apellidos", *people.columns[4:]
    )
    result = link(people.unionByName(other), pivot, LinkageSpec(columns=COLUMNS))
    # Both rows named 01 come beside the match: the best is validated, the other stays.
    assert rows(result.validated.where("id_hash = 'exact'"), "p_nombres_reg") == [("ANA MARIA",)]
    assert rows(result.matched.where("id_hash = 'exact'"), "p_nombres_reg") == [("ANA",)]


@pytest.mark.parametrize("empty", ["registry", "pivot"])
def test_empty_tables(spark, empty):
    people, pivot = frames(spark)
    people, pivot = (people.limit(0), pivot) if empty == "registry" else (people, pivot.limit(0))
    got = found(link(people, pivot, LinkageSpec(columns=COLUMNS)))
    assert {v[0] for v in got.values()} == ({"not_found"} if empty == "registry" else set())
    assert len(got) == (len(ROWS) if empty == "registry" else 0)


def test_few_columns(spark):
    people, pivot = frames(spark)
    # Without an id nothing is settled by it; without dates no fuzzy rule runs.
    result = link(people, pivot.drop("p_cedula"), LinkageSpec(columns=("p_sexo", "p_nombres")))
    assert {v[0] for v in found(result).values()} == {"not_found"}
    with pytest.raises(ValueError, match="no linkage columns"):
        link(people, pivot, LinkageSpec(columns=("nada",)))
    with pytest.raises(ValueError, match="registry lacks"):
        link(people.drop("p_nombres"), pivot, LinkageSpec(columns=COLUMNS))




def test_from_source_to_update(spark):
    people, pivot = frames(spark)
    source = pivot.selectExpr(
        "p_cedula ced", "p_nombres nom", "p_apellidos ape", "p_sexo sex", "p_fecha_nac fec", "id_hash",
        "case when id_hash = 'exact' then 'ya' end id_etiqueta",
    )
    names = {"ced": "p_cedula", "nom": "p_nombres", "ape": "p_apellidos", "sex": "p_sexo", "fec": "p_fecha_nac"}
    mapping = [MappedColumn(k, v) for k, v in names.items()]
    result = link_table(people, source, mapping, "tabla")
    updated = {r.id_hash: r for r in updated_source(source, result, mapping).collect()}
    assert len(updated) == len(ROWS)
    assert updated["exact"].id_etiqueta == "ya" and updated["exact"].estado_identidad is None
    assert updated["typo"].ced == "02" and updated["typo"].ape == "MORA LEON"
    assert updated["typo"].p_nombres_apellidos == "MORA LEON LUIS ANDRES"
    assert updated["shrunk_away"].estado_identidad == "recuperado" and updated["shrunk_away"].nom == "ROSA"
    assert updated["residual"].estado_identidad == "residuales"
    assert updated["empty"].estado_identidad == "no encontrado" and updated["empty"].ced is None


def test_fuzzy_rules_with_unlike_blocks(spark):
    """Each group of rules searches its own block columns, in the order of the rules."""
    columns = "p_cedula string, p_nombres string, p_apellidos string, p_nombres_apellidos string, p_sexo string, p_fecha_nac string, p_fecha_de_fatte string"
    people = [("01", "LUIS ANDRES", "MORA LEON", "MORA LEON LUIS ANDRES", "1", "1991-02-03", "2001-01-01", "a")]
    table = [
        (None, "LUIS ANDRES", "MORA LEOM", "MORA LEOM LUIS ANDRES", "1", "1991-02-03", None, "birth"),
        (None, "LUIS ANDRES", "MORA LEOM", "MORA LEOM LUIS ANDRES", "1", None, "2001-01-01", "event"),
        (None, "LUIS ANDRES", "MORA LEOM", "MORA LEOM LUIS ANDRES", "1", None, None, "neither"),
    ]
    registry = spark.createDataFrame(people, columns + ", id_hash_rp string")
    pivot = spark.createDataFrame(table, columns + ", id_hash string")
    event = FuzzyRule("by_event", date="p_fecha_de_fatte")
    for rules, expected in (((*FUZZY_RULES, event), {"birth": FUZZY_RULES[0].label, "event": "by_event"}), ((event,), {"event": "by_event"})):
        result = link(registry, pivot, LinkageSpec(columns=(*COLUMNS, "p_fecha_de_fatte"), fuzzy_rules=rules))
        assert {r.id_hash: r.id_etiqueta for r in result.matched.collect()} == expected


def test_counts_while_writing_and_stored_tables(spark, tmp_path):
    result = link(*frames(spark), LinkageSpec(columns=COLUMNS))
    stored = {p.name for p in Path(result.work.path.removeprefix("file:")).iterdir()}
    assert stored == {"pivot", "registry", "assigned", "scored", "validated", "fuzzy0", "unresolved"}
    summary = report.outcome_summary(result.matched, result.deterministic, result.unresolved, result.validated)
    assert write_results(result, "t_", Sink("parquet", str(tmp_path))) == {r.id_etiqueta: r["count"] for r in summary.collect()}


def test_settled_rows_are_shuffled_for_their_outcome_only(spark):
    """What is unresolved is stored with its score, packed, and each outcome reads the rows it can have."""
    result = link(*frames(spark), LinkageSpec(columns=COLUMNS))
    for outcome, bound in ((result.residual, "LessThan(semidifuso"), (result.not_found, "GreaterThanOrEqual(semidifuso")):
        assert bound in outcome._jdf.queryExecution().executedPlan().toString()
    names = [p.name for p in Path(result.work.path.removeprefix("file:")).glob("unresolved/part-*")]
    assert names and all(name.endswith("zstd.parquet") for name in names)


def test_a_failed_step_leaves_no_tables(spark, monkeypatch):
    made = []
    monkeypatch.setattr("idweave.plans.linkage.residual_join", lambda *_: made.append(1) or 1 / 0)
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("idweave-*"))
    with pytest.raises(ZeroDivisionError):
        link(*frames(spark), LinkageSpec(columns=COLUMNS))
    assert made and set(Path(spark.conf.get("spark.checkpoint.dir")).glob("idweave-*")) == before


def test_fuzzy_rules_with_their_own_names_and_blocks(spark):
    """Any number of block columns, other name columns, and rules without a date."""
    columns = "p_cedula string, p_nombres string, p_apellidos string, p_nombres_apellidos string, p_sexo string, p_fecha_nac string, canton string, alias string"
    people = [("01", "LUIS ANDRES", "MORA LEON", "MORA LEON LUIS ANDRES", "1", "1991-02-03", "k1", "DON LUCHO MORA")]
    table = [
        (None, "X", "Y", "Y X", "1", "1991-02-10", "k1", "DON LUCHO MORAS", "alias"),
        (None, "X", "Y", "Y X", "1", "1991-02-10", "k2", "DON LUCHO MORAS", "other block"),
        (None, "X", "Y", "Y X", "1", None, "k1", "DON LUCHO MORAS", "no date"),
        (None, "LUIS ANDRES", "MORA LEOM", "MORA LEOM LUIS ANDRES", "1", "1991-02-03", "k9", None, "default names"),
    ]
    registry = spark.createDataFrame([(*p, "a") for p in people], columns + ", id_hash_rp string")
    pivot = spark.createDataFrame(table, columns + ", id_hash string")
    names = ("alias_n", "alias_a", "alias")
    near = FuzzyRule("by_alias", equal=("p_sexo", "canton"), days=30, names=names)
    undated = FuzzyRule("undated", equal=("p_sexo", "canton"), date=None, names=names)
    spec = LinkageSpec(columns=(*COLUMNS, "canton", "alias"), fuzzy_rules=(*FUZZY_RULES, near, undated))
    got = {r.id_hash: r.id_etiqueta for r in link(registry, pivot, spec).matched.collect()}
    assert got == {"alias": "by_alias", "no date": "undated", "default names": FUZZY_RULES[0].label}
    for wrong in ({"equal": ()}, {"date": None, "days": 3}, {"days": -1}):
        with pytest.raises(ValueError):
            FuzzyRule("wrong", **wrong)


@pytest.mark.parametrize("results", ["parquet", "table"])
def test_whole_job(spark, tmp_path, results):
    people, pivot = frames(spark)
    table = f"me06_{results}"
    names = {"ced": "p_cedula", "nom": "p_nombres", "ape": "p_apellidos", "sex": "p_sexo", "fec": "p_fecha_nac"}
    pivot.selectExpr(*[f"{v} {k}" for k, v in names.items()], "id_hash").write.parquet(f"{tmp_path}/{table}")
    people.selectExpr("*", "cast(null as string) p_identidad_mad", "cast(null as string) p_identidad_pad").write.parquet(f"{tmp_path}/people")
    spark.createDataFrame([(table, k, v) for k, v in names.items()], "tabla_entrada string, variables_tabla string, concepto string").write.parquet(f"{tmp_path}/mapping")
    spark.createDataFrame([("TRUE", table)], "precision string, tabla_escritura string").write.parquet(f"{tmp_path}/control")
    at = lambda name: Source("parquet", f"{tmp_path}/{name}")
    out = Sink("parquet", f"{tmp_path}/out")
    sink = out if results == "parquet" else Sink("table", "")
    job = Job(at("people"), at("mapping"), Source("parquet", str(tmp_path)), sink, control=at("control"), target=out, log=out, pruned=True)
    counts = run_job(spark, job)
    assert counts["total encontrados"] == 4 and counts["Validados"] == 1
    updated = {r.id_hash: r.estado_identidad for r in spark.read.parquet(f"{tmp_path}/out/{table}_actualizada").collect()}
    assert updated == {
        "exact": "validados", "by_id_and_date": "recuperado", "typo": "recuperado", "typo_near_date": "recuperado",
        "shrunk_away": "recuperado", "residual": "residuales", "unknown_id": "no encontrado", "empty": "no encontrado",
    }
    assert rows(spark.read.parquet(f"{tmp_path}/out/log_ratore"), "tabla", "proceso") == [(table, "guardado"), (table, "inicio")]
    with pytest.raises(JobError):
        run_job(spark, Job(at("people"), at("mapping"), at(""), sink, pattern="^nothing", log=out))
    with pytest.raises(ValueError):
        Job(at("people"), at("mapping"), at(""), sink)
