"""Registry and pivot tables derived from the test tables ``customer`` and ``orders``.

Every customer is a person; every order is an administrative record of its customer, with
one kind of damage per order class. Row counts grow with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.sources.mapping import MappedColumn

GIVEN_NAMES = "ANA,LUIS,MARIA,JOSE,CARMEN,PEDRO,ROSA,DIEGO,ELENA,MARCO,SOFIA,RAUL,INES,TOMAS,PAULA,HUGO,NORA"
FAMILY_NAMES = (
    "LOPEZ,GARCIA,TORRES,VERA,MENDOZA,CEDENO,ZAMBRANO,ORTIZ,PAREDES,SALAZAR,BRAVO,CASTRO,NUNEZ,ROJAS,"
    "VEGA,MORA,LEON,SUAREZ,IBARRA"
)


def _pick(names: str, index: str) -> str:
    return f"split_part('{names}', ',', cast(1 + {index} % {names.count(',') + 1} as int))"


# The texts below run unchanged in Spark and DuckDB; {customer}, {orders} and {registry}
# stand for the inputs.
REGISTRY_SQL = f"""
with size as (select count(*) n from {{customer}}),
c as (
  select c_custkey k, case when c_custkey % 50 = 1 then c_custkey - 1 else c_custkey end b from {{customer}}),
x as (
  select c.k, c.b, (select n from size) n,
    {_pick(GIVEN_NAMES, "c.b")} || ' ' || {_pick(GIVEN_NAMES, "(c.b * 7 + e.c_nationkey)")} nom,
    {_pick(FAMILY_NAMES, "(c.b * 5)")} || ' ' || {_pick(FAMILY_NAMES, "(c.b * 3 + e.c_nationkey)")} ape
  from c join {{customer}} e on e.c_custkey = c.b)
select lpad(cast(k as string), 10, '0') p_cedula, nom p_nombres, ape p_apellidos,
  ape || ' ' || nom p_nombres_apellidos,
  cast(b % 2 + 1 as string) p_sexo,
  cast(date '1980-01-01' + cast((b * 7919) % 9000 as int) as string) || ' 00:00:00' p_fecha_nac,
  case when k % 9 = 4 then null else 'M' || lpad(cast((b * 31) % (n * 3) as string), 9, '0') end p_cedula_mad,
  case when k % 11 = 4 then null else 'P' || lpad(cast((b * 17) % (n * 3) as string), 9, '0') end p_cedula_pad,
  case when k % 4 = 0 then '00101' else '00202' end || lpad(cast(k as string), 10, '0') id_hash_rp
from x
"""

PV_SQL = """
with j as (
  select o.o_orderkey ok, o.o_orderkey % 24 cls, r.*
  from {orders} o join {registry} r on r.p_cedula = lpad(cast(o.o_custkey as string), 10, '0')),
t as (
  select *,
    left(p_apellidos, cast(length(p_apellidos) - 1 as int)) || 'X' apet,
    left(p_nombres, cast(length(p_nombres) - 1 as int)) nomt,
    left(p_nombres, 1) || 'XX ' || left(split_part(p_nombres, ' ', 2), 1) || 'YY' nomi,
    left(p_apellidos, 1) || 'ZZ ' || left(split_part(p_apellidos, ' ', 2), 1) || 'WW' apei
  from j)
select 'h' || lpad(cast(ok as string), 9, '0') id_hash, cls, p_cedula truth,
  case when cls in (0,1,2,5,19,21,22) then p_cedula when cls = 20 then 'X' || right(p_cedula, 9) end cedula,
  case when cls in (0,3,9,11,22) then p_nombres when cls in (5,13,14) then nomi
       when cls in (6,15,16) then 'KKK' when cls in (17,18,19,23) then nomt
       when cls = 20 then 'QQQ WWW' when cls in (2,21) then 'ZZZ YYY' end nombres,
  case when cls in (0,3,6,9,11,15,16,22) then p_apellidos when cls in (5,13,14) then apei
       when cls in (17,18,19,23) then apet when cls = 20 then 'JJJ KKK'
       when cls in (2,21) then 'HHH FFF' end apellidos,
  case when cls in (1,4,10,12) then p_nombres_apellidos end nombres_apellidos,
  case when cls in (2,3,4,5,6,7,8,13,14,17,18,22,23) then p_sexo when cls = 19 then '9' end sexo,
  case when cls in (2,3,4,6,7,8,17) then p_fecha_nac
       when cls = 18 then cast(cast(left(p_fecha_nac, 10) as date) + cast(ok % 29 + 1 as int) as string)
       when cls = 23 then cast(cast(left(p_fecha_nac, 10) as date) + 30 as string)
       when cls = 22 then left(p_fecha_nac, 10) end fecha_nac,
  case when cls in (7,9,10,13,15) then p_cedula_mad end cedula_mad,
  case when cls in (8,11,12,14,16) then p_cedula_pad end cedula_pad,
  case when ok % 5 = 0 then 'recuperado' when ok % 5 = 1 then 'no encontrado' end id_etiqueta
from t
"""

# At most 4001 keys, so that rows share them; the first rows have none.
REPEATED_KEY = "case when id_hash > 'h000000009' then 'k' || cast(cast(right(id_hash, 9) as bigint) % 4001 as string) end"

MAPPING = [
    MappedColumn(c, f"p_{c}")
    for c in (
        "cedula",
        "nombres",
        "apellidos",
        "nombres_apellidos",
        "sexo",
        "fecha_nac",
        "cedula_mad",
        "cedula_pad",
    )
]
MAPPING_FULL = [MappedColumn(c, f"p_{c}") for c in ("nombres_apellidos", "sexo", "fecha_nac")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REGISTRY_SQL, customer=table(spark, sf_dir, "customer"))


def pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PV_SQL, orders=table(spark, sf_dir, "orders"), registry=registry(spark, sf_dir))


def pv_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot whose row keys are shared by some rows each; a few are null."""
    return pv(spark, sf_dir).withColumn("id_hash", F.expr(REPEATED_KEY))


def pv_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot that knows full names only, each completed from its parts."""
    built = F.coalesce("nombres_apellidos", F.concat_ws(" ", "apellidos", "nombres"))
    return pv(spark, sf_dir).select("id_hash", built.alias("nombres_apellidos"), "sexo", "fecha_nac")
