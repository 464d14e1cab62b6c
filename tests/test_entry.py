"""The registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables not present")

SAMPLE = [
    "s05_pending_filter",
    "n03_row_id",
    "n07_initials",
    "d06_id_cedula_iniciales_sexo",
    "d16_id_cedulma_apell",
    "u02_ambiguous_key",
    "m02_norm",
    "m06_name_score",
    "f02_fuzzy_range",
    "r03_not_found",
    "j01_full_linkage",
    "w09_merged",
]


def test_every_query_has_its_sql():
    others = entry.llm.queries().keys() | {"pipeline"} if entry.llm else set()
    assert entry.queries().keys() - others == entry.oracle_sql().keys() - others


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    frame = entry.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(str(tuple(map(str, r))) for r in frame.select(*columns).collect())
    with duckdb.connect() as db:
        for table in ("customer", "orders"):
            db.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
        result = db.execute(entry.oracle_sql()[name])
        names = [c[0] for c in result.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        expected = sorted(str(tuple(str(r[i]) for i in order)) for r in result.fetchall())
    assert got == expected and got
