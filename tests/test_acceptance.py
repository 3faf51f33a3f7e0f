"""Every registered query of the analytics against its comparison SQL on the smallest data. Queries of separate parts
are tested beside them."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__
from __spark_entry__ import SMOKE_DIR, entry
from acceptance.oracle import oracle_sql
from acceptance.queries import queries

pytestmark = pytest.mark.skipif(not Path(SMOKE_DIR).exists(), reason="no test data")
SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in Path(SMOKE_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_entry(spark):
    assert entry(spark).count() > 0


def test_the_entry_registers_them_all():
    assert queries().keys() <= __spark_entry__.queries().keys()
    assert oracle_sql().items() <= __spark_entry__.oracle_sql().items()
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_only_approximate_metrics_have_no_sql():
    assert set(queries()) - set(oracle_sql()) == {"profile_monthly_sketches"}
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SMOKE_DIR)
    columns = sorted(df.columns)
    rows = Counter(repr(tuple(r)) for r in df.select(*columns).collect())
    if name not in oracle_sql():
        assert rows
        return
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert {n: SQL_TYPES.get(types[n], types[n].upper()) for n in columns} == {
        d[0]: str(d[1]).upper().replace(" ", "") for d in cursor.description
    }
    order = [names.index(n) for n in columns]
    expected = Counter(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    assert rows == expected
