"""The registered queries of the subpackage, and their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from gridsight.llm import queries
from tools.check_oracle import TABLES, canonical


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, name):
    got = entry.queries()[name](spark, sf).toPandas()
    assert len(got)
    if name in queries.ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = con.execute(queries.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and canonical(got).equals(canonical(want))


def test_native_plans_have_no_python(spark, sf):
    for name in ("op10_sharding", "op5_personal_data"):
        text = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
