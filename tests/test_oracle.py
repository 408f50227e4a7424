"""Every registered query with an oracle must equal DuckDB's answer (sf0.001)."""
import pytest

from paths import SF0001
from oracle_compare import compare, duck
from screenlake.plans.catalog import ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    r = compare(spark, con, name, SF0001)
    assert r["cols_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["exact"], r


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "tinyint": "TINYINT", "smallint": "SMALLINT"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_types(spark, con, name):
    from screenlake.plans.catalog import QUERIES
    df = QUERIES[name](spark, SF0001)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert spark_types == duck_types
