"""Every core query that has SQL gives what the SQL gives; every other one runs."""

import pytest

from tessella import registry
from tests.compare import DATA, same, tables

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return tables()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    if name in SQL:
        same(got, con.sql(SQL[name]).df())
    assert len(set(got.columns)) == len(got.columns)


def test_flagship_keeps_every_token(spark):
    chunks = registry.flagship(spark, DATA).toPandas()
    assert (chunks.n_tokens[~chunks.oversize] <= 4096).all()
    total = spark.sql(f"select sum(length(code) div 4) from (select file_id, max(code) code from parquet.`{DATA}/src_file.parquet` where code is not null group by 1)").first()[0]
    assert chunks.n_tokens.sum() == total
