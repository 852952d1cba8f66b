import os

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no driver tables here")




@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, db, name):
    rows = queries()[name](spark, SMALL).toPandas()
    assert len(rows.columns) == len(set(rows.columns))
    if name in oracle_sql():
        assert differences(rows, db.execute(oracle_sql()[name]).df()) is None


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "label" in df.columns
