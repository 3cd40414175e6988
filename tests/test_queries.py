import os

import duckdb
import pytest

from docflow.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables here")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    if name in catalogue.ORACLE_SQL:
        r = con.execute(catalogue.ORACLE_SQL[name])
        names = [x[0] for x in r.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(x[names.index(c)] for c in columns) for x in r.fetchall()), key=repr)
    else:
        assert got


@pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables here")
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10 and set(entry.oracle_sql()) <= set(entry.queries())
