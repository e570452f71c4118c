import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def _entry():
    import __spark_entry__

    return __spark_entry__


def plain(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(_entry().oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = _entry().queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    told = con.execute(_entry().oracle_sql()[name])
    names = [x[0] for x in told.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in told.fetchall()), key=repr)
    assert sorted(names) == columns and got == want


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.columns == ["id", "source", "source_subset", "messages", "tools", "tool_names", "quality", "metadata"] and df.count() > 0
