import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from rivulet.session import local_session

    # The whole test session shares this one; whoever starts it first stops it.
    return local_session("*", app="rivulet-llm-tests", shuffle_partitions=8)


@pytest.fixture(autouse=True)
def nothing_kept():
    """What a test caches or checkpoints is gone before the next one of the shared session."""
    yield
    from pyspark.sql import SparkSession
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()
        for kept in list(session.sparkContext._jsc.getPersistentRDDs().values()):
            kept.unpersist(True)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def oracle(small):
    """Rows of a query's SQL over the smallest tables."""
    import duckdb

    def run(sql, columns):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(columns)
        at = [names.index(c) for c in columns]
        return sorted(tuple(str(r[i]) for i in at) for r in result.fetchall())
    return run


def rows_of(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())
