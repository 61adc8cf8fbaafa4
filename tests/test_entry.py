"""Driver contract: entry runs, every query has a matching oracle where given,
and a sample of queries equals its DuckDB oracle on sf0.001."""
import duckdb

import __spark_entry__ as E
from main_paths import SF001

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "segmento_cliente" in df.columns


def test_oracles_are_registered_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 65


def _compare(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    order = sorted(o_cols)

    def norm(rows, cols):
        idx = [cols.index(c) for c in order]
        return sorted((tuple(repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in idx)
                       for r in rows))
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(res.fetchall(), o_cols)


def test_gold_and_cdc_against_oracle(spark):
    for name in ("gold_visao_geral_clientes", "agg_valor_pedidos_por_cliente_mensal",
                 "cdc_replica_clientes", "dq_declared_tests", "m18_funnel_check"):
        _compare(spark, name)
