"""PostgreSQL-edge expressions on hand-made rows (FIXTURES.md section 4)."""
import datetime as dt

from pyspark.sql import functions as F

from rivulet.functions import exprs as E

AS_OF = dt.date(2001, 8, 1)


def one(spark, col, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


def test_initcap_like_postgres(spark):
    assert one(spark, E.pg_initcap(F.trim("x")), "  joão da-silva o'brien x2y a_b ") == \
        "João Da-Silva O'Brien X2y A_B"
    assert one(spark, E.pg_initcap("x"), "ÁGUA é") == "Água É"
    assert one(spark, E.pg_initcap("x"), "") == ""
    assert one(spark, E.pg_initcap("x"), None) is None


def test_age_years(spark):
    born = dt.date(2000, 2, 29)
    assert one(spark, E.pg_age_years("x", dt.date(2025, 2, 28)), born, "x date") == 24
    assert one(spark, E.pg_age_years("x", dt.date(2025, 3, 1)), born, "x date") == 25
    assert one(spark, E.pg_age_years("x", AS_OF), AS_OF, "x date") == 0
    assert one(spark, E.pg_age_years("x", AS_OF), dt.date(2002, 1, 1), "x date") == 0
    assert one(spark, E.pg_age_years("x", AS_OF), None, "x date") is None


def test_email_domain(spark):
    assert one(spark, E.email_domain("x"), "a@b.com") == "b.com"
    assert one(spark, E.email_domain("x"), "a@b@c") == "b@c"
    assert one(spark, E.email_domain("x"), "sem-arroba") == "sem-arroba"


def test_thresholds(spark):
    cases = [
        (E.categoria_credito, [(10000, "Alto"), (9999.99, "Médio"), (5000, "Médio"), (0.01, "Baixo"),
                               (0, "Sem Limite"), (None, "Sem Limite")]),
        (E.categoria_margem, [(50, "Alta Margem"), (49.99, "Margem Normal"), (20, "Margem Normal"),
                              (0.01, "Baixa Margem"), (0, "Sem Margem"), (None, "Sem Margem")]),
        (E.categoria_score, [(80, "Lead Quente"), (79, "Lead Morno"), (50, "Lead Morno"), (1, "Lead Frio"),
                             (0, "Sem Score"), (None, "Sem Score")]),
        (E.categoria_orcamento, [(50000, "Alto Valor"), (10000, "Médio Valor"), (1, "Baixo Valor"),
                                 (0, "Valor Não Informado"), (None, "Valor Não Informado")]),
        (E.segmento_cliente, [(11, "Cliente VIP"), (10, "Cliente Regular"), (6, "Cliente Regular"),
                              (5, "Cliente Novo"), (1, "Cliente Novo"), (0, "Cliente Inativo (sem pedidos)"),
                              (None, "Cliente Inativo (sem pedidos)")]),
    ]
    for fn, pairs in cases:
        df = spark.createDataFrame([(float(v) if v is not None else None,) for v, _ in pairs], "x double")
        got = [r["r"] for r in df.select(fn("x").alias("r")).collect()]
        assert got == [want for _, want in pairs], fn.__name__


def test_recency_boundaries(spark):
    rows = [(dt.datetime(2001, 7, 2),), (dt.datetime(2001, 7, 1, 23, 59),), (dt.datetime(2000, 8, 1),),
            (dt.datetime(2000, 7, 31),), (None,)]
    df = spark.createDataFrame(rows, "x timestamp")
    got = [r["r"] for r in df.select(E.categoria_cliente("x", AS_OF).alias("r")).collect()]
    assert got == ["Novo", "Recente", "Recente", "Antigo", "Antigo"]


def test_fase_funil_is_case_sensitive(spark):
    df = spark.createDataFrame([(None, "QUALIFICADO"), (None, "qualificado"), (None, "NOVO"),
                                (dt.date(2024, 1, 2), "NOVO"), (None, None)], "d date, s string")
    got = [r["r"] for r in df.select(E.fase_funil("d", "s").alias("r")).collect()]
    assert got == ["Qualificado", "Em Processo", "Novo", "Convertido", "Em Processo"]


def test_margin_overflow_rejected(spark):
    from rivulet.operators import rules
    df = spark.createDataFrame([(1, "P1", "n", 1.00, 20.00), (2, "P2", "n", 10.0, 20.0)],
                               "id long, codigo_produto string, nome string, preco_custo double, "
                               "preco_venda double")
    out = rules.conform(df, "produtos", AS_OF)
    assert [(r["id"], float(r["margem_lucro"])) for r in out.collect()] == [(2, 100.0)]
