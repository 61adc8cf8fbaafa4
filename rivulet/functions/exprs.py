"""Column expressions with PostgreSQL semantics, built from Spark built-ins only.

Every function returns a ``Column``; nothing here leaves the JVM, so all of it
stays inside whole-stage codegen.  ``as_of`` stands for CURRENT_DATE /
CURRENT_TIMESTAMP so results are deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of)[:10])


def date_lit(d) -> Column:
    return F.lit(_date(d).isoformat()).cast("date")


def ts_lit(d, days_back: int = 0, ntz: bool = False) -> Column:
    """Midnight of ``d - days_back`` as a timestamp literal (session zone)."""
    day = _date(d) - _dt.timedelta(days=days_back)
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz" if ntz else "timestamp")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- text

def pg_initcap(c) -> Column:
    """INITCAP as PostgreSQL does it: any non-alphanumeric starts a word.

    Spark's ``initcap`` only splits on spaces (``Da-silva``); here the string is
    cut into alternating alphanumeric / other runs and each run is capitalised.
    """
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), 1)
    return F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")


def email_domain(c) -> Column:
    """``SUBSTRING(e FROM POSITION('@' IN e) + 1)``: after the first '@', else all."""
    return F.regexp_replace(_c(c), r"^[^@]*@", "")


# ---------------------------------------------------------------- dates

def pg_age_years(birth, as_of) -> Column:
    """``EXTRACT(YEAR FROM AGE(birth))`` at ``as_of``: completed years.

    Years are borrowed when (month, day) of ``as_of`` precede those of the birth
    date; the year part of a negative age truncates toward zero.
    """
    b = _c(birth)
    now = date_lit(as_of)
    by, bm, bd = F.year(b), F.month(b), F.dayofmonth(b)
    ny, nm, nd = F.year(now), F.month(now), F.dayofmonth(now)
    before = (nm < bm) | ((nm == bm) & (nd < bd))
    after = (bm < nm) | ((bm == nm) & (bd < nd))
    past = ny - by - F.when(before, 1).otherwise(0)
    future = -(by - ny - F.when(after, 1).otherwise(0))
    return F.when(b.isNull(), F.lit(None)).when(b <= now, past).otherwise(future).cast("int")


def days_between(later, earlier) -> Column:
    """``later - earlier`` for two dates, integer days, NULL if either is NULL."""
    return F.datediff(_c(later), _c(earlier))


# ---------------------------------------------------------------- derived columns
# The labels and thresholds of E1-E15, G3 and G4, which results must equal.

def categoria_cliente(data_cadastro, as_of) -> Column:  # E1
    c = _c(data_cadastro)
    return (F.when(c >= ts_lit(as_of, 30), "Novo")
            .when(c >= ts_lit(as_of, 365), "Recente")
            .otherwise("Antigo"))


# E-mail provider suffixes and labels, in rule order.
EMAIL_PROVIDERS = (
    ("%@gmail.com", "Gmail"),
    ("%@outlook.com", "Outlook"),
    ("%@yahoo.com", "Yahoo"),
    ("%@example.com", "Example"),
)


def provedor_email(email) -> Column:  # E2
    c = _c(email)
    out = None
    for pattern, label in EMAIL_PROVIDERS:
        out = (F.when if out is None else out.when)(c.like(pattern), label)
    return out.otherwise("Outro")


def tipo_cliente_abrev(tipo) -> Column:  # E3
    c = _c(tipo)
    return F.when(c == "pessoa_fisica", "PF").when(c == "pessoa_juridica", "PJ").otherwise("Outro")


def categoria_credito(limite) -> Column:  # E4
    c = _c(limite)
    return (F.when(c >= 10000, "Alto").when(c >= 5000, "Médio")
            .when(c > 0, "Baixo").otherwise("Sem Limite"))


def percentual_desconto(desconto, valor_bruto) -> Column:  # E5
    d, b = _c(desconto).cast("double"), _c(valor_bruto)
    return F.when(b > 0, d / b.cast("double") * 100).otherwise(F.lit(0.0))


def atraso_entrega_dias(real, prevista) -> Column:  # E6
    return days_between(real, prevista)


def status_estoque(atual, minimo) -> Column:  # E9
    a, m = _c(atual), _c(minimo)
    return (F.when(a <= m, "Estoque Baixo").when(a <= m * 2, "Estoque Normal")
            .otherwise("Estoque Alto"))


def categoria_margem(margem) -> Column:  # E10
    c = _c(margem)
    return (F.when(c >= 50, "Alta Margem").when(c >= 20, "Margem Normal")
            .when(c > 0, "Baixa Margem").otherwise("Sem Margem"))


def fase_produto(lancamento, as_of) -> Column:  # E11
    c = _c(lancamento)
    return (F.when(c >= date_lit(_date(as_of) - _dt.timedelta(days=30)), "Lançamento")
            .when(c >= date_lit(_date(as_of) - _dt.timedelta(days=365)), "Recente")
            .otherwise("Estabelecido"))


def categoria_score(score) -> Column:  # E12
    c = _c(score)
    return (F.when(c >= 80, "Lead Quente").when(c >= 50, "Lead Morno")
            .when(c > 0, "Lead Frio").otherwise("Sem Score"))


def categoria_orcamento(orcamento) -> Column:  # E13
    c = _c(orcamento)
    return (F.when(c >= 50000, "Alto Valor").when(c >= 10000, "Médio Valor")
            .when(c > 0, "Baixo Valor").otherwise("Valor Não Informado"))


def fase_funil(data_conversao, status_raw) -> Column:  # E14 (case-sensitive on the raw status)
    s = _c(status_raw)
    return (F.when(_c(data_conversao).isNotNull(), "Convertido")
            .when(s == "QUALIFICADO", "Qualificado").when(s == "NOVO", "Novo")
            .otherwise("Em Processo"))


def status_atividade(ultima_atividade, as_of) -> Column:  # E15
    c = _c(ultima_atividade)
    return (F.when(c >= ts_lit(as_of, 7, ntz=True), "Ativo")
            .when(c >= ts_lit(as_of, 30, ntz=True), "Inativo Recente")
            .otherwise("Inativo"))


def segmento_cliente(total_pedidos) -> Column:  # G3
    c = _c(total_pedidos)
    return (F.when(c > 10, "Cliente VIP").when(c > 5, "Cliente Regular")
            .when(c > 0, "Cliente Novo").otherwise("Cliente Inativo (sem pedidos)"))


def categoria_valor(limite, total_pedidos) -> Column:  # G4
    lim, n = _c(limite), _c(total_pedidos)
    return (F.when((lim >= 10000) & (n > 5), "Premium").when((lim >= 5000) & (n > 2), "Gold")
            .when(n > 0, "Silver").otherwise("Bronze"))
