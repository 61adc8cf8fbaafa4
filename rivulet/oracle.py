"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code (DuckDB functions where they exist,
e.g. ``age``), over the raw tables only: the domain mappings come in as CTEs
from the same SQL text Spark uses.  Conventions shared with
``rivulet.registry.comparable``: every non-integer number leaves as DOUBLE,
extracted date parts as INTEGER, timestamps without time zone.
"""

from __future__ import annotations

from rivulet.sources.fixtures import oracle_cte

AS_OF = "2001-08-01"
AS_OF_LEADS = "2024-01-31"


def initcap(x: str) -> str:
    """PostgreSQL INITCAP in DuckDB (no native initcap)."""
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), "
            r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), lambda t: upper(t[1]) || t[2:]), '')")


def dbl(x: str) -> str:
    return f"cast({x} as double)"


# Generated margin of produtos, exact: hundredths = round_half_up(diff/cost * 10000)
# computed in integer cents; the row is rejected when it overflows decimal(5,2).
_MARGIN_H = ("(case when pv_c - pc_c >= 0 then (2 * (pv_c - pc_c) * 10000 + pc_c) // nullif(2 * pc_c, 0) "
             "else -((2 * (pc_c - pv_c) * 10000 + pc_c) // nullif(2 * pc_c, 0)) end)")

PRODUTOS_TABLE = f"""
produtos as (
  select p.*, case when p.preco_custo > 0 then cast({_MARGIN_H} as decimal(18,0)) / 100
                   else cast(0 as decimal(18,2)) end as margem_lucro
  from (select m.*, cast(m.preco_venda * 100 as bigint) as pv_c, cast(m.preco_custo * 100 as bigint) as pc_c
        from produtos_raw m) p
  where not (p.preco_custo > 0 and abs({_MARGIN_H}) > 99999)
)
"""


def with_tables(*names: str) -> str:
    """WITH clause for domain tables; ``produtos`` gets its generated margin."""
    base = [n if n != "produtos" else None for n in names]
    parts = oracle_cte([n for n in base if n]) if any(base) else ""
    if "produtos" in names:
        from rivulet.sources.fixtures import MAPPINGS
        raw = f"produtos_raw as ({MAPPINGS['produtos'].strip()}),\n{PRODUTOS_TABLE.strip()}"
        parts = (parts.rstrip() + ",\n" + raw + "\n") if parts else ("with " + raw + "\n")
    return parts


# ------------------------------------------------------------------ bronze

BRONZE_CLIENTES_COLS = ("id, nome, email, telefone, cpf, data_nascimento, endereco, status, "
                        "tipo_cliente, cast(limite_credito as double) as limite_credito, "
                        "data_cadastro, updated_at, created_by, version, "
                        "updated_at as ultima_modificacao_fonte")

BRONZE_PEDIDOS_COLS = ("id, cliente_id, numero_pedido, data_pedido, status, "
                       "cast(valor_bruto as double) as valor_bruto, cast(desconto as double) as desconto, "
                       "cast(valor_liquido as double) as valor_liquido, metodo_pagamento, canal_venda, "
                       "observacoes, data_entrega_prevista, data_entrega_real, updated_at, created_by, "
                       "version, updated_at as ultima_modificacao_fonte")

SQL: dict[str, str] = {}

SQL["bronze_clientes"] = with_tables("clientes") + f"""
select {BRONZE_CLIENTES_COLS} from clientes where nome is not null
"""

SQL["bronze_pedidos"] = with_tables("pedidos") + f"""
select {BRONZE_PEDIDOS_COLS} from pedidos where valor_bruto > 0
"""

SQL["bronze_produtos"] = with_tables("produtos") + """
select id, codigo_produto, nome, categoria, subcategoria, marca,
  cast(preco_custo as double) as preco_custo, cast(preco_venda as double) as preco_venda,
  cast(margem_lucro as double) as margem_lucro, estoque_atual, estoque_minimo, ativo,
  cast(null as double) as peso, cast(null as varchar) as dimensoes, cast(null as varchar) as descricao,
  cast(null as varchar[]) as tags, data_lancamento, fornecedor_id, updated_at,
  'sistema' as created_by, 1 as version, updated_at as ultima_modificacao_fonte
from produtos where nome is not null
"""

SQL["bronze_leads"] = with_tables("leads") + """
select id, nome, email, cast(null as varchar) as telefone, cast(null as varchar) as empresa,
  cast(null as varchar) as cargo, fonte, campanha_id, score, status, interesse,
  cast(orcamento_estimado as double) as orcamento_estimado, data_contato, data_conversao,
  cast(null as varchar) as observacoes, cast(null as varchar[]) as tags, ultima_atividade, updated_at,
  'sistema' as created_by, 1 as version, updated_at as ultima_modificacao_fonte
from leads where nome is not null
"""

# ------------------------------------------------------------------ silver

SQL["dim_clientes"] = with_tables("clientes") + f"""
select id as cliente_id, nome, lower(trim(email)) as email_limpo, email as email_original,
  telefone, cpf, data_nascimento, endereco, status, tipo_cliente,
  cast(limite_credito as double) as limite_credito, data_cadastro, updated_at,
  case when data_cadastro >= date '{AS_OF}' - interval 30 day then 'Novo'
       when data_cadastro >= date '{AS_OF}' - interval 365 day then 'Recente' else 'Antigo' end as categoria_cliente,
  case when email like '%@gmail.com' then 'Gmail' when email like '%@outlook.com' then 'Outlook'
       when email like '%@yahoo.com' then 'Yahoo' when email like '%@example.com' then 'Example'
       else 'Outro' end as provedor_email,
  case tipo_cliente when 'pessoa_fisica' then 'PF' when 'pessoa_juridica' then 'PJ' else 'Outro' end as tipo_cliente_abrev,
  case when limite_credito >= 10000 then 'Alto' when limite_credito >= 5000 then 'Médio'
       when limite_credito > 0 then 'Baixo' else 'Sem Limite' end as categoria_credito
from clientes where nome is not null
"""

_PCT = ("case when valor_bruto > 0 then cast(desconto as double) / cast(valor_bruto as double) * 100 "
        "else 0.0 end")
_DELAY = "cast(date_diff('day', data_entrega_prevista, data_entrega_real) as integer)"

SQL["fct_pedidos"] = with_tables("pedidos", "clientes") + f"""
select p.id as pedido_id, p.cliente_id, c.nome as nome_cliente, c.tipo_cliente, p.numero_pedido,
  p.status as status_pedido, cast(p.valor_bruto as double) as valor_bruto,
  cast(p.desconto as double) as desconto, cast(p.valor_liquido as double) as valor_liquido,
  p.metodo_pagamento, p.canal_venda, p.observacoes, p.data_pedido, p.data_entrega_prevista,
  p.data_entrega_real,
  cast(extract(year from p.data_pedido) as integer) as ano_pedido,
  cast(extract(month from p.data_pedido) as integer) as mes_pedido,
  cast(extract(day from p.data_pedido) as integer) as dia_pedido,
  p.updated_at,
  case when p.valor_bruto > 0 then cast(p.desconto as double) / cast(p.valor_bruto as double) * 100 else 0.0 end as percentual_desconto,
  cast(date_diff('day', p.data_entrega_prevista, p.data_entrega_real) as integer) as atraso_entrega_dias
from pedidos p left join (select * from clientes where nome is not null) c on p.cliente_id = c.id
where p.valor_bruto > 0
"""

SILVER_CLIENTES = f"""
select id as cliente_id_origem, {initcap('trim(nome)')} as nome_completo,
  lower(trim(email)) as email_padronizado, telefone, cpf, data_nascimento, endereco, status,
  tipo_cliente, cast(limite_credito as double) as limite_credito,
  data_cadastro as data_cadastro_ts, updated_at as updated_at_ts,
  timestamp '{AS_OF} 00:00:00' as data_processamento,
  substring(email, position('@' in email) + 1) as dominio_email,
  cast(extract(year from data_cadastro) as integer) as ano_cadastro,
  case when data_nascimento is not null
       then cast(date_part('year', age(timestamp '{AS_OF} 00:00:00', cast(data_nascimento as timestamp))) as integer)
  end as idade_estimada
from clientes where email is not null and nome is not null
"""

SQL["silver_clientes"] = with_tables("clientes") + SILVER_CLIENTES

SILVER_PEDIDOS = f"""
select id as pedido_id_origem, cliente_id as cliente_id_origem, trim(numero_pedido) as numero_pedido_clean,
  status, cast(valor_bruto as double) as valor_bruto_decimal, cast(desconto as double) as desconto_decimal,
  cast(valor_liquido as double) as valor_liquido_decimal, metodo_pagamento, canal_venda, observacoes,
  data_pedido as data_pedido_ts, data_entrega_prevista, data_entrega_real, updated_at as updated_at_ts,
  timestamp '{AS_OF} 00:00:00' as data_processamento,
  cast(extract(year from data_pedido) as integer) as ano_pedido,
  cast(extract(month from data_pedido) as integer) as mes_pedido,
  cast(extract(day from data_pedido) as integer) as dia_pedido,
  {_PCT} as percentual_desconto, {_DELAY} as atraso_entrega_dias
from pedidos where valor_bruto > 0
"""

SQL["silver_pedidos"] = with_tables("pedidos") + SILVER_PEDIDOS

SQL["silver_produtos"] = with_tables("produtos") + f"""
select id as produto_id_origem, trim(codigo_produto) as codigo_produto_clean,
  {initcap('trim(nome)')} as nome_produto_clean, upper(trim(categoria)) as categoria_padronizada,
  upper(trim(subcategoria)) as subcategoria_padronizada, {initcap('trim(marca)')} as marca_clean,
  cast(preco_custo as double) as preco_custo_decimal, cast(preco_venda as double) as preco_venda_decimal,
  cast(margem_lucro as double) as margem_lucro_decimal, estoque_atual, estoque_minimo, ativo,
  cast(null as double) as peso, cast(null as varchar) as dimensoes, cast(null as varchar) as descricao,
  cast(null as varchar[]) as tags, data_lancamento, fornecedor_id, updated_at as updated_at_ts,
  timestamp '{AS_OF} 00:00:00' as data_processamento,
  case when estoque_atual <= estoque_minimo then 'Estoque Baixo'
       when estoque_atual <= estoque_minimo * 2 then 'Estoque Normal' else 'Estoque Alto' end as status_estoque,
  case when margem_lucro >= 50 then 'Alta Margem' when margem_lucro >= 20 then 'Margem Normal'
       when margem_lucro > 0 then 'Baixa Margem' else 'Sem Margem' end as categoria_margem,
  case when data_lancamento >= date '{AS_OF}' - interval 30 day then 'Lançamento'
       when data_lancamento >= date '{AS_OF}' - interval 365 day then 'Recente' else 'Estabelecido' end as fase_produto
from produtos where nome is not null and preco_venda > 0 and ativo = true
"""

SQL["silver_leads"] = with_tables("leads") + f"""
select id as lead_id_origem, {initcap('trim(nome)')} as nome_lead_clean,
  lower(trim(email)) as email_lead_clean, cast(null as varchar) as telefone,
  cast(null as varchar) as empresa_clean, cast(null as varchar) as cargo_clean,
  upper(trim(fonte)) as fonte_padronizada, campanha_id, score, upper(trim(status)) as status_padronizado,
  upper(trim(interesse)) as interesse_padronizado,
  cast(orcamento_estimado as double) as orcamento_estimado_decimal,
  data_contato as data_contato_clean, data_conversao as data_conversao_clean,
  cast(null as varchar) as observacoes, cast(null as varchar[]) as tags,
  ultima_atividade as ultima_atividade_ts, updated_at as updated_at_ts,
  timestamp '{AS_OF_LEADS} 00:00:00' as data_processamento,
  case when score >= 80 then 'Lead Quente' when score >= 50 then 'Lead Morno'
       when score > 0 then 'Lead Frio' else 'Sem Score' end as categoria_score,
  case when orcamento_estimado >= 50000 then 'Alto Valor' when orcamento_estimado >= 10000 then 'Médio Valor'
       when orcamento_estimado > 0 then 'Baixo Valor' else 'Valor Não Informado' end as categoria_orcamento,
  case when data_conversao is not null then 'Convertido' when status = 'QUALIFICADO' then 'Qualificado'
       when status = 'NOVO' then 'Novo' else 'Em Processo' end as fase_funil,
  case when ultima_atividade >= timestamp '{AS_OF_LEADS} 00:00:00' - interval 7 day then 'Ativo'
       when ultima_atividade >= timestamp '{AS_OF_LEADS} 00:00:00' - interval 30 day then 'Inativo Recente'
       else 'Inativo' end as status_atividade,
  substring(email, position('@' in email) + 1) as dominio_email_lead
from leads where nome is not null and email is not null
"""

# ------------------------------------------------------------------ gold

SQL["agg_valor_pedidos_por_cliente_mensal"] = with_tables("pedidos", "clientes") + """
select p.cliente_id, c.nome as nome_cliente,
  cast(extract(year from p.data_pedido) as integer) as ano_pedido,
  cast(extract(month from p.data_pedido) as integer) as mes_pedido,
  cast(sum(p.valor_liquido) as double) as valor_total_pedidos_mensal,
  count(distinct p.id) as numero_de_pedidos_mensal
from pedidos p left join (select * from clientes where nome is not null) c on p.cliente_id = c.id
where p.valor_bruto > 0
group by 1, 2, 3, 4
"""

GOLD_CLIENTES = f"""
sc as ({SILVER_CLIENTES}),
pa as (
  select cliente_id as cliente_id_origem, count(id) as total_pedidos,
    sum(cast(valor_liquido as decimal(18,2))) as valor_total_gasto,
    cast(sum(cast(valor_liquido as decimal(18,2))) as double) / count(valor_liquido) as ticket_medio,
    min(data_pedido) as data_primeiro_pedido, max(data_pedido) as data_ultimo_pedido,
    count(case when status = 'concluido' then 1 end) as pedidos_concluidos
  from pedidos where valor_bruto > 0 group by cliente_id
),
gold as (
  select sc.cliente_id_origem, sc.nome_completo, sc.email_padronizado, sc.telefone, sc.cpf, sc.status,
    sc.tipo_cliente, sc.limite_credito, sc.data_cadastro_ts, sc.updated_at_ts as updated_at_cliente_ts,
    sc.dominio_email, sc.ano_cadastro, sc.idade_estimada,
    coalesce(pa.total_pedidos, 0) as total_pedidos_realizados,
    cast(coalesce(pa.valor_total_gasto, 0) as double) as valor_total_gasto_cliente,
    coalesce(pa.ticket_medio, 0.0) as ticket_medio_cliente,
    pa.data_primeiro_pedido, pa.data_ultimo_pedido,
    coalesce(pa.pedidos_concluidos, 0) as pedidos_concluidos,
    case when pa.total_pedidos > 10 then 'Cliente VIP' when pa.total_pedidos > 5 then 'Cliente Regular'
         when pa.total_pedidos > 0 then 'Cliente Novo' else 'Cliente Inativo (sem pedidos)' end as segmento_cliente,
    case when sc.limite_credito >= 10000 and pa.total_pedidos > 5 then 'Premium'
         when sc.limite_credito >= 5000 and pa.total_pedidos > 2 then 'Gold'
         when pa.total_pedidos > 0 then 'Silver' else 'Bronze' end as categoria_valor
  from sc left join pa on sc.cliente_id_origem = pa.cliente_id_origem
)
"""

SQL["gold_visao_geral_clientes"] = (with_tables("clientes", "pedidos").rstrip() + ",\n"
                                    + GOLD_CLIENTES + "select * from gold\n")

# ------------------------------------------------------------------ CDC replica (closed form)

_STEP = 10 ** 12

SQL["cdc_replica_clientes"] = with_tables("clientes") + """
, f as (select *, id % 17 = 0 as del4, id % 34 = 0 as re5, id % 5 = 0 as s7, id % 3 = 0 as s2,
               id % 7 = 0 as s3 from clientes)
select id,
  case when not del4 then nome when re5 then 'reinserido ' || cast(id as varchar) end as nome,
  case when not del4 then email end as email,
  case when not del4 and not s3 then telefone end as telefone,
  case when not del4 then cpf end as cpf,
  case when not del4 then data_nascimento end as data_nascimento,
  case when not del4 then endereco end as endereco,
  case when s7 then 'reativado' when del4 then null when s2 then 'bloqueado' else status end as status,
  case when not del4 then tipo_cliente end as tipo_cliente,
  case when not del4 then cast(limite_credito as double) end as limite_credito,
  case when not del4 then data_cadastro end as data_cadastro,
  case when s7 then updated_at + interval 2 day when del4 then null
       when s2 then updated_at + interval 1 day else updated_at end as updated_at,
  case when not del4 then created_by end as created_by,
  case when not del4 then version end as version
from f where not del4 or re5 or s7
"""

SQL["cdc_stream_replica_clientes"] = SQL["cdc_replica_clientes"]

SQL["cdc_replica_pedidos"] = with_tables("pedidos") + """
select id, cliente_id, numero_pedido, data_pedido, status, cast(valor_bruto as double) as valor_bruto,
  cast(desconto as double) as desconto, cast(valor_liquido as double) as valor_liquido,
  metodo_pagamento, canal_venda, observacoes, data_entrega_prevista, data_entrega_real, updated_at,
  created_by, version
from pedidos where id % 13 <> 0
"""

SQL["cdc_replica_produtos"] = with_tables("produtos") + """
select id, codigo_produto, nome, categoria, cast(null as varchar) as subcategoria, cast(null as varchar) as marca,
  cast(preco_custo as double) as preco_custo, cast(preco_venda as double) as preco_venda,
  cast(margem_lucro as double) as margem_lucro, estoque_atual, cast(null as integer) as estoque_minimo, ativo,
  cast(null as double) as peso, cast(null as varchar) as dimensoes, cast(null as varchar) as descricao,
  cast(null as varchar[]) as tags, cast(null as date) as data_lancamento, cast(null as integer) as fornecedor_id,
  updated_at, cast(null as varchar) as created_by, cast(null as integer) as version
from produtos
"""

SQL["cdc_replica_leads"] = with_tables("leads") + """
select id, nome, email, cast(null as varchar) as telefone, cast(null as varchar) as empresa,
  cast(null as varchar) as cargo, fonte, cast(null as integer) as campanha_id, score, status, interesse,
  cast(orcamento_estimado as double) as orcamento_estimado, data_contato, data_conversao,
  cast(null as varchar) as observacoes, cast(null as varchar[]) as tags,
  cast(null as timestamp) as ultima_atividade, updated_at, cast(null as varchar) as created_by,
  cast(null as integer) as version
from leads
"""

SQL["cdc_control_table"] = with_tables("clientes", "pedidos", "produtos", "leads") + f"""
select 'dbserver1.public.clientes' as topic,
  {7 * _STEP} + max(case when id % 5 = 0 then id end) as last_offset,
  timestamp '2001-08-01 00:07:00' as last_event,
  count(*) + count(case when id % 3 = 0 then 1 end) + count(case when id % 7 = 0 then 1 end)
    + count(case when id % 17 = 0 then 1 end) + count(case when id % 34 = 0 then 1 end)
    + count(case when id % 5 = 0 then 1 end) + 1 as event_count
from clientes
union all
select 'dbserver1.public.pedidos', {2 * _STEP} + max(case when id % 13 = 0 then id end),
  timestamp '2001-08-01 00:02:00', count(*) + count(case when id % 13 = 0 then 1 end) from pedidos
union all
select 'dbserver1.public.produtos', {_STEP} + max(id), timestamp '2001-08-01 00:01:00', count(*) from produtos
union all
select 'dbserver1.public.leads', {_STEP} + max(id), timestamp '2001-08-01 00:01:00', count(*) from leads
"""

# ------------------------------------------------------------------ serving (Q1-Q12)

def sub(name: str) -> str:
    """An oracle query as a subquery."""
    return f"({SQL[name].strip()})"


_PED_R = "(select * from pedidos where id % 13 <> 0)"

SQL["q1_replication_lag"] = with_tables("clientes", "pedidos") + f"""
, counts as (
  select 'clientes' as tabela, (select count(*) from clientes) as source_rows,
         (select count(*) from {sub('cdc_replica_clientes')} r) as target_rows
  union all
  select 'pedidos', (select count(*) from pedidos), (select count(*) from {_PED_R} r))
select tabela, source_rows, target_rows, source_rows - target_rows as lag,
  case when sum(source_rows - target_rows) over () = 0 then 'em dia'
       when sum(source_rows - target_rows) over () < 10 then 'replicando' else 'na fila' end as estado
from counts
"""

SQL["q2_total_revenue"] = with_tables("pedidos") + f"""
select cast(coalesce(sum(valor_bruto), 0) as double) as receita_total from {_PED_R} r
"""

SQL["q3_average_ticket"] = with_tables("pedidos") + f"""
select coalesce(cast(sum(valor_liquido) as double) / count(valor_liquido), 0.0) as ticket_medio
from {_PED_R} r
"""

SQL["q4_counts_long"] = f"""
select tabela, 'Source' as camada, source_rows as registros from {sub('q1_replication_lag')} a
union all
select tabela, 'Target', target_rows from {sub('q1_replication_lag')} b
"""

SQL["q5_latest_customers"] = f"""
select id, nome, email, tipo_cliente, status, strftime(data_cadastro, '%d/%m %H:%M') as cadastro,
  strftime(updated_at, '%H:%M:%S') as updated
from {sub('cdc_replica_clientes')} r
order by updated_at desc nulls last, id desc limit 10
"""

SQL["q6_latest_orders"] = with_tables("pedidos") + f"""
select id, numero_pedido, status, metodo_pagamento,
  cast(cast(cast(valor_bruto as double) as decimal(10,2)) as double) as valor_bruto,
  cast(cast(cast(valor_liquido as double) as decimal(10,2)) as double) as valor_liq,
  canal_venda, strftime(updated_at, '%H:%M:%S') as updated
from {_PED_R} r order by updated_at desc nulls last, id desc limit 10
"""

SQL["q7_top_customers"] = f"""
select cliente_id_origem, nome_completo as nome, total_pedidos_realizados as total_pedidos,
  valor_total_gasto_cliente as receita
from {sub('gold_visao_geral_clientes')} g
order by receita desc nulls first, cliente_id_origem limit 10
"""

SQL["q8_revenue_by_status"] = with_tables("pedidos") + f"""
select status, count(*) as n, cast(sum(valor_bruto) as double) as receita
from {_PED_R} r group by status
"""

for _t in ("pedidos", "produtos", "leads"):
    SQL[f"cdc_sink_{_t}"] = SQL[f"cdc_replica_{_t}"]
SQL["cdc_sink_control"] = SQL["cdc_control_table"]

# Claims on order numbers: which one holds is told by the order's id alone.
SQL["cdc_unique_pedidos"] = with_tables("pedidos") + """
select id, case when id % 22 = 0 then numero_pedido || '-b' else numero_pedido end as numero_pedido,
  case when id % 13 <> 0 then status end as status
from pedidos where id % 13 <> 0 or id % 22 = 0
union all
select id + 2000000000, numero_pedido, 'claim 2' from pedidos where id % 22 = 0 and id % 13 <> 0
union all
select id + 3000000000, numero_pedido, 'claim 3' from pedidos where id % 11 = 0 and id % 13 = 0
"""

SQL["cdc_unique_violations"] = with_tables("pedidos") + f"""
select 'dbserver1.public.pedidos' as topic, cast((id + n * 1000000000::bigint) % 4 as integer) as partition,
  step * {_STEP} + id + n * 1000000000::bigint as "offset", 'unique_violation' as reason
from pedidos, (values (1, 3), (2, 5), (3, 7)) as c(n, step)
where id % 11 = 0 and case n when 1 then id % 13 <> 0 when 2 then id % 13 = 0 or id % 22 <> 0 else id % 13 <> 0 end
"""

SQL["cdc_replica_key_range"] = f"select * from {sub('cdc_replica_pedidos')} where id between 1000 and 5000"

# Offsets of the change log, by step; a: the event applies.
_OFFSETS = with_tables("clientes", "pedidos", "produtos", "leads") + f"""
, ev(t, p, step, o, a) as (
  select 'clientes', id % 4, step, step * {_STEP} + id, true
  from clientes, (values (1, 1), (2, 3), (3, 7), (4, 17), (5, 34), (7, 5)) as s(step, every) where id % every = 0
  union all select 'pedidos', id % 4, step, step * {_STEP} + id, true from pedidos, (values (1, 1), (2, 13)) as s(step, every) where id % every = 0
  union all select 'produtos', id % 4, 1, {_STEP} + id, true from produtos
  union all select 'leads', id % 4, 1, {_STEP} + id, true from leads
  union all select case i when 7 then 'outra' else 'clientes' end, 0, 6, {6 * _STEP} + i, i = 10 from range(11) as r(i))
"""

SQL["cdc_sink_partitions"] = _OFFSETS + """
select 'dbserver1.public.' || t as topic, cast(p as integer) as partition, cast(max(o) as bigint) as last_offset,
  max(timestamp '2001-08-01 00:00:00' + to_minutes(step)) as last_event, count(*) as event_count,
  count(case when step = 2 then 1 end) as repeats
from ev where a group by t, p
"""

SQL["cdc_offset_coverage"] = _OFFSETS + """
select 'dbserver1.public.' || t as topic, cast(p as integer) as partition, cast(min(o) as bigint) as first_offset, cast(max(o) as bigint) as last_offset,
  count(*) as seen, cast(max(o) - min(o) + 1 - count(*) as bigint) as missing, count(case when o > before + 1 then 1 end) as gaps
from (select *, lag(o) over (partition by t, p order by o) as before from ev) group by t, p
"""

SQL["q9_control_by_count"] = f"""
select topic, event_count, last_event from {sub('cdc_control_table')} c
"""

SQL["q10_items_revenue"] = with_tables("itens_pedido") + """
select cast(sum(quantidade * preco_unitario) as double) as receita_total from itens_pedido
"""

SQL["q11_latest_item_with_customer"] = with_tables("itens_pedido", "pedidos", "clientes") + """
select i.id as item_id, i.pedido_id, c.nome, i.produto_id,
  cast(i.quantidade * i.preco_unitario as double) as valor_total
from itens_pedido i join pedidos p on i.pedido_id = p.id join clientes c on p.cliente_id = c.id
order by i.id desc limit 1
"""

SQL["q12_stacked_metrics"] = with_tables("clientes", "pedidos") + """
select 'clientes' as metrica, cast(count(*) as double) as valor from clientes
union all select 'pedidos', cast(count(*) as double) from pedidos
union all select 'receita_total', cast(coalesce(sum(valor_bruto), 0) as double) from pedidos
union all select 'ticket_medio', coalesce(cast(sum(valor_liquido) as double) / count(valor_liquido), 0.0)
  from pedidos
"""

# ------------------------------------------------------------------ services

_AMOUNT = ("cast(case when desconto > 0 then round(quantidade * preco_unitario * (1 - desconto), 2) "
           "else quantidade * preco_unitario end as decimal(18,2))")

SQL["m1_products_page"] = with_tables("produtos") + """
, page as (select * from produtos order by id limit 100),
f as (select * from page where lower(categoria) = lower('Economy'))
select id, nome, categoria, cast(preco_venda as double) as preco_venda, estoque_atual, ativo,
  (select count(*) from f) as total
from f
"""

SQL["m2_sales_page"] = with_tables("vendas") + f"""
select id, cliente_id, produto_id, quantidade, cast(preco_unitario as double) as preco_unitario,
  cast(desconto as double) as desconto, status, data_venda, cast({_AMOUNT} as double) as valor_total, least(100, count(*) over ()) as total
from vendas where data_venda >= timestamp '1998-01-01 00:00:00'
order by id desc limit 100
"""

SQL["m3_vip_customers_page"] = with_tables("clientes") + """
select id, nome, email, status, true as vip, least(100, count(*) over ()) as total from clientes where status = 'premium' order by id limit 100
"""

SQL["m4_sales_summary"] = with_tables("vendas", "produtos", "clientes") + f"""
, s as (select count(*) as n, sum({_AMOUNT}) as receita from vendas)
select n as total_vendas, cast(round(receita, 2) as double) as receita_total,
  round(cast(receita as double) / greatest(1, n), 2) as ticket_medio,
  (select count(*) from produtos) as total_produtos, (select count(*) from clientes) as total_clientes,
  (select count(*) from clientes where status = 'premium') as clientes_vip
from s
"""

SQL["m5_sales_per_status"] = with_tables("vendas") + """
select status, count(*) as quantidade from vendas group by status
"""

SQL["m6_units_per_product"] = with_tables("vendas") + """
select produto_id, sum(quantidade) as unidades from vendas group by produto_id
"""

SQL["m7_sale_amounts"] = with_tables("vendas") + f"""
select id, cast({_AMOUNT} as double) as valor_total from vendas
"""

SQL["m8_stock_after_sales"] = with_tables("produtos", "vendas") + """
, sold as (select produto_id, sum(quantidade) as unidades from vendas group by produto_id)
select p.id, p.estoque_atual, coalesce(s.unidades, 0) as unidades,
  greatest(0, p.estoque_atual - coalesce(s.unidades, 0)) as estoque_final
from produtos p left join sold s on p.id = s.produto_id
"""

SQL["m9_customer_lifetime"] = with_tables("vendas") + f"""
select cliente_id, count(*) as total_compras, cast(sum({_AMOUNT}) as double) as valor_total_gasto
from vendas group by cliente_id
"""

SQL["m9_customer_lifetime_stream"] = SQL["m9_customer_lifetime"]

SQL["m10_leads_page"] = with_tables("leads") + """
select id, nome, email, status, score, least(100, count(*) over ()) as total
from leads where lower(status) = 'novo' order by id desc limit 100
"""

SQL["m11_campaigns_page"] = with_tables("campanhas_marketing") + """
select id, nome, tipo, cast(orcamento as double) as orcamento, status,
  (select count(*) from campanhas_marketing) as total
from campanhas_marketing order by id desc limit 5
"""

SQL["m12_activities_page"] = with_tables("atividades") + """
select *, least(100, count(*) over ()) as total from atividades order by id desc limit 100
"""

SQL["m13_crm_summary"] = with_tables("leads", "campanhas_marketing", "atividades") + """
, l as (select count(*) as total_leads, count(case when status = 'Convertido' then 1 end) as conv,
               sum(score) as s from leads)
select total_leads, conv as leads_convertidos,
  round(cast(conv as double) / cast(greatest(1, total_leads) as double) * 100, 2) as taxa_conversao,
  round(cast(coalesce(s, 0) as double) / cast(greatest(1, total_leads) as double), 1) as score_medio,
  (select count(*) from campanhas_marketing) as total_campanhas,
  (select count(*) from atividades) as total_atividades
from l
"""

SQL["m14_leads_per_status"] = with_tables("leads") + """
select status, count(*) as quantidade from leads group by status
"""

SQL["m15_activities_per_type"] = with_tables("atividades") + """
select tipo, count(*) as quantidade from atividades group by tipo
"""

SQL["m16_leads_per_campaign"] = with_tables("campanhas_marketing", "leads") + """
select c.id, c.nome, c.meta_leads, count(l.id) as leads_gerados
from campanhas_marketing c left join leads l on l.campanha_id = c.id
group by c.id, c.nome, c.meta_leads
"""

SQL["m17_last_contact"] = with_tables("leads", "atividades") + """
select l.id, coalesce(a.ultima, l.ultima_atividade) as ultimo_contato
from leads l left join (select lead_id, max(data_atividade) as ultima from atividades group by lead_id) a
  on a.lead_id = l.id
"""

SQL["m18_funnel_check"] = with_tables("lead_historico") + """
, h as (select *, lag(status) over (partition by lead_id order by ts, id) as status_anterior
        from lead_historico)
select id, lead_id, ts, status_anterior, status,
  (status_anterior, status) in (('Novo','Contactado'), ('Contactado','Qualificado'),
     ('Contactado','Perdido'), ('Qualificado','Convertido'), ('Qualificado','Perdido'))
  or status_anterior = status as legal
from h where status_anterior is not null
"""

# ------------------------------------------------------------------ data quality

_DOMAIN = ("clientes", "pedidos", "produtos", "itens_pedido", "campanhas_marketing", "leads")
# Declared test columns that the models do not have.
_MISSING = {("dim_clientes", "email"), ("fct_pedidos", "produto"), ("fct_pedidos", "quantidade"),
            ("fct_pedidos", "preco_unitario"), ("fct_pedidos", "valor_total_pedido"),
            ("silver_pedidos", "quantidade")}


def _rel(model: str) -> str:
    return model if model in _DOMAIN else f"m_{model}"


def checks_sql(checks) -> str:
    models = sorted({c.model for c in checks} | {c.to for c in checks if c.to})
    derived = [m for m in models if m not in _DOMAIN]
    head = with_tables(*_DOMAIN).rstrip()
    for m in derived:
        head += f",\nm_{m} as ({SQL[m].strip()})"
    parts = []
    for c in checks:
        t = _rel(c.model)
        if (c.model, c.column) in _MISSING:
            parts.append(f"select '{c.name}' as test, '{c.model}' as model, '{c.column}' as \"column\", "
                         f"cast(null as bigint) as failures, 'error' as status")
            continue
        col = c.column
        if c.kind == "not_null":
            f = f"(select count(*) from {t} where {col} is null)"
        elif c.kind == "unique":
            f = (f"(select count(*) from (select {col} from {t} where {col} is not null "
                 f"group by {col} having count(*) > 1) d)")
        elif c.kind == "relationships":
            f = (f"(select count(*) from {t} x where x.{col} is not null and not exists "
                 f"(select 1 from {_rel(c.to)} p where p.{c.field} = x.{col}))")
        elif c.kind == "range":
            conds = []
            if c.low is not None:
                conds.append(f"{col} < {c.low}")
            if c.high is not None:
                conds.append(f"{col} > {c.high}")
            f = f"(select count(*) from {t} where {' or '.join(conds)})"
        elif c.kind == "max_length":
            f = f"(select count(*) from {t} where length({col}) > {c.max_len})"
        parts.append(f"select '{c.name}' as test, '{c.model}' as model, '{c.column}' as \"column\", "
                     f"{f} as failures, case when {f} = 0 then 'pass' else '{c.severity}' end as status")
    return head + "\n" + "\nunion all\n".join(parts) + "\n"


def _quality_sql():
    from rivulet.operators.quality import DDL, DECLARED, REPLICA_LENGTH_CHECKS
    SQL["dq_declared_tests"] = checks_sql(DECLARED)
    SQL["o2_refresh_then_test"] = SQL["dq_declared_tests"]
    SQL["dq_ddl_constraints"] = checks_sql(DDL + REPLICA_LENGTH_CHECKS)
    SQL["o1_refresh_silver_gold"] = SQL["gold_visao_geral_clientes"]
    SQL["s6_published_tables"] = SQL["dim_clientes"]
    SQL["dq_non_empty"] = with_tables("clientes", "pedidos") + """
select (select count(*) from clientes) > 0 as has_clientes, (select count(*) from pedidos) > 0 as has_pedidos,
  (select count(*) from clientes) > 0 or (select count(*) from pedidos) > 0 as ok
"""


_quality_sql()

# ------------------------------------------------------------------ rules and sources

_CLI_COLS = ("id, nome, email, telefone, cpf, data_nascimento, endereco, status, tipo_cliente, "
             "cast(limite_credito as double) as limite_credito, data_cadastro, updated_at, created_by, version")


def _seed_sql(email_mod: int, cpf_mod: int | None = None) -> str:
    cpf = "cpf" if cpf_mod is None else f"case when id % {cpf_mod} = 0 then cpf else '9' || cpf end"
    return (f"select id + 1000000000 as id, nome, case when id % {email_mod} = 0 then email "
            f"else 'novo' || cast(id as varchar) || '@seed.com' end as email, telefone, {cpf} as cpf, "
            f"data_nascimento, endereco, status, tipo_cliente, limite_credito, data_cadastro, updated_at, "
            f"created_by, version from clientes where id % 10 = 0")


SQL["r6_update_by_key"] = with_tables("clientes") + """
select id, nome, case when id % 7 = 0 then 'novo' || cast(id as varchar) || '@email.com' else email end as email,
  telefone, cpf, data_nascimento, endereco, status, tipo_cliente, cast(limite_credito as double) as limite_credito,
  data_cadastro, case when id % 7 = 0 then timestamp '2001-08-01 00:00:00' else updated_at end as updated_at,
  created_by, version
from clientes
"""

SQL["r7_insert_if_absent"] = with_tables("clientes") + f"""
, n as ({_seed_sql(20)})
select {_CLI_COLS} from clientes
union all
select {_CLI_COLS} from n where not exists (select 1 from clientes c where c.email = n.email)
"""

SQL["r8_insert_on_conflict_do_nothing"] = with_tables("clientes") + f"""
, n as ({_seed_sql(20, 30)}),
a as (
  select * from n where not exists (select 1 from clientes c where c.id = n.id)
    and not exists (select 1 from clientes c where c.email = n.email)
    and not exists (select 1 from clientes c where c.cpf = n.cpf)),
b as (
  select * replace (id + 1000000000 as id, 'cadeia' || cast(id as varchar) || '@seed.com' as email,
      (select '9' || c.cpf from clientes c where c.id = n.id - 1000000000) as cpf) from n),
b_in as (select * from b where not exists (select 1 from a where a.cpf = b.cpf)),
c as (
  select * replace (id + 1000000000 as id, '8' || (select k.cpf from clientes k where k.id = b.id - 2000000000) as cpf) from b),
c_in as (select * from c where not exists (select 1 from b_in where b_in.email = c.email))
select {_CLI_COLS} from clientes
union all select {_CLI_COLS} from a
union all select {_CLI_COLS} from b_in
union all select {_CLI_COLS} from c_in
"""

SQL["r10_random_sample"] = with_tables("clientes") + f"""
select {_CLI_COLS} from clientes order by md5(cast(id as varchar) || ':7'), id limit 10
"""


def _contract_sql() -> str:
    from rivulet import schemas
    from rivulet.sources.tables import DOMAIN_TABLES
    parts = [f"select '{t}' as \"table\", true as present, {len(schemas.SCHEMAS[t].fields)} as n_columns, "
             f"'{','.join(f.name for f in schemas.SCHEMAS[t].fields)}' as columns, true as contract_ok, "
             f"(select count(*) from {t}) as n_rows" for t in DOMAIN_TABLES]
    return with_tables(*DOMAIN_TABLES) + "\nunion all\n".join(parts)


SQL["dq_schema_contract"] = _contract_sql()

SQL["r9_delete_cascade"] = with_tables("pedidos", "itens_pedido") + """
select id, pedido_id, produto_id, quantidade from itens_pedido
where pedido_id not in (select id from pedidos where id % 50 = 0)
"""

SQL["r1_r3_generated_columns"] = with_tables("pedidos", "itens_pedido") + """
select i.pedido_id, cast(sum(i.valor_total) as double) as itens_total,
  cast(p.valor_liquido as double) as valor_liquido
from itens_pedido i join pedidos p on p.id = i.pedido_id
group by i.pedido_id, p.valor_liquido
"""

SQL["s3_choose_root"] = f"""
select 'replica' as root, count(*) as linhas from {sub('cdc_replica_clientes')} r
"""

SQL["s4_full_refresh_copy"] = with_tables("clientes", "pedidos") + """
select 'clientes' as tabela, count(*) as linhas from clientes
union all select 'pedidos', count(*) from pedidos
"""

SQL["s9_document_ingest"] = with_tables("produtos") + """
select id, nome, categoria, cast(preco_venda as double) as preco, estoque_atual as estoque, ativo
from produtos
"""

SQL["s9_document_rejects"] = with_tables("produtos") + """
, pages as (select (id - 1) // 100 as page, count(*) as items from produtos group by 1)
select case page % 5 when 1 then 'invalid_json' when 2 then 'no_items' when 3 then 'bad_value' else 'total_below_items' end as reason, count(*) as linhas
from pages where page % 5 <> 0 group by 1
union all select 'loaded_items', coalesce(cast(sum(items) as bigint), 0) from pages where page % 5 = 0
"""

SQL["s10_csv_rejects"] = with_tables("clientes") + """
select id, case when id % 13 = 0 or id % 17 = 0 then 'column_count' else 'bad_value' end as reason,
  case when id % 13 <> 0 and id % 17 <> 0 then 'version' end as columns
from clientes where id % 13 = 0 or id % 17 = 0 or id % 19 = 0
union all select count(*), 'loaded', null from clientes where id % 13 <> 0 and id % 17 <> 0 and id % 19 <> 0
"""

SQL["s10_csv_seed"] = with_tables("clientes") + f"""
select {_CLI_COLS} from clientes
"""

# Events of the change log that must not apply: the malformed ones of step 6
# (every event derived from the tables applies).  The tombstone is dropped
# silently and the null-id delete counts as applied, so neither is listed.
SQL["cdc_quarantine"] = f"""
select topic, 0 as partition, cast({6 * _STEP} + i as bigint) as "offset", value, reason from (values
  ('dbserver1.public.clientes', 0, '{{bad json', 'invalid_json'),
  ('dbserver1.public.clientes', 1, 'null', 'empty'),
  ('dbserver1.public.clientes', 2, '{{"payload":null}}', 'empty'),
  ('dbserver1.public.clientes', 3, '{{"payload":{{}}}}', 'empty'),
  ('dbserver1.public.clientes', 4, '[1]', 'not_object'),
  ('dbserver1.public.clientes', 5, '{{"nome":"sem id","__op":"c"}}', 'missing_pk'),
  ('dbserver1.public.clientes', 6, '{{"id":null,"nome":"id nulo","__op":"c"}}', 'null_key'),
  ('dbserver1.public.outra', 7, '{{"id":1,"nome":"outra"}}', 'unknown_topic'),
  ('dbserver1.public.clientes', 8, '{{"id":1,"limite_credito":"abc","__op":"u"}}', 'bad_value')
) t(topic, i, value, reason)
"""

SQL["cdc_sink_quarantine"] = SQL["cdc_quarantine"]
