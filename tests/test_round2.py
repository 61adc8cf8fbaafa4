"""Skewed windows on wide tables, insert rounds, sink safety and restart, plan shapes."""
import json
import os
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet import schemas
from rivulet.operators import quality, rules, windows
from rivulet.sources.tables import Root, choose_root, fixture_root
from rivulet.streaming import cdc, replication
from main_paths import SF001
from test_cdc import ROUTE, TOPIC, events_df, random_log, replay, state_dict


@pytest.mark.parametrize("partitions", [3, 8, 40])
def test_windows_on_wide_skewed_tables(spark, partitions):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        i = F.col("id")
        df = spark.range(300_000).select(
            F.when(i % 3 == 0, 1).when(i % 50 == 1, None).otherwise(i % 1000).alias("k"), (i * 7919 % 300_007).alias("t"),
            F.concat(F.lit("s"), i % 5).alias("v"), F.sha2(i.cast("string"), 256).alias("outside"), (i * 2).alias("more"))
        w = Window.partitionBy("k").orderBy("t")
        both = df.withColumn("n", F.row_number().over(w)).withColumn("p", F.lag("v").over(w))
        rn = windows.row_number_skew_safe(df, "k", ["t"], "got_n").select("t", "outside", "got_n")
        lag = windows.lag_skew_safe(df, "k", ["t"], "v", "got_p").select("t", "outside", "got_p")
        wrong = both.join(rn, ["t", "outside"]).join(lag, ["t", "outside"])
        assert wrong.count() == 300_000
        assert wrong.filter((F.col("n") != F.col("got_n")) | ~F.col("p").eqNullSafe(F.col("got_p"))).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_conflicts_among_new_rows_go_in_rounds(spark):
    ddl = "id long, email string, cpf string"
    target = spark.createDataFrame([(100, "t", "t")], ddl)
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "b", "y"), (4, "c", "y"), (5, "t", "z"), (6, "q", "z"),
                                  (7, None, "x"), (8, None, None), (9, None, None)], ddl)
    got = sorted(r["id"] for r in rules.insert_on_conflict_do_nothing(target, rows, ["id", "email", "cpf"]).collect())
    seen, want = {"email": {"t"}, "cpf": {"t"}}, [100]
    for r in sorted(rows.collect()):
        if any(r[k] is not None and r[k] in seen[k] for k in seen):
            continue
        want.append(r["id"])
        for k in seen:
            seen[k].add(r[k])
    assert got == sorted(want)


def test_a_long_chain_of_conflicts(spark):
    ddl = "id long, email string, cpf string"
    rows = spark.createDataFrame([(i, f"e{i // 2}", f"c{(i + 1) // 2}") for i in range(7)], ddl)
    got = sorted(r["id"] for r in rules.insert_on_conflict_do_nothing(rows.limit(0), rows, ["id", "email", "cpf"]).collect())
    assert got == [0, 2, 4, 6]


def test_rejected_rows_are_kept_with_their_reason(spark):
    raw = spark.createDataFrame([(1, 1.0, 2.0), (2, 0.01, 99999.0)], "id long, preco_custo double, preco_venda double")
    kept, rejects = (f(raw, "produtos", fixture_date()) for f in (rules.conform, rules.rejects))
    assert [r["id"] for r in kept.collect()] == [1]
    assert [(r["id"], r["reason"]) for r in rejects.collect()] == [(2, "generated_value_overflow")]


def fixture_date():
    from rivulet.sources.tables import AS_OF_ORDERS
    return AS_OF_ORDERS


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    one = [r["id"] for r in rules.random_sample(df.repartition(1), 10, seed=3).collect()]
    assert one == [r["id"] for r in rules.random_sample(df.repartition(13), 10, seed=3).collect()]
    assert one != [r["id"] for r in rules.random_sample(df, 10, seed=4).collect()]


# -- sink --

def sink_at(spark, root, **options):
    return cdc.SnapshotSink(spark, str(root), routes={TOPIC: ROUTE}, **options)


def test_a_path_that_cannot_be_listed_raises(spark, tmp_path):
    with pytest.raises(Exception, match="No FileSystem|UnsupportedFileSystem|scheme"):
        sink_at(spark, "nosuchfs://host/root").state("pedidos")
    sink = sink_at(spark, tmp_path / "s")
    sink.write_batch(events_df(spark, random_log(1, n=50)), 0)
    os.makedirs(tmp_path / "s" / "_control" / "stray")
    for act in (lambda: sink.state("pedidos"), lambda: sink.control(), lambda: sink.write_batch(events_df(spark, random_log(2, n=5)), 1)):
        with pytest.raises(ValueError, match="stray"):
            act()


def test_a_failed_batch_leaves_the_last_commit_and_replays(spark, tmp_path, monkeypatch):
    log = random_log(3, n=200)
    sink = sink_at(spark, tmp_path / "s", compact_every=2)
    sink.write_batch(events_df(spark, log[:100]), 0)
    monkeypatch.setattr(sink, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        sink.write_batch(events_df(spark, log[100:]), 1)
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    assert state_dict(sink_at(spark, tmp_path / "s").state("pedidos")) == replay(log[:100])
    again = sink_at(spark, tmp_path / "s", compact_every=2)
    again.write_batch(events_df(spark, log[100:]), 1)
    assert state_dict(again.state("pedidos")) == replay(log) and again.totals() == again.totals()
    # A checkpoint that starts over must not write below the commits.
    with pytest.raises(ValueError, match="another root"):
        again.write_batch(events_df(spark, log[:10]), 0)


def test_compaction_and_expiry_change_no_answer(spark, tmp_path):
    log = random_log(5, n=400)
    sink = sink_at(spark, tmp_path / "s", compact_every=2)
    for i in range(8):
        sink.write_batch(events_df(spark, log[50 * i:50 * i + 50]), i)
    base = tmp_path / "s" / "pedidos"
    assert len(list((base / "base").glob("v=*"))) >= 3
    assert sink.expire("pedidos") and state_dict(sink.state("pedidos")) == replay(log)
    assert len(list((base / "delta").glob("v=*"))) < 8
    # What a batch writes follows its events, not the table.
    one = sink_at(spark, tmp_path / "s", compact_every=100)
    one.write_batch(events_df(spark, [(9000, json.dumps({"id": 3, "status": "z"}))]), 8)
    assert spark.read.parquet(f"{base}/delta/v=8").count() == 1


def test_a_stopped_query_goes_on_where_it_stopped(spark, tmp_path):
    log = random_log(7, n=300)
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def run(part):
        replication.stage_log([events_df(spark, part).coalesce(1)], path)
        sink = sink_at(spark, tmp_path / "s", compact_every=3)
        query = replication.start(replication.read_changes(spark, "files", path), sink, checkpoint, available_now=True)
        query.awaitTermination()
        query.stop()
        return sink

    run(log[:120])
    run(log[120:200])
    sink = run(log[200:])
    assert state_dict(sink.state("pedidos")) == replay(log)
    whole = cdc.control_counts(events_df(spark, log), {TOPIC: ROUTE}).first()
    assert sink.totals() == {TOPIC: whole["event_count"]}


def test_json_text_is_no_epoch(spark):
    topic = schemas.TOPIC_PREFIX + "clientes"
    values = [{"id": 1, "data_nascimento": 19000}, {"id": 2, "data_nascimento": "19000"}, {"id": 3, "data_nascimento": "2022-01-08"},
              {"payload": {"id": 4, "data_nascimento": 19000}}, {"payload": {"id": 5, "data_nascimento": "19000"}}]
    events = spark.createDataFrame([(topic, 0, i, None, json.dumps(v)) for i, v in enumerate(values)],
                                   "topic string, partition int, offset long, timestamp timestamp, value string")
    got = {r["id"]: str(r["data_nascimento"]) for r in cdc.apply_changes(events)["clientes"].collect()}
    assert got == {1: "2022-01-08", 3: "2022-01-08", 4: "2022-01-08"}
    assert sorted((r["offset"], r["reason"]) for r in cdc.quarantine(events).collect()) == [(1, "bad_value"), (4, "bad_value")]


# -- plans --

def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_events_are_parsed_once(spark):
    events = events_df(spark, random_log(1, n=10))
    plan = plan_of(cdc.apply_changes(events, {TOPIC: ROUTE})["pedidos"])
    # As a map, the enveloped payload, and as a variant: each in one place.
    assert plan.count("from_json") <= 3


def test_monthly_orders_aggregate_before_the_join(spark):
    from rivulet.plans.medallion import Models
    plan = plan_of(Models(fixture_root(spark, SF001))["agg_valor_pedidos_por_cliente_mensal"])
    assert plan.index("Join") < plan.index("Aggregate")


def test_one_scan_a_model_for_row_checks(spark):
    from rivulet.plans.medallion import Models
    models = Models(fixture_root(spark, SF001))
    checks = [c for c in quality.DECLARED if c.kind == "not_null" and c.model == "clientes"]
    assert len(checks) > 1
    plan = quality.run_checks(spark, checks, models.ref)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_summaries_number_no_items(spark):
    import __spark_entry__ as E
    for name in ("m4_sales_summary", "m5_sales_per_status", "m6_units_per_product", "m8_stock_after_sales", "m9_customer_lifetime"):
        plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Window" not in plan


def test_tables_of_a_layer_in_the_catalog(spark, tmp_path):
    from rivulet.plans.medallion import Models, refresh
    name = f"public_silver{uuid.uuid4().hex[:6]}"
    try:
        out = refresh(Models(fixture_root(spark, SF001)), ("dimension",), use_catalog=True)
        assert list(out) == ["dim_clientes"]
        assert spark.table("public_silver.dim_clientes").count() == Models(fixture_root(spark, SF001))["dim_clientes"].count()
    finally:
        spark.sql("drop database if exists public_silver cascade")
        spark.sql(f"drop database if exists {name} cascade")


def test_only_a_missing_replica_falls_back(spark):
    source = Root(spark, lambda n: spark.range(1), "source")

    def missing(name):
        return spark.read.parquet(f"/nowhere/{name}")

    def broken(name):
        raise PermissionError(name)
    assert choose_root(Root(spark, missing, "replica"), source) is source
    with pytest.raises(PermissionError):
        choose_root(Root(spark, broken, "replica"), source)
    with pytest.raises(AnalysisException):
        choose_root(Root(spark, lambda n: spark.range(1).select("nothing"), "replica"), source)


def test_every_query_but_those_of_the_corpus_has_an_oracle():
    from rivulet import oracle, registry
    assert set(registry.QUERIES) == set(registry.QUERIES) & set(oracle.SQL)
