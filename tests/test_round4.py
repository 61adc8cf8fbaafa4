"""Batches of the sink staged as files, merges that move rows once, claims read once."""
import os

from rivulet.streaming import cdc, unique
from test_cdc import ROUTE, events_df, random_log, replay, state_dict
from test_sink import sink_at


def test_a_batch_holds_no_executor_memory_and_leaves_no_staging(spark, tmp_path, monkeypatch):
    log = random_log(21, n=120) + [(900, "{bad")]
    sink = sink_at(spark, tmp_path / "s")
    before, seen, commit = set(spark.sparkContext._jsc.getPersistentRDDs()), [], sink._commit

    def watched(*a):
        seen.append(set(spark.sparkContext._jsc.getPersistentRDDs()))
        return commit(*a)
    monkeypatch.setattr(sink, "_commit", watched)
    sink.write_batch(events_df(spark, log), 0)
    assert seen and seen[0] <= before
    assert os.listdir(tmp_path / "s" / "_staging") == []
    assert state_dict(sink.state("pedidos")) == replay(log[:-1])
    assert [(r["value"], r["reason"]) for r in sink.quarantine().collect()] == [("{bad", "invalid_json")]


def test_a_merge_moves_rows_once(spark, tmp_path, monkeypatch):
    log = random_log(22, n=120)
    sink = sink_at(spark, tmp_path / "s", compact_every=100)
    for i in range(3):
        sink.write_batch(events_df(spark, log[40 * i:40 * i + 40]), i)
    write, plans = sink._write, []

    def watched(df, place):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, place)
    monkeypatch.setattr(sink, "_write", watched)
    sink.compact("pedidos")
    assert [p.count("Exchange") for p in plans] == [1]
    assert state_dict(sink.state("pedidos")) == replay(log)
    keys = sink._read("pedidos", sink._manifest()["runs"]["pedidos"])
    assert keys.count() == keys.select("key").distinct().count()


def test_claims_are_parsed_once(spark, tmp_path):
    typed = cdc.typed_events(cdc.parse_events(events_df(spark, random_log(23, n=60))), ROUTE)
    rows = unique._timeline(typed, "numero_pedido", None, str(tmp_path / "events"))
    assert "numero_pedido" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert all(str(tmp_path / "events") in f for f in rows.inputFiles())


def test_a_checked_model_is_built_once(spark, tmp_path):
    """Models that several passes read are written; stored ones and those of one pass are not."""
    from pyspark.sql import functions as F

    from rivulet.operators import quality
    built = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: built.add(1) or x, "long").asNondeterministic()
    frames = {"t": spark.createDataFrame([(1, 1, "a"), (2, 1, None), (2, 3, "b")], "id long, parent long, v string").withColumn("id", count("id")),
              "p": spark.createDataFrame([(1,), (2,)], "id long")}
    checks = [quality.Check("unique", "t", "id"), quality.Check("not_null", "t", "v"), quality.Check("range", "t", "id", low=2),
              quality.Check("relationships", "t", "parent", to="p", field="id"), quality.Check("relationships", "t", "id", to="p", field="id"),
              quality.Check("not_null", "t", "none")]
    want = {("unique", "id", 1), ("not_null", "v", 1), ("range", "id", 1), ("relationships", "parent", 1), ("relationships", "id", 0), ("not_null", "none", None)}
    got = quality.run_checks(spark, checks, frames.__getitem__).collect()
    assert {(r["test"].split("_t_")[0], r["column"], r["failures"]) for r in got} == want
    assert built.value == 3
    frames["t"].select("id", "parent", "v").write.parquet(f"{tmp_path}/t")
    frames["t"] = spark.read.parquet(f"{tmp_path}/t")
    plan = quality.run_checks(spark, checks[1:3], frames.__getitem__, stored={"t"})._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/t" in plan


def test_numbering_sorts_rows_once(spark):
    from rivulet.operators.windows import row_number_skew_safe
    rows = [(None if k == 9 else k, i) for k in (1, 2, 2, 9, 9) for i in range(7)]
    df = spark.createDataFrame(rows, "k long, o long").repartition(5)
    out = row_number_skew_safe(df, "k", ("o",), "n")
    assert out._jdf.queryExecution().executedPlan().toString().count("Window [row_number") == 1
    for key in (None, 1, 2):
        got = sorted(r["n"] for r in out.collect() if r["k"] == key)
        assert got == list(range(1, sum(k == key for k, _ in rows) + 1))
