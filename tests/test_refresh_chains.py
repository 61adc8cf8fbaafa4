"""Concurrent refresh, published tables, chains of conflicts, uniqueness by hashes."""
import random
import threading

import pytest
from pyspark.sql import functions as F

from main_paths import SF001
from rivulet.operators import quality, rules
from rivulet.plans import medallion
from rivulet.plans.medallion import Model, Models, RefreshError, publish, refresh
from rivulet.sources.tables import fixture_root


def sequential(rows, keys):
    seen, out = {k: set() for k in keys}, []
    for r in sorted(rows, key=lambda r: r[0]):
        values = dict(zip(keys, r, strict=True))
        if any(v is not None and v in seen[k] for k, v in values.items()):
            continue
        out.append(r[0])
        for k, v in values.items():
            seen[k].add(v)
    return out


def test_a_chain_of_ten_thousand_conflicts(spark, monkeypatch):
    n, writes = 10_000, []
    real = rules.written
    monkeypatch.setattr(rules, "written", lambda df: writes.append(1) or real(df))
    rows = [(i, f"e{i // 2}", f"c{(i + 1) // 2}") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, email string, cpf string")
    got = sorted(r["id"] for r in rules.insert_on_conflict_do_nothing(df.limit(0), df, ["id", "email", "cpf"]).collect())
    assert got == list(range(0, n, 2))
    assert len(writes) < 2 * 20     # two written tables a step


@pytest.mark.parametrize("seed", range(3))
def test_chains_and_branches_like_one_row_at_a_time(spark, monkeypatch, seed):
    monkeypatch.setattr(rules, "PLAIN_ROUNDS", 0)
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, f"e{rnd.randrange(60)}"]), f"c{rnd.randrange(90)}") for i in range(120)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, email string, cpf string")
    got = sorted(r["id"] for r in rules.insert_on_conflict_do_nothing(df.limit(0), df, ["id", "email", "cpf"]).collect())
    assert got == sequential(rows, ["id", "email", "cpf"])


def test_models_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    """Two models wait for each other inside their writes: one after another would never end."""
    models = Models(fixture_root(spark, SF001))
    both = threading.Barrier(2, timeout=60)
    names = []

    def meet(df, database, name, keep=2):
        names.append(name)
        if name in ("a", "b"):
            both.wait()
        return "meet"
    monkeypatch.setattr(medallion, "publish", meet)
    spark.range(3).createOrReplaceTempView("meet")
    models.models = {n: Model(n, "silver", "table", ("x",), deps, lambda *d: spark.range(3))
                     for n, deps in (("a", ()), ("b", ()), ("c", ("a", "b")))}
    assert list(refresh(models, use_catalog=True, threads=2, database_root=str(tmp_path))) == ["a", "b", "c"]
    assert sorted(names[:2]) == ["a", "b"] and names[2] == "c"
    spark.sql("drop database if exists public_silver cascade")


def test_a_failing_model_is_named_and_stops_only_its_readers(spark, tmp_path):
    models = Models(fixture_root(spark, SF001))
    bad = F.raise_error(F.lit("broken here"))
    models.models = {"a": Model("a", "silver", "table", (), (), lambda: spark.range(3).select(bad.cast("long").alias("id"))),
                     "b": Model("b", "silver", "table", (), (), lambda: spark.range(3)),
                     "c": Model("c", "gold", "table", (), ("a",), lambda d: d),
                     "d": Model("d", "gold", "table", (), ("b",), lambda d: d)}
    with pytest.raises(RefreshError, match="a: .*broken here.*not built: c") as error:
        refresh(models, lake_root=str(tmp_path))
    assert list(error.value.failed) == ["a"]
    assert spark.read.parquet(str(tmp_path / "gold-data" / "d")).count() == 3


def test_readers_see_old_rows_or_new_ones(spark, tmp_path):
    spark.sql(f"create database published location '{tmp_path}/db'")
    try:
        publish(spark.range(10), "published", "t")
        stop, seen, errors = threading.Event(), set(), []

        def read():
            while not stop.is_set():
                try:
                    seen.add(spark.table("published.t").count())
                except Exception as e:
                    errors.append(e)
        reader = threading.Thread(target=read)
        reader.start()
        for n in (20, 30, 40):
            publish(spark.range(n).withColumn("n", F.lit(n)), "published", "t", keep=4)
        stop.set()
        reader.join()
        assert not errors and seen <= {10, 20, 30, 40}
        with pytest.raises(Exception, match="broken here"):
            publish(spark.range(3).select(F.raise_error(F.lit("broken here"))), "published", "t")
        assert spark.table("published.t").columns == ["id", "n"] and spark.table("published.t").count() == 40
        publish(spark.range(5), "published", "t", keep=1)
        assert spark.table("published.t").count() == 5
        assert len(list((tmp_path / "db" / "_versions" / "t").glob("v-*"))) == 1
        spark.range(2).write.saveAsTable("published.before")
        publish(spark.range(7), "published", "before")
        assert spark.table("published.before").count() == 7
    finally:
        spark.sql("drop database published cascade")


def test_hashes_that_collide_are_no_repeats(spark):
    df = spark.createDataFrame([(i, f"v{i % 40}", None) for i in range(50)], "id long, v string, w string")
    checks = [quality.Check("unique", "t", c) for c in ("id", "v", "w")]
    for hash64 in (F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))):
        got = {r["column"]: r["failures"] for r in quality.run_checks(spark, checks, lambda n: df, hash64).collect()}
        assert got == {"id": 0, "v": 10, "w": 0}
