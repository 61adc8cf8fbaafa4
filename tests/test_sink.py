"""The replica sink: commits that are whole or nothing, levels of runs, UNIQUE columns."""
import json
import os
import random

import pytest

from rivulet import schemas
from rivulet.streaming import cdc
from test_cdc import ROUTE, TOPIC, events_df, random_log, replay, state_dict


def sink_at(spark, root, **options):
    return cdc.SnapshotSink(spark, str(root), routes={TOPIC: ROUTE}, **options)


def breaking(monkeypatch, sink, folder):
    """From now on a write below ``folder`` breaks off after some files, before it has its name."""
    move = sink._move

    def broken(staged, place, fresh=False):
        if folder in place:
            raise RuntimeError(f"lost {place}")
        return move(staged, place, fresh)
    monkeypatch.setattr(sink, "_move", broken)


@pytest.mark.parametrize("folder", ["/delta/", "_quarantine/", "_control/", "_manifest/", "/base/"])
def test_a_write_that_breaks_off_leaves_the_last_answer(spark, tmp_path, monkeypatch, folder):
    log = random_log(11, n=160)
    bad = [(500 + i, v) for i, v in enumerate(["{bad", '{"id":1,"desconto":"x"}'])]
    sink = sink_at(spark, tmp_path / "s", compact_every=100)
    sink.write_batch(events_df(spark, log[:80] + bad[:1]), 0)
    sink.write_batch(events_df(spark, log[80:120]), 1)
    answer = (state_dict(sink.state("pedidos")), sink.totals(), sink.quarantine().count(), sink.commits())
    breaking(monkeypatch, sink, folder)
    with pytest.raises(RuntimeError, match="lost"):
        sink.compact("pedidos") if folder == "/base/" else sink.write_batch(events_df(spark, log[120:] + bad[1:]), 2)
    again = sink_at(spark, tmp_path / "s", compact_every=2)
    assert (state_dict(again.state("pedidos")), again.totals(), again.quarantine().count(), again.commits()) == answer
    # The batch that broke off is applied by its replay, beside its remains; so is the compaction.
    again.write_batch(events_df(spark, log[120:] + bad[1:]), 2)
    again.compact("pedidos")
    assert state_dict(again.state("pedidos")) == replay(log) and again.quarantine().count() == 2
    assert again.expire("pedidos", keep=1) and not os.path.exists(tmp_path / "s" / "_staging")
    assert state_dict(sink_at(spark, tmp_path / "s").state("pedidos")) == replay(log)


def test_a_batch_of_deletes_without_keys_leaves_no_run(spark, tmp_path):
    sink = sink_at(spark, tmp_path / "s", compact_every=2)
    sink.write_batch(events_df(spark, [(0, '{"id":1,"status":"a"}')]), 0)
    assert sink.write_batch(events_df(spark, [(1, '{"id":null,"__op":"d"}')]), 1) == {TOPIC: 1}
    assert [r["first"] for r in sink._manifest()["runs"]["pedidos"]] == [0] and sink.state("pedidos").count() == 1


def test_folders_that_no_commit_names_are_not_read(spark, tmp_path):
    log = random_log(12, n=60)
    sink = sink_at(spark, tmp_path / "s")
    sink.write_batch(events_df(spark, log), 0)
    for name in ("pedidos/base/v=0", "pedidos/delta/v=1", "_control/v=1", "_quarantine/v=1"):
        os.makedirs(tmp_path / "s" / name)
    assert state_dict(sink.state("pedidos")) == replay(log) and sink.commits() == [0] and sink.totals()[TOPIC] > 0
    # A committed batch that comes again is not applied again.
    assert sink.write_batch(events_df(spark, log), 0) == sink.totals()


def test_rows_are_rewritten_once_a_level(spark, tmp_path):
    """Four batches with two runs a level: what merges write grows with the logarithm."""
    rnd = random.Random(4)
    sink, log, written = sink_at(spark, tmp_path / "s", compact_every=2), [], 0
    for batch in range(4):
        part = [(10 * batch + i, json.dumps({"id": rnd.randint(1, 40), "status": f"s{batch}"})) for i in range(10)]
        log += part
        before = {r["path"] for r in sink._manifest()["runs"].get("pedidos", [])}
        sink.write_batch(events_df(spark, part), batch)
        runs = sink._manifest()["runs"]["pedidos"]
        assert len(runs) <= 3 and len({r["level"] for r in runs}) == len(runs)      # one a level at most
        touched = len(before - {r["path"] for r in runs})
        assert touched <= bin(batch ^ (batch + 1)).count("1") - 1 or touched == 0
        written += sum(r["rows"] for r in runs if r["path"] not in before)
    assert state_dict(sink.state("pedidos")) == replay(log)
    assert written <= 4 * 10 * 3
    assert [r["level"] for r in sink._manifest()["runs"]["pedidos"]] == [2]


def test_runs_without_common_keys_are_not_rewritten(spark, tmp_path):
    sink = sink_at(spark, tmp_path / "s", compact_every=2)
    for batch in range(4):
        sink.write_batch(events_df(spark, [(10 * batch + i, json.dumps({"id": 100 * batch + i, "status": "x"})) for i in range(5)]), batch)
    runs = sink._manifest()["runs"]["pedidos"]
    assert len(runs) == 4 and {r["level"] for r in runs} == {0} and not os.path.exists(tmp_path / "s/pedidos/base")
    assert sorted(r["id"] for r in sink.state("pedidos", keys=(102, 201)).collect()) == [102, 103, 104, 200, 201]


def test_a_merge_keeps_deletes_that_older_runs_need(spark, tmp_path):
    """A deleted key must not come back from an older run that the merge leaves alone."""
    sink = sink_at(spark, tmp_path / "s", compact_every=2)
    steps = [[{"id": 1, "status": "a"}, {"id": 9, "status": "a"}], [{"id": 1, "status": "b"}, {"id": 9, "status": "b"}],   # merged to level 1
             [{"id": 1, "__op": "d"}, {"id": 9, "status": "c"}], [{"id": 5, "status": "c"}, {"id": 1, "__op": "d"}]]     # merged, older run left
    for batch, events in enumerate(steps[:3]):
        sink.write_batch(events_df(spark, [(10 * batch + i, json.dumps(e)) for i, e in enumerate(events)]), batch)
    assert sorted(r["id"] for r in sink.state("pedidos").collect()) == [9]
    sink.write_batch(events_df(spark, [(30 + i, json.dumps(e)) for i, e in enumerate(steps[3])]), 3)
    assert sorted(r["id"] for r in sink.state("pedidos").collect()) == [5, 9]


# -- UNIQUE columns --

def consumer(log):
    """State and rejected offsets of a consumer that applies events one by one to a table with a UNIQUE number."""
    table, rejected = {}, []
    for offset, value in log:
        p = json.loads(value)
        if p.get("__op") == "d":
            table.pop(p["id"], None)
            continue
        n = p.get("numero_pedido")
        if n is not None and any(k != p["id"] and row.get("numero_pedido") == n for k, row in table.items()):
            rejected.append(offset)
            continue
        table.setdefault(p["id"], {}).update({c: v for c, v in p.items() if c not in ("id", "__op")})
    return {k: (row.get("numero_pedido"), row.get("status")) for k, row in table.items()}, rejected


def claims(seed, n):
    rnd = random.Random(seed)
    out = []
    for offset in range(n):
        p = {"id": rnd.randint(1, 12)}
        if rnd.random() < 0.2:
            p["__op"] = "d"
        else:
            if rnd.random() < 0.7:
                p["numero_pedido"] = None if rnd.random() < 0.1 else f"n{rnd.randint(1, 8)}"
            p["status"] = f"s{offset}"
        out.append((offset, json.dumps(p)))
    return out


def states(df):
    return {r["id"]: (r["numero_pedido"], r["status"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1])
def test_unique_values_as_one_by_one(spark, tmp_path, seed):
    log = claims(seed, 150)
    want, rejected = consumer(log)
    assert rejected
    events = events_df(spark, log)
    assert states(cdc.apply_changes(events, {TOPIC: ROUTE}, unique=True)["pedidos"]) == want
    bad = cdc.quarantine(events, {TOPIC: ROUTE}, unique=True)
    assert sorted(r["offset"] for r in bad.collect()) == rejected and {r["reason"] for r in bad.collect()} == {"unique_violation"}
    # Across batches, with merges in between.
    sink = sink_at(spark, tmp_path / "s", compact_every=2, unique=True)
    for i in range(2):
        sink.write_batch(events_df(spark, log[75 * i:75 * i + 75]), i)
    assert states(sink.state("pedidos")) == want
    assert sorted(r["offset"] for r in sink.quarantine().collect()) == rejected
    assert sink.totals() == {TOPIC: len(log) - len(rejected)}


def test_a_chain_of_claims(spark):
    """Each claim decides the next: a rejected rename keeps its old number, which rejects the next rename."""
    n = 5
    log = [(i, json.dumps({"id": i, "numero_pedido": f"n{i}"})) for i in range(n)]
    log += [(n + i, json.dumps({"id": i, "numero_pedido": f"n{i + 1}"})) for i in range(n)]
    want, rejected = consumer(log)
    assert len(rejected) == n - 1
    events = events_df(spark, log)
    assert states(cdc.apply_changes(events, {TOPIC: ROUTE}, unique=True)["pedidos"]) == want


def test_without_unique_nothing_changes(spark):
    log = claims(3, 60)
    state = cdc.apply_changes(events_df(spark, log), {TOPIC: ROUTE})["pedidos"]
    assert "unique" not in state._jdf.queryExecution().optimizedPlan().toString()
    assert schemas.UNIQUE_KEYS["pedidos"] == (cdc.ENFORCED["pedidos"],)
