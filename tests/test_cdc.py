"""CDC apply: the fold equals a plain replay of the consumer's upsert/delete
semantics, in one batch or many, and replays are idempotent."""
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.streaming import cdc

TOPIC = schemas.TOPIC_PREFIX + "pedidos"
ROUTE = schemas.ROUTES[TOPIC]
COLS = ["status", "desconto", "observacoes", "canal_venda"]


def replay(events):
    """Python model of the consumer: INSERT present columns (others default),
    ON CONFLICT update present columns, DELETE resets."""
    table = {}
    for _, value in events:
        p = json.loads(value)
        p = p.get("payload", p) if isinstance(p, dict) else p
        if not isinstance(p, dict) or not p or "id" not in p or p["id"] is None:
            continue
        if p.get("__op", "r") == "d":
            table.pop(p["id"], None)
            continue
        row = table.get(p["id"])
        if row is None:
            row = {c: None for c in COLS}
            row["desconto"] = 0
            table[p["id"]] = row
        for c in COLS:
            if c in p:
                row[c] = p[c]
    return table


def random_log(seed, n=400, keys=25):
    rnd = random.Random(seed)
    out = []
    for off in range(n):
        k = rnd.randint(1, keys)
        r = rnd.random()
        if r < 0.15:
            p = {"id": k, "__op": "d"}
        else:
            p = {"id": k, "__op": rnd.choice(["r", "c", "u"])}
            for c in COLS:
                if rnd.random() < 0.5:
                    p[c] = None if rnd.random() < 0.2 else (
                        rnd.randint(0, 99) if c == "desconto" else f"{c}{rnd.randint(0, 9)}")
        if rnd.random() < 0.1:
            p = {"payload": p}
        out.append((off, json.dumps(p)))
    return out


def events_df(spark, log):
    return spark.createDataFrame(
        [(TOPIC, 0, off, None, v) for off, v in log],
        "topic string, partition int, offset long, timestamp timestamp, value string")


def state_dict(df):
    out = {}
    for r in df.collect():
        out[r["id"]] = {c: (int(r[c]) if c == "desconto" and r[c] is not None else r[c]) for c in COLS}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_fold_matches_replay(spark, seed):
    log = random_log(seed)
    got = state_dict(cdc.apply_changes(events_df(spark, log), {TOPIC: ROUTE})["pedidos"])
    assert got == replay(log)


def test_snapshot_sink_batches_and_replay(spark, tmp_path):
    log = random_log(9, n=300)
    sink = cdc.SnapshotSink(spark, str(tmp_path / uuid.uuid4().hex), compact_every=2,
                            routes={TOPIC: ROUTE})
    chunks = [log[:100], log[100:210], log[210:]]
    for i, chunk in enumerate(chunks):
        sink.write_batch(events_df(spark, chunk), i)
    want = replay(log)
    assert state_dict(sink.state("pedidos")) == want
    # Replaying the last batch id changes nothing.
    sink.write_batch(events_df(spark, chunks[-1]), len(chunks) - 1)
    assert state_dict(sink.state("pedidos")) == want
    # A new sink over the same folder (a restarted query) reads the files.
    again = cdc.SnapshotSink(spark, sink.root, compact_every=2, routes={TOPIC: ROUTE})
    assert state_dict(again.state("pedidos")) == want
    ctl = {r["topic"]: r["event_count"] for r in again.control().collect()}
    applied = sum(1 for _, v in log if "id" in json.loads(v).get("payload", json.loads(v)))
    assert ctl[TOPIC] == applied


def test_parse_reasons(spark):
    from rivulet.streaming.changelog import junk_events
    q = cdc.quarantine(junk_events(spark)).collect()
    reasons = sorted(r["reason"] for r in q)
    assert reasons == sorted(["invalid_json", "empty", "empty", "empty", "not_object", "missing_pk",
                              "null_key", "unknown_topic", "bad_value"])


def test_explicit_null_wins_and_defaults(spark):
    log = [(0, json.dumps({"id": 1, "status": "a", "desconto": 5})),
           (1, json.dumps({"id": 1, "status": None})),
           (2, json.dumps({"id": 2, "status": "b"}))]
    got = state_dict(cdc.apply_changes(events_df(spark, log), {TOPIC: ROUTE})["pedidos"])
    assert got[1]["status"] is None and got[1]["desconto"] == 5
    assert got[2]["desconto"] == 0          # replica DEFAULT 0 on insert


def test_snapshot_sink_quarantine_and_control_per_batch(spark, tmp_path):
    import os
    root = str(tmp_path / uuid.uuid4().hex)
    sink = cdc.SnapshotSink(spark, root, compact_every=2, routes={TOPIC: ROUTE})
    clean = [(0, json.dumps({"id": 1, "status": "a"})), (1, json.dumps({"id": 2, "status": "b"}))]
    dirty = [(2, json.dumps({"id": 1, "status": "c"})), (3, "{bad json"),
             (4, json.dumps({"id": 3, "desconto": "abc"})), (5, json.dumps({"id": 2, "__op": "d"}))]
    assert sink.write_batch(events_df(spark, clean), 0) == {TOPIC: 2}
    assert not os.path.exists(f"{root}/_quarantine/v=0")      # no rejects, no quarantine version
    assert sink.write_batch(events_df(spark, dirty), 1) == {TOPIC: 2}
    q = spark.read.parquet(f"{root}/_quarantine/v=1").collect()
    assert sorted(r["reason"] for r in q) == ["bad_value", "invalid_json"]
    ctl = {r["topic"]: (r["last_offset"], r["event_count"]) for r in sink.control().collect()}
    assert ctl[TOPIC] == (5, 4)
    assert state_dict(sink.state("pedidos")) == {1: {"status": "c", "desconto": 0,
                                                     "observacoes": None, "canal_venda": None}}
