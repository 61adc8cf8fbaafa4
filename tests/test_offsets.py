"""Applied offsets per topic and partition: gaps, replays, levels of the ledger."""
import json
import random

import pytest
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.streaming import cdc, offsets
from test_cdc import ROUTE, TOPIC, state_dict


def events(spark, rows):
    """(partition, offset, payload) rows of one topic."""
    data = [(TOPIC, p, o, json.dumps(v) if isinstance(v, dict) else v) for p, o, v in rows]
    return spark.createDataFrame(data, "topic string, partition int, offset long, value string").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp")).select(*[f.name for f in schemas.CHANGE_EVENT.fields])


def brute(found):
    """Coverage and gaps of sets of offsets by partition."""
    cover, holes = {}, set()
    for p, seen in found.items():
        order = sorted(seen)
        cuts = [(a + 1, b - 1) for a, b in zip(order, order[1:]) if b > a + 1]
        cover[p] = (order[0], order[-1], len(order), sum(z - a + 1 for a, z in cuts), len(cuts))
        holes |= {(p, *c) for c in cuts}
    return cover, holes


def as_sets(merged):
    cover = {r["partition"]: (r["first_offset"], r["last_offset"], r["seen"], r["missing"], r["gaps"]) for r in offsets.coverage(merged).collect()}
    return cover, {(r["partition"], r["first"], r["last"]) for r in offsets.gaps(merged).collect()}


def test_two_partitions_a_gap_and_a_replay(spark, tmp_path):
    sink = cdc.SnapshotSink(spark, str(tmp_path / "s"), compact_every=2, routes={TOPIC: ROUTE}, track_offsets=True)
    up = lambda k, s: {"id": k, "status": s}
    first = [(0, 0, up(1, "a")), (0, 1, up(2, "a")), (1, 0, up(3, "a")), (1, 1, up(4, "a"))]
    sink.write_batch(events(spark, first), 0)
    sink.write_batch(events(spark, [(0, 2, {"id": 1, "__op": "d"}), (1, 5, up(3, "b")), (1, 5, up(3, "b"))]), 1)
    sink.compact("pedidos")                         # the delete of 1 leaves no trace
    want = {2: "a", 3: "b", 4: "a"}
    assert {k: v["status"] for k, v in state_dict(sink.state("pedidos")).items()} == want
    # Both first events again, and one that is new: 1 must not come back.
    again = cdc.SnapshotSink(spark, str(tmp_path / "s"), compact_every=2, routes={TOPIC: ROUTE}, track_offsets=True)
    assert again.write_batch(events(spark, first + [(0, 3, up(5, "n"))]), 2) == {TOPIC: 1}
    assert {k: v["status"] for k, v in state_dict(again.state("pedidos")).items()} == want | {5: "n"}
    rows = {r["partition"]: (r["last_offset"], r["event_count"], r["repeats"]) for r in again.partitions().collect()}
    assert rows == {0: (3, 4, 2), 1: (5, 3, 3)}
    assert as_sets(again.consumed()) == brute({0: {0, 1, 2, 3}, 1: {0, 1, 5}})
    assert {(r["partition"], r["first"], r["last"]) for r in again.gaps().collect()} == {(1, 2, 4)}
    assert again.totals() == {TOPIC: 7} and again.control().collect()[0]["last_offset"] == 5
    # Batches of nothing but repeats change the counts of repeats alone, by each event once.
    for batch in (3, 4):
        assert again.write_batch(events(spark, first), batch) == {} and again.totals() == {TOPIC: 7}
    assert {r["partition"]: r["repeats"] for r in again.partitions().collect()} == {0: 6, 1: 7}
    assert again.expire("pedidos", keep=1) and as_sets(again.consumed()) == brute({0: {0, 1, 2, 3}, 1: {0, 1, 5}})


@pytest.mark.parametrize("seed", [1, 2])
def test_ledgers_agree_with_sets(spark, seed, monkeypatch):
    monkeypatch.setattr(offsets, "BLOCK", 16)       # runs and gaps that pass over many blocks
    rnd = random.Random(seed)
    deliveries = [[(rnd.choice([0, 0, 0, 1]), rnd.choice([rnd.randint(0, 60), rnd.randint(200, 300), 5000 + i])) for i in range(120)] for _ in range(3)]
    found, ledgers = {}, []
    for rows in deliveries:
        df = events(spark, [(p, o, None) for p, o in rows] + [(None, 1, None), (0, None, None)])
        own = offsets.ledger(df)
        held = ledgers[0].unionByName(ledgers[-1]) if ledgers else None
        before = {p: set(s) for p, s in found.items()}
        for p, o in rows:
            found.setdefault(p, set()).add(o)
        assert own.agg(F.sum("delivered")).first()[0] == len(rows)
        if held is not None and len(ledgers) == 2:
            left = sorted((r["partition"], r["offset"]) for r in offsets.fresh(df, held).filter("partition IS NOT NULL AND offset IS NOT NULL").collect())
            assert left == sorted((p, o) for p, o in set(rows) if o not in before.get(p, ()))
            assert offsets.fresh(df, held).count() == len(left) + 2     # those without an address stay
            shared = {r["partition"]: r["repeats"] for r in offsets.already_seen(own, held).collect()}
            assert {p: n for p, n in shared.items() if n} == {p: n for p in before if (n := len(before[p] & {o for q, o in rows if q == p}))}
        ledgers.append(own.drop("delivered"))
    merged = offsets.merge(ledgers[0].unionByName(ledgers[1]).unionByName(ledgers[2]))
    assert as_sets(merged) == brute(found)


def test_an_empty_ledger(spark):
    empty = offsets.ledger(events(spark, []))
    assert offsets.coverage(empty).count() == 0 and offsets.gaps(empty).count() == 0
