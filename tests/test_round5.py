"""Disk of the streamed replica: the log is compressed and goes when it is applied, replaced runs go after their batch."""
import os

from pyspark.sql import functions as F

from main_paths import SF001
from rivulet import registry
from rivulet.schemas import CHANGE_EVENT
from rivulet.streaming import replication
from test_cdc import events_df, random_log, replay, state_dict
from test_sink import sink_at


def bytes_under(path):
    return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names)


def test_the_log_takes_a_part_of_its_text_and_goes_when_applied(spark, monkeypatch):
    start, seen = replication.start, {}

    def watched(events, sink, checkpoint, **options):
        seen["log"] = f"{os.path.dirname(checkpoint)}/log"
        seen["bytes"] = bytes_under(seen["log"])
        seen["text"] = spark.read.schema(CHANGE_EVENT).parquet(seen["log"]).agg(F.sum(F.length("value"))).first()[0]
        return start(events, sink, checkpoint, **options)
    monkeypatch.setattr(replication, "start", watched)
    sink = registry._streamed_sink(spark, SF001)
    assert 0 < seen["bytes"] < seen["text"] / 4
    assert not os.path.exists(seen["log"])
    # Of each table, live runs only; of batches, nothing staged.
    live = {r["path"] for runs in sink._manifest()["runs"].values() for r in runs}
    held = {f"{t}/{kind}/{v}" for t in ("clientes", "pedidos", "produtos", "leads") for kind in ("delta", "base")
            if os.path.isdir(f"{sink.root}/{t}/{kind}") for v in os.listdir(f"{sink.root}/{t}/{kind}")}
    assert held == live and not os.path.exists(f"{sink.root}/_staging")
    assert sink.state("pedidos").count() > 0 and sink.quarantine().count() == 9


def test_a_sink_that_keeps_one_commit_gives_the_same_rows(spark, tmp_path):
    log = random_log(31, n=120)
    sink = sink_at(spark, tmp_path / "s", compact_every=2, keep=1)
    for i in range(4):
        sink.write_batch(events_df(spark, log[i * 30:(i + 1) * 30]), i)
        assert state_dict(sink.state("pedidos")) == replay(log[:(i + 1) * 30])
        assert len(os.listdir(tmp_path / "s" / "_manifest")) - sum(n.endswith(".crc") for n in os.listdir(tmp_path / "s" / "_manifest")) == 1
    # A batch that comes again and a restart go on from the kept commit.
    again = sink_at(spark, tmp_path / "s", compact_every=2, keep=1)
    assert again.write_batch(events_df(spark, log[90:]), 3) == sink._manifest()["applied"]
    assert state_dict(again.state("pedidos")) == replay(log) and again.totals() == sink.totals()


def test_files_of_the_sink_are_zstd(spark, tmp_path):
    sink = sink_at(spark, tmp_path / "s")
    sink.write_batch(events_df(spark, random_log(32, n=40)), 0)
    names = [n for _, _, names in os.walk(tmp_path / "s" / "pedidos") for n in names if n.endswith(".parquet")]
    assert names and all(".zstd." in n for n in names)
