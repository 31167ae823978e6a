"""Shards as a streaming source: frontier, restart, growth between reads."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from searchloom import contract as C
from searchloom.operators import gates
from searchloom.plans import incremental
from searchloom.sinks.pointer import UnreadablePointer, VersionedPointer, newest_value
from searchloom.sources import shards, shardstream
from searchloom.streaming import producing
from tests.helpers import row, rows

T0 = 1700009000


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="searchloom-test-")


class Leg:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.cursors, self.frontier = VersionedPointer(spark, f"{root}/cursors"), VersionedPointer(spark, f"{root}/frontier")
        self.counts = []

    def add(self, *items):
        rows(self.spark, *items).write.mode("append").partitionBy("shard_table").parquet(f"{self.root}/shards")

    def source(self):
        return shards.read_parquet(self.spark, f"{self.root}/shards")

    def publish(self, now):
        return shardstream.publish(self.source(), self.frontier, now, 600)

    def run(self, checkpoint="cp"):
        query = producing.start(
            self.source, f"{self.root}/frontier", self.cursors, f"{self.root}/out", f"{self.root}/{checkpoint}", lambda: T0,
            report=lambda n, c: self.counts.append((n, c["items"])),
        )
        query.awaitTermination()
        return self.ends()

    def ends(self):
        return incremental.progress(self.cursors)[1]["cursors"]

    def seen(self):
        return sorted(int(bytes(r["key"])) for r in incremental.main_records(self.spark, f"{self.root}/out", self.cursors).collect())


def test_the_frontier_is_the_stable_prefix(spark, root):
    leg = Leg(spark, root)
    leg.add(row("1", id=1), row("2", id=2, created_unix=T0), row("3", id=3), row("4", id=1, shard_table="message1"))
    assert newest_value(f"{root}/frontier") == {}
    assert leg.publish(T0) == {"message": 1, "message1": 1} == newest_value(f"{root}/frontier")["cursors"]
    assert leg.publish(T0) == {"message": 1, "message1": 1} and leg.frontier.read()[0] == 1
    assert leg.publish(T0 + 700) == {"message": 3, "message1": 1}
    with pytest.raises(gates.GateError):
        shardstream.publish(leg.source(), leg.frontier, T0, 0)
    with open(f"{root}/frontier/{3:012d}.json", "w") as f:
        f.write("{")
    with pytest.raises(UnreadablePointer):
        newest_value(f"{root}/frontier")


def test_of_two_publishers_the_faster_one_counts(spark, root, monkeypatch):
    leg, commit, others = Leg(spark, root), VersionedPointer.commit, [True]
    leg.add(row("1", id=1), row("2", id=2, created_unix=T0))

    def late(self, expected, value):
        if others:
            others.clear()
            assert leg.publish(T0 + 700) == {"message": 2}
        return commit(self, expected, value)

    monkeypatch.setattr(VersionedPointer, "commit", late)
    assert leg.publish(T0) == {"message": 2} == leg.frontier.read()[1]["cursors"]


def test_a_stream_of_growing_shards_loses_nothing(spark, root):
    leg = Leg(spark, root)
    leg.add(row("1", id=1), row("2", id=2, created_unix=T0), row("5", "{bad", id=1, shard_table="message1"))
    leg.publish(T0)
    # after the frontier was found a row becomes visible below a fresh id, and a shard is new
    leg.add(row("3", id=3, created_unix=T0), row("6", id=4, shard_table="message2"))
    assert leg.run() == {"message": 1, "message1": 1} and leg.seen() == [1]
    assert leg.run() == {"message": 1, "message1": 1} and leg.counts == [(0, 2)]  # the frontier stands still
    leg.publish(T0 + 700)
    assert leg.run() == {"message": 3, "message1": 1, "message2": 4} and leg.seen() == [1, 2, 3, 6]
    assert [n for _, n in leg.counts] == [2, 3]
    # offsets in the checkpoint are the cursors
    with open(f"{root}/cp/offsets/1") as f:
        assert json.loads(f.read().split("\n")[-1]) == leg.ends()
    letters = incremental.dead_records(spark, f"{root}/out", leg.cursors).collect()
    assert [(r["message_id"], r["reason"]) for r in letters] == [("5", C.PRODUCER_UNPARSEABLE)]


def test_batches_that_come_again_publish_once(spark, root, monkeypatch):
    leg = Leg(spark, root)
    leg.add(row("1", id=1), row("2", id=2))
    leg.publish(T0)
    publish = incremental.run_range

    def dies_after(*args):
        publish(*args)
        raise OSError("lost the driver")

    monkeypatch.setattr(incremental, "run_range", dies_after)
    with pytest.raises(Exception, match="lost the driver"):
        leg.run()
    assert leg.seen() == [1, 2]
    monkeypatch.undo()
    leg.run()  # the same batch again
    assert leg.seen() == [1, 2] and leg.counts == []
    leg.run("other")  # a new checkpoint starts at the cursors
    assert leg.seen() == [1, 2] and leg.counts == []
    # ticks and the stream go on from each other
    leg.add(row("3", id=3))
    assert incremental.run_tick(leg.source(), leg.cursors, f"{root}/out", T0, 600) == {"message": 3}
    leg.add(row("4", id=4))
    leg.publish(T0)
    assert leg.run() == {"message": 4} and leg.seen() == [1, 2, 3, 4]
    assert leg.counts == [(1, 1)]  # of the rows above the old offset only those above the cursors


def test_a_lost_race_keeps_the_batch(spark, root, monkeypatch):
    leg, commit, others = Leg(spark, root), VersionedPointer.commit, [True]
    leg.add(row("1", id=1), row("2", id=2))
    leg.publish(T0)

    def late(self, expected, value):
        if others:
            others.clear()
            assert incremental.run_range(leg.source(), {"message": 1}, leg.cursors, f"{root}/out", T0)
        return commit(self, expected, value)

    monkeypatch.setattr(VersionedPointer, "commit", late)
    with pytest.raises(Exception, match="another job publishes"):
        leg.run()
    assert leg.seen() == [1]
    assert leg.run() == {"message": 2} and leg.seen() == [1, 2]


def test_bounds_on_ids_reach_the_files(spark, root):
    leg = Leg(spark, root)
    leg.add(row("1", id=1), row("2", id=2), row("3", id=3, shard_table="message1"))
    plan = shards.scan_between(leg.source(), {"message": 1}, {"message": 2})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard_table" in plan and "LessThanOrEqual(id,2)" in plan and "GreaterThan(id,1)" in plan
    assert [r["id"] for r in shards.scan_between(leg.source(), {"message": 1}, {"message": 2, "message1": 2}).collect()] == [2]
    assert shards.scan_between(leg.source(), {}, {}).where(F.lit(True)).count() == 0


def test_a_running_stream_follows_the_frontier(spark, root):
    import time

    leg = Leg(spark, root)
    leg.add(row("1", id=1))
    running = [
        shardstream.keep_publishing(leg.source, leg.frontier, 600, lambda: T0, f"{root}/ticker", every="1 second"),
        producing.start(leg.source, f"{root}/frontier", leg.cursors, f"{root}/out", f"{root}/cp", lambda: T0, processingTime="1 second"),
    ]
    try:
        for ids in ([1], [1, 2]):
            until = time.time() + 60
            while leg.seen() != ids and time.time() < until:
                assert all(q.exception() is None for q in running)
                time.sleep(0.5)
            assert leg.seen() == ids
            if ids == [1]:
                leg.add(row("2", id=2))
    finally:
        for q in running:
            q.stop()
