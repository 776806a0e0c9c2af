"""Stateful streams: what lands in which order and batch must not matter."""

import pytest
from pyspark.sql import functions as F

from genomeloom.streaming import landing as N
from genomeloom.streaming import runs as U

SCHEMA = "project_id long, event_id long, ts timestamp, run_id string, status string"


@pytest.mark.parametrize("size", [1, 10**9])
def test_run_machine_does_not_depend_on_landing_order(spark, tmp_path, size):
    N.use_rocksdb(spark)
    moves = ["PENDING", "RUNNING", "SUCCEEDED", "PENDING", "PENDING", "READY"]
    rows = [(p, 10 * p + i, i, f"r{i // 3}", s) for p in (1, 2) for i, s in enumerate(moves)]
    events = spark.createDataFrame(rows, "project_id long, event_id long, i int, run_id string, status string").select(
        "project_id", "event_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i") * 40_000).alias("ts"), "run_id", "status"
    )
    path = str(tmp_path / "landing")
    for part in (events.where("event_id % 2 = 1"), events.where("event_id % 2 = 0")):
        part.orderBy(F.desc("event_id")).coalesce(1).write.mode("append").json(path)
    N.close_landing(spark, path, events.schema)
    stream = N.landing(spark, path, events.schema, max_bytes=size).drop("_corrupt_record")
    out = N.drain(U.run_machine(stream, "100 days"), "order").orderBy("event_id").collect()
    assert [(r.event_id, r.accepted, r.reason) for r in out if r.project_id == 1] == [
        (10, True, None),
        (11, False, "illegal_move"),
        (12, False, "illegal_move"),
        (13, False, "duplicate_active"),
        (14, False, "duplicate_active"),
        (15, True, None),
    ]
    assert len(out) == 12


def _marks(spark, tmp_path, order, size):
    """Two projects; their states land in files of any order beside the changed products."""
    at = lambda h: F.timestamp_seconds(F.lit(1_700_000_000) + h * 3600)
    states = [(1, 1, 0, "PENDING"), (1, 2, 30, "RUNNING"), (1, 3, 60, "FAILED"), (2, 4, 10, "SUCCEEDED"), (2, 5, 50, "REJECTED")]
    # Product 12 changes before the run goes live, 13 at the same time, 14 while it is live, 15 after it failed.
    changes = [(1, 12, 29), (1, 13, 30), (1, 14, 45), (1, 15, 61), (2, 21, 9), (2, 22, 49), (2, 23, 50), (3, 31, 20)]
    s = spark.createDataFrame(states, "project_id long, event_id long, h long, status string").select("project_id", "event_id", at(F.col("h")).alias("ts"), "status")
    c = spark.createDataFrame(changes, "project_id long, product_id long, h long").select("project_id", "product_id", F.lit("new").alias("sha256"), at(F.col("h")).alias("ts"))
    expected = c.select("project_id", "product_id", F.when(F.col("product_id") == 22, "new").otherwise("old").alias("sha256"))
    streams = []
    for name, rows, key in (("states", s, "event_id"), ("changes", c, "product_id")):
        path = str(tmp_path / name)
        ordered = sorted(rows.collect(), key=lambda r: order * r[key])
        for row in ordered:  # a file a row: it lands by itself
            spark.createDataFrame([row], rows.schema).coalesce(1).write.mode("append").json(path)
        N.close_landing(spark, path, rows.schema)
        streams.append(N.landing(spark, path, rows.schema, max_bytes=size).drop("_corrupt_record"))
    out = N.drain(U.stale_marks(streams[1], expected, streams[0], "100 days"), "stale").collect()
    return sorted((r.product_id, r.status) for r in out)


@pytest.mark.parametrize("order, size", [(1, 1), (-1, 10**9)])
def test_stale_marks_follow_states_that_land_later(spark, tmp_path, order, size):
    N.use_rocksdb(spark)
    assert _marks(spark, tmp_path, order, size) == [(13, "RUNNING"), (14, "RUNNING")]


def test_waiting_rows_are_written_once_however_many_batches(spark, tmp_path):
    """200 rows of one key in 200 or 4 batches: the list grows by appending, so state is written in proportion to rows."""
    N.use_rocksdb(spark)

    class Handle:
        """Counts the rows that go to lists; stands for the state store."""

        def __init__(self):
            self.rows = {}
            self.written = 0
            self.values = {}

        def getListState(self, name, schema):
            outer = self
            outer.rows.setdefault(name, [])

            class State:
                def appendList(self, rows):
                    outer.rows[name] += rows
                    outer.written += len(rows)

                def get(self):
                    return iter(list(outer.rows[name]))

                def clear(self):
                    outer.rows[name] = []

            return State()

        def getValueState(self, name, schema):
            outer = self

            class State:
                def get(self):
                    return outer.values.get(name)

                def update(self, value):
                    outer.values[name] = value

            return State()

        def registerTimer(self, at):
            pass

    class Time:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

        getExpiryTimeInMs = getCurrentWatermarkInMs

    import pandas as pd

    results, written = [], []
    for batches in (200, 4):
        handle, watch = Handle(), U.ReservationWatch(10**9, bucket_seconds=100)
        watch.init(handle)
        moves = pd.DataFrame({"at": [(i * 7919 % 200) * 1_000_000 for i in range(200)], "event_id": range(200), "user_id": 1, "reserved": 5.0})
        moves.loc[3, "reserved"] = None
        released = []
        watch.release = lambda rows, seen=released: seen.extend(rows) or pd.DataFrame()
        for i in range(batches):
            list(watch.handleInputRows((1,), iter([moves.iloc[i * 200 // batches : (i + 1) * 200 // batches]]), None))
        assert handle.written == 200
        for ms in (100_000, 200_000):
            list(watch.handleExpiredTimer((1,), Time(ms), Time(ms)))
        results.append(released)
        written.append(handle.written)
    assert results[0] == results[1] == sorted(results[0], key=lambda r: r[:2]) and len(results[0]) == 200
    assert {type(r[3]) for r in results[0]} == {int, type(None)}
    assert written == [300, 300]  # the second half of the time waits on once


def test_keys_of_a_group_share_timers_and_state_calls(spark):
    """300 rows of 100 projects over 30 days: one timer at a time, and as many state calls as for one project."""
    import pandas as pd

    calls = {"timer": [], "append": 0}

    class State:
        def __init__(self):
            self.rows, self.value = [], None

        def appendList(self, rows):
            calls["append"] += 1
            self.rows += rows

        def clear(self):
            self.rows = []

        def update(self, value):
            self.value = value

    class Rows(State):
        def get(self):
            return iter(list(self.rows))

    class Value(State):
        def get(self):
            return self.value

    class Handle:
        def getListState(self, name, schema):
            return Rows()

        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            calls["timer"].append(at)

    class Time:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    day, machine = 86_400_000, U.RunMachine()
    machine.init(Handle())
    moves = ["PENDING", "READY", "RUNNING"]
    rows = [((10 * i + p % 10) * day * 1000, 3 * p + i, p, f"r{p}", s) for p in range(100) for i, s in enumerate(moves)]
    batch = pd.DataFrame(rows[::-1], columns=["at", "event_id", "project_id", "run_id", "status"])
    list(machine.handleInputRows((0,), iter([batch]), None))
    assert calls == {"timer": [day], "append": 1}
    out = []
    for days in (1, 5, 12, 40):
        for part in machine.handleExpiredTimer((0,), Time(days * day), Time(days * day)):
            out += part.itertuples(index=False)
    assert calls["timer"] == [n * day for n in (1, 2, 6, 13)]
    assert calls["append"] == 1 + 3 + 4  # rows, rows that wait on, what the projects have come to
    assert len(out) == 300 and all(r.accepted for r in out)
    assert [r.to_status for r in out if r.project_id == 7] == moves
