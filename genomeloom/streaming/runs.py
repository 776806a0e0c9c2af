"""Run state machine and reservation ledger as stateful processors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ledger import ACTIVE, TRANSITIONS

RUN_OUTPUT = "project_id long, event_id long, run_id string, from_status string, to_status string, accepted boolean, reason string"
ALERT_OUTPUT = "user_id long, event_id long, reserved_total long, alert string"


def _judge(current: tuple[str, str] | None, run: str, target: str) -> str | None:
    """Reason a move is refused, or None."""
    if target not in TRANSITIONS:
        return "unknown_status"
    if target == "PENDING":
        return "duplicate_active" if current and current[1] in ACTIVE else None
    if current is None:
        return "no_run"
    return None if target in TRANSITIONS[current[1]] else "illegal_move"


# Span of event time that is released at once: what a key holds in it is sorted in memory.
BUCKET_SECONDS = 86_400
# Rows that go to or come from the state in one call.
CHUNK_ROWS = 10_000
# Groups that keys are dealt to. A call to the state costs about as much for one row as for thousands, so the keys of
# a group share their calls; what is due of a group is sorted in memory.
GROUPS = 4096


class InTimeOrder(StatefulProcessor):
    """Holds the rows of a group of keys back and releases them in the order of time.

    Rows wait in a list: a batch appends its rows and reads none. A timer goes off when the watermark has passed the
    end of the earliest bucket of event time that holds a row. The rows of the buckets that ended are then taken out,
    sorted and released, and the timer of the next bucket is set; those that
    wait on are copied to a second list, and the two change places. A row is so written once, and once more for
    each bucket that ends while it waits, however many batches brought the rows.

    What a key has come to is kept in a list of its own: a release appends the keys it moved, and writes the list
    anew when more than half of it is outdated.

    Neither the order in which files land nor how they fall into batches can change what comes out. Only a row
    that lands later than the watermark's delay is left out, as the watermark promises, and one without time.
    """

    #: Columns that are held with their types, ``at`` (microseconds) first. The key is held too: what is released is
    #: written from the rows alone.
    held: tuple[tuple[str, str], ...] = ()
    #: Columns of what is kept of a key, the key first.
    kept: str = ""

    def __init__(self, bucket_seconds: int = BUCKET_SECONDS):
        self.bucket_ms = bucket_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = ", ".join(f"{name} {kind}" for name, kind in self.held)
        self.lists = [handle.getListState(f"waiting_{i}", schema) for i in (0, 1)]
        self.turn = handle.getValueState("turn", "list int, until long, timer long")
        self.known = handle.getListState("known", self.kept)

    def _current(self) -> tuple[int, int, int]:
        """Which list rows wait in, up to which time (microseconds) rows were released, and the timer that is set (0: none)."""
        stored = self.turn.get()
        return (int(stored[0]), int(stored[1]), int(stored[2])) if stored is not None else (0, 0, 0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        turn, released, timer = self._current()
        waiting, first = self.lists[turn], None
        for part in rows:
            part = part[part["at"].notna()]
            # Column by column: a table of mixed columns would turn whole numbers into floats.
            fresh = list(zip(*(_cells(part[name], kind) for name, kind in self.held), strict=True))
            for i in range(0, len(fresh), CHUNK_ROWS):
                waiting.appendList(fresh[i : i + CHUNK_ROWS])
            if fresh:
                first = min(int(part["at"].min()), first) if first is not None else int(part["at"].min())
        if first is not None and (not timer or self._end(first) < timer):
            self.turn.update((turn, released, self._end(first)))
            self.handle.registerTimer(self._end(first))
        return iter(())

    def _end(self, at: int) -> int:
        """End of the bucket of a time (microseconds), in milliseconds."""
        return (at // (1000 * self.bucket_ms) + 1) * self.bucket_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        turn, released, _ = self._current()
        # Buckets that ended together go together; a timer that an earlier one replaced then finds its rows gone.
        passed = timerValues.getCurrentWatermarkInMs() // self.bucket_ms * self.bucket_ms
        until = max(passed, expiredTimerInfo.getExpiryTimeInMs()) * 1000
        if until <= released:
            return
        here, there = self.lists[turn], self.lists[1 - turn]
        due, stay, first = [], [], None
        for row in here.get():
            if row[0] < until:
                due.append(tuple(row))
                continue
            stay.append(tuple(row))
            first = row[0] if first is None else min(first, row[0])
            if len(stay) == CHUNK_ROWS:
                there.appendList(stay)
                stay = []
        if stay:
            there.appendList(stay)
        here.clear()
        timer = self._end(int(first)) if first is not None else 0
        self.turn.update((1 - turn, until, timer))
        if timer:
            self.handle.registerTimer(timer)
        out = self.release(sorted(due, key=self.place))
        if len(out):
            yield out

    def place(self, row: tuple) -> tuple:
        return row[:2]

    def release(self, rows: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def recall(self) -> dict:
        """What is kept of each key of the group."""
        rows = [tuple(row) for row in self.known.get()]
        self.noted = len(rows)
        return {row[0]: row[1:] for row in rows}

    def note(self, now: dict, moved: set) -> None:
        """Keep what the keys ``moved`` have come to; ``now`` holds all keys of the group."""
        if anew := self.noted + len(moved) > 2 * len(now):
            self.known.clear()
        rows = [(key, *now[key]) for key in (now if anew else moved)]
        for i in range(0, len(rows), CHUNK_ROWS):
            self.known.appendList(rows[i : i + CHUNK_ROWS])

    def close(self) -> None:
        pass


def _cells(column: pd.Series, kind: str) -> list:
    """Values for the state: missing ones as None, whole numbers whole (beside nulls they come as floats)."""
    whole = (lambda v: int(v)) if kind in ("long", "int") else (lambda v: v)
    return [None if v is None or v != v else whole(v) for v in column.tolist()]


class RunMachine(InTimeOrder):
    """Keeps the current run of each project; refuses illegal moves and submissions while one is active."""

    held = (("at", "long"), ("event_id", "long"), ("project_id", "long"), ("run_id", "string"), ("status", "string"))
    kept = "project_id long, run_id string, status string"

    def release(self, rows: list[tuple]) -> pd.DataFrame:
        now, moved, out = self.recall(), set(), []
        for _, event, project, run, target in rows:
            current = now.get(project)
            reason = _judge(current, run, target)
            out.append((project, event, run, current[1] if current else None, target, reason is None, reason))
            if reason is None:
                now[project] = (run if target == "PENDING" else current[0], target)
                moved.add(project)
        self.note(now, moved)
        names = [f.split()[0] for f in RUN_OUTPUT.split(", ")]
        return pd.DataFrame(out, columns=names)


class ReservationWatch(InTimeOrder):
    """Running reservation total per user; one alert when it passes the cap."""

    held = (("at", "long"), ("event_id", "long"), ("user_id", "long"), ("reserved", "long"))
    kept = "user_id long, total long, alerted boolean"

    def __init__(self, cap: int, bucket_seconds: int = BUCKET_SECONDS):
        super().__init__(bucket_seconds)
        self.cap = cap

    def release(self, rows: list[tuple]) -> pd.DataFrame:
        now, moved, out = self.recall(), set(), []
        for _, event, user, reserved in rows:
            total, alerted = now.get(user, (0, False))
            total += reserved or 0
            if total > self.cap and not alerted:
                out.append((user, event, total, "cap_reached"))
                alerted = True
            now[user] = (total, alerted)
            moved.add(user)
        self.note(now, moved)
        return pd.DataFrame(out, columns=["user_id", "event_id", "reserved_total", "alert"])


def _timed(rows: DataFrame, delay: str) -> DataFrame:
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def _in_time_order(timed: DataFrame, key: str, processor: InTimeOrder, output: str) -> DataFrame:
    # Rows without a key have a group of their own: nulls would turn the keys beside them into floats.
    group = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(GROUPS))).cast("int")
    return timed.withColumns({"at": F.unix_micros("ts"), "__group": group}).groupBy("__group").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )


def run_machine(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Every event of ``project_id, event_id, ts, run_id, status`` with accepted or refused and why.

    ``delay``: how much later than newer events an event may land and still be judged in its place.
    """
    rows = events.select("project_id", "event_id", "ts", "run_id", "status")
    return _in_time_order(_timed(rows, delay), "project_id", RunMachine(), RUN_OUTPUT)


def reservation_alerts(rows: DataFrame, cap: int, delay: str = "1 day") -> DataFrame:
    """First reservation over the cap of each user, from ``user_id, event_id, ts, reserved``."""
    rows = rows.select("user_id", "event_id", "ts", "reserved")
    return _in_time_order(_timed(rows, delay), "user_id", ReservationWatch(cap), ALERT_OUTPUT)


def usage_alerts(rows: DataFrame) -> DataFrame:
    """Rows whose usage exceeds their reservation; needs no state."""
    return rows.where(F.col("used") > F.col("reserved")).select(
        "user_id", "event_id", F.col("used").alias("reserved_total"), F.lit("usage_over_reservation").alias("alert")
    )


# States that a changed input turns stale.
LIVE = ("SUCCEEDED", "READY", "RUNNING", "WAITING_REVIEW")
STALE_OUTPUT = "project_id long, product_id long, status string, to_status string"


class StaleWatch(InTimeOrder):
    """Keeps the status of each project; a changed product marks it stale if it is live at that time."""

    #: ``kind`` 0: a status, ``ref`` is its event; 1: a changed product, ``ref`` is the product.
    held = (("at", "long"), ("kind", "long"), ("ref", "long"), ("project_id", "long"), ("status", "string"))
    kept = "project_id long, status string"

    def place(self, row: tuple) -> tuple:
        return row[:3]

    def release(self, rows: list[tuple]) -> pd.DataFrame:
        now, moved, out = self.recall(), set(), []
        for _, kind, ref, project, landed in rows:
            if kind == 0:
                now[project] = (landed,)
                moved.add(project)
            elif project in now and now[project][0] in LIVE:
                out.append((project, ref, now[project][0], "STALE"))
        self.note(now, moved)
        return pd.DataFrame(out, columns=["project_id", "product_id", "status", "to_status"])


def stale_marks(changes: DataFrame, expected: DataFrame, states: DataFrame, delay: str = "1 day") -> DataFrame:
    """Product digests against the registered ones: what moved marks the project stale if a run is live at that time.

    ``changes`` (project_id, product_id, sha256, ts) and ``states`` (project_id, event_id, status, ts) are both streams, in
    any order of landing up to ``delay``; a status of the same time as a change counts before it.
    """
    # A watermark for each stream: the slower one holds the time back.
    states, changes = _timed(states, delay), _timed(changes, delay)
    moved = changes.join(
        expected.withColumnRenamed("sha256", "expected"), ["project_id", "product_id"]
    ).where(F.col("sha256") != F.col("expected"))
    rows = states.select(
        "project_id", "ts", F.lit(0).cast("long").alias("kind"), F.col("event_id").alias("ref"), "status"
    ).unionByName(
        moved.select(
            "project_id", "ts", F.lit(1).cast("long").alias("kind"), F.col("product_id").alias("ref"),
            F.lit(None).cast("string").alias("status"),
        )
    )
    return _in_time_order(rows, "project_id", StaleWatch(), STALE_OUTPUT)
