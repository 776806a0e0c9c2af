"""Streaming queries: driver tables land as JSON lines and are drained once."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch
from ..streaming import landing as N
from ..streaming import progress as G
from ..streaming import runs as U
from .ledger import BUDGET_SQL, EVENT_SQL, run_events
from .registry import query

SLOT_SQL = """o AS (SELECT 'B' AS "group", 'm' || o_orderstatus AS model, o_custkey AS case_id, 1 + (length(o_orderpriority) - 5) // 3 AS repetition,
  CASE WHEN o_custkey < 300 THEN 'api_error' WHEN o_custkey < 500 THEN 'parse_error' ELSE 'ok' END AS status, o_totalprice > 490000 AS torn, o_totalprice < 20000 AS foreign_plan FROM orders)"""

PLAN = "plan-1"

RECORDS = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("case_id", T.LongType()),
        T.StructField("repetition", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("plan_sha256", T.StringType()),
    ]
)


def _records(t):
    path = scratch(t.spark, "landing")
    status = F.when(F.col("o_custkey") < 300, "api_error").when(F.col("o_custkey") < 500, "parse_error").otherwise("ok")
    line = F.to_json(
        F.struct(
            F.lit("observation").alias("record_type"),
            F.lit("B").alias("group"),
            F.concat(F.lit("m"), "o_orderstatus").alias("model"),
            F.col("o_custkey").alias("case_id"),
            (F.lit(1) + F.floor((F.length("o_orderpriority") - 5) / 3)).cast("long").alias("repetition"),
            status.alias("status"),
            F.when(F.col("o_totalprice") < 20000, "plan-0").otherwise(PLAN).alias("plan_sha256"),
        )
    )
    torn = F.when(F.col("o_totalprice") > 490000, F.substring(line, 1, 30)).otherwise(line)
    t.orders.select(torn.alias("value")).write.text(path)
    return N.landing(t.spark, path, RECORDS)


@query(
    "stream_progress",
    "ST-01 SRC-09",
    f"""WITH {SLOT_SQL}, d AS (SELECT "group", model, case_id, repetition, any_value(status) AS status, count(*) AS n FROM o WHERE NOT torn AND NOT foreign_plan GROUP BY ALL)
SELECT "group", model, (SELECT 3 * count(*) FROM customer) AS planned, count(*) AS completed, count(*) FILTER (status = 'ok') AS status_ok, count(*) FILTER (status = 'api_error') AS status_api_error,
  count(*) FILTER (status = 'parse_error') AS status_parse_error, CAST(sum(n) - count(*) AS BIGINT) AS duplicates_rejected FROM d GROUP BY ALL""",
)
def stream_progress(t):
    """Progress per arm against the customers planned as cases: duplicates and other plans rejected, torn lines skipped."""
    records = _records(t)
    accepted = N.drain(G.accepted_slots(records, PLAN), "accepted")
    received = N.drain(G.received_lines(records, PLAN), "received")
    arms = t.orders.select(F.lit("B").alias("group"), F.concat(F.lit("m"), "o_orderstatus").alias("model")).distinct()
    return G.progress(accepted, received, G.planned_slots(t.customer, arms, 3))


@query(
    "stream_received",
    "ST-01 SRC-09",
    f"""WITH {SLOT_SQL} SELECT CASE WHEN torn THEN 'unreadable' ELSE 'observation' END AS kind, count(*) AS n FROM o GROUP BY ALL""",
)
def stream_received(t):
    """Lines received by kind; torn lines are counted."""
    return N.drain(G.received_lines(_records(t)), "kinds").groupBy("kind").agg(F.count("*").alias("n"))


# The files below land in no order of time at all: an event may come as late as the table is long.
ANY_ORDER = "3650 days"


def _landed_events(t, columns):
    path = scratch(t.spark, "events")
    rows = columns(run_events(t))
    rows.repartition(6, F.xxhash64("event_id")).write.json(path)
    N.close_landing(t.spark, path, rows.schema)
    return N.landing(t.spark, path, rows.schema, max_bytes=200_000).drop("_corrupt_record")


@query(
    "stream_run_machine",
    "ST-02 J-24 W-07",
    f"""WITH RECURSIVE {EVENT_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY ts, event_id) AS rn FROM ev),
s AS (SELECT project_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS from_status, CAST(NULL AS VARCHAR) AS to_status, CAST(NULL AS VARCHAR) AS reason FROM (SELECT DISTINCT project_id FROM ev)
  UNION ALL SELECT n.project_id, n.rn, CASE WHEN n.status = 'PENDING' AND coalesce(s.state NOT IN ('PENDING', 'READY', 'RUNNING'), true) THEN 'PENDING' WHEN EXISTS (SELECT 1 FROM g WHERE a = s.state AND b = n.status) THEN n.status ELSE s.state END,
   n.event_id, s.state, n.status, CASE WHEN n.status = 'PENDING' THEN CASE WHEN s.state IN ('PENDING', 'READY', 'RUNNING') THEN 'duplicate_active' END WHEN s.state IS NULL THEN 'no_run'
    WHEN NOT EXISTS (SELECT 1 FROM g WHERE a = s.state AND b = n.status) THEN 'illegal_move' END FROM s JOIN n ON n.project_id = s.project_id AND n.rn = s.rn + 1)
SELECT project_id, event_id, from_status, to_status, reason IS NULL AS accepted, reason FROM s WHERE rn > 0""",
)
def stream_run_machine(t):
    """Run events through the state machine; refused moves come out with their reason."""
    N.use_rocksdb(t.spark)
    events = _landed_events(t, lambda df: df.select("project_id", "event_id", "ts", "run_id", "status"))
    out = N.drain(U.run_machine(events, ANY_ORDER), "machine")
    return out.select("project_id", "event_id", "from_status", "to_status", "accepted", "reason")


@query(
    "stream_reservations",
    "ST-03 W-08",
    f"""WITH {BUDGET_SQL} SELECT user_id, event_id, reserved_total, 'cap_reached' AS alert FROM b WHERE reserved_total > 300000
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def stream_reservations(t):
    """One alert per user when the running reservation passes the cap."""
    N.use_rocksdb(t.spark)
    rows = _landed_events(
        t,
        lambda df: df.select(
            F.col("project_id").alias("user_id"), "event_id", "ts", F.round(F.col("value") * 100).cast("long").alias("reserved")
        ),
    )
    return N.drain(U.reservation_alerts(rows, 300_000, ANY_ORDER), "alerts")


@query(
    "stream_usage_alerts",
    "ST-03",
    """SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS reserved_total, 'usage_over_reservation' AS alert FROM events
WHERE CAST(json_extract(props, '$.k') AS BIGINT) > CAST(round(value) AS BIGINT)""",
)
def stream_usage_alerts(t):
    """Usage above its reservation, as it lands."""
    path = scratch(t.spark, "usage")
    rows = t.events.select(
        "user_id",
        "event_id",
        F.round("value").cast("long").alias("reserved"),
        F.get_json_object("props", "$.k").cast("long").alias("used"),
    )
    rows.write.json(path)
    return N.drain(U.usage_alerts(N.landing(t.spark, path, rows.schema)), "usage")


@query(
    "stream_stale",
    "ST-04 J-12",
    f"""WITH {EVENT_SQL}, c AS (SELECT o_custkey AS project_id, o_orderkey AS product_id, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 40320) AS at
  FROM orders WHERE o_orderpriority = '1-URGENT'),
s AS (SELECT c.project_id, product_id, status FROM c JOIN ev ON ev.project_id = c.project_id AND ev.ts <= c.at
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT project_id, product_id, status, 'STALE' AS to_status FROM s WHERE status IN ('SUCCEEDED', 'READY', 'RUNNING', 'WAITING_REVIEW')""",
)
def stream_stale(t):
    """Landing product digests against the registered ones, judged by the run status of their time, which lands as well."""
    N.use_rocksdb(t.spark)
    path = scratch(t.spark, "products")
    digest = F.sha2(F.when(F.col("o_orderpriority") == "1-URGENT", "moved").otherwise(F.col("o_orderpriority")), 256)
    minute = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("o_orderkey") % 40_320 * 60)
    rows = t.orders.select(
        F.col("o_custkey").alias("project_id"), F.col("o_orderkey").alias("product_id"), digest.alias("sha256"), minute.alias("ts")
    )
    rows.repartition(5, F.xxhash64("product_id")).write.json(path)
    N.close_landing(t.spark, path, rows.schema)
    expected = t.orders.select(
        F.col("o_custkey").alias("project_id"), F.col("o_orderkey").alias("product_id"), F.sha2("o_orderpriority", 256).alias("sha256")
    )
    changes = N.landing(t.spark, path, rows.schema, max_bytes=500_000).drop("_corrupt_record")
    states = _landed_events(t, lambda df: df.select("project_id", "event_id", "ts", "status"))
    return N.drain(U.stale_marks(changes, expected, states, ANY_ORDER), "stale")


@query(
    "unobserved_reservations",
    "ST-03 X-04",
    """SELECT user_id, count(*) AS open_slots FROM events WHERE event_type = 'signup' AND NOT EXISTS (SELECT 1 FROM events e2 WHERE e2.user_id = events.user_id
  AND CAST(e2.ts AS DATE) = CAST(events.ts AS DATE) AND e2.event_type = 'purchase') GROUP BY user_id""",
)
def unobserved_reservations(t):
    """Reservations of a day that no observation followed."""
    day = F.to_date("ts").alias("day")
    reserved = t.events.where("event_type = 'signup'").select("user_id", day)
    seen = t.events.where("event_type = 'purchase'").select("user_id", day).distinct()
    return reserved.join(seen, ["user_id", "day"], "left_anti").groupBy("user_id").agg(F.count("*").alias("open_slots"))
