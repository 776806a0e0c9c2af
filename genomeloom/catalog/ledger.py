"""Run-history and budget queries over the event stream table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators import reconcile as C
from .registry import query

# Event types stand for run states, by position in a run's life.
STATE_OF = {"signup": "PENDING", "view": "READY", "click": "RUNNING", "purchase": "SUCCEEDED", "error": "FAILED"}
EVENT_SQL = """ev AS (SELECT event_id, ts, user_id AS project_id, value, 'run' || (event_id // 3) AS run_id,
  CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'READY' WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status FROM events),
h AS (SELECT *, lag(status) OVER w AS prev_status, lag(run_id) OVER w AS prev_run FROM ev WINDOW w AS (PARTITION BY project_id ORDER BY ts, event_id)),
g(a, b) AS (VALUES ('PENDING', 'READY'), ('PENDING', 'BLOCKED'), ('PENDING', 'SKIPPED_NOT_APPLICABLE'), ('READY', 'RUNNING'), ('READY', 'STALE'), ('RUNNING', 'SUCCEEDED'),
  ('RUNNING', 'FAILED'), ('RUNNING', 'WAITING_REVIEW'), ('RUNNING', 'BLOCKED'), ('WAITING_REVIEW', 'READY'), ('WAITING_REVIEW', 'REJECTED'), ('WAITING_REVIEW', 'STALE'),
  ('FAILED', 'READY'), ('FAILED', 'BLOCKED'), ('REJECTED', 'READY'), ('STALE', 'READY'), ('STALE', 'SKIPPED_NOT_APPLICABLE'), ('SUCCEEDED', 'STALE'))"""

ORDER = ["ts", "event_id"]


def day():
    return F.to_date("ts")


def run_events(t):
    state = F.lit(None).cast("string")
    for event, status in STATE_OF.items():
        state = F.when(F.col("event_type") == event, status).otherwise(state)
    return t.events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("project_id"),
        "value",
        F.concat(F.lit("run"), F.floor(F.col("event_id") / 3)).alias("run_id"),
        state.alias("status"),
    )


@query("run_history", "W-07", f"WITH {EVENT_SQL} SELECT event_id, project_id, status, prev_status FROM h")
def run_history(t):
    """Every event with the status before it, day by day."""
    return L.run_history(run_events(t), ["project_id"], ORDER, "status", day()).select(
        "event_id", "project_id", "status", "prev_status"
    )


@query(
    "current_runs",
    "W-07",
    f"""WITH {EVENT_SQL} SELECT project_id, event_id, status, status IN ('PENDING', 'READY', 'RUNNING') AS active FROM ev
QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def current_runs(t):
    """Latest state per project."""
    return L.current_runs(run_events(t), ["project_id"], ORDER, "status").select("project_id", "event_id", "status", "active")


@query(
    "check_transitions",
    "J-24",
    f"""WITH {EVENT_SQL} SELECT event_id, project_id, prev_status, status, 'illegal_move' AS reason FROM h
WHERE prev_status IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g WHERE a = prev_status AND b = status)""",
)
def check_transitions(t):
    """Moves the run graph does not allow."""
    history = L.run_history(run_events(t), ["project_id"], ORDER, "status", day())
    return L.check_transitions(history, L.transition_rows(t.spark), "status").select(
        "event_id", "project_id", "prev_status", "status", "reason"
    )


@query(
    "duplicate_submissions",
    "W-07",
    f"""WITH {EVENT_SQL} SELECT event_id, project_id, run_id, prev_run, prev_status FROM h
WHERE status = 'PENDING' AND prev_status IN ('PENDING', 'READY', 'RUNNING') AND prev_run <> run_id""",
)
def duplicate_submissions(t):
    """New submissions while a run was still active."""
    found = L.duplicate_submissions(run_events(t), ["project_id"], ORDER, "status", "run_id", day())
    return found.select("event_id", "project_id", "run_id", "prev_run", "prev_status")


BUDGET_SQL = """b AS (SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS cents,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS reserved_total, count(*) OVER w AS calls FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))"""


def _trace(t):
    rows = t.events.select("event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return L.budget_trace(rows, ["user_id"], ORDER, day(), "cents", 300_000)


@query("budget_trace", "W-08", f"WITH {BUDGET_SQL} SELECT event_id, user_id, reserved_total, calls, reserved_total > 300000 AS over_cap FROM b")
def budget_trace(t):
    """Running reservations against a cap."""
    return _trace(t).select("event_id", "user_id", "reserved_total", "calls", "over_cap")


@query(
    "first_breach",
    "W-08",
    f"""WITH {BUDGET_SQL} SELECT user_id, event_id, reserved_total, calls FROM b WHERE reserved_total > 300000
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def first_breach(t):
    """First reservation over the cap per user."""
    return L.first_breach(_trace(t), ["user_id"], ORDER).select("user_id", "event_id", "reserved_total", "calls")


@query(
    "usage_over_reservation",
    "W-08 ST-03",
    """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prompt_tokens FROM events
WHERE CAST(json_extract(props, '$.k') AS BIGINT) > CAST(round(value) AS BIGINT) AND event_type <> 'error'""",
)
def usage_over_reservation(t):
    """Slots that used more than they reserved; unknown usage is no breach."""
    known = F.get_json_object("props", "$.k").cast("long")
    ledger = t.events.select(
        "event_id",
        "user_id",
        F.round("value").cast("long").alias("input_reserved"),
        F.lit(10).alias("output_reserved"),
        F.when(F.col("event_type") != "error", known).alias("prompt_tokens"),
        F.lit(None).cast("long").alias("completion_tokens"),
    )
    return L.usage_over_reservation(ledger).select("event_id", "user_id", "prompt_tokens")


BOUND_SQL = """bd AS (SELECT o_custkey AS project_id, o_orderpriority <> '1-URGENT' OR o_totalprice < 400000 AS bound FROM orders)"""


def _bound(t):
    expected = t.orders.select(
        F.col("o_custkey").alias("project_id"), "o_orderkey", F.sha2("o_orderpriority", 256).alias("sha256")
    )
    moved = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") >= 400000)
    actual = t.orders.select(
        F.col("o_custkey").alias("project_id"),
        "o_orderkey",
        F.sha2(F.when(moved, F.lit("moved")).otherwise(F.col("o_orderpriority")), 256).alias("sha256"),
    )
    return C.check_bindings(expected, actual, ["project_id", "o_orderkey"])


@query(
    "stale_products",
    "ST-04 J-12 C-10",
    f"""WITH {EVENT_SQL}, {BOUND_SQL}, l AS (SELECT project_id, status FROM ev QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY ts DESC, event_id DESC) = 1),
m AS (SELECT project_id, count(*) AS changed_inputs FROM bd WHERE NOT bound GROUP BY 1)
SELECT project_id, status, changed_inputs, 'STALE' AS to_status FROM l JOIN m USING (project_id) WHERE status IN ('SUCCEEDED', 'READY', 'RUNNING', 'WAITING_REVIEW')""",
)
def stale_products(t):
    """Projects a changed input turns stale."""
    states = L.current_runs(run_events(t), ["project_id"], ORDER, "status")
    return C.stale_products(_bound(t), states)


@query(
    "run_ledger",
    "C-10 W-07 J-24",
    f"""WITH {EVENT_SQL}, {BOUND_SQL}, l AS (SELECT project_id, status FROM ev QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY ts DESC, event_id DESC) = 1),
e AS (SELECT project_id, count(*) AS events, count(*) FILTER (prev_status IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g WHERE a = prev_status AND b = status)) AS illegal_moves,
  count(*) FILTER (status = 'PENDING' AND prev_status IN ('PENDING', 'READY', 'RUNNING') AND prev_run <> run_id) AS duplicate_submissions FROM h GROUP BY 1),
m AS (SELECT project_id, count(*) AS changed_inputs FROM bd WHERE NOT bound GROUP BY 1)
SELECT project_id, status, status IN ('PENDING', 'READY', 'RUNNING') AS active, events, illegal_moves, duplicate_submissions, coalesce(changed_inputs, 0) AS changed_inputs,
  status IN ('SUCCEEDED', 'READY', 'RUNNING', 'WAITING_REVIEW') AND coalesce(changed_inputs, 0) > 0 AS stale FROM l JOIN e USING (project_id) LEFT JOIN m USING (project_id)""",
)
def run_ledger(t):
    """Whole ledger per project."""
    return L.run_ledger(run_events(t), _bound(t), L.transition_rows(t.spark), "project_id", ORDER, "status", "run_id", day())
