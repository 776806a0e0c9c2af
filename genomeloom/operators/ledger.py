"""Run histories, transition legality, budgets and stale products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded, literal_table
from .spread import previous, running_sums, top_row

# The states of a run, its legal moves, and the states that count as active.
TRANSITIONS = {
    "PENDING": ("READY", "BLOCKED", "SKIPPED_NOT_APPLICABLE"),
    "READY": ("RUNNING", "STALE"),
    "RUNNING": ("SUCCEEDED", "FAILED", "WAITING_REVIEW", "BLOCKED"),
    "WAITING_REVIEW": ("READY", "REJECTED", "STALE"),
    "FAILED": ("READY", "BLOCKED"),
    "REJECTED": ("READY",),
    "STALE": ("READY", "SKIPPED_NOT_APPLICABLE"),
    "SUCCEEDED": ("STALE",),
    "BLOCKED": (),
    "SKIPPED_NOT_APPLICABLE": (),
}
ACTIVE = ("PENDING", "READY", "RUNNING")


def transition_rows(spark: SparkSession) -> DataFrame:
    rows = [{"from_status": a, "to_status": b} for a, targets in TRANSITIONS.items() for b in targets]
    return literal_table(spark, rows, "from_status string, to_status string")


def run_history(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], status: str, bucket: Column
) -> DataFrame:
    """Each event with the status before it; ``bucket`` keeps a long history from being one task."""
    return previous(events, keys, order, bucket, {"prev_status": F.col(status)})


def current_runs(events: DataFrame, keys: Sequence[str], order: Sequence[str], status: str) -> DataFrame:
    """Latest status per project and whether it is active; a partial aggregate, no window."""
    last = top_row(events.select(*keys, *order, status), keys, [F.col(c) for c in order])
    return last.withColumn("active", F.col(status).isin(*ACTIVE))


def check_transitions(
    history: DataFrame, transitions: DataFrame, status: str, known: Sequence[str] | None = None
) -> DataFrame:
    """History rows that break the graph, with the reason."""
    states = list(known) if known is not None else list(TRANSITIONS)
    legal = bounded(
        transitions.select(F.col("from_status").alias("prev_status"), F.col("to_status").alias(status)).withColumn(
            "legal", F.lit(True)
        )
    )
    rows = history.join(legal, ["prev_status", status], "left")
    reason = (
        F.when(~F.col(status).isin(*states), F.lit("unknown_status"))
        .when(F.col("prev_status").isNotNull() & F.col("legal").isNull(), F.lit("illegal_move"))
    )
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("legal")


def duplicate_submissions(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], status: str, run: str, bucket: Column
) -> DataFrame:
    """Submissions of a new run while the project's last run was still active."""
    seen = previous(events, keys, order, bucket, {"prev_status": F.col(status), "prev_run": F.col(run)})
    return seen.where(
        (F.col(status) == "PENDING") & F.col("prev_status").isin(*ACTIVE) & (F.col("prev_run") != F.col(run))
    )


def budget_trace(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, reserved: str, cap: float
) -> DataFrame:
    """Running reservation totals and whether the row is over the cap."""
    out = running_sums(rows, keys, order, bucket, {"reserved_total": F.col(reserved), "calls": F.lit(1).cast("long")})
    return out.withColumn("over_cap", F.round("reserved_total", 6) > cap)


def first_breach(trace: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row over the cap of each key."""
    over = trace.where("over_cap")
    kept = [c for c in trace.columns if c not in keys]
    pick = F.min_by(F.struct(*kept), F.struct(*order))
    return over.groupBy(*keys).agg(pick.alias("b")).select(*keys, *[F.col("b")[c].alias(c) for c in kept])


def usage_over_reservation(ledger: DataFrame) -> DataFrame:
    """Slots whose known usage exceeds what was reserved."""
    over_in = F.coalesce(F.col("prompt_tokens") > F.col("input_reserved"), F.lit(False))
    over_out = F.coalesce(F.col("completion_tokens") > F.col("output_reserved"), F.lit(False))
    return ledger.where(over_in | over_out)


def run_ledger(
    events: DataFrame, bound: DataFrame, transitions: DataFrame, key: str, order: Sequence[str], status: str, run: str, bucket: Column
) -> DataFrame:
    """Per project: current state, moves, illegal moves, duplicate submissions, stale inputs."""
    history = run_history(events, [key], order, status, bucket)
    moves = history.groupBy(key).agg(F.count("*").alias("events"))
    illegal = check_transitions(history, transitions, status).groupBy(key).agg(F.count("*").alias("illegal_moves"))
    doubled = (
        duplicate_submissions(events, [key], order, status, run, bucket)
        .groupBy(key)
        .agg(F.count("*").alias("duplicate_submissions"))
    )
    changed = bound.where(~F.col("bound")).groupBy(key).agg(F.count("*").alias("changed_inputs"))
    now = current_runs(events, [key], order, status).select(key, F.col(status).alias("status"), "active")
    out = now.join(moves, key)
    for part in (illegal, doubled, changed):
        out = out.join(part, key, "left")
    out = out.fillna(0, ["illegal_moves", "duplicate_submissions", "changed_inputs"])
    # States that a changed input turns stale.
    live = F.col("status").isin("SUCCEEDED", "READY", "RUNNING", "WAITING_REVIEW")
    return out.withColumn("stale", live & (F.col("changed_inputs") > 0))
