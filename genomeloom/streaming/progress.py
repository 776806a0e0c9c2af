"""Live progress of repeated observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scoring import ARM, SLOT


def of_plan(records: DataFrame, plan: str | None) -> DataFrame:
    """Observations that were made for ``plan`` (None: for any)."""
    own = F.lit(True) if plan is None else F.coalesce(F.col("plan_sha256") == plan, F.lit(False))
    return records.where(F.col("_corrupt_record").isNull() & (F.col("record_type") == "observation") & own)


def accepted_slots(records: DataFrame, plan: str | None = None) -> DataFrame:
    """First observation of every slot under ``plan``; later ones are dropped by the state store.

    The state is one key per planned slot, so the plan bounds it.
    """
    good = of_plan(records, plan)
    return good.select(*SLOT, "status").dropDuplicates(SLOT)


def received_lines(records: DataFrame, plan: str | None = None) -> DataFrame:
    """Every line with what it is: observation, one of another plan, other record, or unreadable."""
    kind = F.when(F.col("_corrupt_record").isNotNull(), F.lit("unreadable")).otherwise(F.col("record_type"))
    if plan is not None:
        foreign = (F.col("record_type") == "observation") & ~F.coalesce(F.col("plan_sha256") == plan, F.lit(False))
        kind = F.when(F.col("_corrupt_record").isNull() & foreign, F.lit("other_plan")).otherwise(kind)
    return records.select(*ARM, kind.alias("kind"))


def planned_slots(cases: DataFrame, arms: DataFrame, repetitions: int) -> DataFrame:
    """Slots per arm (``group, model, planned``): every case of the plan in every repetition."""
    size = cases.agg((F.count("*") * repetitions).alias("planned"))
    return arms.crossJoin(F.broadcast(size))  # one row


def progress(accepted: DataFrame, received: DataFrame, planned: DataFrame) -> DataFrame:
    """Planned, completed, status counts and rejected duplicates per planned arm, from the tables so far."""
    done = accepted.groupBy(*ARM).agg(
        F.count("*").alias("completed"),
        *[F.count_if(F.col("status") == s).alias(f"status_{s}") for s in ("ok", "api_error", "parse_error")],
    )
    seen = received.where("kind = 'observation'").groupBy(*ARM).agg(F.count("*").alias("received"))
    counts = ("completed", "status_ok", "status_api_error", "status_parse_error", "received")
    return planned.join(done, ARM, "left").join(seen, ARM, "left").fillna(0, list(counts)).select(
        *ARM,
        F.col("planned").cast("long").alias("planned"),
        *counts[:-1],
        (F.col("received") - F.col("completed")).alias("duplicates_rejected"),
    )


def running_counts(records: DataFrame) -> DataFrame:
    """Streaming counts per arm and status for update-mode sinks."""
    return accepted_slots(records).groupBy(*ARM, "status").agg(F.count("*").alias("n"))
