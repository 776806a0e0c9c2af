"""Masking QC over many genomes at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.runs import lowercase_runs
from ..operators import sequences as S
from ..operators.spread import ordinal
from ..session import materialize


def numbered_facts(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column) -> DataFrame:
    """Residue-free facts of each record with its position in the delivery; the records are read once."""
    return ordinal(materialize(S.mask_facts(df, [*keys, *order]), "facts"), keys, order, bucket)


def masking_report(
    before: DataFrame, after: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column
) -> DataFrame:
    """Profile, gap rule, before/after check and interval counts of each delivery in one row.

    Both sides: ``keys, id, seq`` and the ``order`` columns that give file order. Each side is read once: what the
    report needs of a record, its runs included, is stored without its residues.
    """
    facts = S.mask_facts(after.withColumn("runs", lowercase_runs("seq")), [*keys, *order, "runs"])
    facts = materialize(facts, "facts")
    rule = facts.groupBy(*keys).agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum("len"), F.lit(0)).alias("all_n"),
        F.coalesce(F.sum("soft_n"), F.lit(0)).alias("soft_n"),
        F.coalesce(F.sum("gap_n"), F.lit(0)).alias("gap_n"),
    )
    outcome = S.softmask_outcome(F.col("all_n"), F.col("soft_n"), F.col("gap_n"))
    rule = rule.select(*keys, "records", outcome.alias("outcome"))
    sides = [numbered_facts(before, keys, order, bucket), ordinal(facts.drop("runs"), keys, order, bucket)]
    qc = S.mask_qc(*sides, keys).select(*keys, "status", "lowercase_pct", "n_pct", "total")
    width = F.col("end") - F.col("start") + 1
    intervals = (
        facts.select(*keys, F.inline("runs"))
        .groupBy(*keys)
        .agg(F.count("*").alias("intervals"), F.sum(width).alias("interval_bases"), F.max(width).alias("longest"))
    )
    joined = qc.join(rule, list(keys), "left").join(intervals, list(keys), "left")
    return joined.fillna(0, ["intervals", "interval_bases", "longest"])
