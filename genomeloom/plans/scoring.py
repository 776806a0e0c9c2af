"""Repeated-observation scoring from admitted attempts to panels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import scoring as P
from ..session import materialize


@dataclass(frozen=True)
class Scored:
    facts: DataFrame
    results: DataFrame


def score(
    cases: DataFrame, arms: Sequence[tuple[str, str]], observations: DataFrame, repetitions: int = 3, minimum: int = 2
) -> Scored:
    """Grid, slot facts and case results: every panel and hypothesis reads them again, so they are written, once and together.

    Observations and cases meet by case, where the plan fixes how many there are of each; the slots of a case never leave
    its task. A stored row is an arm's case with its slots, and facts are those slots again.
    """
    by_case = observations.repartition("case_id")
    facts = P.slot_facts(P.complete_grid(cases.repartition("case_id"), arms, by_case, repetitions))
    if "code" in facts.columns:
        facts = facts.withColumn("code", F.when(F.col("valid"), F.col("code")))
    # The two sides are dealt by one key of the join; they need no other exchange. Elsewhere a hot key could not be split then.
    conf, name = observations.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        results = materialize(P.case_results(facts, cases.columns, minimum, slots=True), "case-results")
    finally:
        conf.set(name, before)
    # What a slot says for itself replaces what its case says under the same name.
    own = [f.name for f in results.schema["slots"].dataType.elementType.fields]
    shared = [*P.ARM, "case_id", *[c for c in cases.columns if c != "case_id"]]
    return Scored(results.select(*shared, F.explode("slots").alias("s")).select(*shared, *[f"s.{c}" for c in own]), results.drop("slots"))


def panel_by_set(scored: Scored, dims: Sequence[str] = P.DIMENSIONS) -> DataFrame:
    """Extended panel of every analysis set a case belongs to."""
    return P.panels(
        P.in_sets(scored.results), P.in_sets(scored.facts), dims=dims, keys=[*P.ARM, "case_set"], ext=True
    )
