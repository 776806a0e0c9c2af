"""Silent-gap rules as typed predicates, exact-field gates, worst verdict per delivery."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import residue_outcome
from .sequences import softmask_outcome

# Verdict order, and what the three data rules conclude when they find a gap.
VERDICT_RANK = {"pass": 0, "warn": 1, "rollback": 2, "block": 3}
DATA_RULES = {
    "PIT-004": ("block", "protein_internal_ambiguity"),
    "PIT-005": ("rollback", "noncoding_residue"),
    "PIT-006": ("rollback", "masking_mode_error"),
}


@dataclass(frozen=True)
class Rule:
    """``ready`` false (or null) means the input is not there: manual, never a gap."""

    ident: str
    severity: str
    ready: Column
    gap: Column

    def outcome(self) -> Column:
        return (
            F.when(~F.coalesce(self.ready, F.lit(False)), F.lit("manual"))
            .when(F.coalesce(self.gap, F.lit(False)), F.lit("gap"))
            .otherwise(F.lit("ok"))
        )


def standard_rules() -> list[Rule]:
    """The nine rules over a delivery profile table.

    Columns used: ``library_dir, library_file, intron_support, completeness_version,
    ambiguous_proteins, gene_total, gene_coding, mask_total, mask_lower, mask_gap,
    thread_budget, cores, names_one_sided``. Null means "not provided".
    """
    c = F.col
    mask = softmask_outcome(c("mask_total"), c("mask_lower"), c("mask_gap"))
    affected = c("completeness_version").isin("6.1.0") | c("completeness_version").startswith("6.0")
    return [
        Rule("PIT-001", "warning", c("library_dir").isNotNull(), c("library_file").isNull()),
        Rule("PIT-002", "warning", c("intron_support").isNotNull(), c("intron_support").isin("1.0", "1")),
        # An unaffected version still has to be looked at by a person.
        Rule("PIT-003", "warning", affected, affected),
        Rule("PIT-004", "warning", c("ambiguous_proteins").isNotNull(), c("ambiguous_proteins") > 0),
        Rule("PIT-005", "warning", c("gene_total").isNotNull(), residue_outcome(c("gene_total"), c("gene_coding")) == "gap"),
        Rule("PIT-006", "critical", c("mask_total").isNotNull() & (mask != "manual"), mask.startswith("gap")),
        Rule(
            "PIT-007", "warning", c("thread_budget").isNotNull() & c("cores").isNotNull(), c("thread_budget") >= c("cores")
        ),
        Rule("PIT-008", "warning", c("names_one_sided").isNotNull(), c("names_one_sided") > 0),
        Rule("PIT-009", "warning", F.lit(False), F.lit(False)),
    ]


def run_rules(profiles: DataFrame, keys: Sequence[str], rules: Sequence[Rule] | None = None) -> DataFrame:
    """``keys, rule, severity, outcome``: all rules in one pass over the profile rows."""
    rules = list(rules) if rules is not None else standard_rules()
    cells = [
        F.struct(F.lit(r.ident).alias("rule"), F.lit(r.severity).alias("severity"), r.outcome().alias("outcome"))
        for r in rules
    ]
    return profiles.select(*keys, F.explode(F.array(*cells)).alias("r")).select(*keys, "r.*")


def verdict_rank(col: Column) -> Column:
    out = F.lit(-1)
    for name, rank in VERDICT_RANK.items():
        out = F.when(col == name, rank).otherwise(out)
    return out


def worst_verdict(verdicts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Worst ``verdict`` per key with its ``root_cause``; equal verdicts resolve by the smaller cause."""
    pick = F.min_by(F.struct("verdict", "root_cause"), F.struct((-verdict_rank(F.col("verdict"))).alias("r"), F.col("root_cause")))
    return verdicts.groupBy(*keys).agg(pick.alias("w")).select(*keys, "w.verdict", "w.root_cause")


def delivery_verdicts(outcomes: DataFrame, band_status: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rule outcomes and band statuses folded to one verdict; nothing applicable means ``not_covered``.

    Only the three data rules conclude anything; a manual rule covers nothing, and
    an out-of-range band warns without naming a cause. A metric without band or without value says nothing.
    """
    judged = outcomes.where(F.col("rule").isin(*DATA_RULES) & F.col("outcome").isin("gap", "ok"))
    verdict, cause = F.lit("pass"), F.lit("none")
    for rule, (v, root) in DATA_RULES.items():
        hit = (F.col("rule") == rule) & (F.col("outcome") == "gap")
        verdict, cause = F.when(hit, F.lit(v)).otherwise(verdict), F.when(hit, F.lit(root)).otherwise(cause)
    by_rule = judged.select(*keys, verdict.alias("verdict"), cause.alias("root_cause"))
    by_band = band_status.where(F.col("status").isin("within", "out_of_range")).select(
        *keys,
        F.when(F.col("status") == "out_of_range", F.lit("warn")).otherwise(F.lit("pass")).alias("verdict"),
        F.lit("none").alias("root_cause"),
    )
    worst = worst_verdict(by_rule.unionByName(by_band), keys)
    everyone = outcomes.select(*keys).distinct()
    return everyone.join(worst, list(keys), "left").withColumn(
        "status", F.when(F.col("verdict").isNull(), F.lit("not_covered")).otherwise(F.lit("ok"))
    )


def completeness_gate(complete_pct: Column, floor: float = 95.0) -> Column:
    """Below the floor stops; an unreadable summary is manual."""
    return (
        F.when(complete_pct.isNull(), F.lit("manual"))
        .when(complete_pct < floor, F.lit("stop"))
        .otherwise(F.lit("ok"))
    )


def alignment_advice(rate: Column, floor: float = 50.0) -> Column:
    """Alignment rate only advises; a low value never stops a stage."""
    return F.when(rate.isNull(), F.lit("unparsed")).when(rate < floor, F.lit("look_first")).otherwise(F.lit("ok"))
