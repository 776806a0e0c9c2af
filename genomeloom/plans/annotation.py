"""Functional annotation integration: hits and domains to the seven-flag table and its reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import hits as H
from ..operators.sequences import protein_flags


@dataclass(frozen=True)
class Integration:
    quarantined: DataFrame
    best: DataFrame
    hit_report: DataFrame
    flags: DataFrame
    statistics: DataFrame
    overlap: DataFrame
    checks: DataFrame


def integrate(
    proteins: DataFrame, hits: DataFrame, annotations: DataFrame, domains: DataFrame, qcov: float = 50.0
) -> Integration:
    """Lazy plans for every table of the functional stage.

    ``proteins``: ``id, seq``; ``hits``: hit columns plus ``source``; ``annotations``:
    ``source, id, annot``; ``domains``: ``protein, domains, terms``. Proteins with
    interior ambiguity are listed for quarantine and stay in the denominator.
    """
    quarantined = (
        protein_flags(proteins).where(F.col("internal_ambiguity") > 0).select("id", "internal_ambiguity")
    )
    kept = H.filter_hits(hits, qcov)
    best = H.best_hit(kept, ("source", "qseqid"), ["sseqid", "bitscore", "evalue", "qcovhsp", "scovhsp"])
    near = H.near_top(kept.where(F.col("source").isin("KEGG", "KOG")), ("source", "qseqid"))
    table = annotations.select("source", F.col("id").alias("sseqid"), "annot", F.lit(True).alias("found"))
    best = (
        # Merged: the optimizer takes an exploded table for as small as its files and would broadcast it.
        best.join(table.hint("merge"), ["source", "sseqid"], "left")
        .join(near.select("source", "qseqid", "ambiguous"), ["source", "qseqid"], "left")
        .withColumns(
            {
                "annotated": F.coalesce("found", F.lit(False)),
                "annot": F.coalesce("annot", F.lit("")),
                "ambiguous_near_top": F.coalesce("ambiguous", F.lit(False)),
            }
        )
        .drop("found", "ambiguous")
    )
    filtered = kept.groupBy("source").agg(F.count("*").alias("filtered_rows"))
    queries_hit = best.groupBy("source").agg(
        F.count("*").alias("filtered_queries"), F.count_if("ambiguous_near_top").alias("ambiguous_queries")
    )
    report = filtered.join(queries_hit, "source").join(H.missing_annotations(best, ["source"]), "source")
    queries = proteins.select(F.col("id").alias("query"))
    flags = H.flag_matrix(queries, kept, domains)
    return Integration(
        quarantined,
        best,
        report,
        flags,
        H.annotation_stats(flags),
        H.annotation_overlap(flags),
        H.validate_integration(flags, queries),
    )
