"""Coding-only export of gene models and the longest-isoform delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import (
    KINDS,
    LEAVES,
    TRANSCRIPTS,
    check_preserved,
    dangling_parents,
    leaf_parents,
    longest_per_gene,
)


def graph_problems(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reasons a delivery may not be exported: ``keys, reason, n``."""
    has_parent = F.size("parents") > 0
    in_graph = (F.col("kind") == "gene") | F.col("kind").isin(*TRANSCRIPTS)
    row_reasons = F.array_compact(
        F.array(
            F.when(~F.col("kind").isin(*KINDS), F.lit("unknown_kind")),
            F.when(in_graph & F.coalesce("fid", F.lit("")).isin(""), F.lit("missing_id")),
            F.when((F.col("kind") == "gene") & has_parent, F.lit("gene_with_parent")),
            F.when(F.col("kind").isin(*TRANSCRIPTS) & (F.size("parents") != 1), F.lit("transcript_parent_count")),
            F.when(F.col("kind").isin(*LEAVES) & ~has_parent, F.lit("leaf_without_parent")),
        )
    )
    single = features.select(*keys, F.explode(row_reasons).alias("reason"))
    repeated = (
        features.where(in_graph & F.col("fid").isNotNull())
        .groupBy(*keys, "fid")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(*keys, F.lit("repeated_id").alias("reason"))
    )
    graph = features.where(F.col("kind").isin(*TRANSCRIPTS, *LEAVES))
    known = features.where(F.col("fid").isNotNull())
    unresolved = dangling_parents(graph.unionByName(known.where(F.col("kind") == "gene")), keys).select(
        *keys,
        F.when(F.col("kind").isin(*LEAVES), F.lit("leaf_parent_unresolved"))
        .otherwise(F.lit("transcript_parent_unresolved"))
        .alias("reason"),
    )
    plan = coding_plan(features, keys)
    crowded = (
        plan.groupBy(*keys, "gene").agg(F.count("*").alias("n")).where("n > 1").select(
            *keys, F.lit("several_coding_transcripts").alias("reason")
        )
    )
    no_cds = (
        features.select(*keys)
        .distinct()
        .join(leaf_parents(features, keys).select(*keys).distinct(), list(keys), "left_anti")
        .select(*keys, F.lit("no_coding_transcript").alias("reason"))
    )
    everything = single.unionByName(repeated).unionByName(unresolved).unionByName(crowded).unionByName(no_cds)
    return everything.groupBy(*keys, "reason").agg(F.count("*").alias("n"))


def coding_plan(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, transcript, gene`` of transcripts with a CDS."""
    tx = features.where(F.col("kind").isin(*TRANSCRIPTS)).select(
        *keys, F.col("fid").alias("transcript"), F.get("parents", F.lit(0)).alias("gene")
    )
    return tx.join(leaf_parents(features, keys), [*keys, "transcript"], "left_semi").distinct()


def coding_subset(features: DataFrame, keys: Sequence[str], row_id: Sequence[str]) -> DataFrame:
    """Coding branch of every delivery; shared Parent lists are cut to the kept transcripts.

    ``row_id`` identifies a feature row (file, block, pos). Only leaves with more
    than one parent are regrouped; the rest pass through a semi-join.
    """
    plan = coding_plan(features, keys)
    keep_tx = plan.select(*keys, "transcript")
    genes = features.where(F.col("kind") == "gene").join(
        plan.select(*keys, F.col("gene").alias("fid")).distinct(), [*keys, "fid"], "left_semi"
    )
    tx = features.where(F.col("kind").isin(*TRANSCRIPTS)).join(
        keep_tx.withColumnRenamed("transcript", "fid"), [*keys, "fid"], "left_semi"
    )
    rest = features.where(~(F.col("kind") == "gene") & ~F.col("kind").isin(*TRANSCRIPTS))
    lone = (
        rest.where(F.size("parents") == 1)
        .withColumn("transcript", F.col("parents")[0])
        .join(keep_tx, [*keys, "transcript"], "left_semi")
        .drop("transcript")
    )
    shared = rest.where(F.size("parents") > 1)
    trimmed = (
        shared.select(*keys, *row_id, F.posexplode("parents").alias("i", "transcript"))
        .join(keep_tx, [*keys, "transcript"], "left_semi")
        .groupBy(*keys, *row_id)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "transcript"))), lambda s: s["transcript"]).alias("kept"))
    )
    cut = shared.join(trimmed, [*keys, *row_id]).withColumn("parents", F.col("kept")).drop("kept")
    cols = features.columns
    out = genes.select(cols)
    for part in (tx, lone, cut):
        out = out.unionByName(part.select(cols))
    return out


def exclusion_report(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Kept and excluded genes and transcripts per delivery."""
    plan = coding_plan(features, keys)
    exon_tx = leaf_parents(features, keys, ("exon",)).withColumn("has_exon", F.lit(True))
    coding = plan.select(*keys, "transcript").withColumn("coding", F.lit(True))
    tx = (
        features.where(F.col("kind").isin(*TRANSCRIPTS))
        .select(*keys, F.col("fid").alias("transcript"))
        .distinct()
        .join(coding, [*keys, "transcript"], "left")
        .join(exon_tx, [*keys, "transcript"], "left")
    )
    by_tx = tx.groupBy(*keys).agg(
        F.count_if(F.col("coding")).alias("coding_transcripts"),
        F.count_if(F.col("coding").isNull()).alias("excluded_transcripts"),
        F.count_if(F.col("coding").isNull() & F.col("has_exon")).alias("excluded_transcripts_with_exons"),
    )
    genes = (
        features.where(F.col("kind") == "gene")
        .select(*keys, F.col("fid").alias("gene"))
        .distinct()
        .join(plan.select(*keys, "gene").distinct().withColumn("kept", F.lit(True)), [*keys, "gene"], "left")
        .groupBy(*keys)
        .agg(F.count_if(F.col("kept")).alias("coding_gene_ids"), F.count_if(F.col("kept").isNull()).alias("excluded_gene_ids"))
    )
    return by_tx.join(genes, list(keys), "full_outer")


def longest_delivery(models: DataFrame, keys: Sequence[str], gene: str, ident: str, length: str) -> DataFrame:
    """Longest isoform per gene with the gene-count preservation check of each delivery."""
    chosen = longest_per_gene(models, keys, gene, ident, length)
    as_gene = F.lit("gene").alias("kind")
    before = models.select(*keys, gene).distinct().select(*keys, as_gene)
    after = chosen.select(*keys, as_gene)
    summary = chosen.groupBy(*keys).agg(F.sum(length).alias("total_length"), F.max(length).alias("longest"))
    return check_preserved(before, after, keys).join(summary, list(keys), "left")
