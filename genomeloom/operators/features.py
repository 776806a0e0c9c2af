"""Feature graph: coding genes, censuses, links, longest isoforms, gene blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .spread import running_sums

# Feature kinds the graph knows.
TRANSCRIPTS = ("mRNA", "transcript")
LEAVES = ("exon", "CDS", "intron", "start_codon", "stop_codon")
UTRS = ("five_prime_UTR", "three_prime_UTR", "5UTR", "3UTR", "UTR")
KINDS = ("gene", *TRANSCRIPTS, *LEAVES, *UTRS)


def feature_census(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    return features.groupBy(*keys, "kind").agg(F.count("*").alias("n"))


def transcripts(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, transcript, gene`` (first parent); the gene may be null."""
    rows = features.where(F.col("kind").isin(*TRANSCRIPTS) & F.col("fid").isNotNull())
    return rows.select(*keys, F.col("fid").alias("transcript"), F.get("parents", F.lit(0)).alias("gene"))


def leaf_parents(features: DataFrame, keys: Sequence[str], kinds: Sequence[str] = ("CDS",)) -> DataFrame:
    """Distinct transcript ids the leaves of a kind point at; repeats merge before the shuffle."""
    rows = features.where(F.col("kind").isin(*kinds))
    return rows.select(*keys, F.explode("parents").alias("transcript")).distinct()


def coding_genes(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, gene, coding_transcripts``: genes reached from a CDS through its transcript.

    Two equi-joins, whatever the row order of the file; transcripts without a gene do not count.
    """
    tx = transcripts(features, keys)
    linked = tx.join(leaf_parents(features, keys), [*keys, "transcript"], "left_semi")
    return (
        linked.where(F.col("gene").isNotNull())
        .groupBy(*keys, "gene")
        .agg(F.count_distinct("transcript").alias("coding_transcripts"))
    )


def gene_model_summary(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Loci, coding and non-coding genes, CDS and exon rows, transcripts per coding gene.

    Row counts are one pass. A second one reads the rows that say something of a gene: what they know is merged by
    transcript, then by gene, then by delivery. A locus is a gene row's id or the parent of a transcript without
    id; a gene is coding if a CDS names a transcript of it.
    """
    kind, fid, first = F.col("kind"), F.col("fid"), F.get("parents", F.lit(0))
    is_tx = kind.isin(*TRANSCRIPTS)
    counts = features.groupBy(*keys).agg(
        F.count_if(kind == "CDS").alias("cds_features"),
        F.count_if(kind == "exon").alias("exon_features"),
        F.count_if(is_tx).alias("transcripts"),
    )
    telling = features.where(is_tx | kind.isin("gene", "CDS"))
    # A CDS speaks of each of its parents, every other row of one thing.
    about = F.when(kind == "CDS", F.col("parents")).otherwise(F.array(F.when(is_tx, fid)))
    rows = telling.select(*keys, "kind", "fid", first.alias("first"), F.explode(about).alias("transcript"))
    gene = F.when(kind == "gene", fid).when(is_tx, F.col("first"))
    known = (
        rows.select(*keys, "transcript", gene.alias("gene"), (kind == "CDS").alias("coded"))
        .where(F.col("transcript").isNotNull() | F.col("gene").isNotNull())
        .groupBy(*keys, "transcript", "gene")
        .agg(F.bool_or("coded").alias("coded"))
    )
    # Loci have no transcript and need nothing of each other: they are spread by gene.
    own = F.when(F.col("transcript").isNull(), F.col("gene"))
    coded = F.bool_or("coded").over(Window.partitionBy(*keys, "transcript", own))
    # Rows without transcript are loci; what only CDS rows say of a transcript has done its work and goes.
    known = known.withColumn("coded", coded & F.col("transcript").isNotNull()).where(F.col("gene").isNotNull())
    genes = known.groupBy(*keys, "gene").agg(
        F.bool_or(F.col("transcript").isNull()).alias("locus"), F.bool_or("coded").alias("coded")
    )
    genes = genes.groupBy(*keys).agg(
        F.count_if("locus").alias("gff_gene_loci"), F.count_if("coded").alias("coding_genes")
    )
    out = counts.join(genes, list(keys), "left").fillna(0, ["gff_gene_loci", "coding_genes"])
    return out.withColumns(
        {
            "noncoding_genes": F.greatest(F.col("gff_gene_loci") - F.col("coding_genes"), F.lit(0).cast("long")),
            "isoforms_per_gene": F.round(
                F.try_divide(F.col("transcripts").cast("double"), F.col("coding_genes").cast("double")), 3
            ),
        }
    ).drop("transcripts")


def residue_outcome(genes: Column, coding: Column) -> Column:
    """Gap where gene rows exceed 1.05 times the genes that reach a CDS."""
    return F.when((coding > 0) & (genes > coding * 1.05), F.lit("gap")).otherwise(F.lit("ok"))


def coding_residue_rule(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    genes = features.groupBy(*keys).agg(F.count_if(F.col("kind") == "gene").alias("gene_total"))
    coding = coding_genes(features, keys).groupBy(*keys).agg(F.count("*").alias("gene_with_coding_transcript"))
    out = genes.join(coding, list(keys), "left").fillna(0, ["gene_with_coding_transcript"])
    return out.withColumn("outcome", residue_outcome(F.col("gene_total"), F.col("gene_with_coding_transcript")))


def dangling_parents(features: DataFrame, keys: Sequence[str], counted: bool = False) -> DataFrame:
    """Unresolved references: ``keys, kind, child, parent, reason``.

    ``counted``: one row with ``n`` for all children of a kind instead; they are counted before they meet their parent.
    """
    links = features.select(
        *keys, "kind", F.col("fid").alias("child"), F.explode("parents").alias("parent")
    )
    if counted:
        links = links.groupBy(*keys, "kind", "parent").agg(F.count("*").alias("n"))
    ids = features.where(F.col("fid").isNotNull()).groupBy(*keys, F.col("fid").alias("parent")).agg(
        F.bool_or(F.col("kind") == "gene").alias("is_gene"),
        F.bool_or(F.col("kind").isin(*TRANSCRIPTS)).alias("is_tx"),
    )
    seen = links.join(ids, [*keys, "parent"], "left")
    reason = (
        F.when(F.col("is_gene").isNull(), F.lit("unknown_parent"))
        .when(F.col("kind").isin(*LEAVES) & ~F.col("is_tx"), F.lit("leaf_parent_not_transcript"))
        .when(F.col("kind").isin(*TRANSCRIPTS) & ~F.col("is_gene"), F.lit("transcript_parent_not_gene"))
    )
    return (
        seen.withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(*keys, "kind", *([] if counted else ["child"]), "parent", "reason", *(["n"] if counted else []))
    )


def ancestors(features: DataFrame, keys: Sequence[str], stop_kind: str = "gene") -> DataFrame:
    """Nearest ancestor of ``stop_kind`` for every leaf link: ``keys, child, parent, ancestor, reason``.

    Inner nodes climb by pointer jumping, each round twice as far as the one before, until none can climb on: any
    depth is reached in logarithmically many rounds, each stored once. Leaves, the bulk of the rows, join once
    at the end. ``reason`` tells why an ancestor is null: ``unknown_parent``, ``no_ancestor``, or ``cycle``.
    """
    nodes = features.where(F.col("fid").isNotNull() & ~F.col("kind").isin(*LEAVES))
    hop = nodes.select(
        *keys,
        F.col("fid").alias("node"),
        F.when(F.col("kind") == stop_kind, F.col("fid")).alias("ancestor"),
        F.explode_outer("parents").alias("up"),
    )
    climbing = F.col("ancestor").isNull() & F.col("up").isNotNull()
    hop = materialize(hop, "climb")
    # A chain without a circle is shorter than the number of nodes.
    for _ in range(hop.count().bit_length() + 1):
        if hop.where(climbing).isEmpty():
            break
        above = hop.select(
            *keys, F.col("node").alias("up"), F.col("ancestor").alias("a2"), F.col("up").alias("u2")
        )
        moved = hop.where(climbing).join(above, [*keys, "up"], "left").select(
            *keys, "node", F.col("a2").alias("ancestor"), F.when(F.col("a2").isNull(), F.col("u2")).alias("up")
        )
        hop = materialize(hop.where(~climbing).unionByName(moved.distinct()), "climb")
    found = hop.select(*keys, F.col("node").alias("parent"), "ancestor", climbing.alias("__open")).distinct()
    links = features.where(F.col("kind").isin(*LEAVES)).select(
        *keys, F.col("fid").alias("child"), F.explode("parents").alias("parent")
    )
    reason = (
        F.when(F.col("ancestor").isNotNull(), F.lit(None).cast("string"))
        .when(F.col("__open").isNull(), F.lit("unknown_parent"))
        .when(F.col("__open"), F.lit("cycle"))
        .otherwise(F.lit("no_ancestor"))
    )
    return links.join(found, [*keys, "parent"], "left").select(
        *keys, "child", "parent", "ancestor", reason.alias("reason")
    )


def longest_per_gene(models: DataFrame, keys: Sequence[str], gene: str, ident: str, length: str) -> DataFrame:
    """Longest model of each gene, equal lengths by smallest id; a partial aggregate per gene."""
    kept = [c for c in models.columns if c not in (*keys, gene)]
    pick = F.min_by(F.struct(*kept), F.struct((-F.col(length)).alias("l"), F.col(ident).alias("i")))
    return models.groupBy(*keys, gene).agg(pick.alias("b")).select(*keys, gene, *[F.col(f"b.{c}").alias(c) for c in kept])


def gene_blocks(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    skip: int = 0,
    limit: int | None = None,
    full_source: bool = False,
) -> DataFrame:
    """Rows from one gene row up to the next, numbered from 1 per source.

    The last block of a possibly truncated source is left out unless
    ``full_source``. ``skip`` and ``limit`` choose blocks by number.
    """
    opened = running_sums(rows, keys, order, bucket, {"gene_block": (F.col("kind") == "gene").cast("long")})
    inside = opened.where(F.col("gene_block") > 0)
    if not full_source:
        last = rows.groupBy(*keys).agg(F.count_if(F.col("kind") == "gene").alias("last_block"))
        inside = inside.join(last, list(keys)).where(F.col("gene_block") < F.col("last_block")).drop("last_block")
    inside = inside.where(F.col("gene_block") > skip)
    if limit is not None:
        inside = inside.where(F.col("gene_block") <= skip + limit)
    return inside


def gtf_gene_summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unique gene ids, identifier formats, gene rows and rows without an id."""
    base = rows.groupBy(*keys).agg(
        F.count_if(F.col("kind") == "gene").alias("gene_feature_records"),
        F.count_if(F.col("gene_id").isNull() & F.col("problem").isNull()).alias("rows_without_gene_id"),
        F.count_if(F.col("problem").isNotNull()).alias("problem_rows"),
        F.array_join(F.array_sort(F.collect_set("format")), ";").alias("gene_id_formats"),
    )
    unique = (
        rows.where(F.col("gene_id").isNotNull())
        .select(*keys, "gene_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("unique_gene_ids"))
    )
    return base.join(unique, list(keys), "left").fillna(0, ["unique_gene_ids"])


def protein_links(features: DataFrame, proteins: DataFrame, keys: Sequence[str], attribute: str = "protein_id") -> DataFrame:
    """CDS protein ids against protein records, both directions: one count row per delivery."""
    linked = (
        features.where(F.col("kind") == "CDS")
        .select(*keys, F.col("attrs")[attribute].alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
        .withColumn("in_cds", F.lit(True))
    )
    present = proteins.select(*keys, "id").distinct().withColumn("in_set", F.lit(True))
    both = linked.join(present, [*keys, "id"], "full_outer")
    return both.groupBy(*keys).agg(
        F.count_if(F.col("in_cds") & F.col("in_set")).alias("linked"),
        F.count_if(F.col("in_cds") & F.col("in_set").isNull()).alias("cds_protein_ids_without_sequence"),
        F.count_if(F.col("in_set") & F.col("in_cds").isNull()).alias("proteins_without_cds_id"),
    )


def check_preserved(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gene rows of two stages side by side."""
    a = before.where(F.col("kind") == "gene").groupBy(*keys).agg(F.count("*").alias("genes_before"))
    b = after.where(F.col("kind") == "gene").groupBy(*keys).agg(F.count("*").alias("genes_after"))
    out = a.join(b, list(keys), "full_outer").fillna(0, ["genes_before", "genes_after"])
    return out.withColumns(
        {
            "lost": F.col("genes_before") - F.col("genes_after"),
            "preserved": F.col("genes_before") == F.col("genes_after"),
        }
    )


def compare_deliveries(baseline: DataFrame, delivery: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, metric, value`` tables of two model sets with the change of each metric."""
    a = baseline.select(*keys, "metric", F.col("value").alias("baseline"))
    b = delivery.select(*keys, "metric", F.col("value").alias("delivery"))
    return a.join(b, [*keys, "metric"], "full_outer").withColumn("delta", F.col("delivery") - F.col("baseline"))
