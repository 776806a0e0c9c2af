"""GFF3 and GTF scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attributes as A
from ..session import bounded, materialize
from .sequences import read_lines

FIELDS = ["seqid", "source", "kind", "start", "end", "score", "strand", "phase", "attributes"]


def _before_embedded_fasta(lines: DataFrame) -> DataFrame:
    """Drop everything from a ``##FASTA`` line on, per file."""
    mark = (
        lines.where(F.col("value").startswith("##FASTA"))
        .groupBy("file")
        .agg(F.min(F.struct("block", "pos")).alias("stop"))
    )
    # One row per file with the directive; the lines stay where they are unless very many files have one.
    return (
        lines.join(bounded(materialize(mark, "stops")), "file", "left")
        .where(F.col("stop").isNull() | (F.struct("block", "pos") < F.col("stop")))
        .drop("stop")
    )


def _fields(lines: DataFrame) -> DataFrame:
    rows = _before_embedded_fasta(lines).where(
        ~F.col("value").startswith("#") & ~F.col("value").rlike(r"^\s*$")
    )
    return rows.withColumn("f", F.split("value", "\t"))


def row_reason(fields: Column) -> Column:
    """Why a strict scan rejects the row; null if it is fine."""
    start, end = fields[3].try_cast("long"), fields[4].try_cast("long")
    return (
        F.when(F.size(fields) != 9, F.lit("width"))
        .when(A.bad_attributes(fields[8]), F.lit("attributes"))
        .when(start.isNull() | end.isNull() | (start < 1) | (end < start), F.lit("coordinates"))
    )


def _parsed(rows: DataFrame) -> DataFrame:
    g = F.when(F.size("f") == 9, F.col("f"))
    rows = rows.withColumn("g", g).withColumn("attrs", A.attribute_map(F.coalesce(F.col("g")[8], F.lit(""))))
    return rows.select(
        "file",
        "block",
        "pos",
        F.col("g")[0].alias("seqid"),
        F.col("g")[1].alias("source"),
        F.col("g")[2].alias("kind"),
        F.col("g")[3].try_cast("long").alias("start"),
        F.col("g")[4].try_cast("long").alias("end"),
        F.col("g")[5].alias("score"),
        F.col("g")[6].alias("strand"),
        F.col("g")[7].alias("phase"),
        "attrs",
        A.decode(F.col("attrs")["ID"]).alias("fid"),
        A.parent_list(F.col("attrs")).alias("parents"),
        F.col("value").alias("raw"),
        *(["reason"] if "reason" in rows.columns else []),
    )


def scan_gff3(spark: SparkSession, path) -> DataFrame:
    """Every feature row with the reason a strict scan would reject it."""
    return _parsed(_fields(read_lines(spark, path)).withColumn("reason", row_reason(F.col("f"))))


def read_gff3(spark: SparkSession, path, strict: bool = False) -> DataFrame:
    """Nine-column features. Lenient: rows of another width are skipped. Strict: any defect raises.

    Every operator scans features more than once: keep them as Parquet after the first read.
    """
    if not strict:
        return _parsed(_fields(read_lines(spark, path)).where(F.size("f") == 9))
    rows = scan_gff3(spark, path)
    bad = rows.where(F.col("reason").isNotNull()).select("file", "reason", "raw").limit(5).collect()
    if bad:
        raise ValueError("GFF3 rejected: " + "; ".join(f"{r.reason}: {r.raw[:80]}" for r in bad))
    return rows.drop("reason")


def read_regions(spark: SparkSession, path) -> DataFrame:
    """``##sequence-region`` directives: ``file, seqid, start, end, raw``."""
    lines = _before_embedded_fasta(read_lines(spark, path))
    parts = F.split(F.rtrim("value"), r"\s+")
    return lines.where(F.col("value").startswith("##sequence-region")).select(
        "file",
        "block",
        "pos",
        F.get(parts, F.lit(1)).alias("seqid"),
        F.get(parts, F.lit(2)).try_cast("long").alias("start"),
        F.get(parts, F.lit(3)).try_cast("long").alias("end"),
        F.rtrim("value").alias("raw"),
    )


def read_gtf(spark: SparkSession, path) -> DataFrame:
    """Nine-column GTF rows with the gene identifier and how it was written."""
    rows = _fields(read_lines(spark, path)).where(F.size("f") == 9)
    rows = rows.withColumn("g", A.gtf_gene_id(F.col("f")[2], F.col("f")[8]))
    return rows.select(
        "file",
        "block",
        "pos",
        F.col("f")[0].alias("seqid"),
        F.col("f")[2].alias("kind"),
        F.col("f")[3].try_cast("long").alias("start"),
        F.col("f")[4].try_cast("long").alias("end"),
        F.col("f")[8].alias("attributes"),
        "g.gene_id",
        "g.format",
        "g.problem",
    )
