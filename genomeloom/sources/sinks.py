"""Writers: FASTA, GFF3, reports, and publish-once tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.residues import wrap
from ..session import materialize


def write_fasta(df: DataFrame, path: str, header: str = "header", seq: str = "seq", width: int = 80) -> None:
    """Wrapped FASTA, one file per partition, in the DataFrame's row order."""
    record = F.concat(F.lit(">"), F.col(header), F.lit("\n"), wrap(seq, width))
    df.select(record.alias("value")).write.text(path)


def fastq_record() -> Column:
    """The four lines of a read in one value."""
    return F.concat_ws("\n", F.concat(F.lit("@"), "header"), "seq", F.lit("+"), "qual")


def write_fastq(df: DataFrame, path: str) -> None:
    df.select(fastq_record().alias("value")).write.text(path)


def gff3_line(attributes: Column) -> Column:
    dot = F.lit(".")
    return F.concat_ws(
        "\t",
        "seqid",
        F.coalesce("source", dot),
        "kind",
        F.col("start").cast("string"),
        F.col("end").cast("string"),
        F.coalesce("score", dot),
        F.coalesce("strand", dot),
        F.coalesce("phase", dot),
        attributes,
    )


def write_gff3(
    features: DataFrame, path: str, line: Column, order: Sequence[str], regions: DataFrame | None = None
) -> None:
    """GFF3 in source order: version line first, then sequence-region lines, then features.

    Parts are range-partitioned on the ordering, so reading part files by name
    gives the whole file; no part is gathered in one task.
    """
    spark = features.sparkSession
    body = features.select(F.lit(2).alias("tier"), F.struct(*order).alias("ord"), line.alias("value"))
    blank = F.lit(None).cast(body.schema["ord"].dataType)
    head = spark.range(1).select(F.lit(0).alias("tier"), blank.alias("ord"), F.lit("##gff-version 3").alias("value"))
    whole = head.unionByName(body)
    if regions is not None:
        whole = whole.unionByName(
            regions.select(F.lit(1).alias("tier"), blank.alias("ord"), F.col("raw").alias("value"))
        )
    # Bounds of the ranges are sampled: the source is evaluated once, and its lines are read twice.
    (
        materialize(whole, "gff3-lines")
        .repartitionByRange("tier", "ord", "value")
        .sortWithinPartitions("tier", "ord", "value")
        .select("value")
        .write.text(path)
    )


def write_report(df: DataFrame, path: str, fmt: str = "tsv") -> None:
    """Report rows as headered TSV or as JSON lines."""
    if fmt == "tsv":
        df.write.csv(path, sep="\t", header=True, nullValue="None")
    elif fmt == "json":
        df.write.json(path)
    else:
        raise ValueError("fmt is 'tsv' or 'json'")


def _receipt(columns: Sequence[str]) -> tuple[Column, Column]:
    """Record count, and an order-free digest of 128 bits: the sums of two hashes of each row."""
    row = F.to_json(F.struct(*[f"`{c}`" for c in sorted(columns)]), {"ignoreNullFields": "false"})
    sums = [F.sum(F.xxhash64(*seed, row).cast("decimal(38,0)")).cast("string") for seed in ((), (F.lit(1),))]
    return F.count(F.lit(1)).alias("rows"), F.concat_ws("/", *sums).alias("digest")


def provenance(df: DataFrame) -> DataFrame:
    """One row: record count and an order-free digest of the content."""
    return df.agg(*_receipt(df.columns))


def publish(df: DataFrame, path: str) -> dict:
    """Write once: staging, re-read check, then rename. An existing target is refused.

    What is written is counted and digested on its way, so the input is computed once.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(f"refusing to overwrite {path}")
    # A name of its own: what a failed run left behind does not refuse the next.
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, *_receipt(df.columns)).write.mode("errorifexists").parquet(staging)
    made = provenance(spark.read.schema(df.schema).parquet(staging)).first().asDict()
    if made != seen.get:
        raise ValueError(f"staged copy differs: {made} != {seen.get}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        raise OSError(f"could not publish {path}")
    return made
