"""FASTA and FASTQ as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import residues as R
from ..operators.spread import ordinal
from ..session import bounded, materialize
from .blockgzip import read_block_gzip_lines

PLACE = ["block", "pos"]


def read_lines(spark: SparkSession, path, line_sep: str | None = None) -> DataFrame:
    """Text rows with their place: ``file``, ``block`` (split offset), ``pos`` (order inside the split).

    Files are packed into partitions by size, so only ``(block, pos)`` together
    give file order. A split is one file block at most, which bounds what any
    per-block window has to hold.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.regexp_replace("value", "\r", "").alias("value"),
    )


def page() -> Column:
    """Bucket of a line for ordered helpers: its block and, as a compressed file is one block, 65,536 lines of it."""
    return F.struct("block", F.shiftright("pos", 16).alias("page"))


def with_ordinal(df: DataFrame, out: str = "rec") -> DataFrame:
    """Dense 0-based record number in file order; needs ``file, block, pos``."""
    return ordinal(df, ["file"], PLACE, page(), out)


def _fasta_chunks(spark: SparkSession, path) -> DataFrame:
    return read_lines(spark, path, "\n>").withColumn("blank", F.col("value").rlike(r"^\s*$"))


def read_fasta(spark: SparkSession, path, strict: bool = False) -> DataFrame:
    """One row per record: ``file, block, pos, id, header, seq``; plain or gzip.

    Records are cut at newline + ``>``, which keeps one file splittable. For
    records too long for one row (whole chromosomes) use ``read_fasta_pieces``.
    """
    if strict:
        found = fasta_problems(spark, path).limit(5).collect()
        if found:
            raise ValueError("FASTA rejected: " + "; ".join(f"{r.file}: {r.reason} x{r.n}" for r in found))
    parts = F.split(F.regexp_replace("value", r"^>", ""), "\n", 2)
    return (
        _fasta_chunks(spark, path)
        .where(~F.col("blank"))
        .withColumn("parts", parts)
        .select(
            "file",
            "block",
            "pos",
            R.first_token(F.col("parts")[0]).alias("id"),
            F.col("parts")[0].alias("header"),
            F.regexp_replace(F.coalesce(F.get("parts", F.lit(1)), F.lit("")), r"\s", "").alias("seq"),
        )
    )


def fasta_problems(spark: SparkSession, path) -> DataFrame:
    """Strict-mode findings per file: ``file, reason, n``."""
    place = F.struct("block", "pos")
    head = (
        _fasta_chunks(spark, path)
        .groupBy("file")
        .agg(
            F.min_by("blank", place).alias("blank"),
            F.min_by(F.col("value").startswith(">"), place).alias("marked"),
            F.bool_and("blank").alias("empty"),
            F.count_if("blank").alias("blanks"),
        )
    )
    # A blank chunk after the first is a bare marker: no header and no residues.
    bare = head.withColumn("bare", F.col("blanks") - F.col("blank").cast("long")).where("bare > 0")
    misplaced = head.where(F.col("empty")).select("file", F.lit("no_records").alias("reason")).unionByName(
        head.where(~F.col("blank") & ~F.col("marked")).select(
            "file", F.lit("sequence_before_header").alias("reason")
        )
    )
    rows = read_fasta(spark, path)
    single = rows.select(
        "file",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("id") == "", F.lit("empty_header")),
                    F.when(F.col("seq") == "", F.lit("empty_sequence")),
                )
            )
        ).alias("reason"),
    )
    repeated = (
        rows.groupBy("file", "id")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("file", F.lit("repeated_id").alias("reason"))
    )
    counted = misplaced.unionByName(single).unionByName(repeated).withColumn("n", F.lit(1).cast("long"))
    for reason in ("empty_header", "empty_sequence"):
        counted = counted.unionByName(bare.select("file", F.lit(reason).alias("reason"), F.col("bare").alias("n")))
    return counted.groupBy("file", "reason").agg(F.sum("n").alias("n"))


def read_fasta_pieces(spark: SparkSession, path) -> DataFrame:
    """One row per sequence line: ``file, rec, id, start, bases`` (start is 1-based in the record).

    A chromosome stays many rows, spread over the blocks of its file. Lines are placed inside their page; from the page
    before they only need its number of headers, its last id, and how many bases have come since.
    """
    lines = read_lines(spark, path).where(~F.col("value").rlike(r"^\s*$"))
    is_head = F.col("value").startswith(">")
    bases = F.when(~is_head, F.regexp_replace("value", r"\s", ""))
    lines = lines.select(
        "file", page().alias("page"), "block", "pos", bases.alias("bases"),
        F.when(is_head, R.first_token(F.expr("substring(value, 2)"))).alias("head"),
    ).withColumn("len", F.coalesce(F.length("bases"), F.lit(0)).cast("long"))
    so_far = Window.partitionBy("file", "page").orderBy(*PLACE).rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumns({"heads": F.count("head").over(so_far), "run": F.sum("len").over(so_far)}).withColumns(
        {
            "own_id": F.last("head", ignorenulls=True).over(so_far),
            "own_run": F.last(F.when(F.col("head").isNotNull(), F.col("run")), ignorenulls=True).over(so_far),
        }
    )
    pages = placed.groupBy("file", "page").agg(
        F.max("heads").alias("n"),
        F.max("run").alias("total"),
        F.max_by("own_id", F.struct(*PLACE)).alias("last_id"),
        F.max("own_run").alias("last_run"),
    )
    before = Window.partitionBy("file").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.withColumn("past", F.coalesce(F.sum("total").over(before), F.lit(0)))
    opened = F.last(F.when(F.col("n") > 0, F.col("past") + F.col("last_run")), ignorenulls=True).over(before)
    pages = pages.select(
        "file",
        "page",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("recs"),
        F.last("last_id", ignorenulls=True).over(before).alias("id_before"),
        (F.col("past") - F.coalesce(opened, F.lit(0))).alias("carried"),
    )
    start = F.when(F.col("heads") > 0, F.col("run") - F.col("own_run")).otherwise(F.col("carried") + F.col("run"))
    return (
        placed.join(pages, ["file", "page"])
        .where(F.col("bases").isNotNull() & (F.col("recs") + F.col("heads") > 0))
        .select(
            "file",
            (F.col("recs") + F.col("heads") - 1).alias("rec"),
            F.coalesce("own_id", "id_before").alias("id"),
            (start - F.col("len") + 1).alias("start"),
            "bases",
        )
    )


def numbered_lines(lines: DataFrame, out: str = "line") -> DataFrame:
    """Dense 0-based line number per file, for lines just as a source gives them: none left out.

    Places are consecutive inside a split, so a line needs from the others only how many lines the splits before
    its own hold: one row per split. The lines themselves stay where they were read.
    """
    splits = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = materialize(splits.select("file", "block", shift.alias("__shift")), "splits")
    return lines.join(bounded(shifts), ["file", "block"]).withColumn(out, F.col("pos") + F.col("__shift")).drop("__shift")


def read_fastq(spark: SparkSession, path, strict: bool = False, block_gzip: bool = False) -> DataFrame:
    """Four-line records: ``file, rec, header, seq, plus, qual, reason`` (null reason = well formed).

    Lines are numbered where they are read; a record whose lines lie in one task is put together there before the
    one exchange. ``block_gzip``: the files are gzip; those written in blocks are read by ranges.
    """
    rows = fastq_records(read_block_gzip_lines(spark, path) if block_gzip else read_lines(spark, path))
    if strict:
        bad = rows.where(F.col("reason").isNotNull()).select("file", "rec", "reason").limit(5).collect()
        if bad:
            raise ValueError("FASTQ rejected: " + "; ".join(f"{r.file}#{r.rec}: {r.reason}" for r in bad))
    return rows


def fastq_records(lines: DataFrame) -> DataFrame:
    """Four lines each of a file as a record, from ``file, block, pos, value``; see ``read_fastq``."""
    numbered = numbered_lines(lines)
    slot = F.col("line") % 4

    def pick(i: int):
        return F.max(F.when(slot == i, F.col("value")))

    return (
        numbered.withColumn("rec", (F.col("line") / 4).cast("long"))
        .groupBy("file", "rec")
        .agg(
            pick(0).alias("header"),
            pick(1).alias("seq"),
            pick(2).alias("plus"),
            pick(3).alias("qual"),
            F.count("*").alias("lines"),
        )
        .withColumn(
            "reason",
            F.when(F.col("lines") < 4, F.lit("incomplete"))
            .when(~F.col("header").startswith("@"), F.lit("header_marker"))
            .when(~F.col("plus").startswith("+"), F.lit("separator_marker"))
            .when(F.length("seq") != F.length("qual"), F.lit("quality_length")),
        )
        .drop("lines")
    )
