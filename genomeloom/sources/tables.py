"""Hit tables, domain tables, headered tables, run records, checksums and file listings."""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequences import read_lines

# The seventeen columns of a hit table, in order.
HIT_COLUMNS = (
    "qseqid",
    "sseqid",
    "pident",
    "length",
    "mismatch",
    "gapopen",
    "qstart",
    "qend",
    "sstart",
    "send",
    "evalue",
    "bitscore",
    "qlen",
    "slen",
    "qcovhsp",
    "scovhsp",
    "stitle",
)
HIT_NUMERIC = ("evalue", "bitscore", "qcovhsp", "scovhsp")

# Identifiers recognised by content, never by column number.
DOMAIN_PATTERN = r"(IPR\d{6,})"
TERM_PATTERN = r"(GO:\d{7})"

# Bytes of a file that a task holds while it takes the digest.
READ_BYTES = 1 << 20


def read_hits(spark: SparkSession, path) -> DataFrame:
    """Seventeen-column hits; rows of another width are skipped. Titles may hold quotes, so this is no CSV."""
    cells = spark.read.text(path).select(F.split("value", "\t").alias("f")).where(F.size("f") == 17)
    return cells.select(
        *[
            (F.col("f")[i].cast("double") if name in HIT_NUMERIC else F.col("f")[i]).alias(name)
            for i, name in enumerate(HIT_COLUMNS)
        ]
    )


def read_domains(spark: SparkSession, path) -> DataFrame:
    """Ragged rows as ``protein, domains, terms``."""
    rows = spark.read.text(path).where(F.col("value") != "")
    return rows.select(
        F.substring_index("value", "\t", 1).alias("protein"),
        F.array_distinct(F.regexp_extract_all("value", F.lit(DOMAIN_PATTERN))).alias("domains"),
        F.array_distinct(F.regexp_extract_all("value", F.lit(TERM_PATTERN))).alias("terms"),
    )


def read_id_annotation(spark: SparkSession, path, keys: DataFrame | None = None, key: str = "sseqid") -> DataFrame:
    """``id, annot``: first column and the rest. With ``keys`` only those ids are kept."""
    parts = F.split("value", "\t", 2)
    rows = spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("id"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("annot")
    )
    if keys is None:
        return rows
    wanted = keys.select(F.col(key).alias("id")).distinct()
    return rows.join(wanted, "id", "left_semi")


def read_tsv(spark: SparkSession, path, schema: T.StructType | str, sep: str = "\t") -> DataFrame:
    """Headered table with a declared schema; a byte-order mark sits on the skipped header line."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema, enforceSchema=True, quote='"', escape='"')


def read_records(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON lines; an unreadable line keeps its text in ``_corrupt_record`` and nulls elsewhere."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").json(path)


def read_checksums(spark: SparkSession, path) -> DataFrame:
    """``sha256, path`` per line of a checksum list; other lines are marked ``valid = false``."""
    return parse_checksums(read_lines(spark, path))


def parse_checksums(lines: DataFrame, col: str = "value") -> DataFrame:
    pattern = r"^([a-fA-F0-9]{64}) [ *](.+)$"
    return lines.where(~F.col(col).rlike(r"^\s*$")).select(
        F.lower(F.regexp_extract(col, pattern, 1)).alias("sha256"),
        F.regexp_extract(col, pattern, 2).alias("path"),
        F.col(col).rlike(pattern).alias("valid"),
    )


def resolve_checksums(rows: DataFrame) -> DataFrame:
    """One row per path: its digest, or ``conflict`` where the list names more than one."""
    distinct = rows.where("valid").select("path", "sha256").distinct()
    return distinct.groupBy("path").agg(
        F.count("*").alias("digests"),
        F.when(F.count("*") == 1, F.max("sha256")).alias("sha256"),
        (F.count("*") > 1).alias("conflict"),
    )


def inventory_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``path, size_bytes, sha256`` of every file below ``path``, of any size.

    The listing reads no content; each file is then streamed through the digest in small
    reads where its row is, from any store that Arrow opens by address (local, HDFS, S3, GCS).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", F.col("length").alias("size_bytes"))

    def digest(batches):
        for batch in batches:
            digests = pa.array([file_digest(p) for p in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], ["path", "size_bytes", "sha256"])

    return files.mapInArrow(digest, "path string, size_bytes long, sha256 string")


def file_digest(path: str, step: int = READ_BYTES) -> str:
    """SHA-256 of one file, read ``step`` bytes at a time."""
    local = re.sub(r"^file:/+", "/", path)
    if local.startswith("/"):
        files, place = fs.LocalFileSystem(), local
    else:
        files, place = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    total = hashlib.sha256()
    with files.open_input_stream(place, buffer_size=None) as stream:
        while piece := stream.read(step):
            total.update(piece)
    return total.hexdigest()


def read_agp(spark: SparkSession, path) -> DataFrame:
    """AGP component rows (gap rows keep null component coordinates)."""
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    f = F.split("value", "\t")
    names = ["object", "object_beg", "object_end", "part", "kind", "component", "component_beg", "component_end", "strand"]
    longs = {"object_beg", "object_end", "part", "component_beg", "component_end"}
    return rows.where(F.size(f) >= 8).select(
        *[
            (F.get(f, F.lit(i)).try_cast("long") if n in longs else F.get(f, F.lit(i))).alias(n)
            for i, n in enumerate(names)
        ]
    )


# Summary lines of the external tools.
RATE_PATTERN = r"([\d.]+)%\s+overall alignment rate"
COMPLETENESS_PATTERN = r"C:([\d.]+)%\[S:([\d.]+)%,D:([\d.]+)%\],F:([\d.]+)%,M:([\d.]+)%,n:(\d+)"
LINEAGE_PATTERN = r"lineage dataset is:\s*(\S+)"
MODE_PATTERN = r"run in mode:\s*(\S+)"
VERSION_PATTERN = r"Version\s*:\s*(\S+)"


def read_logs(spark: SparkSession, path) -> DataFrame:
    """One row per log file: ``file, text``."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    )


def _number(pattern: str, group: int, text: str = "text"):
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("double")


def parse_alignment_rate(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("alignment_rate_pct", F.round(_number(RATE_PATTERN, 1, text), 2))


def parse_completeness(df: DataFrame, text: str = "text") -> DataFrame:
    """Completeness percentages; ``parsed`` is false unless line, lineage and mode are all there."""
    names = ["complete_pct", "single_pct", "duplicated_pct", "fragmented_pct", "missing_pct"]
    out = df
    for i, name in enumerate(names, 1):
        out = out.withColumn(name, _number(COMPLETENESS_PATTERN, i, text))
    out = (
        out.withColumn("n", _number(COMPLETENESS_PATTERN, 6, text).cast("long"))
        .withColumn("lineage", F.nullif(F.regexp_extract(text, LINEAGE_PATTERN, 1), F.lit("")))
        .withColumn("mode", F.nullif(F.regexp_extract(text, MODE_PATTERN, 1), F.lit("")))
    )
    return out.withColumn(
        "parsed", F.col("n").isNotNull() & F.col("lineage").isNotNull() & F.col("mode").isNotNull()
    )


def parse_versions(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("version", F.nullif(F.regexp_extract(text, VERSION_PATTERN, 1), F.lit("")))


def discover_genomes(files: DataFrame, registry: DataFrame, name: str = "name") -> DataFrame:
    """Group genome files by accession: one GFF and one protein file each, copies merged.

    ``registry`` is ``accession, species, clade``; accessions outside it stay, with clade ``unknown``.
    Of several files of a kind the name that sorts last stays.
    """
    kind = F.when(F.contains(F.col(name), F.lit("_genomic.gff")), F.lit("gff")).when(
        F.contains(F.col(name), F.lit("_protein.faa")), F.lit("faa")
    )
    base = F.replace(
        F.substring_index(F.substring_index(F.col(name), "_genomic.gff", 1), "_protein.faa", 1), F.lit(" (1)"), F.lit("")
    )
    accession = F.when(base.startswith("GCF_"), F.substring_index(base, "_", 2)).otherwise(base)
    known = files.withColumn("kind", kind).where(F.col("kind").isNotNull()).withColumn("accession", accession)
    grouped = known.groupBy("accession").agg(
        F.max(F.when(F.col("kind") == "gff", F.col(name))).alias("gff"),
        F.max(F.when(F.col("kind") == "faa", F.col(name))).alias("faa"),
        F.count_if(F.contains(F.col(name), F.lit(" ("))).alias("copies"),
    )
    return grouped.join(registry, "accession", "left").withColumns(
        {
            "registered": F.col("species").isNotNull(),
            "species": F.coalesce("species", "accession"),
            "clade": F.coalesce("clade", F.lit("unknown")),
        }
    )
