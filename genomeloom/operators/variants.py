"""Paired variants of a delivery: same surface statistics, different cause."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import residues as R
from .hits import coverage
from .sequences import base_profile
from .spread import ordinal, previous


def functional_pair(
    table: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, flags: Sequence[str], keep: int, rename: Column
) -> tuple[DataFrame, DataFrame]:
    """(content cleared, ids renamed) after the first ``keep`` rows of each set.

    Both leave exactly the kept rows joinable and annotated, so the coverage is the same number.
    """
    rows = ordinal(table, keys, order, bucket, "rec")
    late = F.col("rec") >= keep
    cleared = rows.withColumns({f: F.when(late, 0).otherwise(F.col(f)) for f in flags}).drop("rec")
    renamed = rows.withColumn("query", F.when(late, rename).otherwise(F.col("query"))).drop("rec")
    return cleared, renamed


def coverage_pair(
    queries: DataFrame, cleared: DataFrame, renamed: DataFrame, keys: Sequence[str], flags: Sequence[str]
) -> DataFrame:
    """Recomputed coverage of both variants side by side."""
    a = coverage(queries, cleared, keys, flags).select(*keys, "query_proteins", F.col("annotated_query_proteins").alias("cleared_n"))
    b = coverage(queries, renamed, keys, flags).select(*keys, F.col("annotated_query_proteins").alias("renamed_n"))
    return a.join(b, list(keys)).withColumn("equal_surface", F.col("cleared_n") == F.col("renamed_n"))


def suffix_protein_ids(features: DataFrame, suffix: str = ".protein", attribute: str = "protein_id") -> DataFrame:
    """CDS rows pointing at renamed protein ids; every other attribute and coordinate stays."""
    changed = F.transform_values(
        "attrs", lambda k, v: F.when((k == attribute) & (F.col("kind") == "CDS"), F.concat(v, F.lit(suffix))).otherwise(v)
    )
    return features.withColumn("attrs", changed)


def masking_pair(windows: DataFrame, seq: str = "seq") -> DataFrame:
    """Each window as (soft, hard) delivery with the statistics of both against the upper-case reference."""
    soft = base_profile(windows.withColumns({"variant": F.lit("soft")}), seq, "any")
    hard_seq = F.regexp_replace(seq, R.SOFT_ANY, "N")
    hard = base_profile(windows.withColumns({"variant": F.lit("hard"), "reference": F.upper(seq), seq: hard_seq}), seq, "any")
    both = soft.withColumn("reference", F.upper(seq)).unionByName(hard)
    return both.withColumn("sequence_equal_ignorecase", F.upper(seq) == F.col("reference")).drop("reference")


def rename_sequences(features: DataFrame, suffix: str = ".v2") -> DataFrame:
    """Feature seqids moved to another version; coordinates stay."""
    return features.withColumn("seqid", F.concat("seqid", F.lit(suffix)))


def shift_layout_end(agp: DataFrame, shift: int = 200) -> DataFrame:
    """Object ends moved past the sequence end."""
    return agp.withColumn("object_end", F.col("object_end") + shift)


RANGES = 256


def swap_mates(r1: DataFrame, r2: DataFrame, sample: str) -> tuple[DataFrame, DataFrame]:
    """First mates of each sample with the second mates of the next one: equal counts, no common names.

    The ring runs over the list of samples, one row each, by name, in ranges between some of the names.
    """
    names = r2.select(sample).distinct()
    # At most RANGES names, the same on every run.
    some = names.where(F.col(sample).isNotNull()).orderBy(F.xxhash64(sample)).limit(RANGES).collect()
    borders = F.array(*[F.lit(x) for x in sorted(r[0] for r in some)]).cast("array<string>")
    bucket = F.size(F.filter(borders, lambda b: b <= F.col(sample)))
    before = previous(names, [], [sample], bucket, {"owner": F.col(sample)})
    last = F.broadcast(names.agg(F.max(sample).alias("last")))
    ring = before.join(last, F.lit(True)).select(sample, F.coalesce("owner", "last").alias("owner"))
    moved = r2.join(ring, sample).drop(sample).withColumnRenamed("owner", sample)
    return r1, moved


def older_database(versions: DataFrame, version: str = "3.0") -> DataFrame:
    """Recorded database version set back; tools and mask statistics stay."""
    return versions.withColumn("database_version", F.lit(version))


def without_evidence(hints: DataFrame) -> DataFrame:
    """An emptied hint table with the same schema."""
    return hints.where(F.lit(False))
