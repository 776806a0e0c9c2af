"""File-name grammar: kinds, mate tags, sample prefixes, review references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recognised extensions and delimiter-bounded keywords.
FASTA_EXT = r"\.(fa|fas|fasta|fna|fa\.gz|fasta\.gz)$"
READ_EXT = r"\.(fq|fastq|fq\.gz|fastq\.gz)$"
HIC_WORD = r"(?:^|[_.\-])hi[-_]?c(?:[_.\-]|$)"
RNA_WORD = r"(?:^|[_.\-])rna(?:[_.\-]|$)|transcri"
WGS_WORD = r"(?:^|[_.\-])(?:wgs|whole[-_]?genome)(?:[_.\-]|$)"
HAPLOTYPE_WORD = (
    r"(?:^|[_.\-])(?:hap[_.\-]?[12]|phased|phase[_.\-]?separated|subgenome|diploid|triploid)(?:[_.\-]|$)"
)
MATE_SUFFIX = r"(^|[_.\-])r?([12])$"

# Reference grammar of a review edit.
FRAGMENT_REF = r"^([^:]+):(\d+)-(\d+)(:(hap1|hap2))?$"
SCAFFOLD_REF = r"^\S+_scaf_\d+$"


def _base(name: Column) -> Column:
    leaf = F.element_at(F.split(F.lower(name), "/"), -1)
    return F.regexp_replace(leaf, READ_EXT, "")


def mate_tag(name: Column | str) -> Column:
    """``r1`` / ``r2`` at the end of the name, null where there is none."""
    col = F.col(name) if isinstance(name, str) else name
    number = F.regexp_extract(_base(col), MATE_SUFFIX, 2)
    return F.when(number == "1", F.lit("r1")).when(number == "2", F.lit("r2"))


def sample_prefix(name: Column | str) -> Column:
    """Lower-case name without read extension and mate suffix."""
    col = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(_base(col), MATE_SUFFIX, "")


def file_kind(name: Column | str) -> Column:
    """wgs_reads, hic_reads, rna_reads, unknown_reads, assembly, bam or other.

    Reads without a library keyword stay unknown; they are never taken for WGS.
    """
    col = F.lower(F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit("")))
    return (
        F.when(col.rlike(READ_EXT) & col.rlike(HIC_WORD), F.lit("hic_reads"))
        .when(col.rlike(READ_EXT) & col.rlike(RNA_WORD), F.lit("rna_reads"))
        .when(col.rlike(READ_EXT) & col.rlike(WGS_WORD), F.lit("wgs_reads"))
        .when(col.rlike(READ_EXT), F.lit("unknown_reads"))
        .when(col.rlike(FASTA_EXT), F.lit("assembly"))
        .when(col.endswith(".bam"), F.lit("bam"))
        .otherwise(F.lit("other"))
    )


def edit_ref(ref: Column | str) -> Column:
    """``struct<form, coordinate, hap>``: form is fragment, scaffold, missing or invalid."""
    col = F.col(ref) if isinstance(ref, str) else ref
    fragment = col.rlike(FRAGMENT_REF)
    return F.struct(
        F.when(F.coalesce(col, F.lit("")) == "", F.lit("missing"))
        .when(fragment, F.lit("fragment"))
        .when(col.rlike(SCAFFOLD_REF), F.lit("scaffold"))
        .otherwise(F.lit("invalid"))
        .alias("form"),
        F.when(
            fragment,
            F.concat(
                F.regexp_extract(col, FRAGMENT_REF, 1), F.lit(":"), F.regexp_extract(col, FRAGMENT_REF, 2),
                F.lit("-"), F.regexp_extract(col, FRAGMENT_REF, 3),
            ),
        ).alias("coordinate"),
        F.when(fragment, F.nullif(F.regexp_extract(col, FRAGMENT_REF, 5), F.lit(""))).alias("hap"),
    )
