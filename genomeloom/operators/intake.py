"""Intake audit, routing, project rules, review gate and stage summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.filenames import HAPLOTYPE_WORD, edit_ref, file_kind, mate_tag, sample_prefix

# Supported technology / library type pairs.
SUPPORTED_COMBOS = (
    ("illumina_wgs", "wgs"),
    ("illumina_wgs", "rna_seq"),
    ("illumina_hiseq_hic", "hic"),
    ("hifi", "wgs"),
    ("ont", "wgs"),
)
READ_TECHNOLOGIES = ("hifi", "ont", "illumina_wgs")
REQUIRED_TOOLS = ("fastqc", "fastp", "hifiasm", "nextflow")
STAGE_METRICS = (
    "contig_count",
    "contig_n50",
    "total_bp",
    "busco_complete_single",
    "busco_complete_dup",
    "busco_fragmented",
    "busco_missing",
)


def classify_files(df: DataFrame, name: str = "name") -> DataFrame:
    reads = file_kind(name).endswith("_reads")
    return df.withColumns(
        {
            "kind": file_kind(name),
            "mate": F.when(reads, mate_tag(name)),
            "prefix": F.when(reads, sample_prefix(name)),
        }
    )


def unpaired_prefixes(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sample prefixes with only one mate: ``keys, kind, prefix, missing``. Unmarked files do not count."""
    tagged = files.where(F.col("kind").isin("wgs_reads", "hic_reads", "rna_reads") & F.col("mate").isNotNull())
    sides = tagged.groupBy(*keys, "kind", "prefix").agg(
        F.bool_or(F.col("mate") == "r1").alias("r1"), F.bool_or(F.col("mate") == "r2").alias("r2")
    )
    return sides.where(~(F.col("r1") & F.col("r2"))).select(
        *keys, "kind", "prefix", F.when(F.col("r1"), F.lit("r2")).otherwise(F.lit("r1")).alias("missing")
    )


def intake_audit(files: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Kinds found per inventory, unpaired prefixes, haplotype hint, and whether unknown reads block it."""
    rows = classify_files(files, name)
    kinds = rows.groupBy(*keys).agg(
        *[
            F.count_if(F.col("kind") == k).alias(k)
            for k in ("wgs_reads", "hic_reads", "rna_reads", "unknown_reads", "assembly", "bam", "other")
        ],
        F.bool_or((F.col("kind") == "assembly") & F.lower(F.col(name)).rlike(HAPLOTYPE_WORD)).alias("haplotype_hint"),
    )
    unpaired = unpaired_prefixes(rows, keys).groupBy(*keys).agg(F.count("*").alias("unpaired_prefixes"))
    return (
        kinds.join(unpaired, list(keys), "left")
        .fillna(0, ["unpaired_prefixes"])
        .withColumn("blocked_by_unknown_reads", F.col("unknown_reads") > 0)
    )


def file_pairs(files: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Compressed read files grouped by name stem: complete when a stem has exactly two files."""
    pattern = r"^(.*)[_-]?([12RI])\.(fq|fastq)\.gz$"
    reads = files.where(F.col(name).rlike(r"\.(fq|fastq)\.gz$"))
    stem = F.when(F.col(name).rlike(pattern), F.regexp_extract(name, pattern, 1)).otherwise(F.col(name))
    return reads.groupBy(*keys, stem.alias("stem")).agg(F.count("*").alias("files")).withColumn(
        "paired", F.col("files") == 2
    )


def _roles(role: str) -> Column:
    return F.exists(F.col("libraries"), lambda x: F.coalesce(x["sample_role"] == role, F.lit(False)))


def _library_codes() -> Column:
    """Blocker codes of each library, as one flat array."""

    def one(x: Column) -> Column:
        tech, kind = x["technology"], x["library_type"]
        supported = F.lit(False)
        for t, k in SUPPORTED_COMBOS:
            supported = supported | ((tech == t) & (kind == k))
        names = F.coalesce(x["read_files"], F.array().cast("array<string>"))

        def prefixes(tag: str) -> Column:
            return F.transform(F.filter(names, lambda n: mate_tag(n) == tag), sample_prefix)

        lonely = F.size(F.array_except(prefixes("r1"), prefixes("r2"))) + F.size(
            F.array_except(prefixes("r2"), prefixes("r1"))
        )
        ident = F.coalesce(x["library_id"], F.lit("?"))
        return F.array_compact(
            F.array(
                F.when(
                    tech.isNotNull() & kind.isNotNull() & ~supported, F.concat(F.lit("unsupported_combo:"), ident)
                ).when(tech.isNotNull() & kind.isNull(), F.concat(F.lit("missing_library_type:"), ident)),
                F.when((tech == "illumina_wgs") & (lonely > 0), F.concat(F.lit("unpaired:"), ident)),
            )
        )

    return F.flatten(F.transform("libraries", one))


def route(projects: DataFrame) -> DataFrame:
    """Blockers and one of five intents per project, computed inside the row.

    Columns: ``project_id, libraries`` (array of struct), ``has_existing, representation,
    ploidy, mixed_sample``.
    """
    has_hic = F.exists("libraries", lambda x: F.coalesce(x["library_type"] == "hic", F.lit(False)))
    has_reads = F.exists(
        "libraries",
        lambda x: (x["library_type"].isNull() | (x["library_type"] == "wgs"))
        & F.coalesce(x["technology"].isin(*READ_TECHNOLOGIES), F.lit(False)),
    )
    existing = F.coalesce("has_existing", F.lit(False))
    general = F.array_compact(
        F.array(
            F.when(F.coalesce("representation", F.lit("unresolved")) == "unresolved", F.lit("representation_unresolved")),
            F.when((F.size("libraries") > 0) & ~_roles("proband"), F.lit("no_proband")),
            F.when(F.col("ploidy") > 2, F.lit("ploidy_above_two")),
            F.when(F.col("mixed_sample"), F.lit("mixed_sample")),
            F.when(has_hic & ~has_reads & ~existing, F.lit("hic_without_source")),
        )
    )
    rows = projects.withColumns(
        {"has_hic": has_hic, "has_reads": has_reads, "blockers": F.array_sort(F.concat(general, _library_codes()))}
    )
    intent = (
        F.when(F.size("blockers") > 0, F.lit("blocked"))
        .when(F.col("has_reads") & F.col("has_hic"), F.lit("assemble_and_scaffold"))
        .when(F.col("has_reads"), F.lit("assemble_only"))
        .when(existing & F.col("has_hic"), F.lit("existing_then_scaffold"))
        .when(existing, F.lit("existing_only_validate"))
        .otherwise(F.lit("blocked"))
    )
    return rows.withColumn("intent", intent)


def validate_projects(projects: DataFrame) -> DataFrame:
    """Cross-field reasons per project.

    Beyond the routing columns: ``parental_identity_required, backend,
    allow_remote_upload, cpu_limit, memory_gb_limit, disk_gb_limit``.
    """
    proband = F.filter("libraries", lambda x: F.coalesce(x["sample_role"] == "proband", F.lit(False)))
    assembly = F.filter(proband, lambda x: ~F.coalesce(x["library_type"] == "rna_seq", F.lit(False)))
    no_role = F.exists("libraries", lambda x: x["sample_role"].isNull())
    limits = F.col("cpu_limit").isNull() | F.col("memory_gb_limit").isNull() | F.col("disk_gb_limit").isNull()
    reasons = F.array_compact(
        F.array(
            F.when(F.coalesce("representation", F.lit("unresolved")) == "unresolved", F.lit("representation_undeclared")),
            F.when(
                (F.col("backend") == "remote_agent") & ~F.coalesce(~F.col("allow_remote_upload"), F.lit(False)),
                F.lit("remote_upload_not_off"),
            ),
            F.when(F.col("backend").isin("sop_package", "remote_agent") & limits, F.lit("limits_missing")),
            F.when(no_role, F.lit("role_missing")),
            F.when((F.size("libraries") > 0) & (F.size(proband) == 0), F.lit("no_proband")),
            F.when(F.size(assembly) > 1, F.lit("several_assembly_probands")),
            F.when(F.coalesce("parental_identity_required", F.lit(False)) & ~_roles("parent"), F.lit("parent_required")),
        )
    )
    return projects.withColumn("reasons", reasons)


def missing_tools(manifest: DataFrame, versions: str = "software_versions") -> DataFrame:
    """Required tools without a recorded version; a missing manifest is its own finding."""
    wanted = F.array(*[F.lit(x) for x in REQUIRED_TOOLS])
    return manifest.withColumn(
        "missing",
        F.when(F.col(versions).isNull(), F.array(F.lit("no_manifest"))).otherwise(
            F.array_sort(F.array_except(wanted, F.map_keys(versions)))
        ),
    )


def review_gate(packages: DataFrame, edits: DataFrame) -> DataFrame:
    """Blockers per review package.

    ``packages``: ``package_id, approved_by_human, submission_action, input_assembly_hash,
    review_package_hash, stale, status``; ``edits``: ``package_id, ref, liftover_hap``
    (null when nothing was lifted over). Edits aggregate per coordinate first, so a
    package of any size is never one group of rows.
    """
    e = edits.withColumn("r", edit_ref("ref"))
    lifted = F.lower(F.coalesce("liftover_hap", F.lit("")))
    mismatch = (lifted != "") & (F.coalesce(F.col("r.hap"), F.lit("")) != lifted)
    valid = F.col("r.form").isin("fragment", "scaffold")
    coordinate = F.col("r.coordinate")
    per = (
        e.groupBy("package_id", coordinate.alias("coordinate"))
        .agg(
            F.when(coordinate.isNotNull(), F.count("*") - 1).otherwise(0).alias("repeats"),
            F.count_if(F.col("r.form") == "missing").alias("missing_ref"),
            F.count_if(F.col("r.form") == "invalid").alias("invalid_ref"),
            F.count_if(valid & mismatch).alias("hap_mismatch"),
        )
        .groupBy("package_id")
        .agg(
            F.sum("repeats").alias("repeats"),
            F.sum("missing_ref").alias("missing_ref"),
            F.sum("invalid_ref").alias("invalid_ref"),
            F.sum("hap_mismatch").alias("hap_mismatch"),
        )
    )
    rows = packages.join(per, "package_id", "left")
    approved = F.coalesce("approved_by_human", F.lit(False))
    action = F.coalesce("submission_action", F.lit("")) != ""
    codes = F.array_compact(
        F.array(
            F.when(~approved, F.lit("not_approved")),
            F.when(~action, F.lit("no_submission_action")),
            F.when(approved & ~action, F.lit("approved_without_action")),
            F.when(F.coalesce("input_assembly_hash", F.lit("")) == "", F.lit("no_input_hash")),
            F.when(F.coalesce("review_package_hash", F.lit("")) == "", F.lit("no_package_hash")),
            F.when(F.col("stale"), F.lit("stale")),
            F.when(F.col("missing_ref") > 0, F.lit("missing_ref")),
            F.when(F.col("invalid_ref") > 0, F.lit("invalid_ref")),
            F.when(F.col("repeats") > 0, F.lit("duplicate_coordinates")),
            F.when(F.col("hap_mismatch") > 0, F.lit("hap_mismatch")),
            F.when(F.col("status").isin("rejected", "undetermined"), F.lit("status_not_approved")),
        )
    )
    return rows.select("package_id", codes.alias("blockers")).withColumn("ok", F.size("blockers") == 0)


def label_metrics(
    metrics: DataFrame, failures: DataFrame, projects: DataFrame, key: str = "project_id", wanted: Sequence[str] = STAGE_METRICS
) -> DataFrame:
    """Every wanted metric of every project as number, tool_failed, missing or na — never a silent zero.

    ``metrics``: ``key, metric, value`` (double) and ``raw`` (text as recorded); ``failures``: ``key, metric``.
    """
    grid = projects.select(key, F.explode(F.array(*[F.lit(m) for m in wanted])).alias("metric"))
    m = metrics.groupBy(key, "metric").agg(F.max("value").alias("value"), F.max("raw").alias("raw"))
    f = failures.select(key, "metric").distinct().withColumn("failed", F.lit(True))
    rows = grid.join(m, [key, "metric"], "left").join(f, [key, "metric"], "left")
    label = (
        F.when(F.col("value").isNotNull(), F.lit("number"))
        .when(F.col("failed"), F.lit("tool_failed"))
        .when(F.col("raw").isNull(), F.lit("missing"))
        .otherwise(F.lit("na"))
    )
    return rows.select(key, "metric", "value", label.alias("label"))


def stage_summary(
    projects: DataFrame, metrics: DataFrame, failures: DataFrame, candidates: DataFrame, key: str = "project_id"
) -> DataFrame:
    """Honest stage report per project.

    ``projects``: ``key, representation, phased``; ``candidates``: ``key, deleted, approved``.
    A project is clean only without failures and without missing metrics.
    """
    labels = label_metrics(metrics, failures, projects, key).groupBy(key).agg(
        F.count_if(F.col("label") == "number").alias("numbers"),
        F.count_if(F.col("label") == "missing").alias("missing"),
        F.count_if(F.col("label") == "na").alias("not_applicable"),
    )
    failed = failures.groupBy(key).agg(F.count("*").alias("failures"))
    removed = candidates.groupBy(key).agg(
        F.count_if(F.col("deleted") & ~F.coalesce("approved", F.lit(False))).alias("deleted_without_approval")
    )
    rows = (
        projects.join(labels, key, "left").join(failed, key, "left").join(removed, key, "left")
        .fillna(0, ["failures", "deleted_without_approval"])
    )
    unresolved = F.coalesce("representation", F.lit("unresolved")) == "unresolved"
    return rows.select(
        key,
        unresolved.alias("blocked"),
        F.when(~unresolved, F.col("representation")).alias("representation"),
        "numbers",
        "missing",
        "not_applicable",
        "failures",
        "deleted_without_approval",
        ((F.col("representation") == "primary_reference") & F.coalesce("phased", F.lit(False))).alias("phase_conflict"),
        ((F.col("failures") == 0) & (F.col("missing") == 0)).alias("clean"),
    )
