"""Reconciliation of ids, digests, files and metrics between two sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_records(seqs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Records whose id the query table names."""
    return seqs.join(ids.select(key).distinct(), key, "left_semi")


def selection_problems(seqs: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Requested ids with no record, more than one record, or requested twice: ``id, reason``."""
    asked = ids.groupBy(key).agg(F.count("*").alias("asked"))
    found = seqs.groupBy(key).agg(F.count("*").alias("found"))
    both = asked.join(found, key, "left")
    reason = F.array_compact(
        F.array(
            F.when(F.col("found").isNull(), F.lit("missing")),
            F.when(F.col("found") > 1, F.lit("repeated_record")),
            F.when(F.col("asked") > 1, F.lit("repeated_request")),
        )
    )
    return both.select(key, F.explode(reason).alias("reason"))


def fingerprints(df: DataFrame, keys: Sequence[str], id_col: str = "id", seq: str = "seq") -> DataFrame:
    """Id, length and digest of each record; sequences go no further than this."""
    return df.select(
        *keys, F.col(id_col).alias("id"), F.length(seq).cast("long").alias("length"), F.sha2(F.col(seq), 256).alias("sha256")
    )


def fingerprint_diff(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Missing, added, changed and equal records between two fingerprint tables."""
    a = before.select(*keys, "id", F.struct("length", "sha256").alias("a"))
    b = after.select(*keys, "id", F.struct("length", "sha256").alias("b"))
    both = a.join(b, [*keys, "id"], "full_outer")
    present = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.groupBy(*keys).agg(
        F.count_if(F.col("b").isNull()).alias("missing"),
        F.count_if(F.col("a").isNull()).alias("added"),
        F.count_if(present & (F.col("a") != F.col("b"))).alias("changed"),
        F.count_if(present & (F.col("a") == F.col("b"))).alias("equal"),
    )


def id_sets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every distinct key with ``side``: common, only_left or only_right."""
    a = left.select(*keys).distinct().withColumn("in_left", F.lit(True))
    b = right.select(*keys).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, list(keys), "full_outer")
    side = (
        F.when(F.col("in_left") & F.col("in_right"), F.lit("common"))
        .when(F.col("in_left"), F.lit("only_left"))
        .otherwise(F.lit("only_right"))
    )
    return both.select(*keys, side.alias("side"))


def reconcile_names(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Counts of common and one-sided names per delivery; ``consistent`` when nothing is one-sided."""
    sides = id_sets(left, right, [*keys, name])
    out = sides.groupBy(*keys).agg(
        F.count_if(F.col("side") == "common").alias("common"),
        F.count_if(F.col("side") == "only_left").alias("only_left"),
        F.count_if(F.col("side") == "only_right").alias("only_right"),
    )
    return out.withColumn("consistent", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def marker_sets(members: DataFrame, ident: str = "id", source: str = "source") -> DataFrame:
    """Complete-marker sets over the sources A, B and C as one row of counts."""

    def has(s: str) -> Column:
        return F.bool_or(F.col(source) == s)

    by_id = members.groupBy(ident).agg(has("A").alias("a"), has("B").alias("b"), has("C").alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return by_id.agg(
        F.count_if(a & ~c).alias("a_not_c"),
        F.count_if(b & ~c).alias("b_not_c"),
        F.count_if(a & b & ~c).alias("a_and_b_not_c"),
        F.count_if(a | b).alias("a_or_b"),
        F.count_if(c & ~a & ~b).alias("c_only"),
    )


def mate_concordance(r1: DataFrame, r2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mates by position: ``keys, rec, header`` on both sides; names compared without ``/1`` and ``/2``."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        name = F.regexp_replace(F.regexp_extract("header", r"^@?(\S*)", 1), r"/[12]$", "")
        return df.select(*keys, "rec", name.alias(tag))

    both = side(r1, "n1").join(side(r2, "n2"), [*keys, "rec"], "full_outer")
    return both.groupBy(*keys).agg(
        F.count("*").alias("positions"),
        F.count_if(F.col("n1") == F.col("n2")).alias("matching"),
        F.count_if(F.col("n1").isNull() | F.col("n2").isNull()).alias("unpaired"),
        F.coalesce(F.min(F.when(~F.col("n1").eqNullSafe(F.col("n2")), F.col("rec"))), F.lit(-1)).alias("first_mismatch"),
    )


def check_bindings(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected against actual digest of every upstream product; a missing product is not bound."""
    a = actual.select(*keys, F.col("sha256").alias("actual"))
    out = expected.withColumnRenamed("sha256", "expected").join(a, list(keys), "left")
    return out.withColumn("bound", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


# Control files a bundle carries about itself.
CONTROL_FILES = ("MANIFEST.json", "MANIFEST.sha256")


def unsafe_path(path: Column) -> Column:
    """Absolute, climbing, drive or backslash paths, and paths that are not in normal form."""
    return (
        (path == "")
        | path.startswith("/")
        | path.rlike(r"(^|/)\.\.(/|$)")
        | path.rlike(r"(^|/)\.(/|$)")
        | path.contains("//")
        | path.endswith("/")
        | path.contains("\\")
        | path.contains(":")
    )


def verify_bundle(manifest: DataFrame, files: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Manifest against files: every path with ``reason`` (``ok`` when size and digest agree).

    Both sides: ``keys, path, size_bytes, sha256``. Control files are no payload. A file is there when it
    is listed on its side; one whose digest is not known is ``unverified``, neither missing nor changed.
    """
    listed = manifest.groupBy(*keys, "path").agg(
        F.count("*").alias("entries"), F.max("size_bytes").alias("m_size"), F.max("sha256").alias("m_sha")
    )
    real = files.where(~F.col("path").isin(*CONTROL_FILES)).select(
        *keys, "path", F.col("size_bytes").alias("f_size"), F.col("sha256").alias("f_sha"), F.lit(True).alias("there")
    )
    both = listed.join(real, [*keys, "path"], "full_outer")
    reason = (
        F.when(F.col("entries").isNull(), F.lit("extra"))
        .when(unsafe_path(F.col("path")) | F.col("path").isin(*CONTROL_FILES), F.lit("unsafe_path"))
        .when(F.col("entries") > 1, F.lit("duplicate_entry"))
        .when(F.col("there").isNull(), F.lit("missing"))
        .when(~F.col("m_size").eqNullSafe(F.col("f_size")), F.lit("size"))
        .when(F.col("f_sha").isNull(), F.lit("unverified"))
        .when(~F.col("m_sha").eqNullSafe(F.col("f_sha")), F.lit("sha256"))
        .otherwise(F.lit("ok"))
    )
    return both.select(*keys, "path", reason.alias("reason"), F.coalesce("f_size", F.lit(0)).alias("bytes"))


OUTCOMES = ("verified", "changed", "conflict", "missing", "unlisted", "unverified")


def source_receipts(checksums: DataFrame, files: DataFrame, group: Column) -> DataFrame:
    """Per source group: files verified against their list, conflicts excluded, missing and changed ones.

    ``checksums``: one row per path from ``resolve_checksums``; ``files``: ``path, size_bytes, sha256``.
    """
    both = checksums.select("path", "conflict", F.col("sha256").alias("listed")).join(
        files.select("path", "size_bytes", F.col("sha256").alias("actual"), F.lit(True).alias("there")), "path", "full_outer"
    )
    outcome = (
        F.when(F.col("conflict"), F.lit("conflict"))
        .when(F.col("there").isNull(), F.lit("missing"))
        .when(F.col("conflict").isNull(), F.lit("unlisted"))
        .when(F.col("actual").isNull(), F.lit("unverified"))
        .when(F.col("listed") == F.col("actual"), F.lit("verified"))
        .otherwise(F.lit("changed"))
    )
    rows = both.withColumns({"outcome": outcome, "source_group": group})
    return rows.groupBy("source_group").agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES],
        F.coalesce(F.sum(F.when(F.col("outcome") == "verified", F.col("size_bytes"))), F.lit(0)).alias("verified_bytes"),
    )


def pair_surface(artifacts: DataFrame) -> DataFrame:
    """Per pair: same file names, equal declared files, and exchanged delivery/reference roles.

    Columns: ``pair_id, member`` (1 or 2), ``name, role`` (declared, delivery, reference), ``sha256``.
    """

    def digest(member: int, role: str) -> Column:
        return F.max(F.when((F.col("member") == member) & (F.col("role") == role), F.col("sha256")))

    by_name = artifacts.groupBy("pair_id", "name").agg(
        F.min("member").alias("lo"),
        F.max("member").alias("hi"),
        F.max("role").alias("role"),
        (F.min("sha256") == F.max("sha256")).alias("same"),
        digest(1, "delivery").alias("d1"),
        digest(1, "reference").alias("r1"),
        digest(2, "delivery").alias("d2"),
        digest(2, "reference").alias("r2"),
    )
    both = F.col("lo") < F.col("hi")
    out = by_name.groupBy("pair_id").agg(
        F.bool_and(both).alias("same_names"),
        F.coalesce(F.bool_and(F.when(F.col("role") == "declared", F.col("same") & both)), F.lit(True)).alias("same_declared"),
        *[F.max(c).alias(c) for c in ("d1", "r1", "d2", "r2")],
        (F.min("lo") < F.max("hi")).alias("two_members"),
    )
    swapped = F.coalesce((F.col("d1") == F.col("r2")) & (F.col("r1") == F.col("d2")), F.lit(False))
    return out.select("pair_id", "same_names", "same_declared", swapped.alias("roles_swapped"), "two_members")


def check_agp(agp: DataFrame, lengths: DataFrame) -> DataFrame:
    """Object end against sequence length (``id, length``), with the summed component span."""
    objects = agp.groupBy("object").agg(
        F.max("object_end").alias("object_end"),
        F.coalesce(F.sum(F.col("component_end") - F.col("component_beg") + 1), F.lit(0)).alias("component_span"),
    )
    out = objects.join(lengths.select(F.col("id").alias("object"), "length"), "object", "full_outer")
    outcome = (
        F.when(F.col("length").isNull(), F.lit("no_sequence"))
        .when(F.col("object_end").isNull(), F.lit("no_layout"))
        .when(F.col("object_end") != F.col("length"), F.lit("length_conflict"))
        .otherwise(F.lit("ok"))
    )
    return out.withColumns({"difference": F.col("object_end") - F.col("length"), "outcome": outcome})


def select_pairs(files: DataFrame, report: DataFrame) -> DataFrame:
    """Accessions in band with their file pair, skip reason, total size and the selected one.

    ``files``: ``accession, kind`` (gff / faa), ``path, size_bytes``. Selection is by
    smallest total size, equal sizes by accession.
    """
    eligible = report.where(F.col("band_verdict") == "in_band").select("accession").distinct()
    grouped = (
        files.join(eligible, "accession", "left_semi")
        .groupBy("accession")
        .agg(
            F.count_if(F.col("kind") == "gff").alias("gff_files"),
            F.count_if(F.col("kind") == "faa").alias("faa_files"),
            F.sum("size_bytes").alias("total_bytes"),
        )
    )
    reason = F.when((F.col("gff_files") == 0) | (F.col("faa_files") == 0), F.lit("missing_mate")).when(
        (F.col("gff_files") > 1) | (F.col("faa_files") > 1), F.lit("ambiguous_paths")
    )
    rows = grouped.withColumn("skipped", reason)
    first = rows.where(F.col("skipped").isNull()).agg(
        F.min(F.struct("total_bytes", "accession"))["accession"].alias("chosen")
    )
    return rows.join(F.broadcast(first), F.lit(True)).select(
        "accession", "gff_files", "faa_files", "total_bytes", "skipped",
        F.coalesce(F.col("skipped").isNull() & (F.col("accession") == F.col("chosen")), F.lit(False)).alias("selected"),
    )


def recheck_metrics(stored: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored metric values against recomputed ones: ``keys, metric, stored, actual, outcome``."""
    a = stored.select(*keys, "metric", F.col("value").alias("stored"), F.lit(True).alias("in_stored"))
    b = actual.select(*keys, "metric", F.col("value").alias("actual"), F.lit(True).alias("in_actual"))
    both = a.join(b, [*keys, "metric"], "full_outer")
    outcome = (
        F.when(F.col("in_stored").isNull(), F.lit("not_stored"))
        .when(F.col("in_actual").isNull(), F.lit("not_recomputed"))
        .when(F.col("stored").eqNullSafe(F.col("actual")), F.lit("equal"))
        .otherwise(F.lit("differs"))
    )
    return both.select(*keys, "metric", "stored", "actual", outcome.alias("outcome"))


def stale_products(bound: DataFrame, states: DataFrame, key: str = "project_id") -> DataFrame:
    """Projects whose upstream digest moved while their run still counts as valid."""
    moved = bound.where(~F.col("bound")).groupBy(key).agg(F.count("*").alias("changed_inputs"))
    # States that a changed input turns stale.
    live = states.where(F.col("status").isin("SUCCEEDED", "READY", "RUNNING", "WAITING_REVIEW"))
    return live.join(moved, key).select(key, "status", "changed_inputs", F.lit("STALE").alias("to_status"))
