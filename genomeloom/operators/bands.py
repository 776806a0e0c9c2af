"""Reference bands: registry checks, evaluation with project overrides, clade calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded, literal_table
from .spread import exact_median

BAND_SCHEMA = (
    "id string, metric string, taxon_scope string, unit string, lo double, hi double, source_type string, "
    "enforce boolean, anchor string, refs array<struct<text string, doi string, url string>>"
)

# Calibrated population bands per clade (metric, low, high).
BAND_SNAPSHOT = {
    "actinopterygii": {"protein_coding_gene_count": (15000, 85000), "median_protein_length": (420, 580)},
    "fungi": {"protein_coding_gene_count": (4000, 8000), "median_protein_length": (350, 500)},
    "nematoda": {"protein_coding_gene_count": (8000, 35000), "median_protein_length": (150, 420)},
    "viridiplantae": {"protein_coding_gene_count": (15000, 55000), "median_protein_length": (320, 450)},
    "insecta": {"protein_coding_gene_count": (9000, 20000), "median_protein_length": (420, 620)},
    "aves": {"protein_coding_gene_count": (12000, 25000), "median_protein_length": (450, 600)},
    "mammalia": {"protein_coding_gene_count": (13000, 30000), "median_protein_length": (440, 600)},
}

# Names under which deliveries report a metric, later ones taking precedence.
METRIC_ALIASES = {
    "protein_coding_gene_count": ("gene_count", "coding_genes"),
    "repeat_masked_pct": ("lowercase_pct",),
    "median_protein_length": ("median_protein_length_aa",),
    "annotation_busco_complete_pct": ("busco.complete_pct",),
}

# Source types a band may declare.
SOURCE_TYPES = ("case_reference", "published", "population_reference")


def snapshot_rows() -> list[dict]:
    return [
        {"metric": metric, "taxon_scope": clade, "lo": float(lo), "hi": float(hi)}
        for clade, metrics in BAND_SNAPSHOT.items()
        for metric, (lo, hi) in metrics.items()
    ]


def band_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """Bands as a broadcastable dimension; absent fields stay null, the anchor defaults to the clade."""
    names = [f.split()[0] for f in BAND_SCHEMA.split(", ") if not f.startswith(("doi", "url"))]
    full = [{**{n: None for n in names}, "anchor": "clade_fallback", **r} for r in rows]
    return literal_table(spark, full, BAND_SCHEMA)


def single_verdict(value: Column, lo: Column, hi: Column) -> Column:
    """``no_band`` before ``no_data`` before the range itself; both ends belong to the range."""
    return (
        F.when(lo.isNull() | hi.isNull(), F.lit("no_band"))
        .when(value.isNull(), F.lit("no_data"))
        .when(value.between(lo, hi), F.lit("in_band"))
        .otherwise(F.lit("out_of_band"))
    )


def validate_bands(bands: DataFrame) -> DataFrame:
    """``id, reasons`` of bands that break the registry rules."""
    cited = F.filter("refs", lambda r: F.coalesce(r["doi"], r["url"]).isNotNull())
    empty = [
        F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing_{c}"))
        for c in ("id", "metric", "taxon_scope", "unit", "source_type", "enforce")
    ]
    reasons = F.array_compact(
        F.array(
            *empty,
            F.when(F.col("refs").isNull() | (F.size("refs") == 0), F.lit("missing_references")),
            F.when(F.col("lo").isNull() | F.col("hi").isNull() | (F.col("lo") >= F.col("hi")), F.lit("range")),
            F.when(~F.coalesce(F.col("source_type"), F.lit("")).isin(*SOURCE_TYPES), F.lit("source_type")),
            F.when(
                F.col("enforce") & ((F.col("source_type") != "published") | (F.coalesce(F.size(cited), F.lit(0)) < 2)),
                F.lit("enforce_needs_published_and_two_citations"),
            ),
        )
    )
    return bands.withColumn("reasons", reasons).where(F.size("reasons") > 0).select("id", "metric", "reasons")


def validate_overrides(overrides: DataFrame) -> DataFrame:
    """``project, metric, reasons`` of overrides breaking the project rules.

    Columns: ``project, status, n_references, metric, lo, hi, enforce, based_on``
    (a project without overrides is one row with a null metric).
    """
    reasons = F.array_compact(
        F.array(
            F.when((F.col("status") == "selected") & (F.col("n_references") == 0), F.lit("selected_without_references")),
            F.when(
                F.col("metric").isNotNull()
                & (F.col("lo").isNull() | F.col("hi").isNull() | (F.col("lo") >= F.col("hi"))),
                F.lit("range"),
            ),
            F.when(
                F.coalesce("enforce", F.lit(False))
                & ((F.coalesce("based_on", F.lit("")) == "") | (F.col("n_references") == 0)),
                F.lit("enforce_needs_anchor"),
            ),
        )
    )
    return overrides.withColumn("reasons", reasons).where(F.size("reasons") > 0).select("project", "metric", "reasons")


def merge_registry(registry: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per project: its overrides, then every registry band of a metric it did not override."""
    own = overrides.select(
        "project",
        F.lit(None).cast("string").alias("id"),
        "metric",
        F.coalesce("taxon_scope", F.lit("any")).alias("taxon_scope"),
        "lo",
        "hi",
        F.coalesce("enforce", F.lit(False)).alias("enforce"),
        F.lit("project_reference").alias("anchor"),
    )
    projects = overrides.select("project").distinct()
    rest = (
        projects.join(bounded(registry), F.lit(True))
        .join(overrides.select("project", "metric").distinct(), ["project", "metric"], "left_anti")
        .select("project", "id", "metric", "taxon_scope", "lo", "hi", "enforce", F.lit("clade_fallback").alias("anchor"))
    )
    return own.unionByName(rest)


def evaluate_bands(metrics: DataFrame, bands: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Judge ``delivery, taxon, metric, value`` rows against bands.

    An override of the same delivery and metric replaces the clade band. Rows no
    band speaks about come out as ``unknown_metric``, rows without a value as ``no_data`` — never as a
    pass and never as a warning.
    """
    m = metrics.select("delivery", "taxon", "metric", "value")
    if overrides is not None:
        o = overrides.select(
            "delivery",
            "metric",
            F.col("taxon_scope").alias("o_scope"),
            F.col("lo").alias("o_lo"),
            F.col("hi").alias("o_hi"),
            F.coalesce("enforce", F.lit(False)).alias("o_enforce"),
        )
        m = m.alias("m").join(
            o.alias("o"),
            (F.col("m.delivery") == F.col("o.delivery"))
            & (F.col("m.metric") == F.col("o.metric"))
            & (F.col("m.taxon").isNull() | F.col("o_scope").isNull() | (F.col("o_scope") == F.col("m.taxon"))),
            "left",
        ).select("m.*", "o_scope", "o_lo", "o_hi", "o_enforce")
    else:
        none = F.lit(None)
        m = m.withColumns(
            {
                "o_scope": none.cast("string"),
                "o_lo": none.cast("double"),
                "o_hi": none.cast("double"),
                "o_enforce": none.cast("boolean"),
            }
        )
    b = bands.select(
        F.col("id").alias("band_id"),
        F.col("metric").alias("b_metric"),
        F.col("taxon_scope").alias("b_scope"),
        F.col("lo").alias("b_lo"),
        F.col("hi").alias("b_hi"),
        F.coalesce("enforce", F.lit(False)).alias("b_enforce"),
    )
    scope = F.col("taxon").isNull() | F.col("b_scope").isin("any") | (F.col("b_scope") == F.col("taxon"))
    judged = m.join(bounded(b), (F.col("metric") == F.col("b_metric")) & scope & F.col("o_lo").isNull(), "left")
    lo, hi = F.coalesce("o_lo", "b_lo"), F.coalesce("o_hi", "b_hi")
    status = (
        F.when(lo.isNull(), F.lit("unknown_metric"))
        .when(F.col("value").isNull() | F.isnan("value"), F.lit("no_data"))
        .when(F.col("value").between(lo, hi), F.lit("within"))
        .otherwise(F.lit("out_of_range"))
    )
    enforce = F.coalesce("o_enforce", "b_enforce", F.lit(False))
    return judged.select(
        "delivery",
        "taxon",
        "metric",
        "value",
        "band_id",
        lo.alias("lo"),
        hi.alias("hi"),
        status.alias("status"),
        F.when((status == "out_of_range") & enforce, F.lit("warning")).otherwise(F.lit("info")).alias("severity"),
        F.when(F.col("o_lo").isNotNull(), F.lit("project_reference"))
        .when(F.col("b_lo").isNotNull(), F.lit("clade_fallback"))
        .otherwise(F.lit("none"))
        .alias("anchor"),
        (~enforce).alias("advisory_only"),
    )


def extract_metrics(
    df: DataFrame, keys: Sequence[str], document: str, aliases: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Named metrics out of nested JSON as ``keys, metric, value``; booleans and texts do not count as numbers."""
    aliases = aliases or METRIC_ALIASES
    parsed = df.withColumn("__v", F.try_parse_json(document))

    def number(path: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get("__v", f"$.{path}", "variant"))
        return F.when(
            kind.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"),
            F.try_variant_get("__v", f"$.{path}", "double"),
        )

    cells = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.coalesce(*[number(p) for p in reversed(tuple(paths))]).alias("value"),
        )
        for metric, paths in aliases.items()
    ]
    return (
        parsed.select(*keys, F.explode(F.array(*cells)).alias("__m"))
        .select(*keys, "__m.metric", "__m.value")
        .where(F.col("value").isNotNull())
    )


def clade_summary(report: DataFrame) -> DataFrame:
    """Per clade: sets, coding-gene range and median, protein-length range, verdict counts.

    ``report`` needs ``clade, coding_genes, protein_median_len, band_verdict``. Zero
    counts are treated as absent, and medians are truncated to integers.
    """
    genes = F.when(F.col("coding_genes") > 0, F.col("coding_genes"))
    lens = F.when(F.col("protein_median_len") > 0, F.col("protein_median_len"))
    rows = report.withColumns({"g": genes, "l": lens})
    base = rows.groupBy("clade").agg(
        F.count("*").alias("n"),
        F.min("g").alias("genes_min"),
        F.max("g").alias("genes_max"),
        F.min("l").alias("length_min"),
        F.max("l").alias("length_max"),
        *[
            F.count_if(F.col("band_verdict") == v).alias(v)
            for v in ("in_band", "out_of_band", "no_band", "no_data")
        ],
    )
    median = exact_median(rows, ["clade"], "g", "genes_median")
    return base.join(median.withColumn("genes_median", F.col("genes_median").cast("long")), "clade", "left")


def specificity(report: DataFrame, keys: Sequence[str] = (), verdict: str = "band_verdict") -> DataFrame:
    """in_band over judged; sets without data or band stay outside the denominator but are counted."""
    out = report.groupBy(*keys).agg(
        F.count_if(F.col(verdict) == "in_band").alias("in_band"),
        F.count_if(F.col(verdict) == "out_of_band").alias("out_of_band"),
        F.count_if(F.col(verdict).isin("no_data", "no_band")).alias("not_judged"),
    )
    return out.withColumn(
        "specificity_pct",
        F.round(F.try_divide(F.lit(100.0) * F.col("in_band"), F.col("in_band") + F.col("out_of_band")), 2),
    )


def verdict_matrix(df: DataFrame, expected: str, actual: str) -> DataFrame:
    """Expected against actual verdicts as a long count table."""
    return df.groupBy(expected, actual).agg(
        F.count("*").alias("n"), F.count_if(F.col(expected).eqNullSafe(F.col(actual))).alias("matching")
    )
