"""Band registries kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = (
    "id string, metric string, taxon_scope string, unit string, expected_range array<double>, source_type string, "
    "enforce boolean, notes string, references array<struct<text string, doi string, url string>>"
)


def read_bands(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Bands from JSON lines, or from one document or list per file with ``multiline``.

    A range that is not a pair of numbers gives null bounds, which ``validate_bands`` reports.
    """
    rows = spark.read.schema(_SCHEMA).option("multiLine", str(multiline).lower()).json(path)
    pair = F.size("expected_range") == 2
    return rows.select(
        "id",
        "metric",
        "taxon_scope",
        "unit",
        F.when(pair, F.col("expected_range")[0]).alias("lo"),
        F.when(pair, F.col("expected_range")[1]).alias("hi"),
        "source_type",
        "enforce",
        F.lit("clade_fallback").alias("anchor"),
        F.col("references").alias("refs"),
        F.col("_metadata.file_path").alias("source"),
    )
