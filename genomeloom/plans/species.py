"""Species batch report and clade calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bands as B
from ..operators.features import gene_model_summary
from ..operators.sequences import protein_summary
from ..session import bounded


def species_report(
    features: DataFrame, proteins: DataFrame, registry: DataFrame, bands: DataFrame, key: str = "accession"
) -> DataFrame:
    """One row per accession: gene models, protein set, and the coding-gene band of its clade.

    ``features`` and ``proteins`` hold all accessions at once. An accession with
    only one of the two files keeps nulls in the other half.
    """
    models = gene_model_summary(features, [key])
    sets = protein_summary(proteins, [key])
    rows = models.join(sets, key, "full_outer").join(registry.select(key, "species", "clade"), key, "left")
    rows = rows.withColumns(
        {"species": F.coalesce("species", F.col(key).cast("string")), "clade": F.coalesce("clade", F.lit("unknown"))}
    )
    band = bands.where(F.col("metric") == "protein_coding_gene_count").select(
        F.col("taxon_scope").alias("clade"), F.col("lo").alias("band_lo"), F.col("hi").alias("band_hi")
    )
    judged = rows.join(bounded(band), "clade", "left")
    return judged.withColumn(
        "band_verdict", B.single_verdict(F.col("coding_genes"), F.col("band_lo"), F.col("band_hi"))
    )
