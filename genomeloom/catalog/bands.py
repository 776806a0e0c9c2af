"""Band, calibration and species-report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import residues as R
from ..operators import bands as B
from ..plans.species import species_report
from ..session import scratch
from . import star
from .features import SUMMARY_SQL
from .registry import query
from .sequences import PROTEIN_SQL, seqs

BANDS = [
    {"id": "B1", "metric": "customers", "taxon_scope": "ASIA", "unit": "rows", "lo": 55.0, "hi": 65.0, "enforce": False},
    {"id": "B2", "metric": "customers", "taxon_scope": "EUROPE", "unit": "rows", "lo": 50.0, "hi": 60.0, "enforce": True},
    {"id": "B3", "metric": "positive_pct", "taxon_scope": "any", "unit": "percent", "lo": 88.0, "hi": 94.0, "enforce": True},
    {"id": "B4", "metric": "customers", "taxon_scope": "AFRICA", "unit": "rows", "lo": 10.0, "hi": 20.0, "enforce": True},
]
BANDS_SQL = """bands(id, metric, scope, lo, hi, enforce) AS (VALUES ('B1', 'customers', 'ASIA', 55.0, 65.0, false), ('B2', 'customers', 'EUROPE', 50.0, 60.0, true),
  ('B3', 'positive_pct', 'any', 88.0, 94.0, true), ('B4', 'customers', 'AFRICA', 10.0, 20.0, true))"""

METRICS_SQL = """m AS (SELECT c_nationkey AS delivery, any_value(r_name) AS taxon, unnest(['customers', 'positive_pct', 'odd']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), 100.0 * count(*) FILTER (c_acctbal > 0) / count(*), CAST(count(*) FILTER (c_mktsegment = 'BUILDING') AS DOUBLE)]) AS value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY c_nationkey),
o AS (SELECT n_nationkey AS delivery, 'customers' AS metric, CASE WHEN n_regionkey = 3 THEN 'ASIA' END AS scope, 0.0 AS lo, CASE WHEN n_regionkey = 2 THEN 58.0 ELSE 1000.0 END AS hi,
  n_regionkey = 2 AS enforce FROM nation WHERE n_regionkey IN (2, 3))"""


def nation_metrics(t):
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("taxon"))
    counts = t.customer.groupBy("c_nationkey").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("c_acctbal") > 0).alias("p"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("b"),
    )
    return counts.join(place, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_nationkey as delivery",
        "taxon",
        "stack(3, 'customers', double(n), 'positive_pct', 100.0D * p / n, 'odd', double(b)) as (metric, value)",
    )


def overrides(t):
    key = F.col("n_regionkey")
    return t.nation.where(key.isin(2, 3)).select(
        F.col("n_nationkey").alias("delivery"),
        F.lit("customers").alias("metric"),
        F.when(key == 3, "ASIA").alias("taxon_scope"),
        F.lit(0.0).alias("lo"),
        F.when(key == 2, 58.0).otherwise(1000.0).alias("hi"),
        (key == 2).alias("enforce"),
    )


@query(
    "evaluate_bands",
    "J-11 SRC-14 C-06",
    f"""WITH {METRICS_SQL}, {BANDS_SQL}, j AS (SELECT m.*, o.lo AS olo, o.hi AS ohi, o.enforce AS oe
  FROM (SELECT * REPLACE (CASE WHEN metric = 'positive_pct' AND delivery % 7 = 3 THEN NULL ELSE value END AS value) FROM m) m LEFT JOIN o ON o.delivery = m.delivery AND o.metric = m.metric AND (o.scope IS NULL OR o.scope = m.taxon)),
k AS (SELECT j.*, b.id AS band_id, coalesce(olo, b.lo) AS lo, coalesce(ohi, b.hi) AS hi, coalesce(oe, b.enforce, false) AS e FROM j
  LEFT JOIN bands b ON b.metric = j.metric AND b.scope IN (j.taxon, 'any') AND olo IS NULL)
SELECT delivery, taxon, metric, round(value, 6) AS value, band_id, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, CASE WHEN lo IS NULL THEN 'unknown_metric' WHEN value IS NULL THEN 'no_data' WHEN value BETWEEN lo AND hi THEN 'within' ELSE 'out_of_range' END AS status,
  CASE WHEN lo IS NOT NULL AND NOT value BETWEEN lo AND hi AND e THEN 'warning' ELSE 'info' END AS severity,
  CASE WHEN olo IS NOT NULL THEN 'project_reference' WHEN band_id IS NOT NULL THEN 'clade_fallback' ELSE 'none' END AS anchor, NOT e AS advisory_only FROM k""",
)
def evaluate_bands(t):
    """Metrics of every nation against clade bands, project overrides first; some percentages are not known."""
    lost = (F.col("metric") == "positive_pct") & (F.col("delivery") % 7 == 3)
    metrics = nation_metrics(t).withColumn("value", F.when(~lost, F.col("value")))
    out = B.evaluate_bands(metrics, B.band_rows(t.spark, BANDS), overrides(t))
    return out.withColumn("value", F.round("value", 6))


@query(
    "merge_registry",
    "X-03",
    f"""WITH {METRICS_SQL}, {BANDS_SQL} SELECT delivery AS project, CAST(NULL AS VARCHAR) AS id, metric, coalesce(scope, 'any') AS taxon_scope, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, enforce, 'project_reference' AS anchor FROM o
UNION ALL SELECT p.delivery, b.id, b.metric, b.scope, CAST(b.lo AS DOUBLE), CAST(b.hi AS DOUBLE), b.enforce, 'clade_fallback' FROM (SELECT DISTINCT delivery FROM o) p, bands b
  WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.delivery = p.delivery AND o.metric = b.metric)""",
)
def merge_registry(t):
    """Overrides and the remaining registry of each project."""
    return B.merge_registry(B.band_rows(t.spark, BANDS), overrides(t).withColumnRenamed("delivery", "project"))


@query(
    "validate_bands",
    "A-28 SRC-14",
    """WITH b AS (SELECT 'B' || p_partkey AS id, CASE WHEN p_size <> 7 THEN p_type END AS metric, p_size AS lo, p_retailprice / 60.0 AS hi,
   CASE WHEN p_brand LIKE '%1' THEN 'rumour' WHEN p_size > 20 THEN 'published' ELSE 'case_reference' END AS source_type, p_size > 25 AS enforce,
   CASE WHEN p_name LIKE 'red%' THEN 2 WHEN p_name LIKE 'blue%' THEN 0 ELSE 1 END AS cited FROM part),
r AS (SELECT id, metric, list_filter([CASE WHEN metric IS NULL THEN 'missing_metric' END, CASE WHEN cited = 0 THEN 'missing_references' END,
  CASE WHEN lo >= hi THEN 'range' END, CASE WHEN source_type = 'rumour' THEN 'source_type' END,
  CASE WHEN enforce AND (source_type <> 'published' OR cited < 2) THEN 'enforce_needs_published_and_two_citations' END], lambda x: x IS NOT NULL) AS l FROM b)
SELECT id, metric, array_to_string(l, ';') AS reasons FROM r WHERE len(l) > 0""",
)
def validate_bands(t):
    """Parts as band entries: which break the registry rules?"""
    ref = lambda doi: F.struct(F.lit("text").alias("text"), F.lit(doi).cast("string").alias("doi"), F.lit(None).cast("string").alias("url"))
    name = F.col("p_name")
    bands = t.part.select(
        F.concat(F.lit("B"), "p_partkey").alias("id"),
        F.when(F.col("p_size") != 7, F.col("p_type")).alias("metric"),
        F.lit("any").alias("taxon_scope"),
        F.lit("unit").alias("unit"),
        F.col("p_size").cast("double").alias("lo"),
        (F.col("p_retailprice") / 60.0).alias("hi"),
        F.when(F.col("p_brand").endswith("1"), "rumour").when(F.col("p_size") > 20, "published").otherwise("case_reference").alias("source_type"),
        (F.col("p_size") > 25).alias("enforce"),
        F.when(name.startswith("red"), F.array(ref("10.1/a"), ref("10.1/b")))
        .when(name.startswith("blue"), F.array().cast("array<struct<text:string,doi:string,url:string>>"))
        .otherwise(F.array(ref("10.1/a"), ref(None)))
        .alias("refs"),
    )
    return B.validate_bands(bands).withColumn("reasons", F.array_join("reasons", ";"))


@query(
    "validate_overrides",
    "A-28",
    """WITH r AS (SELECT o_orderkey AS project, CASE WHEN o_orderstatus <> 'P' THEN 'customers' END AS metric, list_filter([
   CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice < 100000 THEN 'selected_without_references' END,
   CASE WHEN o_orderstatus <> 'P' AND o_totalprice > 400000 THEN 'range' END,
   CASE WHEN o_orderstatus = 'F' AND (o_orderpriority = '5-LOW' OR o_totalprice < 100000) THEN 'enforce_needs_anchor' END], lambda x: x IS NOT NULL) AS l FROM orders)
SELECT project, metric, array_to_string(l, ';') AS reasons FROM r WHERE len(l) > 0""",
)
def validate_overrides(t):
    """Orders as project overrides: which break the project rules?"""
    own = F.col("o_orderstatus") != "P"
    rows = t.orders.select(
        F.col("o_orderkey").alias("project"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "selected").otherwise("not_selected").alias("status"),
        F.when(F.col("o_totalprice") < 100000, 0).otherwise(1).alias("n_references"),
        F.when(own, "customers").alias("metric"),
        F.when(own, F.when(F.col("o_totalprice") > 400000, 9.0).otherwise(1.0)).alias("lo"),
        F.when(own, F.lit(5.0)).alias("hi"),
        F.when(own, F.col("o_orderstatus") == "F").alias("enforce"),
        F.when(F.col("o_orderpriority") != "5-LOW", "anchor").alias("based_on"),
    )
    return B.validate_overrides(rows).withColumn("reasons", F.array_join("reasons", ";"))


@query(
    "extract_metrics",
    "PRJ-19",
    """WITH d AS (SELECT o_orderkey AS delivery, o_orderstatus AS st, o_custkey, o_totalprice, o_orderpriority AS pr FROM orders)
SELECT delivery, 'protein_coding_gene_count' AS metric, CAST(CASE WHEN st = 'F' THEN o_custkey + 1 ELSE o_custkey END AS DOUBLE) AS value FROM d
UNION ALL SELECT delivery, 'repeat_masked_pct', o_totalprice FROM d WHERE pr NOT IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT delivery, 'annotation_busco_complete_pct', 97.5 FROM d WHERE st <> 'P'""",
)
def extract_metrics(t):
    """Aliased numbers out of nested metric documents; booleans and texts are no numbers."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    masked = F.when(priority == "1-URGENT", F.lit("true")).when(priority == "2-HIGH", F.lit('"12.5"')).otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    document = F.concat(
        F.lit('{"gene_count": '), F.col("o_custkey").cast("string"),
        F.when(status == "F", F.concat(F.lit(', "coding_genes": '), (F.col("o_custkey") + 1).cast("string"))).otherwise(F.lit("")),
        F.lit(', "lowercase_pct": '), masked,
        F.when(status != "P", F.lit(', "busco": {"complete_pct": 97.5}')).otherwise(F.lit(', "busco": null')),
        F.lit("}"),
    )
    return B.extract_metrics(t.orders.select(F.col("o_orderkey").alias("delivery"), document.alias("doc")), ["delivery"], "doc")


SPECIES_SQL = f"""{SUMMARY_SQL}, seqs AS (SELECT doc_id, lang, source, regexp_replace(text, '[\\s>]', '', 'g') AS seq FROM documents),
pr AS (SELECT CAST(replace(source, 'src', '') AS INT) AS acc, lang || '_' || length(seq) AS id, length(seq) AS len, {PROTEIN_SQL} FROM seqs),
ps AS (SELECT acc, count(*) FILTER (len > 0) AS proteins, CAST(sum(ambiguous_listed) AS BIGINT) AS ambiguous_residues, CAST(sum(internal_stops_one) AS BIGINT) AS internal_stops,
  count(*) - count(DISTINCT id) AS duplicate_ids, CAST(floor(quantile_cont(len, 0.5) FILTER (len > 0)) AS BIGINT) AS protein_median_len FROM pr GROUP BY acc),
sb(clade, lo, hi) AS (VALUES ('ASIA', 30.0, 45.0), ('EUROPE', 35.0, 60.0), ('AFRICA', 5.0, 20.0), ('AMERICA', 0.0, 100.0)),
rep AS (SELECT coalesce(models.acc, ps.acc) AS accession, n_name AS species, coalesce(r_name, 'unknown') AS clade, gff_gene_loci, coding_genes, noncoding_genes, cds_features, exon_features, isoforms_per_gene,
  proteins, protein_median_len, internal_stops, ambiguous_residues, duplicate_ids,
  CASE WHEN lo IS NULL THEN 'no_band' WHEN coding_genes IS NULL THEN 'no_data' WHEN coding_genes BETWEEN lo AND hi THEN 'in_band' ELSE 'out_of_band' END AS band_verdict
  FROM models FULL JOIN ps ON ps.acc = models.acc LEFT JOIN nation ON n_nationkey = coalesce(models.acc, ps.acc) LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN sb ON sb.clade = r_name)"""

REPORT = [
    "species", "clade", "accession", "gff_gene_loci", "coding_genes", "noncoding_genes", "cds_features", "exon_features", "isoforms_per_gene",
    "proteins", "protein_median_len", "internal_stops", "ambiguous_residues", "duplicate_ids", "band_verdict",
]


def _species(t):
    features = star.features(t).withColumnRenamed("acc", "accession")
    proteins = seqs(t).select(
        F.regexp_replace("source", "src", "").cast("int").alias("accession"),
        F.concat("lang", F.lit("_"), F.length("seq")).alias("id"),
        "seq",
    )
    registry = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("accession"), F.col("n_name").alias("species"), F.col("r_name").alias("clade")
    )
    bands = B.band_rows(
        t.spark,
        [
            {"metric": "protein_coding_gene_count", "taxon_scope": c, "lo": lo, "hi": hi}
            for c, lo, hi in (("ASIA", 30.0, 45.0), ("EUROPE", 35.0, 60.0), ("AFRICA", 5.0, 20.0), ("AMERICA", 0.0, 100.0))
        ],
    )
    return species_report(features, proteins, registry, bands)


@query("species_report", "C-05 A-02 A-03 SNK-01", f"{SPECIES_SQL} SELECT {', '.join(REPORT)} FROM rep")
def species_report_query(t):
    """One report row per accession: gene models, proteins, band verdict."""
    return _species(t).select(*REPORT)


@query(
    "clade_summary",
    "A-11 C-05 T-03",
    f"""{SPECIES_SQL} SELECT clade, count(*) AS n, min(nullif(coding_genes, 0)) AS genes_min, max(nullif(coding_genes, 0)) AS genes_max,
  min(nullif(protein_median_len, 0)) AS length_min, max(nullif(protein_median_len, 0)) AS length_max, count(*) FILTER (band_verdict = 'in_band') AS in_band,
  count(*) FILTER (band_verdict = 'out_of_band') AS out_of_band, count(*) FILTER (band_verdict = 'no_band') AS no_band, count(*) FILTER (band_verdict = 'no_data') AS no_data,
  CAST(floor(quantile_cont(nullif(coding_genes, 0), 0.5)) AS BIGINT) AS genes_median FROM rep GROUP BY clade ORDER BY clade""",
)
def clade_summary(t):
    """Clade calibration of the species report."""
    return B.clade_summary(_species(t)).orderBy("clade")


@query(
    "specificity",
    "A-26",
    f"""{SPECIES_SQL} SELECT clade, count(*) FILTER (band_verdict = 'in_band') AS in_band, count(*) FILTER (band_verdict = 'out_of_band') AS out_of_band,
  count(*) FILTER (band_verdict IN ('no_band', 'no_data')) AS not_judged,
  round(100.0 * count(*) FILTER (band_verdict = 'in_band') / nullif(count(*) FILTER (band_verdict IN ('in_band', 'out_of_band')), 0), 2) AS specificity_pct FROM rep GROUP BY clade""",
)
def specificity(t):
    """Share of judged sets inside their band."""
    return B.specificity(_species(t), ["clade"])


@query(
    "verdict_matrix",
    "A-26",
    """WITH v AS (SELECT CASE WHEN quality = 1 THEN 'pass' ELSE 'block' END AS expected, CASE WHEN n_chars > 1500 THEN 'pass' WHEN n_chars > 400 THEN 'warn' ELSE 'block' END AS actual
   FROM labels JOIN documents USING (doc_id))
SELECT expected, actual, count(*) AS n, count(*) FILTER (expected = actual) AS matching FROM v GROUP BY ALL""",
)
def verdict_matrix(t):
    """Expected verdicts against a length rule."""
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.when(F.col("quality") == 1, "pass").otherwise("block").alias("expected"),
        F.when(F.col("n_chars") > 1500, "pass").when(F.col("n_chars") > 400, "warn").otherwise("block").alias("actual"),
    )
    return B.verdict_matrix(rows, "expected", "actual")


@query(
    "read_bands",
    "SRC-14 A-28",
    """SELECT 'P' || p_partkey AS id, p_brand AS metric, CAST(p_size AS DOUBLE) AS lo, CAST(p_size + 10 AS DOUBLE) AS hi, p_size > 40 AS enforce FROM part""",
)
def read_bands(t):
    """A band registry kept as JSON lines, read with its schema and its source file."""
    from ..sources.bands import read_bands as scan

    path = scratch(t.spark, "bands")
    t.part.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("P"), "p_partkey").alias("id"),
                F.col("p_brand").alias("metric"),
                F.lit("any").alias("taxon_scope"),
                F.array(F.col("p_size").cast("double"), F.col("p_size") + 10.0).alias("expected_range"),
                (F.col("p_size") > 40).alias("enforce"),
            )
        ).alias("value")
    ).write.text(path)
    return scan(t.spark, path).select("id", "metric", "lo", "hi", "enforce")
