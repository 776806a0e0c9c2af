"""Scans and sinks of the tabular formats: write the driver tables in a format, read them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import reconcile as C
from ..session import literal_table, scratch
from ..sources import sinks
from ..sources import tables as S
from .registry import balanced, query

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("props", T.StructType([T.StructField("k", T.LongType())])),
    ]
)


@query(
    "read_tsv",
    "SRC-08 SNK-01",
    """SELECT c_nationkey, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, count(*) FILTER (c_mktsegment = 'BUILDING') AS building
FROM customer GROUP BY c_nationkey""",
)
def read_tsv(t):
    """Customers through a headered TSV with a declared schema."""
    path = scratch(t.spark, "tsv")
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    sinks.write_report(rows, path)
    back = S.read_tsv(t.spark, path, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    return back.groupBy("c_nationkey").agg(
        F.count("*").alias("n"),
        F.sum("c_custkey").alias("keys"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"),
    )


@query(
    "read_records",
    "SRC-09",
    """SELECT event_type, count(*) FILTER (NOT bad) AS records, count(*) FILTER (bad) AS unreadable,
  CAST(coalesce(sum(CAST(json_extract(props, '$.k') AS BIGINT)) FILTER (NOT bad), 0) AS BIGINT) AS k_sum
FROM (SELECT *, value > 150 AS bad FROM events) GROUP BY event_type
""".replace("SELECT event_type, count(*) FILTER (NOT bad)", "SELECT CASE WHEN bad THEN NULL ELSE event_type END AS event_type, count(*) FILTER (NOT bad)").replace(
        "GROUP BY event_type", "GROUP BY 1"
    ),
)
def read_records(t):
    """Events as JSON lines with torn lines among them: torn ones are counted, not fatal."""
    path = scratch(t.spark, "jsonl")
    whole = F.concat(
        F.lit('{"event_id": '), "event_id", F.lit(', "user_id": '), "user_id", F.lit(', "event_type": "'), "event_type",
        F.lit('", "props": '), "props", F.lit("}"),
    )
    line = F.when(F.col("value") > 150, F.substring(whole, 1, 25)).otherwise(whole)
    t.events.select(line.alias("value")).write.text(path)
    rows = S.read_records(t.spark, path, EVENT_SCHEMA)
    torn = F.col("_corrupt_record").isNotNull()
    return rows.groupBy(F.when(~torn, F.col("event_type")).alias("event_type")).agg(
        F.count_if(~torn).alias("records"),
        F.count_if(torn).alias("unreadable"),
        F.coalesce(F.sum(F.when(~torn, F.col("props.k"))), F.lit(0)).alias("k_sum"),
    )


@query(
    "read_checksums",
    "SRC-10",
    """WITH c AS (SELECT 'set/' || source || '/' || n_chars AS path, count(DISTINCT sha256(text)) AS digests, max(sha256(text)) AS sha FROM documents GROUP BY 1)
SELECT path, digests, CASE WHEN digests = 1 THEN sha END AS sha256, digests > 1 AS conflict FROM c""",
)
def read_checksums(t):
    """A checksum list read back; paths with two digests are conflicts."""
    path = scratch(t.spark, "sums")
    name = F.concat_ws("/", F.lit("set"), "source", "n_chars")
    mark = F.when(F.col("lang") == "en", " *").otherwise("  ")
    t.documents.select(F.concat(F.sha2("text", 256), mark, name).alias("value")).write.text(path)
    return S.resolve_checksums(S.read_checksums(t.spark, path))


@query(
    "inventory_files",
    "SRC-11",
    """WITH g AS (SELECT 'c_nationkey=' || c_nationkey AS folder, string_agg(c_name || chr(10), '' ORDER BY c_custkey) AS body FROM customer GROUP BY c_nationkey)
SELECT folder, CAST(strlen(body) AS BIGINT) AS size_bytes, sha256(body) AS sha256 FROM g""",
)
def inventory_files(t):
    """Size and digest of text files, one per nation with its customers."""
    path = scratch(t.spark, "inventory")
    rows = t.customer.select("c_nationkey", "c_custkey", F.col("c_name").alias("value"))
    ordered = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").drop("c_custkey")
    ordered.write.partitionBy("c_nationkey").text(path)
    found = S.inventory_files(t.spark, path, "part-*")
    return found.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), "size_bytes", "sha256")


@query(
    "read_agp",
    "SRC-13 J-20",
    """WITH a AS (SELECT l_orderkey AS o, CAST(sum(l_quantity) AS BIGINT) AS span, CAST(max(l_linenumber) AS BIGINT) * 50 AS e FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey AS o, CASE WHEN o_orderstatus = 'P' THEN 350 ELSE 300 END AS len FROM orders)
SELECT coalesce('o' || a.o, 'o' || s.o) AS object, e AS object_end, span AS component_span, CAST(len AS BIGINT) AS length, e - len AS difference,
  CASE WHEN len IS NULL THEN 'no_sequence' WHEN e IS NULL THEN 'no_layout' WHEN e <> len THEN 'length_conflict' ELSE 'ok' END AS outcome
FROM a FULL JOIN s ON a.o = s.o""",
)
def read_agp(t):
    """Lines as an AGP layout, checked against sequence lengths."""
    path = scratch(t.spark, "agp")
    number = F.col("l_linenumber")
    line = F.concat_ws(
        "\t", F.concat(F.lit("o"), "l_orderkey"), (number * 50 - 49), (number * 50), number, F.lit("W"),
        F.concat(F.lit("c"), "l_partkey"), F.lit("1"), F.col("l_quantity").cast("long"), F.lit("+"),
    )
    t.lineitem.select(line.alias("value")).write.text(path)
    lengths = t.orders.select(
        F.concat(F.lit("o"), "o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", 350).otherwise(300).cast("long").alias("length"),
    )
    return C.check_agp(S.read_agp(t.spark, path), lengths)


LOG_SQL = """SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN round(s_acctbal / 100.0, 2) END AS alignment_rate_pct,
  CASE WHEN s_nationkey <> 3 THEN CAST(s_nationkey AS DOUBLE) + 70.5 END AS complete_pct, CASE WHEN s_nationkey <> 3 THEN 3640 END AS n,
  CASE WHEN s_nationkey < 20 THEN 'lin_odb10' END AS lineage, 'proteins' AS mode, s_nationkey <> 3 AND s_nationkey < 20 AS parsed,
  CASE WHEN s_nationkey > 10 THEN '3.' || s_nationkey END AS version FROM supplier"""


@query("tool_summaries", "SRC-12", LOG_SQL)
def tool_summaries(t):
    """Alignment rate, completeness line and version from a folder of log files; absent lines stay null."""
    text = F.concat_ws(
        "\n",
        F.lit("reads; of these:"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.format_string("%.4f", F.col("s_acctbal") / 100.0), F.lit("% overall alignment rate"))),
        F.when(
            F.col("s_nationkey") != 3,
            F.concat(F.lit("C:"), F.col("s_nationkey") + 70, F.lit(".5%[S:60.1%,D:2.0%],F:1.5%,M:3.0%,n:3640")),
        ),
        F.when(F.col("s_nationkey") < 20, F.lit("# The lineage dataset is: lin_odb10 (Creation)")),
        F.lit("# BUSCO was run in mode: proteins"),
        F.when(F.col("s_nationkey") > 10, F.concat(F.lit("Version : 3."), "s_nationkey")),
    )
    path = scratch(t.spark, "logs")
    # A file a log, all in one folder. The tasks write and publish them side by side; with version 1 the driver would move
    # each in turn.
    named = t.supplier.select(F.concat_ws("\n", F.concat(F.lit("supplier "), "s_suppkey"), text).alias("value"))
    writer = balanced(named).write.option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    key = F.regexp_extract("text", r"^supplier (\d+)\n", 1).cast(t.supplier.schema["s_suppkey"].dataType)
    rows = S.read_logs(t.spark, path).withColumn("s_suppkey", key)
    out = S.parse_versions(S.parse_completeness(S.parse_alignment_rate(rows)))
    return out.select(
        "s_suppkey", "alignment_rate_pct", "complete_pct", F.col("n").cast("int").alias("n"), "lineage", "mode", "parsed", "version"
    )


def genome_files(t):
    """Suppliers as genome files: a GFF each, proteins for solvent ones, copies in the first nations."""
    stem = F.concat(F.lit("GCF_"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.lit(".1_ASM"))
    names = F.array_compact(
        F.array(
            F.concat(stem, F.lit("_genomic.gff.gz")),
            F.when(F.col("s_acctbal") > 0, F.concat(stem, F.lit("_protein.faa.gz"))),
            F.when(F.col("s_nationkey") < 5, F.concat(stem, F.lit(" (1)_genomic.gff.gz"))),
            F.concat(stem, F.lit("_report.txt")),
        )
    )
    return t.supplier.select("s_suppkey", "s_acctbal", "s_nationkey", F.explode(names).alias("name"))


@query(
    "discover_genomes",
    "SRC-15",
    """WITH s AS (SELECT *, 'GCF_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '.1' AS acc FROM supplier),
r(acc, species, clade) AS (VALUES ('GCF_000000001.1', 'Danio_rerio', 'actinopterygii'), ('GCF_000000007.1', 'Gallus_gallus', 'aves'),
  ('GCF_000000012.1', 'Arxiozyma_heterogenica', 'fungi'))
SELECT acc AS accession, acc || '_ASM_genomic.gff.gz' AS gff, CASE WHEN s_acctbal > 0 THEN acc || '_ASM_protein.faa.gz' END AS faa,
  CAST(CASE WHEN s_nationkey < 5 THEN 1 ELSE 0 END AS BIGINT) AS copies, r.species IS NOT NULL AS registered, coalesce(r.species, acc) AS species,
  coalesce(r.clade, 'unknown') AS clade FROM s LEFT JOIN r USING (acc)""",
)
def discover_genomes(t):
    """Files grouped by accession; copies merged, unregistered accessions kept."""
    registry = literal_table(
        t.spark,
        [
            {"accession": "GCF_000000001.1", "species": "Danio_rerio", "clade": "actinopterygii"},
            {"accession": "GCF_000000007.1", "species": "Gallus_gallus", "clade": "aves"},
            {"accession": "GCF_000000012.1", "species": "Arxiozyma_heterogenica", "clade": "fungi"},
        ],
        "accession string, species string, clade string",
    )
    return S.discover_genomes(genome_files(t).select("name"), registry)


@query(
    "select_pairs",
    "J-21 T-02",
    """WITH c AS (SELECT 'GCF_' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '.1' AS accession, CAST(CASE WHEN s_nationkey < 5 THEN 2 ELSE 1 END AS BIGINT) AS gff_files,
   CAST(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS BIGINT) AS faa_files, s_suppkey, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal < 8000),
d AS (SELECT accession, gff_files, faa_files, CAST((gff_files + faa_files) * (1000 + s_nationkey) AS BIGINT) AS total_bytes,
   CASE WHEN faa_files = 0 THEN 'missing_mate' WHEN gff_files > 1 THEN 'ambiguous_paths' END AS skipped FROM c)
SELECT *, coalesce(skipped IS NULL AND accession = (SELECT accession FROM d WHERE skipped IS NULL ORDER BY total_bytes, accession LIMIT 1), false) AS selected FROM d""",
)
def select_pairs(t):
    """Complete source pairs among accessions in band, the smallest one selected."""
    name = F.col("name")
    accession = F.substring_index(F.replace(name, F.lit(" (1)"), F.lit("")), "_", 2)
    files = genome_files(t).where(~name.endswith("_report.txt")).select(
        accession.alias("accession"),
        F.when(name.contains("_protein.faa"), "faa").otherwise("gff").alias("kind"),
        name.alias("path"),
        (F.lit(1000) + F.col("s_nationkey")).cast("long").alias("size_bytes"),
    )
    report = t.supplier.select(
        F.concat(F.lit("GCF_"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.lit(".1")).alias("accession"),
        F.when(F.col("s_acctbal") < 8000, "in_band").otherwise("out_of_band").alias("band_verdict"),
    )
    return C.select_pairs(files, report)


@query(
    "publish_roundtrip",
    "SNK-04 SNK-01",
    """SELECT o_orderpriority, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys, true AS refused,
  (SELECT count(*) FROM orders) AS published_rows FROM orders GROUP BY o_orderpriority""",
)
def publish_roundtrip(t):
    """Publish once through staging; a second publish to the same place is refused."""
    path = scratch(t.spark, "publish")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    receipt = sinks.publish(rows, path)
    try:
        sinks.publish(rows, path)
        refused = False
    except FileExistsError:
        refused = True
    back = t.spark.read.parquet(path)
    return back.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys")).withColumns(
        {"refused": F.lit(refused), "published_rows": F.lit(receipt["rows"]).cast("long")}
    )


@query(
    "report_json",
    "SNK-01",
    """SELECT n_nationkey, n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def report_json(t):
    """A summary written as JSON lines and read back with its schema."""
    path = scratch(t.spark, "json")
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    report = t.nation.select("n_nationkey", "n_name").join(counts, "n_nationkey", "left").fillna(0, ["customers"])
    sinks.write_report(report, path, "json")
    return t.spark.read.schema("n_nationkey int, n_name string, customers long").json(path)
