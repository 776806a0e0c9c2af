"""Paired-variant queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import residues as R
from ..operators import features as G
from ..operators import reconcile as C
from ..operators import variants as V
from ..operators.hits import SOURCES
from ..operators.spread import ordinal
from .hits import ANY_SQL, FLAGS_SQL, flags
from .registry import query
from .sequences import SEQS, seqs


@query(
    "functional_variants",
    "C-15 J-08",
    f"""WITH {FLAGS_SQL}, q AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS rec, {ANY_SQL} AS a FROM flags)
SELECT c_nationkey, count(*) AS query_proteins, count(*) FILTER (a = 1 AND rec < 8) AS cleared_n, count(*) FILTER (a = 1 AND rec < 8) AS renamed_n, true AS equal_surface FROM q GROUP BY c_nationkey""",
)
def functional_variants(t):
    """Cleared content and renamed ids give the same coverage for different reasons."""
    table = flags(t).withColumn("query", F.concat(F.lit("c"), "c_custkey", F.lit(".t1")))
    queries = table.select("c_nationkey", "query")
    renamed_id = F.regexp_replace("query", r"\.t(\d+)$", ".transcript$1")
    cleared, renamed = V.functional_pair(
        table, ["c_nationkey"], ["c_custkey"], F.floor(F.col("c_custkey") / 4096), SOURCES, 8, renamed_id
    )
    return V.coverage_pair(queries, cleared, renamed, ["c_nationkey"], SOURCES)


@query(
    "structural_variants",
    "C-15 J-09",
    """WITH c AS (SELECT DISTINCT l_linestatus AS acc, l_partkey AS id FROM lineitem WHERE l_returnflag = 'R'), n AS (SELECT acc, count(*) AS n FROM c GROUP BY acc), p AS (SELECT count(*) AS p FROM part)
SELECT acc, 'original' AS variant, n AS linked, CAST(0 AS BIGINT) AS cds_protein_ids_without_sequence, p - n AS proteins_without_cds_id FROM n, p
UNION ALL SELECT acc, 'suffixed', 0, n, p FROM n, p""",
)
def structural_variants(t):
    """Protein links of the original models and of models with suffixed protein ids."""
    cds = t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_linestatus").alias("acc"),
        F.lit("CDS").alias("kind"),
        F.create_map(F.lit("protein_id"), F.col("l_partkey").cast("string"), F.lit("product"), F.lit("x")).alias("attrs"),
    )
    proteins = t.part.select(F.explode(F.array(F.lit("O"), F.lit("F"))).alias("acc"), F.col("p_partkey").cast("string").alias("id"))
    one = G.protein_links(cds, proteins, ["acc"]).withColumn("variant", F.lit("original"))
    two = G.protein_links(V.suffix_protein_ids(cds), proteins, ["acc"]).withColumn("variant", F.lit("suffixed"))
    return one.unionByName(two)


@query(
    "masking_variants",
    "C-15 PRJ-01 PRJ-02",
    rf"""WITH {SEQS}, w AS (SELECT doc_id, regexp_replace(seq, '[^A-Za-z]', '', 'g') AS seq FROM seqs), v AS (SELECT doc_id, 'soft' AS variant, seq, upper(seq) AS r FROM w
  UNION ALL SELECT doc_id, 'hard', regexp_replace(seq, '[a-z]', 'N', 'g'), upper(seq) FROM w)
SELECT doc_id, variant, length(seq) AS length, length(regexp_replace(seq, '[^a-z]', '', 'g')) AS lower_n, length(regexp_replace(seq, '[^Nn]', '', 'g')) AS gap_n,
  length(regexp_replace(seq, '[^a-zN]', '', 'g')) AS masked_n, upper(seq) = r AS sequence_equal_ignorecase FROM v""",
)
def masking_variants(t):
    """Soft and hard deliveries share their masked-site count."""
    rows = V.masking_pair(seqs(t).select("doc_id", F.regexp_replace("seq", "[^A-Za-z]", "").alias("seq")))
    return rows.select("doc_id", "variant", "length", "lower_n", "gap_n", "masked_n", "sequence_equal_ignorecase")


@query(
    "name_variants",
    "C-15 J-07",
    """SELECT c_nationkey AS acc, count(*) AS only_left, count(*) AS only_right, CAST(0 AS BIGINT) AS common, false AS consistent FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) GROUP BY 1""",
)
def name_variants(t):
    """Feature seqids moved to a new version share no name with the reference."""
    rows = t.customer.select(F.col("c_nationkey").alias("acc"), F.col("c_mktsegment").alias("seqid"))
    moved = V.rename_sequences(rows)
    left = rows.withColumnRenamed("seqid", "name")
    return C.reconcile_names(left, moved.withColumnRenamed("seqid", "name"), ["acc"])


@query(
    "layout_variants",
    "C-15 J-20",
    """SELECT outcome, count(*) AS n, CAST(max(200) AS BIGINT) AS difference FROM (SELECT DISTINCT l_orderkey, 'length_conflict' AS outcome FROM lineitem) GROUP BY outcome""",
)
def layout_variants(t):
    """Object ends shifted by 200 conflict with every sequence length."""
    agp = t.lineitem.select(
        F.concat(F.lit("o"), "l_orderkey").alias("object"),
        (F.col("l_linenumber") * 50).cast("long").alias("object_end"),
        F.lit(1).cast("long").alias("component_beg"),
        F.lit(50).cast("long").alias("component_end"),
    )
    lengths = agp.groupBy(F.col("object").alias("id")).agg(F.max("object_end").alias("length"))
    out = C.check_agp(V.shift_layout_end(agp), lengths)
    return out.groupBy("outcome").agg(F.count("*").alias("n"), F.max("difference").alias("difference"))


@query(
    "mate_variants",
    "C-15 J-10",
    """WITH n AS (SELECT o_orderpriority AS sample, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT sample, n, coalesce(lead(sample) OVER (ORDER BY sample), min(sample) OVER ()) AS other FROM n)
SELECT s.sample, greatest(s.n, o.n) AS positions, CAST(0 AS BIGINT) AS matching, abs(s.n - o.n) AS unpaired, CAST(0 AS BIGINT) AS first_mismatch FROM s JOIN n o ON o.sample = s.other""",
)
def mate_variants(t):
    """First mates of one sample against second mates of the next: nothing matches by position."""
    rows = ordinal(
        t.orders.select(F.col("o_orderpriority").alias("sample"), "o_orderkey"), ["sample"], ["o_orderkey"],
        F.floor(F.col("o_orderkey") / 4096),
    )
    r1 = rows.withColumn("header", F.concat(F.lit("@"), "o_orderkey", F.lit("/1")))
    r2 = rows.withColumn("header", F.concat(F.lit("@"), "o_orderkey", F.lit("/2")))
    a, b = V.swap_mates(r1, r2, "sample")
    return C.mate_concordance(a, b, ["sample"])


@query(
    "older_database_variant",
    "C-15",
    """SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN '3.0' ELSE '3.' || s_nationkey END AS database_version, round(s_acctbal, 2) AS masked_pct,
  s_nationkey % 2 = 0 AND s_nationkey <> 0 AS differs FROM supplier""",
)
def older_database_variant(t):
    """Half of the deliveries recorded with an older database; their mask statistics stay."""
    even = F.col("s_nationkey") % 2 == 0
    rows = t.supplier.select(
        "s_suppkey",
        "s_nationkey",
        F.concat(F.lit("3."), "s_nationkey").alias("database_version"),
        F.round("s_acctbal", 2).alias("masked_pct"),
    ).withColumn("recorded", F.col("database_version"))
    both = V.older_database(rows.where(even)).unionByName(rows.where(~even))
    differs = F.col("database_version") != F.col("recorded")
    return both.select("s_suppkey", "database_version", "masked_pct", differs.alias("differs"))


@query(
    "without_evidence_variant",
    "C-15",
    """SELECT l_orderkey, count(*) AS hints, CAST(0 AS BIGINT) AS kept FROM lineitem GROUP BY l_orderkey""",
)
def without_evidence_variant(t):
    """Hints of every order before and after their table was emptied."""
    hints = t.lineitem.select("l_orderkey", "l_linenumber")
    left = V.without_evidence(hints).groupBy("l_orderkey").agg(F.count("*").alias("kept"))
    before = hints.groupBy("l_orderkey").agg(F.count("*").alias("hints"))
    return before.join(left, "l_orderkey", "left").fillna(0, ["kept"])
