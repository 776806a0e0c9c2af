"""Hit-table queries: order = query, line = hit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hits as H
from ..plans.annotation import integrate
from ..session import scratch
from ..sources import tables as T
from .registry import query

HITS_SQL = """hits AS (SELECT 'q' || l_orderkey AS qseqid, 's' || l_partkey || '_' || l_linenumber AS sseqid, l_partkey,
  l_extendedprice AS bitscore, l_discount AS evalue, l_quantity * 2 AS qcovhsp, l_tax * 100 AS scovhsp,
  CASE l_linestatus || l_returnflag WHEN 'OR' THEN 'Nr' WHEN 'OA' THEN 'Swissprot' WHEN 'ON' THEN 'KEGG' WHEN 'FR' THEN 'KOG'
    ELSE 'TrEMBL' END AS source FROM lineitem)"""


def hits(t):
    tag = F.concat("l_linestatus", "l_returnflag")
    return t.lineitem.select(
        F.concat(F.lit("q"), "l_orderkey").alias("qseqid"),
        F.concat(F.lit("s"), "l_partkey", F.lit("_"), "l_linenumber").alias("sseqid"),
        "l_partkey",
        F.col("l_extendedprice").alias("bitscore"),
        F.col("l_discount").alias("evalue"),
        (F.col("l_quantity") * 2).alias("qcovhsp"),
        (F.col("l_tax") * 100).alias("scovhsp"),
        F.when(tag == "OR", "Nr").when(tag == "OA", "Swissprot").when(tag == "ON", "KEGG").when(tag == "FR", "KOG")
        .otherwise("TrEMBL").alias("source"),
    )


BEST_SQL = """best AS (SELECT * FROM hits WHERE qcovhsp >= 50
  QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, evalue, qcovhsp DESC, sseqid DESC) = 1)"""


@query("best_hit", "W-01 PRJ-08", f"WITH {HITS_SQL}, {BEST_SQL} SELECT qseqid, sseqid, bitscore, evalue, qcovhsp FROM best")
def best_hit(t):
    """Best filtered hit of every query."""
    return H.best_hit(H.filter_hits(hits(t)), keep=["sseqid", "bitscore", "evalue", "qcovhsp"])


NEAR_SQL = """near AS (SELECT qseqid, any_value(top) AS top, count(*) AS close, count(DISTINCT sseqid) AS subjects FROM (
  SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS top FROM hits WHERE qcovhsp >= 50)
  WHERE bitscore >= top * (1 - 0.05) GROUP BY qseqid)"""


@query("near_top", "W-02", f"WITH {HITS_SQL}, {NEAR_SQL} SELECT qseqid, top, close, close > 1 AS ambiguous FROM near")
def near_top(t):
    """Queries with several hits within five percent of their best score."""
    return H.near_top(H.filter_hits(hits(t)))


@query("near_top_subjects", "W-02", f"WITH {HITS_SQL}, {NEAR_SQL} SELECT qseqid, top, subjects AS close, subjects > 1 AS ambiguous FROM near")
def near_top_subjects(t):
    """The same by different subjects."""
    return H.near_top(H.filter_hits(hits(t)), unit="subjects")


@query(
    "annotate_best",
    "J-01 SRC-07",
    f"""WITH {HITS_SQL}, {BEST_SQL}, a AS (SELECT 's' || p_partkey || '_' || n AS id, p_name AS annot
  FROM part, (VALUES (1), (2), (3), (4), (5), (6), (7)) v(n) WHERE p_size > 10)
SELECT qseqid, sseqid, coalesce(annot, '') AS annot, a.id IS NOT NULL AS annotated FROM best LEFT JOIN a ON a.id = sseqid""",
)
def annotate_best(t):
    """Best hits with subject descriptions; small parts have none."""
    annot = t.part.where("p_size > 10").select(
        F.explode(F.array(*[F.concat(F.lit("s"), "p_partkey", F.lit(f"_{n}")) for n in range(1, 8)])).alias("id"),
        F.col("p_name").alias("annot"),
    )
    best = H.best_hit(H.filter_hits(hits(t)), keep=["sseqid"])
    return H.annotate_best(best, annot).select("qseqid", "sseqid", "annot", "annotated")


@query(
    "annot_missing_ids",
    "J-01",
    f"""WITH {HITS_SQL}, {BEST_SQL} SELECT count(DISTINCT sseqid) AS annot_missing_ids FROM best
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)""",
)
def annot_missing_ids(t):
    """Distinct best subjects no annotation row describes."""
    best = H.best_hit(H.filter_hits(hits(t)), keep=["sseqid", "l_partkey"])
    known = t.part.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("k"))
    marked = best.join(known, "l_partkey", "left").withColumn("annotated", F.coalesce("k", F.lit(False)))
    return H.missing_annotations(marked)


@query(
    "read_hits",
    "SRC-05 PRJ-08",
    """SELECT l_returnflag AS pident, count(*) AS n, round(sum(l_extendedprice), 2) AS bitscore_sum,
  round(sum(l_discount), 4) AS evalue_sum, count(*) FILTER (l_quantity >= 25) AS covered
FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'O') GROUP BY l_returnflag""",
)
def read_hits(t):
    """Lines as a 17-column hit file; open unreturned lines are one column short and skipped."""
    path = scratch(t.spark, "hits")
    cells = [
        F.concat(F.lit("q"), "l_orderkey"), F.concat(F.lit("s"), "l_partkey"), F.col("l_returnflag"),
        *[F.lit("1")] * 7, F.col("l_discount").cast("string"), F.col("l_extendedprice").cast("string"),
        F.lit("9"), F.lit("9"), F.col("l_quantity").cast("string"), F.col("l_tax").cast("string"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), None).otherwise(F.lit('title "quoted" text')),
    ]
    t.lineitem.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)
    rows = T.read_hits(t.spark, path)
    return rows.groupBy("pident").agg(
        F.count("*").alias("n"),
        F.round(F.sum("bitscore"), 2).alias("bitscore_sum"),
        F.round(F.sum("evalue"), 4).alias("evalue_sum"),
        F.count_if(F.col("qcovhsp") >= 25).alias("covered"),
    )


DOMAIN_ROWS_SQL = """dom AS (SELECT 'q' || l_orderkey AS protein,
  CASE WHEN l_returnflag <> 'N' THEN 'IPR' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS ipr,
  CASE WHEN l_linestatus = 'O' THEN 'GO:' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') END AS go1,
  CASE WHEN l_linestatus = 'O' THEN 'GO:' || lpad(CAST(l_linenumber AS VARCHAR), 7, '0') END AS go2 FROM lineitem)"""


def domain_lines(t):
    number = F.lpad(F.col("l_partkey").cast("string"), 6, "0")
    go = F.concat(
        F.lit("GO:"), F.lpad(F.col("l_suppkey").cast("string"), 7, "0"),
        F.lit("(x)|GO:"), F.lpad(F.col("l_linenumber").cast("string"), 7, "0"),
    )
    return t.lineitem.select(
        F.concat_ws(
            "\t",
            F.concat(F.lit("q"), "l_orderkey"),
            F.lit("md5"),
            F.when(F.col("l_returnflag") != "N", F.concat(F.lit("IPR"), number)),
            F.lit("-"),
            F.when(F.col("l_linestatus") == "O", go),
        ).alias("value")
    )


DOMAIN_SETS_SQL = """sets AS (SELECT protein, coalesce(string_agg(DISTINCT ipr, ';' ORDER BY ipr), '') AS ipr_list, count(DISTINCT ipr) AS n_ipr
  FROM dom GROUP BY protein),
gos AS (SELECT protein, string_agg(DISTINCT g, ';' ORDER BY g) AS go_list, count(DISTINCT g) AS n_go
  FROM (SELECT protein, go1 AS g FROM dom UNION ALL SELECT protein, go2 FROM dom) WHERE g IS NOT NULL GROUP BY protein)"""


def _domains(t, label):
    path = scratch(t.spark, label)
    domain_lines(t).write.text(path)
    return T.read_domains(t.spark, path)


@query(
    "domain_sets",
    "SRC-06 A-07",
    f"""WITH {DOMAIN_ROWS_SQL}, {DOMAIN_SETS_SQL} SELECT protein, ipr_list, coalesce(go_list, '') AS go_list,
  n_ipr AS ipr_n, coalesce(n_go, 0) AS go_n FROM sets LEFT JOIN gos USING (protein)""",
)
def domain_sets(t):
    """Domain and term sets per protein from ragged rows, found by content."""
    sets = H.domain_sets(_domains(t, "domains"))
    return sets.select(
        "protein",
        F.array_join("domains", ";").alias("ipr_list"),
        F.array_join("terms", ";").alias("go_list"),
        F.size("domains").cast("long").alias("ipr_n"),
        F.size("terms").cast("long").alias("go_n"),
    )


@query(
    "protein_terms",
    "A-07 T-03",
    f"""WITH {DOMAIN_ROWS_SQL} SELECT DISTINCT protein, g AS term FROM
  (SELECT protein, go1 AS g FROM dom UNION ALL SELECT protein, go2 FROM dom) WHERE g IS NOT NULL ORDER BY protein, term""",
)
def protein_terms(t):
    """Distinct protein-term pairs in report order."""
    return H.protein_terms(_domains(t, "terms")).orderBy("protein", "term")


@query(
    "read_id_annotation",
    "SRC-07 T-03",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || chr(9) || p_brand AS annot FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) ORDER BY id""",
)
def read_id_annotation(t):
    """Annotation scan limited to the subjects in use."""
    path = scratch(t.spark, "annot")
    t.part.select(F.concat_ws("\t", "p_partkey", "p_name", "p_brand").alias("value")).write.text(path)
    keys = t.lineitem.where("l_quantity = 50").select(F.col("l_partkey").cast("string").alias("sseqid"))
    return T.read_id_annotation(t.spark, path, keys).orderBy("id")


FLAGS_SQL = """flags AS (SELECT c_custkey, c_nationkey,
  CAST(bool_or(coalesce(o_orderpriority = '1-URGENT', false)) AS INT) AS "Nr", CAST(bool_or(coalesce(o_orderpriority = '2-HIGH' AND o_totalprice > 250000, false)) AS INT) AS "Swissprot",
  CAST(bool_or(coalesce(o_orderpriority = '3-MEDIUM' AND o_totalprice > 400000, false)) AS INT) AS "KEGG",
  CAST(bool_or(coalesce(o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice > 450000, false)) AS INT) AS "KOG",
  CAST(bool_or(coalesce(o_orderpriority = '5-LOW' AND o_totalprice > 475000, false)) AS INT) AS "TrEMBL",
  CAST(any_value(c_mktsegment = 'BUILDING') AS INT) AS "Interpro", CAST(any_value(c_acctbal < 0) AS INT) AS "GO"
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey)"""


def flags(t):
    bars = {"Nr": ("1-URGENT", 0), "Swissprot": ("2-HIGH", 250000), "KEGG": ("3-MEDIUM", 400000),
            "KOG": ("4-NOT SPECIFIED", 450000), "TrEMBL": ("5-LOW", 475000)}
    seen = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        *[
            F.max(((F.col("o_orderpriority") == p) & (F.col("o_totalprice") > bar)).cast("int")).alias(name)
            for name, (p, bar) in bars.items()
        ]
    )
    rows = t.customer.join(seen, "c_custkey", "left").fillna(0, list(bars))
    return rows.select(
        "c_custkey",
        "c_nationkey",
        *bars,
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("Interpro"),
        (F.col("c_acctbal") < 0).cast("int").alias("GO"),
    )


STAT_COLUMNS = ", ".join(
    f"""CAST(sum("{c}") AS BIGINT) AS "{c}_n", round(100.0 * sum("{c}") / count(*), 2) AS "{c}_pct" """ for c in H.SOURCES
)
ANY_SQL = "greatest(" + ", ".join(f'"{c}"' for c in H.SOURCES) + ")"


@query(
    "annotation_stats",
    "A-08",
    f"""WITH {FLAGS_SQL} SELECT c_nationkey, count(*) AS total_queries, {STAT_COLUMNS}, CAST(sum({ANY_SQL}) AS BIGINT) AS any_n,
  round(100.0 * sum({ANY_SQL}) / count(*), 2) AS any_pct, CAST(count(*) - sum({ANY_SQL}) AS BIGINT) AS none_n
FROM flags GROUP BY c_nationkey""",
)
def annotation_stats(t):
    """Seven-flag statistics per query set, over all queries."""
    return H.annotation_stats(flags(t), ["c_nationkey"])


@query(
    "annotation_overlap",
    "A-09 T-03",
    f"""WITH {FLAGS_SQL} SELECT {", ".join(f'"{c}"' for c in H.SOURCES)}, count(*) AS count FROM flags
GROUP BY {", ".join(f'"{c}"' for c in H.SOURCES)}""",
)
def annotation_overlap(t):
    """Queries per flag combination."""
    return H.annotation_overlap(flags(t)).orderBy(*H.SOURCES)


@query(
    "coverage",
    "J-08",
    f"""WITH {FLAGS_SQL}, tab AS (SELECT c_nationkey, CASE WHEN "TrEMBL" = 1 THEN c_custkey || '.transcript' ELSE CAST(c_custkey AS VARCHAR) END AS query,
   {ANY_SQL} AS a FROM flags),
q AS (SELECT c_nationkey, CAST(c_custkey AS VARCHAR) AS query FROM customer)
SELECT q.c_nationkey, count(*) AS query_proteins, count(*) FILTER (tab.a = 1) AS annotated_query_proteins,
  count(*) AS annotation_rows, CAST(0 AS BIGINT) AS repeated_ids,
  round(100.0 * count(*) FILTER (tab.a = 1) / count(*), 6) AS annotation_coverage_pct
FROM q LEFT JOIN tab ON tab.c_nationkey = q.c_nationkey AND tab.query = q.query GROUP BY q.c_nationkey""",
)
def coverage(t):
    """Exact-id coverage when some annotation rows carry renamed ids."""
    ident = F.col("c_custkey").cast("string")
    table = flags(t).withColumn(
        "query", F.when(F.col("TrEMBL") == 1, F.concat(ident, F.lit(".transcript"))).otherwise(ident)
    )
    queries = t.customer.select("c_nationkey", ident.alias("query"))
    return H.coverage(queries, table, ["c_nationkey"], H.SOURCES)


INTEGRATED_SQL = f"""{HITS_SQL}, {DOMAIN_ROWS_SQL}, {DOMAIN_SETS_SQL},
k AS (SELECT * FROM hits WHERE qcovhsp >= 90),
seen AS (SELECT qseqid AS query, {", ".join(f"max(CASE WHEN source = '{s}' THEN 1 ELSE 0 END) AS \"{s}\"" for s in H.HIT_SOURCES)}
  FROM k GROUP BY qseqid),
m AS (SELECT 'q' || o_orderkey AS query, {", ".join(f'coalesce("{s}", 0) AS "{s}"' for s in H.HIT_SOURCES)},
  CAST(coalesce(n_ipr, 0) > 0 AS INT) AS "Interpro", CAST(coalesce(n_go, 0) > 0 AS INT) AS "GO",
  coalesce(ipr_list, '') AS ipr_list, coalesce(go_list, '') AS go_list
  FROM orders LEFT JOIN seen ON seen.query = 'q' || o_orderkey LEFT JOIN sets ON sets.protein = 'q' || o_orderkey
  LEFT JOIN gos ON gos.protein = 'q' || o_orderkey)"""


def _integration(t):
    proteins = t.orders.select(
        F.concat(F.lit("q"), "o_orderkey").alias("id"),
        F.concat(F.regexp_replace("o_orderpriority", "[^A-Z]", ""), F.when(F.col("o_orderstatus") == "P", "*M*").otherwise("*")).alias("seq"),
    )
    rows = hits(t)
    annotations = t.part.where("p_size > 10").select(
        F.explode(F.array(*[F.lit(s) for s in H.HIT_SOURCES])).alias("source"), "p_partkey", "p_name"
    ).select(
        "source",
        F.explode(F.array(*[F.concat(F.lit("s"), "p_partkey", F.lit(f"_{n}")) for n in range(1, 8)])).alias("id"),
        F.col("p_name").alias("annot"),
    )
    return integrate(proteins, rows, annotations, _domains(t, "integrate"), qcov=90.0)


@query(
    "functional_flags",
    "C-04 A-07 W-01",
    f"WITH {INTEGRATED_SQL} SELECT * FROM m",
)
def functional_flags(t):
    """Integrated seven-flag table of every query."""
    return _integration(t).flags


@query(
    "functional_hit_report",
    "C-04 J-01 W-02",
    f"""WITH {HITS_SQL}, k AS (SELECT * FROM hits WHERE qcovhsp >= 90),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY source, qseqid ORDER BY bitscore DESC, evalue, qcovhsp DESC, sseqid DESC) = 1),
n AS (SELECT source, qseqid, count(*) AS close FROM (SELECT *, max(bitscore) OVER (PARTITION BY source, qseqid) AS top FROM k)
  WHERE bitscore >= top * (1 - 0.05) GROUP BY source, qseqid),
f AS (SELECT source, count(*) AS filtered_rows FROM k GROUP BY source),
g AS (SELECT b.source, count(*) AS filtered_queries, count(*) FILTER (b.source IN ('KEGG', 'KOG') AND close > 1) AS ambiguous_queries
  FROM b JOIN n ON n.source = b.source AND n.qseqid = b.qseqid GROUP BY b.source),
x AS (SELECT source, count(DISTINCT sseqid) FILTER (NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)) AS annot_missing_ids
  FROM b GROUP BY source)
SELECT source, filtered_rows, filtered_queries, ambiguous_queries, annot_missing_ids FROM f JOIN g USING (source) JOIN x USING (source)""",
)
def functional_hit_report(t):
    """Filtered rows, queries, ambiguous queries and missing annotations per source."""
    return _integration(t).hit_report


@query(
    "functional_statistics",
    "C-04 A-08",
    f"""WITH {INTEGRATED_SQL} SELECT count(*) AS total_queries, {STAT_COLUMNS}, CAST(sum({ANY_SQL}) AS BIGINT) AS any_n,
  round(100.0 * sum({ANY_SQL}) / count(*), 2) AS any_pct, CAST(count(*) - sum({ANY_SQL}) AS BIGINT) AS none_n FROM m""",
)
def functional_statistics(t):
    return _integration(t).statistics


@query(
    "validate_integration",
    "A-10 C-04",
    """SELECT true AS all_queries_one_row, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS queries,
  true AS seven_flags_complete, true AS denominator_is_total, 'PASS' AS status FROM orders""",
)
def validate_integration(t):
    """Self-checks of the integrated table."""
    return _integration(t).checks


@query(
    "quarantined_proteins",
    "C-04 PRJ-03",
    """SELECT 'q' || o_orderkey AS id, CAST(1 AS BIGINT) AS internal_ambiguity FROM orders WHERE o_orderstatus = 'P'""",
)
def quarantined_proteins(t):
    """Every protein set aside for interior ambiguity."""
    return _integration(t).quarantined


@query(
    "preview_quarantined",
    "T-01 C-04",
    """SELECT 'q' || o_orderkey AS id, CAST(1 AS BIGINT) AS internal_ambiguity FROM orders WHERE o_orderstatus = 'P'
ORDER BY o_orderkey LIMIT 20""",
)
def preview_quarantined(t):
    """The first twenty of them by order number: a report for people."""
    bad = _integration(t).quarantined
    return bad.orderBy(F.regexp_replace("id", "^q", "").cast("long")).limit(20)
