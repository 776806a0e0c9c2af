"""Feature-graph queries over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import attributes as A
from ..operators import features as G
from ..operators.spread import preview, quarantine
from ..plans import export
from ..session import materialize, scratch
from ..sources import features as X
from ..sources import sinks
from . import star
from .registry import query
from .star import STAR_SQL

SUMMARY_SQL = f"""WITH {STAR_SQL},
loci AS (SELECT acc, count(DISTINCT fid) AS gff_gene_loci FROM genes GROUP BY acc),
cg AS (SELECT acc, count(DISTINCT gene) AS coding_genes FROM coding GROUP BY acc),
lf AS (SELECT acc, count(*) FILTER (kind = 'CDS') AS cds_features, count(*) FILTER (kind = 'exon') AS exon_features
  FROM leaf0 GROUP BY acc),
tn AS (SELECT acc, count(*) AS n FROM tx GROUP BY acc),
models AS (SELECT acc, cds_features, exon_features, gff_gene_loci, coding_genes,
  greatest(gff_gene_loci - coding_genes, 0) AS noncoding_genes, round(n * 1.0 / coding_genes, 3) AS isoforms_per_gene
FROM loci LEFT JOIN cg USING (acc) LEFT JOIN lf USING (acc) LEFT JOIN tn USING (acc))"""


def _gff_attributes():
    return F.concat_ws(
        ";",
        F.when(F.col("fid").isNotNull(), F.concat(F.lit("ID="), "fid")),
        F.when(F.size("parents") > 0, F.concat(F.lit("Parent="), F.array_join("parents", ","))),
        F.when(F.col("protein_id").isNotNull(), F.concat(F.lit("protein_id="), "protein_id")),
        F.lit("Note=a%20b+c"),
    )


def _write_star_gff(t, label: str, features) -> str:
    path = scratch(t.spark, label)
    rows = features.select(
        F.concat(F.lit("chr"), "acc").alias("seqid"),
        F.lit("star").alias("source"),
        "kind",
        "start",
        "end",
        F.lit(None).cast("string").alias("score"),
        F.lit("+").alias("strand"),
        F.lit(None).cast("string").alias("phase"),
        "fid",
        "parents",
        "protein_id",
    )
    line = sinks.gff3_line(_gff_attributes())
    regions = t.nation.select(F.concat(F.lit("##sequence-region chr"), "n_nationkey", F.lit(" 1 900000")).alias("raw"))
    sinks.write_gff3(rows, path, line, ["seqid", "start", "kind"], regions)
    return path


@query(
    "gff_roundtrip",
    "SRC-02 SNK-02 PRJ-06 A-01",
    f"""WITH {STAR_SQL}, f AS (
  SELECT acc, 'gene' AS kind, 0 AS parents, s, e, 1 AS named FROM genes
  UNION ALL SELECT acc, kind, 1, s, e, 1 FROM tx
  UNION ALL SELECT acc, kind, CASE WHEN kind = 'exon' AND l_linestatus = 'O' THEN 2 ELSE 1 END, s, e, 0 FROM leaf0)
SELECT 'chr' || acc AS seqid, kind, count(*) AS n, CAST(sum(parents) AS BIGINT) AS parents, CAST(sum(s) AS BIGINT) AS start_sum,
  CAST(sum(e) AS BIGINT) AS end_sum, CAST(sum(named) AS BIGINT) AS named, count(*) AS notes FROM f GROUP BY acc, kind""",
)
def gff_roundtrip(t):
    """The star schema written as GFF3 with directives and read back."""
    rows = X.read_gff3(t.spark, _write_star_gff(t, "gff", star.features(t)))
    return rows.groupBy("seqid", "kind").agg(
        F.count("*").alias("n"),
        F.sum(F.size("parents").cast("long")).alias("parents"),
        F.sum("start").alias("start_sum"),
        F.sum("end").alias("end_sum"),
        F.count("fid").alias("named"),
        F.count_if(A.decode(F.col("attrs")["Note"]) == "a b+c").alias("notes"),
    )


@query(
    "sequence_regions",
    "SRC-02 SNK-02",
    """SELECT 'chr' || n_nationkey AS seqid, CAST(1 AS BIGINT) AS start, CAST(900000 AS BIGINT) AS "end" FROM nation""",
)
def sequence_regions(t):
    """Sequence-region directives survive the round trip."""
    return X.read_regions(t.spark, _write_star_gff(t, "regions", star.genes(t))).select("seqid", "start", "end")


@query(
    "parse_attributes",
    "PRJ-06",
    """SELECT event_id, 'e' || event_id AS fid, 2 AS parents, 'u ' || user_id AS first_parent, event_type AS kind,
  CAST(value AS VARCHAR) <> '' AS has_value, true AS repeated FROM events""",
)
def parse_attributes(t):
    """Attribute text to map and decoded parent list; a repeated key is flagged and the last one wins."""
    text = F.concat(
        F.lit("ID=e"), "event_id", F.lit(";Parent=u%20"), "user_id", F.lit(",x%2Cy;kind=first;value="),
        F.col("value").cast("string"), F.lit(";kind="), "event_type", F.lit(";flag"),
    )
    rows = t.events.select("event_id", text.alias("text")).withColumn("attrs", A.attribute_map("text"))
    parents = A.parent_list(F.col("attrs"))
    return rows.select(
        "event_id",
        A.decode(F.col("attrs")["ID"]).alias("fid"),
        F.size(parents).alias("parents"),
        parents[0].alias("first_parent"),
        F.col("attrs")["kind"].alias("kind"),
        (F.col("attrs")["value"] != "").alias("has_value"),
        A.bad_attributes("text").alias("repeated"),
    )


GTF_SQL = """g AS (SELECT o_orderstatus AS src, o_orderpriority AS p, 'g' || o_custkey AS gid FROM orders),
r AS (SELECT src, CASE WHEN p = '1-URGENT' THEN gid WHEN p = '2-HIGH' THEN gid WHEN p = '3-MEDIUM' THEN gid
    WHEN p = '4-NOT SPECIFIED' THEN gid END AS gene_id,
  CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'gene_id_attribute' WHEN p = '3-MEDIUM' THEN 'gene_feature_ID'
    WHEN p = '4-NOT SPECIFIED' THEN 'bare_gene_feature_ID' END AS format,
  p IN ('3-MEDIUM', '4-NOT SPECIFIED') AS is_gene FROM g)"""


@query(
    "gtf_gene_summary",
    "SRC-03 A-12",
    f"""WITH {GTF_SQL} SELECT src, count(*) FILTER (is_gene) AS gene_feature_records,
  count(*) FILTER (gene_id IS NULL) AS rows_without_gene_id, CAST(0 AS BIGINT) AS problem_rows,
  string_agg(DISTINCT format, ';' ORDER BY format) AS gene_id_formats, count(DISTINCT gene_id) AS unique_gene_ids
FROM r GROUP BY src""",
)
def gtf_gene_summary(t):
    """Orders as GTF rows in every spelling of a gene identifier."""
    gid = F.concat(F.lit("g"), "o_custkey")
    p = F.col("o_orderpriority")
    attributes = (
        F.when(p == "1-URGENT", F.concat(F.lit('gene_id "'), gid, F.lit('"; transcript_id "t"')))
        .when(p == "2-HIGH", F.concat(F.lit("transcript_id t1; gene_id "), gid, F.lit(";")))
        .when(p == "3-MEDIUM", F.concat(F.lit("ID="), gid, F.lit(";Name=x")))
        .when(p == "4-NOT SPECIFIED", F.concat(gid, F.lit(";")))
        .otherwise(F.lit('transcript_id "t9"'))
    )
    kind = F.when(p.isin("3-MEDIUM", "4-NOT SPECIFIED"), "gene").otherwise("CDS")
    path = scratch(t.spark, "gtf")
    line = F.concat_ws(
        "\t", "o_orderstatus", F.lit("src"), kind, F.lit("1"), F.lit("9"), F.lit("."), F.lit("+"), F.lit("."), attributes
    )
    t.orders.select(line.alias("value")).write.text(path)
    rows = X.read_gtf(t.spark, path).withColumnRenamed("seqid", "src")
    return G.gtf_gene_summary(rows, ["src"])


@query(
    "feature_census",
    "A-01",
    f"""WITH {STAR_SQL} SELECT acc, kind, count(*) AS n FROM (SELECT acc, 'gene' AS kind FROM genes
  UNION ALL SELECT acc, kind FROM tx UNION ALL SELECT acc, kind FROM leaf0) GROUP BY acc, kind""",
)
def feature_census(t):
    return G.feature_census(star.features(t), ["acc"])


@query(
    "coding_genes",
    "J-02",
    f"WITH {STAR_SQL} SELECT acc, gene, count(DISTINCT tx) AS coding_transcripts FROM coding GROUP BY acc, gene",
)
def coding_genes(t):
    return G.coding_genes(star.features(t), ["acc"])


@query("gene_model_summary", "A-02 J-02", f"{SUMMARY_SQL} SELECT * FROM models")
def gene_model_summary(t):
    return G.gene_model_summary(star.features(t), ["acc"])


@query(
    "coding_residue_rule",
    "A-06 J-02",
    f"""WITH {STAR_SQL}, g AS (SELECT acc, count(*) AS gene_total FROM genes GROUP BY acc),
c AS (SELECT acc, count(DISTINCT gene) AS gene_with_coding_transcript FROM coding GROUP BY acc)
SELECT acc, gene_total, gene_with_coding_transcript,
  CASE WHEN gene_with_coding_transcript > 0 AND gene_total > gene_with_coding_transcript * 1.05 THEN 'gap' ELSE 'ok' END AS outcome
FROM g LEFT JOIN c USING (acc)""",
)
def coding_residue_rule(t):
    return G.coding_residue_rule(star.features(t), ["acc"])


@query(
    "dangling_parents",
    "J-05",
    f"""WITH {STAR_SQL}, ids AS (SELECT acc, fid, 'gene' AS k FROM genes UNION ALL SELECT acc, fid, 'tx' FROM tx),
links AS (SELECT acc, kind, CASE WHEN kind = 'intron' AND s > 600 THEN 'g' || l_partkey ELSE parent END AS parent FROM leaf
  UNION ALL SELECT acc, kind, CASE WHEN kind = 'transcript' THEN 't' || o_custkey ELSE gene END FROM tx)
SELECT links.acc, kind, parent, count(*) AS n, CASE WHEN ids.k IS NULL THEN 'unknown_parent'
    WHEN kind IN ('exon', 'CDS', 'intron') THEN 'leaf_parent_not_transcript' ELSE 'transcript_parent_not_gene' END AS reason
FROM links LEFT JOIN ids ON ids.acc = links.acc AND ids.fid = links.parent
WHERE ids.k IS NULL OR (kind IN ('exon', 'CDS', 'intron') AND ids.k <> 'tx') OR (kind IN ('mRNA', 'transcript') AND ids.k <> 'gene')
GROUP BY links.acc, kind, parent, ids.k""",
)
def dangling_parents(t):
    """Unresolved references in a damaged graph: late introns hang on genes, some transcripts on transcripts."""
    rows = star.features(t)
    late = (F.col("kind") == "intron") & (F.col("start") > 600)
    parents = (
        F.when(late, F.array(F.regexp_replace("protein_id", "^p", "g")))
        .when(F.col("kind") == "transcript", F.transform("parents", lambda p: F.regexp_replace(p, "^g", "t")))
        .otherwise(F.col("parents"))
    )
    return G.dangling_parents(rows.withColumn("parents", parents), ["acc"], counted=True)


@query(
    "ancestors",
    "J-03",
    """WITH x AS (SELECT r_name, 'r' || r_regionkey AS root, count(*) AS leaves, count(DISTINCT o_orderkey) AS parents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT root AS ancestor, leaves, parents FROM x""",
)
def ancestors(t):
    """Fourteen-level climb: lineitem to order, customer, nine groups of a nation, nation and region."""
    none = F.lit(None).cast("string")

    def node(df, kind, fid, parent):
        return df.select(
            F.lit("all").alias("acc"),
            F.lit(kind).alias("kind"),
            (fid if fid is None else fid).alias("fid") if fid is not None else none.alias("fid"),
            (F.array(parent) if parent is not None else F.array().cast("array<string>")).alias("parents"),
        )

    def tag(prefix, col):
        return F.concat(F.lit(prefix), F.col(col))

    def step(i):
        return F.concat(F.lit("s"), F.col("n_nationkey"), F.lit("_"), i)

    steps = t.nation.select("n_nationkey", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("i"))
    graph = (
        node(t.region, "root", tag("r", "r_regionkey"), None)
        .unionByName(node(t.nation, "branch", tag("n", "n_nationkey"), tag("r", "n_regionkey")))
        .unionByName(node(steps, "branch", step(F.col("i")), F.when(F.col("i") < 9, step(F.col("i") + 1)).otherwise(tag("n", "n_nationkey"))))
        .unionByName(node(t.customer, "gene", tag("g", "c_custkey"), F.concat(F.lit("s"), "c_nationkey", F.lit("_1"))))
        .unionByName(node(t.orders, "mRNA", tag("t", "o_orderkey"), tag("g", "o_custkey")))
        .unionByName(node(t.lineitem, "CDS", None, tag("t", "l_orderkey")))
    )
    found = G.ancestors(graph, ["acc"], stop_kind="root")
    return found.groupBy("ancestor").agg(F.count("*").alias("leaves"), F.count_distinct("parent").alias("parents"))


@query(
    "longest_per_gene",
    "W-03",
    """WITH m AS (SELECT o_custkey AS gene, o_orderkey AS tx, count(*) AS len FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY ALL)
SELECT gene, tx, len FROM m QUALIFY row_number() OVER (PARTITION BY gene ORDER BY len DESC, tx) = 1""",
)
def longest_per_gene(t):
    """Longest transcript (most leaves) of each gene, ties by smallest id."""
    return G.longest_per_gene(_models(t).drop("acc"), [], "gene", "tx", "len")


def _models(t):
    sizes = t.lineitem.groupBy(F.col("l_orderkey").alias("tx")).agg(F.count("*").alias("len"))
    owner = t.customer.select(F.col("c_custkey").alias("gene"), F.col("c_nationkey").alias("acc"))
    return (
        t.orders.select(F.col("o_orderkey").alias("tx"), F.col("o_custkey").alias("gene"))
        .join(sizes, "tx")
        .join(owner, "gene")
        .select("acc", "gene", "tx", "len")
    )


@query(
    "longest_delivery",
    "C-03 W-03 A-13",
    """WITH m AS (SELECT c_nationkey AS acc, o_custkey AS gene, o_orderkey AS tx, count(*) AS len
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY acc, gene ORDER BY len DESC, tx) = 1)
SELECT acc, count(DISTINCT gene) AS genes_before, any_value(n) AS genes_after, count(DISTINCT gene) - any_value(n) AS lost,
  count(DISTINCT gene) = any_value(n) AS preserved, any_value(total) AS total_length, any_value(longest) AS longest
FROM m JOIN (SELECT acc, count(*) AS n, CAST(sum(len) AS BIGINT) AS total, max(len) AS longest FROM b GROUP BY acc) USING (acc)
GROUP BY acc""",
)
def longest_delivery(t):
    """Longest-isoform delivery per accession with its preservation check."""
    return export.longest_delivery(_models(t), ["acc"], "gene", "tx", "len")


@query(
    "check_preserved",
    "A-13",
    """SELECT c_nationkey AS acc, count(*) AS genes_before, count(*) FILTER (has) AS genes_after,
  count(*) FILTER (NOT has) AS lost, bool_and(has) AS preserved
FROM (SELECT c_nationkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000) AS has FROM customer)
GROUP BY c_nationkey""",
)
def check_preserved(t):
    """Genes lost when only customers with a large order are kept."""
    before = star.genes(t)
    big = t.orders.where("o_totalprice > 450000").select(F.concat(F.lit("g"), "o_custkey").alias("fid"))
    return G.check_preserved(before, before.join(big, "fid", "left_semi"), ["acc"])


@query(
    "gene_blocks",
    "W-05",
    """WITH r AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_extendedprice, l_returnflag = 'R' AS g FROM lineitem),
b AS (SELECT *, sum(CAST(g AS INT)) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice
    ROWS UNBOUNDED PRECEDING) AS block FROM r),
m AS (SELECT l_suppkey, count(*) FILTER (g) AS last_block FROM r GROUP BY l_suppkey)
SELECT l_suppkey, CAST(block AS BIGINT) AS gene_block, count(*) AS rows, CAST(min(l_orderkey) AS BIGINT) AS first_order
FROM b JOIN m USING (l_suppkey) WHERE block > 2 AND block <= 12 AND block < last_block GROUP BY l_suppkey, block""",
)
def gene_blocks(t):
    """Ten complete blocks per source after the first two; returned lines open a block."""
    rows = t.lineitem.withColumn("kind", F.when(F.col("l_returnflag") == "R", "gene").otherwise("CDS"))
    blocks = G.gene_blocks(
        rows,
        ["l_suppkey"],
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
        F.floor(F.col("l_orderkey") / 4096),
        skip=2,
        limit=10,
    )
    return blocks.groupBy("l_suppkey", "gene_block").agg(
        F.count("*").alias("rows"), F.min("l_orderkey").alias("first_order")
    )


@query(
    "protein_links",
    "J-09",
    """WITH c AS (SELECT DISTINCT l_linestatus AS acc, 'p' || l_partkey AS id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45),
p AS (SELECT DISTINCT s.acc, CASE WHEN p_size > 40 THEN 'p' || p_partkey || '.protein' ELSE 'p' || p_partkey END AS id
  FROM part, (SELECT DISTINCT l_linestatus AS acc FROM lineitem) s)
SELECT coalesce(c.acc, p.acc) AS acc, count(*) FILTER (c.id IS NOT NULL AND p.id IS NOT NULL) AS linked,
  count(*) FILTER (p.id IS NULL) AS cds_protein_ids_without_sequence, count(*) FILTER (c.id IS NULL) AS proteins_without_cds_id
FROM c FULL JOIN p ON c.acc = p.acc AND c.id = p.id GROUP BY 1""",
)
def protein_links(t):
    """CDS protein ids against protein records, some of them renamed."""
    cds = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select(
        F.col("l_linestatus").alias("acc"),
        F.lit("CDS").alias("kind"),
        F.create_map(F.lit("protein_id"), F.concat(F.lit("p"), "l_partkey")).alias("attrs"),
    )
    pid = F.concat(F.lit("p"), "p_partkey")
    proteins = t.part.select(
        F.explode(F.array(F.lit("O"), F.lit("F"))).alias("acc"),
        F.when(F.col("p_size") > 40, F.concat(pid, F.lit(".protein"))).otherwise(pid).alias("id"),
    )
    return G.protein_links(cds, proteins, ["acc"])


@query(
    "compare_deliveries",
    "J-22",
    """WITH a AS (SELECT c_nationkey AS acc, unnest(['genes', 'busy']) AS metric,
    unnest([count(*), count(*) FILTER (c_acctbal > 0)]) AS v FROM customer GROUP BY 1),
b AS (SELECT c_nationkey AS acc, unnest(['genes', 'extra']) AS metric,
    unnest([count(*), count(*) FILTER (c_acctbal > 5000)]) AS v FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1)
SELECT coalesce(a.acc, b.acc) AS acc, coalesce(a.metric, b.metric) AS metric, CAST(a.v AS DOUBLE) AS baseline,
  CAST(b.v AS DOUBLE) AS delivery, CAST(b.v - a.v AS DOUBLE) AS delta
FROM a FULL JOIN b ON a.acc = b.acc AND a.metric = b.metric""",
)
def compare_deliveries(t):
    """Metric change between a baseline and a delivery that lost one segment."""

    def metrics(df, second, bound):
        return (
            df.groupBy(F.col("c_nationkey").alias("acc"))
            .agg(F.count("*").alias("g"), F.count_if(F.col("c_acctbal") > bound).alias("s"))
            .selectExpr("acc", f"stack(2, 'genes', cast(g as double), '{second}', cast(s as double)) as (metric, value)")
        )

    delivery = t.customer.where("c_mktsegment <> 'BUILDING'")
    return G.compare_deliveries(metrics(t.customer, "busy", 0), metrics(delivery, "extra", 5000), ["acc"])


def _stored_star(t):
    """Star features with every seventh leaf twice, kept as Parquet, the form every multi-pass job should read."""
    part = F.substring("protein_id", 2, 20).cast("long")
    rows = star.features(t).unionByName(star.leaves(t).where(part % 7 == 0))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "features")


@query(
    "coding_subset",
    "C-02 J-02 J-05",
    f"""WITH {STAR_SQL}, c AS (SELECT DISTINCT acc, tx, gene FROM coding),
lf AS (SELECT acc, kind, tx AS p1, CASE WHEN kind = 'exon' AND l_linestatus = 'O' THEN 't' || l_partkey END AS p2, s, e, l_partkey FROM leaf0),
d AS (SELECT * FROM lf UNION ALL SELECT * FROM lf WHERE l_partkey % 7 = 0),
k AS (SELECT d.*, (a.tx IS NOT NULL) AS k1, (b.tx IS NOT NULL) AS k2 FROM d
  LEFT JOIN c a ON a.acc = d.acc AND a.tx = d.p1 LEFT JOIN c b ON b.acc = d.acc AND b.tx = d.p2)
SELECT acc, 'gene' AS kind, count(DISTINCT gene) AS n, CAST(0 AS BIGINT) AS parents FROM c GROUP BY acc
UNION ALL SELECT tx.acc, tx.kind, count(*), count(*) FROM tx JOIN c ON c.acc = tx.acc AND c.tx = tx.fid GROUP BY tx.acc, tx.kind
UNION ALL SELECT acc, kind, count(*), CAST(sum(CAST(k1 AS INT) + CAST(k2 AS INT)) AS BIGINT) FROM k WHERE k1 OR k2 GROUP BY acc, kind""",
)
def coding_subset(t):
    """Coding branch kept, shared parent lists trimmed: rows and parents left per kind, repeated rows as often as they come."""
    kept = export.coding_subset(_stored_star(t), ["acc"], ["row"])
    return kept.groupBy("acc", "kind").agg(
        F.count("*").alias("n"), F.sum(F.size("parents").cast("long")).alias("parents")
    )


@query(
    "exclusion_report",
    "C-02 A-01",
    f"""WITH {STAR_SQL}, c AS (SELECT DISTINCT acc, tx, gene FROM coding),
ex AS (SELECT DISTINCT acc, parent FROM leaf WHERE kind = 'exon'),
t1 AS (SELECT tx.acc, count(*) FILTER (c.tx IS NOT NULL) AS coding_transcripts, count(*) FILTER (c.tx IS NULL) AS excluded_transcripts,
   count(*) FILTER (c.tx IS NULL AND ex.parent IS NOT NULL) AS excluded_transcripts_with_exons
  FROM tx LEFT JOIN c ON c.acc = tx.acc AND c.tx = tx.fid LEFT JOIN ex ON ex.acc = tx.acc AND ex.parent = tx.fid GROUP BY tx.acc),
g1 AS (SELECT genes.acc, count(*) FILTER (k.gene IS NOT NULL) AS coding_gene_ids, count(*) FILTER (k.gene IS NULL) AS excluded_gene_ids
  FROM genes LEFT JOIN (SELECT DISTINCT acc, gene FROM c) k ON k.acc = genes.acc AND k.gene = genes.fid GROUP BY genes.acc)
SELECT * FROM t1 FULL JOIN g1 USING (acc)""",
)
def exclusion_report(t):
    """Kept and excluded genes and transcripts per delivery."""
    return export.exclusion_report(star.features(t), ["acc"])


@query(
    "graph_problems",
    "C-02 PRJ-12 J-05",
    f"""WITH {STAR_SQL}, c AS (SELECT DISTINCT acc, tx, gene FROM coding),
p AS (SELECT acc, 'several_coding_transcripts' AS reason FROM c GROUP BY acc, gene HAVING count(*) > 1
  UNION ALL SELECT leaf.acc, 'leaf_parent_unresolved' FROM leaf LEFT JOIN tx ON tx.acc = leaf.acc AND tx.fid = leaf.parent
    WHERE tx.fid IS NULL)
SELECT acc, reason, count(*) AS n FROM p GROUP BY acc, reason""",
)
def graph_problems(t):
    """Why each delivery cannot be labelled a longest, closed coding set."""
    return export.graph_problems(materialize(star.features(t), "features"), ["acc"])


@query(
    "quarantine",
    "PRJ-12 SRC-02",
    """WITH r AS (SELECT l_linestatus, CASE WHEN l_discount = 0.0 THEN 'width' WHEN l_tax = 0.0 THEN 'attributes'
   WHEN l_quantity < 5 THEN 'coordinates' END AS reason FROM lineitem)
SELECT l_linestatus AS seqid, coalesce(reason, 'good') AS reason, count(*) AS n FROM r GROUP BY ALL""",
)
def quarantine_rows(t):
    """Malformed rows set apart with their reason, good rows beside them."""
    fields = F.array(
        "l_linestatus", F.lit("src"), F.lit("CDS"), F.lit("100"),
        F.when(F.col("l_quantity") < 5, "99").otherwise("200"), F.lit("."), F.lit("+"), F.lit("."),
        F.when(F.col("l_tax") == 0.0, "ID=a;ID=b").otherwise("ID=a;Parent=b"),
    )
    rows = t.lineitem.withColumn("f", F.when(F.col("l_discount") == 0.0, F.slice(fields, 1, 8)).otherwise(fields))
    good, bad = quarantine(rows, X.row_reason(F.col("f")))
    both = good.withColumn("reason", F.lit("good")).unionByName(bad)
    return both.groupBy(F.col("f")[0].alias("seqid"), "reason").agg(F.count("*").alias("n"))


@query(
    "preview_dangling",
    "T-01 J-05",
    """SELECT l_suppkey AS acc, l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) <= 5""",
)
def preview_dangling(t):
    """First five offending rows of every delivery."""
    rows = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select(
        F.col("l_suppkey").alias("acc"), "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return preview(rows, ["acc"], ["l_orderkey", "l_linenumber", "l_extendedprice"], 5)
