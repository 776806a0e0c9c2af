"""The star schema read as a feature graph: customer = gene, orders = transcript, lineitem = leaf."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Leaf kinds: a returned line of a large quantity is a CDS, other returned and accepted
# lines are exons, the rest introns. Open exons also belong to a second transcript.
STAR_SQL = """genes AS (SELECT c_nationkey AS acc, 'g' || c_custkey AS fid, c_custkey * 1000 + 1 AS s, c_custkey * 1000 + 1000 AS e
  FROM customer),
tx AS (SELECT c_nationkey AS acc, 't' || o_orderkey AS fid, 'g' || o_custkey AS gene, o_orderkey, o_custkey,
    CASE WHEN o_orderstatus = 'P' THEN 'transcript' ELSE 'mRNA' END AS kind,
    o_custkey * 1000 + 1 AS s, o_custkey * 1000 + 500 AS e
  FROM orders JOIN customer ON o_custkey = c_custkey),
leaf0 AS (SELECT tx.acc, tx.fid AS tx, l_linestatus, l_partkey,
    CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'CDS' WHEN l_returnflag = 'N' THEN 'intron' ELSE 'exon' END AS kind,
    l_linenumber * 100 + 1 AS s, CAST(l_linenumber * 100 + l_quantity AS BIGINT) AS e
  FROM lineitem JOIN tx ON l_orderkey = tx.o_orderkey),
leaf AS (SELECT acc, kind, tx AS parent, s, e, l_partkey FROM leaf0
  UNION ALL SELECT acc, kind, 't' || l_partkey, s, e, l_partkey FROM leaf0 WHERE kind = 'exon' AND l_linestatus = 'O'),
cds_tx AS (SELECT DISTINCT acc, parent FROM leaf WHERE kind = 'CDS'),
coding AS (SELECT tx.acc, tx.fid AS tx, tx.gene FROM tx JOIN cds_tx ON cds_tx.acc = tx.acc AND cds_tx.parent = tx.fid)"""


def genes(t) -> DataFrame:
    return t.customer.select(
        F.col("c_nationkey").alias("acc"),
        F.lit("gene").alias("kind"),
        F.concat(F.lit("g"), "c_custkey").alias("fid"),
        F.array().cast("array<string>").alias("parents"),
        (F.col("c_custkey") * 1000 + 1).alias("start"),
        (F.col("c_custkey") * 1000 + 1000).alias("end"),
        F.lit(None).cast("string").alias("protein_id"),
    )


def transcripts(t) -> DataFrame:
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("acc"))
    return t.orders.join(owner, "o_custkey").select(
        "acc",
        F.when(F.col("o_orderstatus") == "P", "transcript").otherwise("mRNA").alias("kind"),
        F.concat(F.lit("t"), "o_orderkey").alias("fid"),
        F.array(F.concat(F.lit("g"), "o_custkey")).alias("parents"),
        (F.col("o_custkey") * 1000 + 1).alias("start"),
        (F.col("o_custkey") * 1000 + 500).alias("end"),
        F.lit(None).cast("string").alias("protein_id"),
    )


def leaves(t) -> DataFrame:
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("acc")), "o_custkey"
    )
    flag = F.col("l_returnflag")
    kind = F.when((flag == "R") & (F.col("l_quantity") > 45), "CDS").when(flag == "N", "intron").otherwise("exon")
    own = F.concat(F.lit("t"), "l_orderkey")
    other = F.concat(F.lit("t"), "l_partkey")
    return t.lineitem.join(owner, "l_orderkey").select(
        "acc",
        kind.alias("kind"),
        F.lit(None).cast("string").alias("fid"),
        F.when((kind == "exon") & (F.col("l_linestatus") == "O"), F.array(own, other)).otherwise(F.array(own)).alias("parents"),
        (F.col("l_linenumber") * 100 + 1).cast("long").alias("start"),
        (F.col("l_linenumber") * 100 + F.col("l_quantity")).cast("long").alias("end"),
        F.concat(F.lit("p"), "l_partkey").alias("protein_id"),
    )


def features(t) -> DataFrame:
    return genes(t).unionByName(transcripts(t)).unionByName(leaves(t))
