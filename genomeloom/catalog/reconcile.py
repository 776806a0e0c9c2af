"""Reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import residues as R
from ..operators import reconcile as C
from ..operators.spread import ordinal
from .registry import query
from .sequences import SEQS, seqs

# The altered copy loses one source, gains one page per host and upper-cases French text.
COPY_SQL = f"""{SEQS}, copy AS (
  SELECT doc_id, lang, source, CASE WHEN lang = 'fr' THEN translate(seq, 'acgt', 'ACGT') ELSE seq END AS seq FROM seqs WHERE source <> 'src7'
  UNION ALL SELECT 1000000000 + item_id, 'en', 'bench', text FROM benchmark)"""


def altered(t):
    kept = seqs(t).where("source <> 'src7'").withColumn(
        "seq", F.when(F.col("lang") == "fr", F.translate("seq", "acgt", "ACGT")).otherwise(F.col("seq"))
    )
    extra = t.benchmark.select(
        (F.col("item_id") + 1_000_000_000).alias("doc_id"), F.lit("en").alias("lang"), F.lit("bench").alias("source"), F.col("text").alias("seq")
    )
    return kept.unionByName(extra)


@query(
    "fingerprint_diff",
    "J-06 X-01",
    f"""WITH {COPY_SQL}, a AS (SELECT lang, doc_id, sha256(seq) AS h FROM seqs), b AS (SELECT lang, doc_id, sha256(seq) AS h FROM copy)
SELECT coalesce(a.lang, b.lang) AS lang, count(*) FILTER (b.h IS NULL) AS missing, count(*) FILTER (a.h IS NULL) AS added,
  count(*) FILTER (a.h <> b.h) AS changed, count(*) FILTER (a.h = b.h) AS equal
FROM a FULL JOIN b ON a.lang = b.lang AND a.doc_id = b.doc_id GROUP BY 1""",
)
def fingerprint_diff(t):
    """Records missing, added and changed in an altered copy."""
    a = C.fingerprints(seqs(t), ["lang"], "doc_id")
    return C.fingerprint_diff(a, C.fingerprints(altered(t), ["lang"], "doc_id"), ["lang"])


@query(
    "id_sets",
    "X-01",
    """SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' ELSE 'common' END AS side
FROM (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0) a
FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 400000) b ON a.k = b.k""",
)
def id_sets(t):
    """Solvent customers against customers with a large order."""
    return C.id_sets(
        t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")),
        t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("k")),
        ["k"],
    )


@query(
    "reconcile_names",
    "J-07",
    """WITH a AS (SELECT DISTINCT l_returnflag AS acc, 'p' || l_partkey AS name FROM lineitem WHERE l_quantity > 40),
b AS (SELECT DISTINCT f AS acc, CASE WHEN p_size > 45 THEN 'p' || p_partkey || '.v2' ELSE 'p' || p_partkey END AS name
  FROM part, (SELECT DISTINCT l_returnflag AS f FROM lineitem)),
c AS (SELECT coalesce(a.acc, b.acc) AS acc, count(*) FILTER (a.name = b.name) AS common, count(*) FILTER (b.name IS NULL) AS only_left,
  count(*) FILTER (a.name IS NULL) AS only_right FROM a FULL JOIN b ON a.acc = b.acc AND a.name = b.name GROUP BY 1)
SELECT *, only_left = 0 AND only_right = 0 AS consistent FROM c""",
)
def reconcile_names(t):
    """Sequence names used against sequence names delivered."""
    used = t.lineitem.where("l_quantity > 40").select(
        F.col("l_returnflag").alias("acc"), F.concat(F.lit("p"), "l_partkey").alias("name")
    )
    name = F.concat(F.lit("p"), "p_partkey")
    delivered = t.part.select(
        F.explode(F.array(F.lit("R"), F.lit("A"), F.lit("N"))).alias("acc"),
        F.when(F.col("p_size") > 45, F.concat(name, F.lit(".v2"))).otherwise(name).alias("name"),
    )
    return C.reconcile_names(used, delivered, ["acc"])


@query(
    "marker_sets",
    "X-02",
    """WITH m AS (SELECT l_partkey AS id, bool_or(l_returnflag = 'R' AND l_discount > 0.08) AS a,
  bool_or(l_returnflag = 'A' AND l_tax > 0.07) AS b, bool_or(l_quantity = 50) AS c FROM lineitem GROUP BY l_partkey)
SELECT count(*) FILTER (a AND NOT c) AS a_not_c, count(*) FILTER (b AND NOT c) AS b_not_c, count(*) FILTER (a AND b AND NOT c) AS a_and_b_not_c,
  count(*) FILTER (a OR b) AS a_or_b, count(*) FILTER (c AND NOT a AND NOT b) AS c_only FROM m""",
)
def marker_sets(t):
    """Markers found by three model sets."""
    r = t.lineitem
    members = (
        r.where("l_returnflag = 'R' AND l_discount > 0.08").select("l_partkey", F.lit("A").alias("source"))
        .unionByName(r.where("l_returnflag = 'A' AND l_tax > 0.07").select("l_partkey", F.lit("B").alias("source")))
        .unionByName(r.where("l_quantity = 50").select("l_partkey", F.lit("C").alias("source")))
    )
    return C.marker_sets(members, "l_partkey")


@query(
    "select_records",
    "J-04",
    f"""WITH {SEQS} SELECT doc_id, sha256(seq) AS digest FROM seqs WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def select_records(t):
    """Records named by a query table."""
    kept = C.select_records(seqs(t), t.labels.where("quality = 1"), "doc_id")
    return kept.select("doc_id", F.sha2("seq", 256).alias("digest"))


@query(
    "selection_problems",
    "J-04",
    """WITH asked AS (SELECT o_custkey AS id, count(*) AS asked FROM orders WHERE o_totalprice > 480000 GROUP BY 1),
found AS (SELECT c_custkey AS id, 1 AS found FROM customer WHERE c_acctbal > 0)
SELECT id, 'missing' AS reason FROM asked LEFT JOIN found USING (id) WHERE found IS NULL
UNION ALL SELECT id, 'repeated_request' FROM asked WHERE asked > 1""",
)
def selection_problems(t):
    """Requests without a record, and repeated requests."""
    asked = t.orders.where("o_totalprice > 480000").select(F.col("o_custkey").alias("id"))
    return C.selection_problems(t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("id")), asked)


MATES_SQL = """turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS rec FROM conversations WHERE role <> 'system'),
a AS (SELECT conv_id, rec, rec AS n1 FROM turns WHERE role = 'user'),
b AS (SELECT conv_id, rec, CASE WHEN length(text) > 300 THEN rec + 100 ELSE rec END AS n2 FROM turns WHERE role = 'assistant')"""


@query(
    "mate_concordance",
    "J-10 W-06",
    f"""WITH {MATES_SQL} SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, count(*) AS positions, count(*) FILTER (n1 = n2) AS matching,
  count(*) FILTER (n1 IS NULL OR n2 IS NULL) AS unpaired, coalesce(min(CASE WHEN n1 IS DISTINCT FROM n2 THEN coalesce(a.rec, b.rec) END), -1) AS first_mismatch
FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.rec = b.rec GROUP BY 1""",
)
def mate_concordance(t):
    """User and assistant turns as mates by position; long answers carry another read name."""
    turns = ordinal(
        t.conversations.where("role <> 'system'"), ["conv_id", "role"], ["turn"], F.floor(F.col("turn") / 4096)
    )
    number = F.when((F.col("role") == "assistant") & (F.length("text") > 300), F.col("rec") + 100).otherwise(F.col("rec"))
    mate = F.when(F.col("role") == "user", "/1").otherwise("/2")
    rows = turns.withColumn("header", F.concat(F.lit("@run."), number, mate, F.lit(" extra")))
    return C.mate_concordance(rows.where("role = 'user'"), rows.where("role = 'assistant'"), ["conv_id"])


@query(
    "check_bindings",
    "J-12",
    """SELECT doc_id, source, lang <> 'es' AS bound FROM documents WHERE source <> 'src7'
UNION ALL SELECT doc_id, source, false FROM documents WHERE source = 'src7'""",
)
def check_bindings(t):
    """Expected digests against an altered delivery: Spanish text changed, one source gone."""
    expected = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("sha256"))
    text = F.when(F.col("lang") == "es", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    actual = t.documents.where("source <> 'src7'").select("doc_id", F.sha2(text, 256).alias("sha256"))
    return C.check_bindings(expected, actual, ["doc_id"]).select("doc_id", "source", "bound")


BUNDLE_SQL = """m AS (SELECT CASE WHEN lang = 'es' AND source = 'src3' THEN '../' || doc_id ELSE 'docs/' || doc_id END AS path,
   strlen(text) AS sz, sha256(text) AS sha, lang = 'de' AND source = 'src6' AS dup FROM documents WHERE source <> 'src9'),
m2 AS (SELECT path, sz, sha FROM m UNION ALL SELECT path, sz, sha FROM m WHERE dup),
l AS (SELECT path, count(*) AS n, max(sz) AS sz, max(sha) AS sha FROM m2 GROUP BY path),
f AS (SELECT 'docs/' || doc_id AS path, strlen(CASE WHEN lang = 'fr' THEN text || 'x' WHEN lang = 'de' THEN reverse(text) ELSE text END) AS sz,
   sha256(CASE WHEN lang = 'fr' THEN text || 'x' WHEN lang = 'de' THEN reverse(text) ELSE text END) AS sha FROM documents WHERE source <> 'src7')"""


@query(
    "verify_bundle",
    "J-17 SRC-11",
    f"""WITH {BUNDLE_SQL}, r AS (SELECT CASE WHEN l.path IS NULL THEN 'extra' WHEN l.path LIKE '../%' THEN 'unsafe_path' WHEN l.n > 1 THEN 'duplicate_entry'
   WHEN f.path IS NULL THEN 'missing' WHEN l.sz <> f.sz THEN 'size' WHEN l.sha <> f.sha THEN 'sha256' ELSE 'ok' END AS reason, coalesce(f.sz, 0) AS bytes
   FROM l FULL JOIN f ON l.path = f.path)
SELECT reason, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM r GROUP BY reason""",
)
def verify_bundle(t):
    """A manifest with unsafe, repeated, missing and changed entries against its files."""
    d = t.documents
    path = F.when((F.col("lang") == "es") & (F.col("source") == "src3"), F.concat(F.lit("../"), "doc_id")).otherwise(
        F.concat(F.lit("docs/"), "doc_id")
    )
    listed = d.where("source <> 'src9'").select(
        path.alias("path"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.sha2("text", 256).alias("sha256"),
        ((F.col("lang") == "de") & (F.col("source") == "src6")).alias("dup"),
    )
    manifest = listed.unionByName(listed.where("dup"))
    text = (
        F.when(F.col("lang") == "fr", F.concat("text", F.lit("x")))
        .when(F.col("lang") == "de", F.reverse("text"))
        .otherwise(F.col("text"))
    )
    files = d.where("source <> 'src7'").select(
        F.concat(F.lit("docs/"), "doc_id").alias("path"),
        F.octet_length(text).cast("long").alias("size_bytes"),
        F.sha2(text, 256).alias("sha256"),
    )
    return C.verify_bundle(manifest, files).groupBy("reason").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


@query(
    "source_receipts",
    "C-16 SRC-10 SRC-11 J-17",
    """WITH c AS (SELECT 'set/' || source || '/' || n_chars AS path, count(DISTINCT sha256(text)) AS n, max(sha256(text)) AS sha
   FROM documents WHERE lang <> 'es' GROUP BY 1),
f AS (SELECT 'set/' || source || '/' || n_chars AS path, CASE WHEN source <> 'src3' THEN max(sha256(CASE WHEN lang = 'fr' THEN text || 'x' ELSE text END)) END AS sha, max(strlen(text)) AS sz, true AS there
   FROM documents WHERE source <> 'src7' GROUP BY 1, source),
r AS (SELECT split_part(coalesce(c.path, f.path), '/', 2) AS source_group, CASE WHEN c.n > 1 THEN 'conflict' WHEN f.there IS NULL THEN 'missing'
   WHEN c.n IS NULL THEN 'unlisted' WHEN f.sha IS NULL THEN 'unverified' WHEN c.sha = f.sha THEN 'verified' ELSE 'changed' END AS o, sz FROM c FULL JOIN f ON c.path = f.path)
SELECT source_group, count(*) FILTER (o = 'verified') AS verified, count(*) FILTER (o = 'changed') AS changed, count(*) FILTER (o = 'conflict') AS conflict,
  count(*) FILTER (o = 'missing') AS missing, count(*) FILTER (o = 'unlisted') AS unlisted, count(*) FILTER (o = 'unverified') AS unverified,
  CAST(coalesce(sum(sz) FILTER (o = 'verified'), 0) AS BIGINT) AS verified_bytes FROM r GROUP BY source_group""",
)
def source_receipts(t):
    """Checksum lists against files per source; paths listed with two digests are excluded, one source has no digests."""
    from ..sources.tables import parse_checksums, resolve_checksums

    path = F.concat_ws("/", F.lit("set"), "source", "n_chars")
    lines = t.documents.where("lang <> 'es'").select(F.concat(F.sha2("text", 256), F.lit("  "), path).alias("value"))
    text = F.when(F.col("lang") == "fr", F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    files = (
        t.documents.where("source <> 'src7'")
        .groupBy(path.alias("path"))
        .agg(F.max(F.when(F.col("source") != "src3", F.sha2(text, 256))).alias("sha256"), F.max(F.octet_length("text").cast("long")).alias("size_bytes"))
    )
    return C.source_receipts(resolve_checksums(parse_checksums(lines)), files, F.split("path", "/")[1])


@query(
    "pair_surface",
    "J-19",
    """SELECT o_orderkey AS pair_id, o_orderpriority <> '1-URGENT' AS same_names, o_orderstatus <> 'P' AS same_declared,
  o_orderpriority <> '5-LOW' AS roles_swapped, true AS two_members FROM orders""",
)
def pair_surface(t):
    """Two packets per order: shared task, exchanged delivery and reference, some broken on purpose."""
    low, urgent = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "1-URGENT"
    first, second = F.sha2(F.concat(F.lit("a"), "o_orderkey"), 256), F.sha2(F.concat(F.lit("b"), "o_custkey"), 256)
    task = F.sha2("o_orderpriority", 256)
    other = F.when(F.col("o_orderstatus") == "P", F.sha2("o_orderstatus", 256)).otherwise(task)

    def item(member, name, role, sha):
        return F.struct(
            F.lit(member).alias("member"), F.lit(name).alias("name"), F.lit(role).alias("role"), sha.alias("sha256")
        )

    rows = F.array_compact(
        F.array(
            item(1, "task.md", "declared", task),
            item(2, "task.md", "declared", other),
            item(1, "sequence.fa", "delivery", first),
            item(1, "reference.fa", "reference", second),
            item(2, "sequence.fa", "delivery", F.when(low, first).otherwise(second)),
            item(2, "reference.fa", "reference", F.when(low, second).otherwise(first)),
            F.when(urgent, item(2, "notes.txt", "other", task)),
        )
    )
    artifacts = t.orders.select(F.col("o_orderkey").alias("pair_id"), F.explode(rows).alias("r")).select("pair_id", "r.*")
    return C.pair_surface(artifacts)


@query(
    "recheck_metrics",
    "C-17",
    """WITH a AS (SELECT c_nationkey AS acc, unnest(['rows', 'positive', 'renamed']) AS metric, unnest([count(*), count(*) FILTER (c_acctbal > 0), 0]) AS v
   FROM customer GROUP BY 1),
b AS (SELECT c_nationkey AS acc, unnest(['rows', 'positive', 'segments']) AS metric,
   unnest([count(*), count(*) FILTER (c_acctbal >= 500), count(DISTINCT c_mktsegment)]) AS v FROM customer GROUP BY 1)
SELECT coalesce(a.acc, b.acc) AS acc, coalesce(a.metric, b.metric) AS metric, CAST(a.v AS DOUBLE) AS stored, CAST(b.v AS DOUBLE) AS actual,
  CASE WHEN a.acc IS NULL THEN 'not_stored' WHEN b.acc IS NULL THEN 'not_recomputed' WHEN a.v = b.v THEN 'equal' ELSE 'differs' END AS outcome
FROM a FULL JOIN b ON a.acc = b.acc AND a.metric = b.metric""",
)
def recheck_metrics(t):
    """Stored metric documents against metrics recomputed from the delivered rows."""
    grouped = t.customer.groupBy(F.col("c_nationkey").alias("acc"))
    document = F.to_json(
        F.struct(
            F.count("*").cast("double").alias("rows"),
            F.count_if(F.col("c_acctbal") > 0).cast("double").alias("positive"),
            F.lit(0.0).alias("renamed"),
        )
    )
    stored = (
        grouped.agg(document.alias("doc"))
        .select("acc", F.explode(F.from_json("doc", "map<string, double>")).alias("metric", "value"))
    )
    actual = grouped.agg(
        F.count("*").alias("a"), F.count_if(F.col("c_acctbal") >= 500).alias("b"), F.count_distinct("c_mktsegment").alias("c")
    ).selectExpr("acc", "stack(3, 'rows', double(a), 'positive', double(b), 'segments', double(c)) as (metric, value)")
    return C.recheck_metrics(stored, actual, ["acc"])
