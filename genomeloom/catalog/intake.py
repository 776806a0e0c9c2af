"""Intake, project, review, rule and stage-summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bands as B
from ..operators import intake as I
from ..operators import rules as Z
from .registry import query


def _file_names(t):
    """Parts as file names: brand, library word, mate and extension out of the part's own columns."""
    words = F.when(F.col("p_type") == "ECONOMY", "_WGS").when(F.col("p_type") == "SMALL", "_Hi-C").when(
        F.col("p_type") == "LARGE", "_rna"
    ).when(F.col("p_type") == "PROMO", "_hap1").otherwise("_hiseq")
    mate = F.when(F.col("p_size") <= 20, "_R1").when(F.col("p_size") <= 40, "_2").otherwise("")
    ext = (
        F.when(F.col("p_type") == "PROMO", ".fa.gz")
        .when(F.col("p_retailprice") > 990, ".bam")
        .when(F.col("p_retailprice") > 980, ".txt")
        .otherwise(".fastq.gz")
    )
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), words, mate, ext)
    return t.part.select("p_partkey", F.col("p_brand").alias("inventory"), name.alias("name"))


NAMES_SQL = r"""n AS (SELECT p_partkey, p_brand AS inventory, p_type, p_size, p_retailprice,
  replace(p_name, ' ', '-') AS stem, CASE p_type WHEN 'ECONOMY' THEN '_WGS' WHEN 'SMALL' THEN '_Hi-C' WHEN 'LARGE' THEN '_rna' WHEN 'PROMO' THEN '_hap1' ELSE '_hiseq' END AS word,
  CASE WHEN p_size <= 20 THEN '_R1' WHEN p_size <= 40 THEN '_2' ELSE '' END AS mate,
  CASE WHEN p_type = 'PROMO' THEN '.fa.gz' WHEN p_retailprice > 990 THEN '.bam' WHEN p_retailprice > 980 THEN '.txt' ELSE '.fastq.gz' END AS ext FROM part),
k AS (SELECT *, CASE WHEN ext = '.fastq.gz' THEN CASE p_type WHEN 'ECONOMY' THEN 'wgs_reads' WHEN 'SMALL' THEN 'hic_reads' WHEN 'LARGE' THEN 'rna_reads' ELSE 'unknown_reads' END
   WHEN ext = '.fa.gz' THEN 'assembly' WHEN ext = '.bam' THEN 'bam' ELSE 'other' END AS kind FROM n),
c AS (SELECT *, CASE WHEN ext = '.fastq.gz' AND mate = '_R1' THEN 'r1' WHEN ext = '.fastq.gz' AND mate = '_2' THEN 'r2' END AS m,
   CASE WHEN ext = '.fastq.gz' THEN lower(stem || word) END AS prefix FROM k)"""


@query("classify_files", "PRJ-09 PRJ-10", f"WITH {NAMES_SQL} SELECT p_partkey, kind, m AS mate, prefix FROM c")
def classify_files(t):
    """Kind, mate and sample prefix of every file name."""
    return I.classify_files(_file_names(t)).select("p_partkey", "kind", "mate", "prefix")


@query(
    "classify_urls",
    "PRJ-09",
    r"""SELECT page_id, CASE WHEN regexp_matches(lower(url), '\.(fq|fastq|fq\.gz|fastq\.gz)$') THEN 'unknown_reads'
  WHEN regexp_matches(lower(url), '\.(fa|fas|fasta|fna|fa\.gz|fasta\.gz)$') THEN 'assembly' WHEN url LIKE '%.bam' THEN 'bam' ELSE 'other' END AS kind FROM pages""",
)
def classify_urls(t):
    """Page addresses are none of the known kinds unless they end like one."""
    return I.classify_files(t.pages, "url").select("page_id", "kind")


@query(
    "intake_audit",
    "C-08 PRJ-09 PRJ-10",
    f"""WITH {NAMES_SQL}, u AS (SELECT inventory, kind, prefix FROM c WHERE m IS NOT NULL AND kind IN ('wgs_reads', 'hic_reads', 'rna_reads')
   GROUP BY ALL HAVING count(DISTINCT m) = 1),
a AS (SELECT inventory, {", ".join(f"count(*) FILTER (kind = '{k}') AS {k}" for k in ("wgs_reads", "hic_reads", "rna_reads", "unknown_reads", "assembly", "bam", "other"))},
  bool_or(kind = 'assembly' AND word = '_hap1') AS haplotype_hint FROM c GROUP BY inventory)
SELECT a.*, (SELECT count(*) FROM u WHERE u.inventory = a.inventory) AS unpaired_prefixes, unknown_reads > 0 AS blocked_by_unknown_reads FROM a""",
)
def intake_audit(t):
    """Kinds, unpaired prefixes and hints per inventory."""
    return I.intake_audit(_file_names(t), ["inventory"])


@query(
    "file_pairs",
    "C-08",
    f"""WITH {NAMES_SQL}, f AS (SELECT inventory, CASE WHEN mate = '_R1' THEN stem || word || '_R' WHEN mate = '_2' THEN stem || word || '_'
   ELSE stem || word || '.fastq.gz' END AS stem FROM c WHERE ext = '.fastq.gz')
SELECT inventory, stem, count(*) AS files, count(*) = 2 AS paired FROM f GROUP BY ALL""",
)
def file_pairs(t):
    """Compressed reads by name stem; a stem needs exactly two files."""
    return I.file_pairs(_file_names(t), ["inventory"])


def projects(t):
    """One project per order, its libraries out of the order's own columns."""
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")

    def lib(ident, tech, kind, files, role):
        return F.struct(
            F.lit(ident).alias("library_id"),
            tech.alias("technology"),
            kind.alias("library_type"),
            files.alias("read_files"),
            role.alias("sample_role"),
        )

    role = F.when(priority == "5-LOW", F.lit(None)).when(status == "P", "parent").otherwise("proband").cast("string")
    pair = F.when(price > 400000, F.array(F.lit("A_R1.fq.gz"), F.lit("B_R2.fq.gz"))).otherwise(
        F.array(F.lit("A_R1.fq.gz"), F.lit("A_R2.fq.gz"))
    )
    wgs = F.when(
        status != "O",
        lib("wgs", F.lit("illumina_wgs"), F.when(priority == "1-URGENT", None).otherwise("wgs").cast("string"), pair, role),
    )
    hic = F.when(
        priority.isin("2-HIGH", "3-MEDIUM"),
        lib("hic", F.lit("illumina_hiseq_hic"), F.when(price < 50000, "wgs").otherwise("hic"), F.array().cast("array<string>"), F.lit("proband")),
    )
    return t.orders.select(
        F.col("o_orderkey").alias("project_id"),
        F.array_compact(F.array(wgs, hic)).alias("libraries"),
        (F.col("o_custkey") < 700).alias("has_existing"),
        F.when(price < 20000, "unresolved").when(price < 30000, None).otherwise("primary_reference").cast("string").alias("representation"),
        F.when(price > 480000, 4).otherwise(2).alias("ploidy"),
        ((price > 470000) & (price <= 480000)).alias("mixed_sample"),
        (status == "F").alias("parental_identity_required"),
        F.when(priority == "4-NOT SPECIFIED", "remote_agent").when(priority == "2-HIGH", "sop_package").otherwise("local").alias("backend"),
        F.when(status == "O", F.lit(None)).otherwise(status == "P").cast("boolean").alias("allow_remote_upload"),
        F.when(price < 250000, 8).cast("int").alias("cpu_limit"),
        F.lit(64).alias("memory_gb_limit"),
        F.lit(500).alias("disk_gb_limit"),
    )


PROJECT_SQL = """p AS (SELECT o_orderkey AS project_id, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS price, o_custkey < 700 AS existing,
  o_orderstatus <> 'O' AS wgs, o_orderpriority IN ('2-HIGH', '3-MEDIUM') AS hlib, o_totalprice >= 50000 AS hictype FROM orders)"""


@query(
    "route_projects",
    "C-08 A-25",
    f"""WITH {PROJECT_SQL}, x AS (SELECT *, hlib AND hictype AS has_hic, wgs AS has_reads, list_sort(list_filter([
   CASE WHEN price < 30000 THEN 'representation_unresolved' END,
   CASE WHEN (wgs OR hlib) AND NOT (hlib OR (wgs AND pr <> '5-LOW' AND st <> 'P')) THEN 'no_proband' END,
   CASE WHEN price > 480000 THEN 'ploidy_above_two' END, CASE WHEN price > 470000 AND price <= 480000 THEN 'mixed_sample' END,
   CASE WHEN hlib AND hictype AND NOT wgs AND NOT existing THEN 'hic_without_source' END,
   CASE WHEN wgs AND pr = '1-URGENT' THEN 'missing_library_type:wgs' END, CASE WHEN wgs AND price > 400000 THEN 'unpaired:wgs' END,
   CASE WHEN hlib AND NOT hictype THEN 'unsupported_combo:hic' END], lambda b: b IS NOT NULL)) AS bl FROM p)
SELECT project_id, array_to_string(bl, ';') AS blockers, CASE WHEN len(bl) > 0 THEN 'blocked' WHEN has_reads AND has_hic THEN 'assemble_and_scaffold'
  WHEN has_reads THEN 'assemble_only' WHEN existing AND has_hic THEN 'existing_then_scaffold' WHEN existing THEN 'existing_only_validate' ELSE 'blocked' END AS intent FROM x""",
)
def route_projects(t):
    """Blockers and intent of every project."""
    return I.route(projects(t)).select("project_id", F.array_join("blockers", ";").alias("blockers"), "intent")


@query(
    "validate_projects",
    "A-25",
    f"""WITH {PROJECT_SQL} SELECT project_id, array_to_string(list_filter([
   CASE WHEN price < 30000 THEN 'representation_undeclared' END,
   CASE WHEN pr = '4-NOT SPECIFIED' AND st <> 'F' THEN 'remote_upload_not_off' END,
   CASE WHEN pr IN ('4-NOT SPECIFIED', '2-HIGH') AND price >= 250000 THEN 'limits_missing' END,
   CASE WHEN wgs AND pr = '5-LOW' THEN 'role_missing' END,
   CASE WHEN (wgs OR hlib) AND NOT (hlib OR (wgs AND pr <> '5-LOW' AND st <> 'P')) THEN 'no_proband' END,
   CASE WHEN hlib AND wgs AND pr <> '5-LOW' AND st <> 'P' THEN 'several_assembly_probands' END,
   CASE WHEN st = 'F' AND NOT (wgs AND pr <> '5-LOW' AND st = 'P') THEN 'parent_required' END], lambda b: b IS NOT NULL), ';') AS reasons FROM p""",
)
def validate_projects(t):
    """Cross-field findings of every project."""
    return I.validate_projects(projects(t)).select("project_id", F.array_join("reasons", ";").alias("reasons"))


@query(
    "missing_tools",
    "J-25",
    """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'no_manifest' ELSE array_to_string(list_filter([
   CASE WHEN s_nationkey > 20 THEN 'fastp' END, CASE WHEN s_nationkey > 10 THEN 'hifiasm' END, CASE WHEN s_acctbal > 5000 THEN 'nextflow' END], lambda x: x IS NOT NULL), ';') END AS missing
FROM supplier""",
)
def missing_tools(t):
    """Required tools without a recorded version."""
    versions = F.map_from_entries(
        F.array_compact(
            F.array(
                F.struct(F.lit("fastqc"), F.lit("0.12")),
                F.when(F.col("s_nationkey") <= 20, F.struct(F.lit("fastp"), F.lit("0.23"))),
                F.when(F.col("s_nationkey") <= 10, F.struct(F.lit("hifiasm"), F.lit("0.19"))),
                F.when(F.col("s_acctbal") <= 5000, F.struct(F.lit("nextflow"), F.lit("24.4"))),
            )
        )
    )
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, versions).alias("software_versions"))
    return I.missing_tools(rows).select("s_suppkey", F.array_join("missing", ";").alias("missing"))


EDIT_SQL = """e AS (SELECT l_orderkey AS package_id, CASE WHEN l_discount = 0.1 THEN NULL WHEN l_tax = 0.08 THEN 'chr' || l_suppkey || ':x-y'
   WHEN l_returnflag = 'N' THEN 'asm_scaf_' || l_partkey WHEN l_returnflag = 'R' THEN 'chr' || l_linenumber || ':1-50' ELSE 'chr' || l_suppkey || ':10-90:hap1' END AS ref,
   CASE WHEN l_discount = 0.1 THEN 'missing' WHEN l_tax = 0.08 THEN 'invalid' WHEN l_returnflag = 'N' THEN 'scaffold' ELSE 'fragment' END AS form,
   CASE WHEN l_discount = 0.1 OR l_tax = 0.08 THEN NULL WHEN l_returnflag = 'R' THEN 'chr' || l_linenumber || ':1-50' WHEN l_returnflag = 'A' THEN 'chr' || l_suppkey || ':10-90' END AS coordinate,
   CASE WHEN l_discount <> 0.1 AND l_tax <> 0.08 AND l_returnflag = 'A' THEN 'hap1' END AS hap,
   CASE WHEN l_quantity > 45 THEN 'HAP1' WHEN l_quantity > 42 THEN 'hap2' END AS lift, l_linenumber, l_partkey, l_suppkey FROM lineitem)"""


def edits(t):
    flag = F.col("l_returnflag")
    ref = (
        F.when(F.col("l_discount") == 0.1, F.lit(None))
        .when(F.col("l_tax") == 0.08, F.concat(F.lit("chr"), "l_suppkey", F.lit(":x-y")))
        .when(flag == "N", F.concat(F.lit("asm_scaf_"), "l_partkey"))
        .when(flag == "R", F.concat(F.lit("chr"), "l_linenumber", F.lit(":1-50")))
        .otherwise(F.concat(F.lit("chr"), "l_suppkey", F.lit(":10-90:hap1")))
    )
    lift = F.when(F.col("l_quantity") > 45, "HAP1").when(F.col("l_quantity") > 42, "hap2")
    return t.lineitem.select(F.col("l_orderkey").alias("package_id"), ref.alias("ref"), lift.alias("liftover_hap"))


@query(
    "parse_edit_ref",
    "PRJ-17",
    f"WITH {EDIT_SQL} SELECT form, coordinate, hap, count(*) AS n FROM e GROUP BY ALL",
)
def parse_edit_ref(t):
    """Review references by form, coordinate and haplotype."""
    from ..functions.filenames import edit_ref

    rows = edits(t).select(edit_ref("ref").alias("r"))
    return rows.groupBy("r.form", "r.coordinate", "r.hap").agg(F.count("*").alias("n"))


@query(
    "review_gate",
    "C-09 PRJ-17",
    f"""WITH {EDIT_SQL}, d AS (SELECT package_id, coordinate, count(*) AS n FROM e WHERE coordinate IS NOT NULL GROUP BY ALL),
a AS (SELECT package_id, bool_or(form = 'missing') AS mi, bool_or(form = 'invalid') AS inv,
   bool_or(form IN ('fragment', 'scaffold') AND lift IS NOT NULL AND coalesce(hap, '') <> lower(lift)) AS hm FROM e GROUP BY package_id),
b AS (SELECT o_orderkey AS package_id, list_filter([CASE WHEN o_orderstatus = 'P' THEN 'not_approved' END,
   CASE WHEN o_orderpriority = '1-URGENT' THEN 'no_submission_action' END, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' THEN 'approved_without_action' END,
   CASE WHEN o_custkey < 20 THEN 'no_input_hash' END, CASE WHEN o_totalprice < 5000 THEN 'no_package_hash' END, CASE WHEN o_totalprice > 450000 THEN 'stale' END,
   CASE WHEN mi THEN 'missing_ref' END, CASE WHEN inv THEN 'invalid_ref' END,
   CASE WHEN EXISTS (SELECT 1 FROM d WHERE d.package_id = o_orderkey AND n > 1) THEN 'duplicate_coordinates' END,
   CASE WHEN hm THEN 'hap_mismatch' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'status_not_approved' END], lambda x: x IS NOT NULL) AS bl
  FROM orders LEFT JOIN a ON a.package_id = o_orderkey)
SELECT package_id, array_to_string(bl, ';') AS blockers, len(bl) = 0 AS ok FROM b""",
)
def review_gate(t):
    """Review packages and the reasons they may not pass."""
    packages = t.orders.select(
        F.col("o_orderkey").alias("package_id"),
        (F.col("o_orderstatus") != "P").alias("approved_by_human"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "sign-off").alias("submission_action"),
        F.when(F.col("o_custkey") >= 20, F.sha2(F.col("o_custkey").cast("string"), 256)).alias("input_assembly_hash"),
        F.when(F.col("o_totalprice") >= 5000, F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("review_package_hash"),
        (F.col("o_totalprice") > 450000).alias("stale"),
        F.when(F.col("o_orderpriority") == "5-LOW", "rejected").otherwise("accepted").alias("status"),
    )
    out = I.review_gate(packages, edits(t))
    return out.select("package_id", F.array_join("blockers", ";").alias("blockers"), "ok")


STAGE_SQL = """pr AS (SELECT c_custkey AS project_id, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'unresolved' WHEN c_mktsegment = 'BUILDING' THEN 'primary_reference' ELSE 'phased' END AS rep,
   c_acctbal > 5000 AS phased FROM customer),
w(metric, status) AS (VALUES ('contig_count', 'F'), ('contig_n50', 'O'), ('total_bp', 'P'), ('busco_complete_single', 'x'), ('busco_complete_dup', 'x'), ('busco_fragmented', 'x'), ('busco_missing', 'x')),
m AS (SELECT o_custkey AS project_id, CASE o_orderstatus WHEN 'F' THEN 'contig_count' WHEN 'O' THEN 'contig_n50' ELSE 'total_bp' END AS metric,
   max(CASE WHEN o_totalprice > 300000 THEN o_totalprice END) AS value, max(o_orderpriority) AS raw FROM orders GROUP BY ALL),
fl AS (SELECT DISTINCT o_custkey AS project_id, 'busco_missing' AS metric FROM orders WHERE o_totalprice > 480000),
lab AS (SELECT pr.project_id, w.metric, m.value, CASE WHEN m.value IS NOT NULL THEN 'number' WHEN fl.metric IS NOT NULL THEN 'tool_failed'
   WHEN m.raw IS NULL THEN 'missing' ELSE 'na' END AS label FROM pr CROSS JOIN w LEFT JOIN m ON m.project_id = pr.project_id AND m.metric = w.metric
   LEFT JOIN fl ON fl.project_id = pr.project_id AND fl.metric = w.metric)"""


def _stage(t):
    projects_ = t.customer.select(
        F.col("c_custkey").alias("project_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("c_mktsegment") == "MACHINERY", "unresolved")
        .when(F.col("c_mktsegment") == "BUILDING", "primary_reference")
        .otherwise("phased")
        .alias("representation"),
        (F.col("c_acctbal") > 5000).alias("phased"),
    )
    metrics = t.orders.select(
        F.col("o_custkey").alias("project_id"),
        F.when(F.col("o_orderstatus") == "F", "contig_count").when(F.col("o_orderstatus") == "O", "contig_n50").otherwise("total_bp").alias("metric"),
        F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")).alias("value"),
        F.col("o_orderpriority").alias("raw"),
    )
    failures = t.orders.where("o_totalprice > 480000").select(
        F.col("o_custkey").alias("project_id"), F.lit("busco_missing").alias("metric")
    )
    candidates = t.orders.select(
        F.col("o_custkey").alias("project_id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("deleted"),
        (F.col("o_orderstatus") != "P").alias("approved"),
    )
    return projects_, metrics, failures, candidates


@query("label_metrics", "PRJ-13", f"WITH {STAGE_SQL} SELECT project_id, metric, value, label FROM lab")
def label_metrics(t):
    """Wanted metrics as number, tool_failed, missing or na."""
    projects_, metrics, failures, _ = _stage(t)
    return I.label_metrics(metrics, failures, projects_)


@query(
    "stage_summary",
    "C-11 PRJ-13",
    f"""WITH {STAGE_SQL}, l AS (SELECT project_id, count(*) FILTER (label = 'number') AS numbers, count(*) FILTER (label = 'missing') AS missing,
   count(*) FILTER (label = 'na') AS not_applicable FROM lab GROUP BY 1),
f AS (SELECT o_custkey AS project_id, count(*) FILTER (o_totalprice > 480000) AS failures, count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS d FROM orders GROUP BY 1)
SELECT pr.project_id, coalesce(rep, 'unresolved') = 'unresolved' AS blocked, CASE WHEN rep <> 'unresolved' THEN rep END AS representation, numbers, missing, not_applicable,
  coalesce(failures, 0) AS failures, coalesce(d, 0) AS deleted_without_approval, coalesce(rep = 'primary_reference', NULL) AND phased AS phase_conflict,
  coalesce(failures, 0) = 0 AND missing = 0 AS clean FROM pr JOIN l USING (project_id) LEFT JOIN f USING (project_id)""",
)
def stage_summary(t):
    """Stage report with honest markers and warnings."""
    projects_, metrics, failures, candidates = _stage(t)
    return I.stage_summary(projects_, metrics, failures, candidates)


PROFILE_SQL = """pf AS (SELECT o_orderkey AS delivery, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '/db' END AS library_dir, CASE WHEN o_totalprice > 100000 THEN 'Dfam_3.embl' END AS library_file,
   CASE WHEN o_orderpriority = '1-URGENT' THEN '1.0' WHEN o_orderpriority = '2-HIGH' THEN '0.8' WHEN o_orderpriority = '3-MEDIUM' THEN '1' END AS intron_support,
   CASE WHEN o_orderpriority = '1-URGENT' THEN '6.1.0' WHEN o_orderpriority = '2-HIGH' THEN '6.0.2' WHEN o_orderpriority = '3-MEDIUM' THEN '5.8' END AS completeness_version,
   n, am, ge, co, tb, mt, ml, mg FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_tax = 0.08) AS am, count(*) FILTER (l_returnflag <> 'N') AS ge,
     count(*) FILTER (l_returnflag = 'R') AS co, CAST(sum(l_linenumber) AS BIGINT) AS tb, CAST(sum(l_quantity) AS BIGINT) AS mt,
     CAST(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O' AND l_discount > 0.05), 0) AS BIGINT) AS ml, CAST(coalesce(sum(l_quantity) FILTER (l_tax > 0.06), 0) AS BIGINT) AS mg
     FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
rl AS (SELECT delivery, unnest(['PIT-001','PIT-002','PIT-003','PIT-004','PIT-005','PIT-006','PIT-007','PIT-008','PIT-009']) AS rule,
   unnest(['warning','warning','warning','warning','warning','critical','warning','warning','warning']) AS severity, unnest([
   CASE WHEN library_dir IS NULL THEN 'manual' WHEN library_file IS NULL THEN 'gap' ELSE 'ok' END,
   CASE WHEN intron_support IS NULL THEN 'manual' WHEN intron_support IN ('1', '1.0') THEN 'gap' ELSE 'ok' END,
   CASE WHEN completeness_version = '6.1.0' OR completeness_version LIKE '6.0%' THEN 'gap' ELSE 'manual' END,
   CASE WHEN am IS NULL THEN 'manual' WHEN am > 0 THEN 'gap' ELSE 'ok' END,
   CASE WHEN ge IS NULL THEN 'manual' WHEN co > 0 AND ge > co * 1.05 THEN 'gap' ELSE 'ok' END,
   CASE WHEN mt IS NULL OR mt = 0 THEN 'manual' WHEN ml * 1.0 / mt < 0.005 THEN 'gap' WHEN mg * 1.0 / mt > 0.2 THEN 'gap' ELSE 'ok' END,
   CASE WHEN tb IS NULL THEN 'manual' WHEN tb >= 16 THEN 'gap' ELSE 'ok' END,
   CASE WHEN n IS NULL THEN 'manual' WHEN n > 6 THEN 'gap' ELSE 'ok' END, 'manual']) AS outcome FROM pf)"""


def profiles(t):
    q = F.col("l_quantity")
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("delivery")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("l_tax") == 0.08).alias("ambiguous_proteins"),
        F.count_if(F.col("l_returnflag") != "N").alias("gene_total"),
        F.count_if(F.col("l_returnflag") == "R").alias("gene_coding"),
        F.sum("l_linenumber").alias("thread_budget"),
        F.sum(q).cast("long").alias("mask_total"),
        F.coalesce(F.sum(F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") > 0.05), q)), F.lit(0)).cast("long").alias("mask_lower"),
        F.coalesce(F.sum(F.when(F.col("l_tax") > 0.06, q)), F.lit(0)).cast("long").alias("mask_gap"),
    )
    p = F.col("o_orderpriority")
    rows = t.orders.select(
        F.col("o_orderkey").alias("delivery"),
        F.when(F.col("o_orderstatus") != "P", "/db").alias("library_dir"),
        F.when(F.col("o_totalprice") > 100000, "Dfam_3.embl").alias("library_file"),
        F.when(p == "1-URGENT", "1.0").when(p == "2-HIGH", "0.8").when(p == "3-MEDIUM", "1").alias("intron_support"),
        F.when(p == "1-URGENT", "6.1.0").when(p == "2-HIGH", "6.0.2").when(p == "3-MEDIUM", "5.8").alias("completeness_version"),
        F.lit(16).alias("cores"),
    )
    return rows.join(sums, "delivery", "left").withColumn(
        "names_one_sided", F.when(F.col("n").isNotNull(), F.greatest(F.col("n") - 6, F.lit(0)))
    )


@query("rule_outcomes", "C-07", f"WITH {PROFILE_SQL} SELECT delivery, rule, severity, outcome FROM rl")
def rule_outcomes(t):
    """All nine rules on every delivery: gap, ok, or manual when the input is not there."""
    return Z.run_rules(profiles(t), ["delivery"])


@query(
    "delivery_verdicts",
    "C-07 T-04 J-11",
    f"""WITH {PROFILE_SQL}, v AS (SELECT delivery, CASE WHEN outcome = 'ok' THEN 'pass' WHEN rule = 'PIT-004' THEN 'block' ELSE 'rollback' END AS verdict,
   CASE WHEN outcome = 'ok' THEN 'none' WHEN rule = 'PIT-004' THEN 'protein_internal_ambiguity' WHEN rule = 'PIT-005' THEN 'noncoding_residue' ELSE 'masking_mode_error' END AS root_cause
   FROM rl WHERE rule IN ('PIT-004', 'PIT-005', 'PIT-006') AND outcome <> 'manual'
  UNION ALL SELECT o_orderkey, CASE WHEN o_totalprice BETWEEN 20000 AND 450000 THEN 'pass' ELSE 'warn' END, 'none' FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 10 <> 0),
w AS (SELECT delivery, verdict, root_cause FROM v QUALIFY row_number() OVER (PARTITION BY delivery ORDER BY
   CASE verdict WHEN 'block' THEN 3 WHEN 'rollback' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END DESC, root_cause) = 1)
SELECT o_orderkey AS delivery, verdict, root_cause, CASE WHEN verdict IS NULL THEN 'not_covered' ELSE 'ok' END AS status
FROM orders LEFT JOIN w ON w.delivery = o_orderkey""",
)
def delivery_verdicts(t):
    """Worst verdict of the three data rules and the bands; not_covered when nothing applies."""
    metrics = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("delivery"),
        F.lit(None).cast("string").alias("taxon"),
        F.lit("total_price").alias("metric"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice")).alias("value"),
    )
    band = {"id": "P1", "metric": "total_price", "taxon_scope": "any", "unit": "money", "lo": 20000.0, "hi": 450000.0, "enforce": False}
    bands = B.evaluate_bands(metrics, B.band_rows(t.spark, [band]))
    return Z.delivery_verdicts(Z.run_rules(profiles(t), ["delivery"]), bands, ["delivery"])


@query(
    "gates",
    "PRJ-18",
    """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'manual' WHEN s_acctbal / 100.0 < 60 THEN 'stop' ELSE 'ok' END AS completeness,
  CASE WHEN s_acctbal < 0 THEN 'unparsed' WHEN s_acctbal / 100.0 < 50 THEN 'look_first' ELSE 'ok' END AS alignment FROM supplier""",
)
def gates(t):
    """Completeness floor and alignment advice."""
    value = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") / 100.0)
    return t.supplier.select(
        "s_suppkey",
        Z.completeness_gate(value, 60.0).alias("completeness"),
        Z.alignment_advice(value).alias("alignment"),
    )
