import random

import pytest
from pyspark.sql import functions as F

from genomeloom.operators import bands as B
from genomeloom.operators import features as G
from genomeloom.operators import hits as H
from genomeloom.operators import reconcile as C
from genomeloom.operators import rules as Z
from genomeloom.operators import sequences as S
from genomeloom.operators import spread as W
from genomeloom.plans import export
from genomeloom.sources.features import read_gff3


def hot_rows(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 20)}", i, rng.randint(0, 9)) for i in range(2000)]
    return rows, spark.createDataFrame(rows, "k string, o long, v long")


def test_bucketed_helpers_equal_plain_windows(spark):
    rows, df = hot_rows(spark)
    bucket = F.floor(F.col("o") / 37)
    sums = W.running_sums(df, ["k"], ["o"], bucket, {"inc": F.col("v")})
    sums = W.running_sums(sums, ["k"], ["o"], bucket, {"exc": F.col("v")}, inclusive=False)
    sums = W.previous(sums, ["k"], ["o"], bucket, {"prev": F.col("v")})
    sums = W.carry_forward(sums, ["k"], ["o"], bucket, F.when(F.col("v") > 7, F.col("v")), "carried")
    got = {r.o: (r.inc, r.exc, r.prev, r.carried) for r in W.ordinal(sums, ["k"], ["o"], bucket).collect()}
    total, last, big = {}, {}, {}
    for k, o, v in rows:
        before = total.get(k, 0)
        total[k] = before + v
        if v > 7:
            big[k] = v
        assert got[o] == (total[k], before, last.get(k), big.get(k))
        last[k] = v


def test_top_row_and_median(spark):
    rows, df = hot_rows(spark)
    top = {r.k: r.o for r in W.top_row(df, ["k"], [F.col("v"), F.col("o")]).collect()}
    median = {r.k: r.m for r in W.exact_median(df, ["k"], "v", "m").collect()}
    import statistics

    for k in {r[0] for r in rows}:
        mine = [(v, o) for kk, o, v in rows if kk == k]
        assert top[k] == max(mine)[1]
        assert median[k] == statistics.median(v for v, _ in mine)


def brute_intervals(seq):
    out, start = [], None
    for i, ch in enumerate(seq + "X", 1):
        if ch in "acgt" and start is None:
            start = i
        elif ch not in "acgt" and start is not None:
            out.append((start, i - 1))
            start = None
    return out


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_mask_intervals_against_brute_force(spark, size):
    rng = random.Random(size)
    seqs = [("a", "acgt" * 9), ("b", ""), ("c", "NNN"), ("d", "x")] + [
        (f"r{i}", "".join(rng.choice("acgtACGTNn") for _ in range(rng.randint(1, 80)))) for i in range(30)
    ]
    df = spark.createDataFrame(seqs, "id string, seq string")
    rows = S.mask_intervals(S.pieces_of(df, ["id"], size=size), ["id"]).collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.start, r.end))
    for ident, seq in seqs:
        assert sorted(got.get(ident, [])) == brute_intervals(seq), ident


def test_softmask_rule_thresholds(spark):
    rows = [
        ("empty", ""), ("unmasked", "A" * 1000), ("edge", "A" * 995 + "a" * 5), ("hard", "N" * 210 + "a" * 790), ("n_edge", "N" * 200 + "a" * 800),
    ]
    df = spark.createDataFrame(rows, "g string, seq string")
    got = {r.g: r.outcome for r in S.softmask_rule(df, ["g"]).collect()}
    assert got == {"empty": "manual", "unmasked": "gap_not_softmasked", "edge": "ok", "hard": "gap_hardmasked", "n_edge": "ok"}


def test_mask_qc_order_and_case(spark):
    before = spark.createDataFrame([("g", 0, "a", "ACGT"), ("g", 1, "b", "AAAA"), ("h", 0, "a", "AC"), ("h", 1, "b", "GT")], "g string, rec long, id string, seq string")
    after = spark.createDataFrame([("g", 0, "a", "acGT"), ("g", 1, "b", "AAAA"), ("h", 0, "b", "GT"), ("h", 1, "a", "AC")], "g string, rec long, id string, seq string")
    sides = [S.mask_facts(d, ["g", "rec"]) for d in (before, after)]
    got = {r.g: r for r in S.mask_qc(*sides, ["g"]).collect()}
    assert got["g"].status == "PASS" and got["g"].lowercase_pct == 25.0
    assert not got["h"].ids_equal and not got["h"].lengths_equal and got["h"].status == "FAIL"


def test_protein_summary_fixture(spark):
    rows = [("x", "p1", "MK*V"), ("x", "p2", "MXZA*"), ("x", "p2", "MKV"), ("x", "p3", "MKVL*"), ("x", "p4", "")]
    r = S.protein_summary(spark.createDataFrame(rows, "g string, id string, seq string"), ["g"]).first()
    assert (r.proteins, r.duplicate_ids, r.ambiguous_residues, r.internal_stops, r.protein_median_len) == (4, 1, 2, 1, 4)


def test_stop_definitions(spark):
    df = S.protein_flags(spark.createDataFrame([("M*K**",), ("*",), ("M.K*",)], "seq string"))
    got = [(r.internal_ambiguity, r.internal_stops_one, r.internal_stops_all) for r in df.collect()]
    assert got == [(2, 2, 1), (0, 0, 0), (1, 0, 0)]


GFF = """##gff-version 3
c\tx\tgene\t1\t100\t.\t+\t.\tID=g1
c\tx\tmRNA\t1\t100\t.\t+\t.\tID=t1;Parent=g1
c\tx\tCDS\t1\t50\t.\t+\t0\tParent=t1,t2
c\tx\tmRNA\t1\t100\t.\t+\t.\tID=t2;Parent=g1
c\tx\tgene\t200\t300\t.\t+\t.\tID=g2
c\tx\tmRNA\t200\t300\t.\t+\t.\tID=t3;Parent=g2
c\tx\tCDS\t200\t250\t.\t+\t0\tParent=t3
c\tx\tCDS\t260\t280\t.\t+\t0\tParent=t3
c\tx\tgene\t400\t500\t.\t+\t.\tID=g3
c\tx\tncRNA\t400\t500\t.\t+\t.\tID=n1;Parent=g3
c\tx\texon\t400\t500\t.\t+\t.\tParent=t3,gone
"""


def test_gene_model_fixture(spark, write):
    f = read_gff3(spark, write("a.gff3", GFF)).withColumn("acc", F.lit("a"))
    r = G.gene_model_summary(f, ["acc"]).first()
    assert (r.gff_gene_loci, r.coding_genes, r.noncoding_genes, r.cds_features, r.exon_features, r.isoforms_per_gene) == (3, 2, 1, 3, 1, 1.5)
    assert G.coding_residue_rule(f, ["acc"]).first().outcome == "gap"
    loose = {(r.kind, r.parent, r.reason) for r in G.dangling_parents(f, ["acc"]).collect()}
    assert loose == {("exon", "gone", "unknown_parent")}
    up = {(r.parent, r.ancestor) for r in G.ancestors(f, ["acc"]).collect()}
    assert up == {("t1", "g1"), ("t2", "g1"), ("t3", "g2"), ("gone", None)}
    why = {r.parent: r.reason for r in G.ancestors(f, ["acc"]).collect()}
    assert why == {"t1": None, "t2": None, "t3": None, "gone": "unknown_parent"}
    blocks = G.gene_blocks(f, ["acc"], ["block", "pos"], F.col("block"), full_source=True)
    assert {r.gene_block: r.n for r in blocks.groupBy("gene_block").agg(F.count("*").alias("n")).collect()} == {1: 4, 2: 4, 3: 3}
    assert G.gene_blocks(f, ["acc"], ["block", "pos"], F.col("block")).agg(F.max("gene_block")).first()[0] == 2
    kept = export.coding_subset(f, ["acc"], ["file", "block", "pos"]).collect()
    assert sorted((r.kind, tuple(r.parents)) for r in kept) == sorted(
        [("gene", ()), ("gene", ()), ("mRNA", ("g1",)), ("mRNA", ("g1",)), ("mRNA", ("g2",)), ("CDS", ("t1", "t2")), ("CDS", ("t3",)), ("CDS", ("t3",)), ("exon", ("t3",))]
    )
    reasons = {r.reason for r in export.graph_problems(f, ["acc"]).collect()}
    assert reasons == {"unknown_kind", "leaf_parent_unresolved", "several_coding_transcripts"}


def test_best_hit_ties_and_near_top(spark):
    rows = [
        ("q1", "s1", 100.0, 1e-5, 60.0), ("q1", "s2", 100.0, 1e-5, 60.0), ("q1", "s3", 95.0, 1e-9, 90.0), ("q1", "s4", 94.9, 0.0, 90.0),
        ("q2", "s1", 10.0, 1e-5, 49.9), ("q3", "s1", 10.0, 1e-5, 50.0), ("q4", "s1", 5.0, 2.0, 80.0), ("q4", "s0", 5.0, 1.0, 50.0),
    ]
    df = H.filter_hits(spark.createDataFrame(rows, "qseqid string, sseqid string, bitscore double, evalue double, qcovhsp double"))
    assert {r.qseqid: r.sseqid for r in H.best_hit(df).collect()} == {"q1": "s2", "q3": "s1", "q4": "s0"}
    near = {r.qseqid: (r.close, r.ambiguous) for r in H.near_top(df).collect()}
    assert near == {"q1": (3, True), "q3": (1, False), "q4": (2, True)}


def test_empty_query_set_statistics(spark):
    schema = "query string, " + ", ".join(f"{c} int" for c in H.SOURCES)
    r = H.annotation_stats(spark.createDataFrame([], schema)).first()
    assert (r.total_queries, r.any_n, r.none_n, r.any_pct) == (0, 0, 0, 0.0)


def test_band_rules(spark):
    bands = B.band_rows(
        spark,
        [
            {"id": "a", "metric": "m", "taxon_scope": "fungi", "lo": 1.0, "hi": 5.0, "enforce": True},
            {"id": "b", "metric": "m", "taxon_scope": "aves", "lo": 1.0, "hi": 5.0},
            {"id": "c", "metric": "n", "taxon_scope": "any", "lo": 0.0, "hi": 1.0},
        ],
    )
    metrics = spark.createDataFrame(
        [("d1", "fungi", "m", 5.0), ("d2", "fungi", "m", 5.1), ("d3", "aves", "n", 2.0), ("d4", "aves", "odd", 2.0), ("d5", "fungi", "m", 9.0)],
        "delivery string, taxon string, metric string, value double",
    )
    own = spark.createDataFrame([("d5", "m", None, 8.0, 10.0, False)], "delivery string, metric string, taxon_scope string, lo double, hi double, enforce boolean")
    got = {r.delivery: (r.status, r.severity, r.anchor) for r in B.evaluate_bands(metrics, bands, own).collect()}
    assert got == {
        "d1": ("within", "info", "clade_fallback"),
        "d2": ("out_of_range", "warning", "clade_fallback"),
        "d3": ("out_of_range", "info", "clade_fallback"),
        "d4": ("unknown_metric", "info", "none"),
        "d5": ("within", "info", "project_reference"),
    }
    assert len(B.snapshot_rows()) == 14


def test_rules_manual_is_never_a_gap(spark):
    cols = "delivery string, library_dir string, library_file string, intron_support string, completeness_version string, ambiguous_proteins long, gene_total long, gene_coding long, mask_total long, mask_lower long, mask_gap long, thread_budget long, cores long, names_one_sided long"
    rows = [("none",) + (None,) * 13, ("bad", "/d", None, "1.0", "6.1.0", 1, 106, 100, 1000, 0, 0, 8, 8, 1), ("good", "/d", "f", "0.8", "5.8", 0, 105, 100, 1000, 100, 0, 4, 8, 0)]
    out = {}
    for r in Z.run_rules(spark.createDataFrame(rows, cols), ["delivery"]).collect():
        out.setdefault(r.delivery, {})[r.rule[-1]] = r.outcome
    assert set(out["none"].values()) == {"manual"}
    assert [out["bad"][str(i)] for i in range(1, 10)] == ["gap"] * 8 + ["manual"]
    assert [out["good"][str(i)] for i in range(1, 10)] == ["ok", "ok", "manual", "ok", "ok", "ok", "ok", "ok", "manual"]


def test_bundle_reasons(spark):
    m = [("a", 1, "x"), ("b", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x"), ("../e", 1, "x"), ("f", 1, "x"), ("g//h", 1, "x")]
    f = [("a", 1, "x"), ("b", 1, "x"), ("c", 2, "x"), ("d", 1, "y"), ("z", 1, "x"), ("MANIFEST.json", 1, "x")]
    schema = "path string, size_bytes long, sha256 string"
    got = {r.path: r.reason for r in C.verify_bundle(spark.createDataFrame(m, schema), spark.createDataFrame(f, schema)).collect()}
    assert got == {"a": "ok", "b": "duplicate_entry", "c": "size", "d": "sha256", "../e": "unsafe_path", "f": "missing", "g//h": "unsafe_path", "z": "extra"}


def test_near_top_with_one_hot_query(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"q{rng.randint(0, 30)}", f"s{rng.randint(0, 50)}", float(rng.randint(1, 400)), 1.0, 60.0) for _ in range(4000)]
    df = spark.createDataFrame(rows, "qseqid string, sseqid string, bitscore double, evalue double, qcovhsp double")
    want = {}
    for q in {r[0] for r in rows}:
        top = max(r[2] for r in rows if r[0] == q)
        near = [r for r in rows if r[0] == q and r[2] >= top * (1 - 0.05)]
        want[q] = (len(near), len({r[1] for r in near}))
    hits = {r.qseqid: r.close for r in H.near_top(df).collect()}
    subjects = {r.qseqid: r.close for r in H.near_top(df, unit="subjects").collect()}
    assert {q: (hits[q], subjects[q]) for q in want} == want


def test_quarantine_and_preview(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "k string, v long")
    good, bad = W.quarantine(df, F.when(F.col("v") > 40, "large"))
    assert (good.count(), bad.count()) == (42, 9)
    got = sorted(map(tuple, W.preview(df, ["k"], ["v"], 3).collect()))
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 1)]


def test_pieces_and_window(spark):
    df = spark.createDataFrame([("a", "ACGTACGTAC"), ("b", "TTTT")], "id string, seq string")
    regions = spark.createDataFrame([("a", 3, 8), ("b", 4, 9)], "id string, start long, end long")
    parts = S.piece_window(S.pieces_of(df, ["id"], size=4), regions, ["id"]).orderBy("id", "part_start").collect()
    assert [(r.id, r.part_start, r.bases) for r in parts] == [("a", 3, "GT"), ("a", 5, "ACGT"), ("b", 4, "T")]
    whole = {r.id: r.bases for r in S.sequence_window(df, regions, "id").collect()}
    assert whole == {"a": "GTACGT", "b": "T"}


def test_ancestors_of_any_depth_and_circles(spark):
    chain = [("x", "region", f"n{i}", [f"n{i + 1}"]) for i in range(40)] + [("x", "gene", "n40", [])]
    ring = [("x", "region", f"r{i}", [f"r{(i + 1) % 5}"]) for i in range(5)]
    loose = [("x", "region", "alone", ["nowhere"])]
    leaves = [("x", "exon", None, [p]) for p in ("n0", "n39", "r2", "alone", "absent")]
    rows = spark.createDataFrame(chain + ring + loose + leaves, "acc string, kind string, fid string, parents array<string>")
    got = {r.parent: (r.ancestor, r.reason) for r in G.ancestors(rows, ["acc"]).collect()}
    assert got == {
        "n0": ("n40", None),
        "n39": ("n40", None),
        "r2": (None, "cycle"),
        "alone": (None, "no_ancestor"),
        "absent": (None, "unknown_parent"),
    }


def test_exploded_annotations_are_not_broadcast(spark):
    """Ids that ``explode`` makes out of a small file: its size says nothing about their number."""
    from genomeloom.plans.annotation import integrate

    ids = F.explode(F.array(*[F.concat(F.lit("s"), "id", F.lit(f"_{n}")) for n in range(35)])).alias("id")
    annot = spark.range(2).select(ids, F.lit("text").alias("annot"))
    rows = [("Nr", "q1", "s0_3", 9.0, 0.1, 99.0, 1.0), ("Nr", "q2", "s7_1", 9.0, 0.1, 99.0, 1.0)]
    hits = spark.createDataFrame(rows, "source string, qseqid string, sseqid string, bitscore double, evalue double, qcovhsp double, scovhsp double")
    proteins = spark.createDataFrame([("q1", "MA*"), ("q2", "MA*")], "id string, seq string")
    domains = spark.createDataFrame([], "protein string, domains array<string>, terms array<string>")
    best = integrate(proteins, hits, annot.select(F.lit("Nr").alias("source"), "id", "annot"), domains).best
    single = H.annotate_best(hits, annot)
    for df in (best, single):
        assert {r.qseqid: r.annotated for r in df.collect()} == {"q1": True, "q2": False}
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins = [line.split("], [")[0] for line in plan.splitlines() if "HashJoin" in line]
        assert "SortMergeJoin" in plan and not any("sseqid" in keys for keys in joins)


def test_domain_sets_meet_once(spark):
    rows = [("p", ["b", "a"], ["t"]), ("p", ["a"], ["t", "s"]), ("q", [], []), ("r", ["c"], [])]
    df = spark.createDataFrame(rows, "protein string, domains array<string>, terms array<string>")
    out = H.domain_sets(df)
    assert {r.protein: (r.domains, r.terms) for r in out.collect()} == {
        "p": (["a", "b"], ["s", "t"]), "q": ([], []), "r": (["c"], []),
    }
    assert out._jdf.queryExecution().sparkPlan().toString().count("LocalTableScan") + out._jdf.queryExecution().sparkPlan().toString().count("ExistingRDD") == 1


def test_dangling_parents_are_counted_before_they_meet(spark):
    rows = [("a", "gene", "g1", []), *[("a", "exon", None, ["g1", "x"])] * 3, ("a", "mRNA", "t1", ["g1"])]
    df = spark.createDataFrame(rows, "acc string, kind string, fid string, parents array<string>")
    out = G.dangling_parents(df, ["acc"], counted=True)
    assert {tuple(r) for r in out.collect()} == {
        ("a", "exon", "g1", "leaf_parent_not_transcript", 3), ("a", "exon", "x", "unknown_parent", 3),
    }
