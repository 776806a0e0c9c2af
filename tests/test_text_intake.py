import random
import re

import pytest
from pyspark.sql import functions as F

from genomeloom.functions import filenames as N
from genomeloom.operators import intake as I
from genomeloom.operators import ledger as L
from genomeloom.operators import multiterm as M
from genomeloom.operators import textscan as X


def test_file_kinds_and_mates(spark):
    cases = {
        "A_WGS_R1.fastq.gz": ("wgs_reads", "r1", "a_wgs"),
        "A_WGS_2.fq": ("wgs_reads", "r2", "a_wgs"),
        "x-hi-c.R2.fq.gz": ("hic_reads", "r2", "x-hi-c"),
        "hiseq_R1.fastq": ("unknown_reads", "r1", "hiseq"),
        "transcriptome.fq": ("rna_reads", None, "transcriptome"),
        "asm.hap1.fa.gz": ("assembly", None, "asm.hap1.fa.gz"),
        "a.bam": ("bam", None, "a.bam"),
        "readme.txt": ("other", None, "readme.txt"),
    }
    df = spark.createDataFrame([(n,) for n in cases], "name string")
    got = {r.name: (r.k, r.m, r.p) for r in df.select("name", N.file_kind("name").alias("k"), N.mate_tag("name").alias("m"), N.sample_prefix("name").alias("p")).collect()}
    assert got == cases


def test_unpaired_prefixes_by_sample(spark):
    files = spark.createDataFrame([("i", "A_wgs_R1.fq"), ("i", "B_wgs_R2.fq"), ("i", "C_wgs_R1.fq"), ("i", "C_wgs_R2.fq")], "inv string, name string")
    got = {(r.prefix, r.missing) for r in I.unpaired_prefixes(I.classify_files(files), ["inv"]).collect()}
    assert got == {("a_wgs", "r2"), ("b_wgs", "r1")}
    audit = I.intake_audit(files, ["inv"]).first()
    assert audit.unpaired_prefixes == 2 and audit.wgs_reads == 4 and not audit.blocked_by_unknown_reads


def test_route_and_rules(spark):
    lib = "struct<library_id: string, technology: string, library_type: string, read_files: array<string>, sample_role: string>"
    schema = f"project_id string, libraries array<{lib}>, has_existing boolean, representation string, ploidy int, mixed_sample boolean, parental_identity_required boolean, backend string, allow_remote_upload boolean, cpu_limit int, memory_gb_limit int, disk_gb_limit int"
    wgs = ("w", "illumina_wgs", "wgs", ["a_R1.fq", "a_R2.fq"], "proband")
    hic = ("h", "illumina_hiseq_hic", "hic", [], "proband")
    rows = [
        ("ok", [wgs, hic], False, "primary_reference", 2, False, False, "local", None, None, None, None),
        ("mates", [("w", "illumina_wgs", "wgs", ["a_R1.fq", "b_R2.fq"], "proband")], False, "primary_reference", 2, False, False, "local", None, None, None, None),
        ("hic", [hic], False, "primary_reference", 2, False, True, "sop_package", None, 4, None, 9),
        ("old", [], True, "primary_reference", None, None, False, "remote_agent", True, 4, 8, 9),
        ("open", [("w", "hifi", None, None, None)], False, "unresolved", 4, True, False, "local", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.project_id: (r.intent, list(r.blockers)) for r in I.route(df).collect()}
    assert got["ok"] == ("assemble_and_scaffold", [])
    assert got["mates"] == ("blocked", ["unpaired:w"])
    assert got["hic"] == ("blocked", ["hic_without_source"])
    assert got["old"] == ("existing_only_validate", [])
    assert got["open"] == ("blocked", ["missing_library_type:w", "mixed_sample", "no_proband", "ploidy_above_two", "representation_unresolved"])
    reasons = {r.project_id: list(r.reasons) for r in I.validate_projects(df).collect()}
    assert reasons["hic"] == ["limits_missing", "parent_required"]
    assert reasons["old"] == ["remote_upload_not_off"]
    assert reasons["ok"] == ["several_assembly_probands"]
    assert reasons["open"] == ["representation_undeclared", "role_missing", "no_proband"]


def test_review_gate(spark):
    packages = spark.createDataFrame(
        [("good", True, "go", "h", "h", False, "accepted"), ("bad", True, None, None, "h", True, "rejected"), ("dup", True, "go", "h", "h", False, "modified")],
        "package_id string, approved_by_human boolean, submission_action string, input_assembly_hash string, review_package_hash string, stale boolean, status string",
    )
    edits = spark.createDataFrame(
        [("good", "chr1:1-9:hap1", "HAP1"), ("good", "asm_scaf_3", None), ("dup", "chr1:1-9", None), ("dup", "chr1:1-9:hap2", "hap1"), ("bad", "nonsense", None), ("bad", None, None)],
        "package_id string, ref string, liftover_hap string",
    )
    got = {r.package_id: list(r.blockers) for r in I.review_gate(packages, edits).collect()}
    assert got["good"] == []
    assert got["dup"] == ["duplicate_coordinates", "hap_mismatch"]
    assert got["bad"] == ["no_submission_action", "approved_without_action", "no_input_hash", "stale", "missing_ref", "invalid_ref", "status_not_approved"]


def test_transitions(spark):
    rows = [("p", 1, "PENDING"), ("p", 2, "READY"), ("p", 3, "SUCCEEDED"), ("p", 4, "STALE"), ("p", 5, "LOST")]
    df = spark.createDataFrame(rows, "project string, seq long, status string")
    hist = L.run_history(df, ["project"], ["seq"], "status", F.floor(F.col("seq") / 2))
    bad = L.check_transitions(hist, L.transition_rows(spark), "status")
    assert {(r.seq, r.reason) for r in bad.collect()} == {(3, "illegal_move"), (5, "unknown_status")}
    assert L.transition_rows(spark).count() == 18
    now = L.current_runs(df.where("seq < 3"), ["project"], ["seq"], "status").first()
    assert now.status == "READY" and now.active


GOOD = '{"verdict": "pass", "root_cause": "none", "evidence": ["task.md:1"], "action": "go on", "proposes_threshold_relaxation": false, "proposes_skipping_check": false}'


@pytest.mark.parametrize(
    "text, failure",
    [
        (GOOD, None),
        (None, "missing_text"),
        ("plain words", "invalid_json"),
        ("[1]", "invalid_json"),
        (GOOD[:-1] + ', "verdict": "warn"}', "invalid_json"),
        (GOOD.replace("false}", "NaN}"), "invalid_json"),
        (GOOD[:-1] + ', "extra": 1}', "schema"),
        (GOOD.replace('"pass"', '"fine"'), "schema"),
        (GOOD.replace('["task.md:1"]', '["task.md:1", "task.md:1"]'), "schema"),
        (GOOD.replace('["task.md:1"]', "[]"), "schema"),
        (GOOD.replace('"go on"', '"  "'), "schema"),
        (GOOD.replace("false}", '"no"}'), "schema"),
        (GOOD.replace("task.md:1", "other.md:1"), "evidence_filename"),
        (GOOD.replace("task.md:1", "../task.md:1"), "evidence_filename"),
    ],
)
def test_answer_failures(spark, text, failure):
    df = spark.createDataFrame([(text,)], "text string")
    r = X.parse_answers(df, "text", F.array(F.lit("task.md"))).first()
    assert r.failure == failure
    assert (r.verdict == "pass") == (failure is None)


def test_secrets_and_redaction(spark):
    text = "first\nkey sk-" + "a" * 24 + " and sk-test-" + "b" * 20 + "\n\nAKIA" + "A1" * 8 + "\nask-" + "c" * 30 + "\n-----BEGIN PRIVATE KEY-----"
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = sorted((r.category, r.line, r.fixture) for r in X.scan_secrets(df, ["id"], "text").collect())
    assert got == [("api_key_literal", 2, False), ("api_key_literal", 2, True), ("aws_access_key_literal", 4, False), ("private_key_header", 6, False)]
    assert "sk-" not in df.select(X.redact("text").alias("t")).first().t


def test_leaks_and_exceptions(spark):
    rows = [(1, "A bad idea"), (2, "badly done"), (3, "none here"), (4, "none_of"), (5, "x masking_mode_error y"), (6, "a\r\nb"), (7, "none quoted"),
            (8, "sub_bad_word"), (9, "none"), (10, "none"), (11, "None"), (12, None), (13, "")]
    docs = spark.createDataFrame(rows, "id int, text string").withColumn("name", F.concat(F.lit("f/"), "id", F.when(F.col("id") == 12, "/meta.json").when(F.col("id") == 13, "_Injected.txt").otherwise(".txt")))
    # 7: cleared. 9: the source has changed since. 10: not written by a tool as it is. 11: another source's digest.
    clear = spark.createDataFrame([(7, "none", "a", "1"), (9, "none", "b", "0"), (10, "none", "a", "1"), (11, "none", "a", "1")], "id int, token string, source_path string, source_sha256 string")
    made = spark.createDataFrame([(7, "tool_verbatim", ["x", "a"]), (9, "tool_verbatim", ["b"]), (10, "edited", ["a"]), (11, "tool_verbatim", ["b"])], "id int, text_origin string, source_paths array<string>")
    sources = spark.createDataFrame([("a", "1"), ("b", "2")], "source_path string, sha256 string")
    found = X.leak_scan(docs, ["id"], "text", name="name", exceptions=clear, extractions=made, sources=sources)
    assert sorted((r.id, r.kind, r.token) for r in found.collect()) == [
        (1, "trace_word", "bad"), (3, "single_word", "none"), (5, "enum_token", "masking_mode_error"), (6, "non_lf", "CR"), (8, "trace_word", "bad"),
        (9, "single_word", "none"), (10, "single_word", "none"), (11, "single_word", "none"), (12, "private_name", "meta.json"), (13, "trace_word", "injected"),
    ]
    with pytest.raises(ValueError):
        X.leak_scan(docs, ["id"], "text", exceptions=clear)


def test_ten_thousand_terms_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 4))) for _ in range(400)] + ["a_b", "é", "x1"]
    terms = [(" ".join(rng.choices(words, k=rng.randint(1, 4))), kind, rule) for i in range(10_000) for kind, rule in [(f"k{i % 3}", M.RULES[i % 3])]]
    terms += [("", "k", "inside"), (None, "k", "inside"), ("a", None, "inside"), ("Be", "k9", "word")]
    texts = [(i, rng.choice([" ", "_", "-", ""]).join(rng.choices(words, k=60)).title()) for i in range(25)] + [(90, None), (91, "")]
    want = set()
    for i, text in texts:
        low = (text or "").lower()
        for term, kind, rule in terms:
            if not term or kind is None:
                continue
            edge = {"inside": "", "word": "a-z0-9", "token": "a-z0-9_"}[rule]
            pattern = re.escape(term.lower()) if not edge else f"(?<![{edge}]){re.escape(term.lower())}(?![{edge}])"
            if term.lower() in low and re.search(pattern, low):
                want.add((i, kind, term.lower()))
    df, table = spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(terms, "term string, kind string, rule string")
    for size in (1 << 22, 40_000):  # one automaton, and several slices of the table
        monkeypatch.setattr(M, "MAX_TERM_BYTES", size)
        got = [tuple(r) for r in M.find_terms(df, ["id"], "text", table).distinct().collect()]
        assert set(got) == want and len(want) > 500


def test_a_thousand_pointers_to_one_file(spark):
    lines = "\n".join(f"row{i}\tx" for i in range(400))
    files = spark.createDataFrame([("big.tsv", "a\tb\n" + lines), ("deep.json", '{"l": [[1, {"k": 2}]], "a.b": 1}'), ("bad.json", "{"), ("gone.tsv", None)], "file string, text string")
    pointers = spark.createDataFrame(
        [("big.tsv", str(i)) for i in range(1000)] + [("big.tsv", c) for c in "abc"]
        + [("deep.json", p) for p in ("l.0.1.k", "l.0.2", "l.-1", "a.b", "l")] + [("bad.json", "x"), ("gone.tsv", "a"), ("gone.tsv", "1")],
        "file string, locator string",
    )
    out = X.resolve_pointers(pointers, files)
    assert not re.search(r"\btext#", out._jdf.queryExecution().executedPlan().toString())
    got = {(r.file, r.locator): r.outcome for r in out.collect()}
    assert len(got) == pointers.count()
    assert sorted(int(k) for (f, k), v in got.items() if f == "big.tsv" and v == "resolved" and k.isdigit()) == list(range(1, 402))
    rest = {k: v for k, v in got.items() if not k[1].isdigit() or k[0] == "gone.tsv"}
    assert rest == {
        ("big.tsv", "a"): "resolved", ("big.tsv", "b"): "resolved", ("big.tsv", "c"): "unresolved", ("deep.json", "l.0.1.k"): "resolved",
        ("deep.json", "l.0.2"): "unresolved", ("deep.json", "l.-1"): "resolved", ("deep.json", "a.b"): "unresolved", ("deep.json", "l"): "resolved",
        ("bad.json", "x"): "unresolved", ("gone.tsv", "a"): "no_file", ("gone.tsv", "1"): "no_file",
    }


def test_pointers(spark):
    files = spark.createDataFrame(
        [("a.json", '{"a": {"b": [1, null]}, "n": null}'), ("t.tsv", "x\ty\n1\t2\n"), ("e.txt", ""), ("m.gff3", "c\tID=1;protein_id=p"), ("s.fa", ">id1 d\nAC\n>id2\nGT")],
        "file string, text string",
    )
    cases = {
        ("a.json", "a.b.1"): "resolved", ("a.json", "a.b.2"): "unresolved", ("a.json", "n"): "resolved", ("a.json", "z"): "unresolved",
        ("t.tsv", "y"): "resolved", ("t.tsv", "2"): "resolved", ("t.tsv", "3"): "unresolved", ("e.txt", "empty"): "resolved", ("e.txt", "1"): "unresolved",
        ("m.gff3", "protein_id"): "resolved", ("m.gff3", "Parent"): "unresolved", ("s.fa", "id2"): "resolved", ("s.fa", "id3"): "unresolved",
        ("meta.json", "a"): "unsafe", ("gone.md", "1"): "no_file",
    }
    df = spark.createDataFrame(list(cases), "file string, locator string")
    assert {(r.file, r.locator): r.outcome for r in X.resolve_pointers(df, files).collect()} == cases


def test_few_names_travel_with_their_file_and_many_are_met(spark):
    wide = "\t".join(f"c{i}" for i in range(X.FEW_NAMES + 1))
    small = spark.createDataFrame([("a.tsv", "x\ty")], "file string, text string")
    files = small.union(spark.createDataFrame([("b.tsv", wide)], "file string, text string"))
    asked = [("a.tsv", "x"), ("a.tsv", "z"), ("b.tsv", "c0"), ("b.tsv", "x"), ("gone.tsv", "x")]
    pointers = spark.createDataFrame(asked, "file string, locator string")
    for df, outcome in ((small, "no_file"), (files, "resolved")):
        out = X.resolve_pointers(pointers, df)
        plan = out._jdf.queryExecution().analyzed().toString()
        assert plan.count("Join ") == (1 if df is small else 2)
        got = {(r.file, r.locator): r.outcome for r in out.collect()}
        assert got[("a.tsv", "x")] == "resolved" and got[("a.tsv", "z")] == "unresolved" and got[("b.tsv", "c0")] == outcome
