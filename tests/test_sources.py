import random

import pytest
from pyspark.sql import functions as F

from genomeloom.sources import features as X
from genomeloom.sources import sequences as Q
from genomeloom.sources import sinks
from genomeloom.sources import tables as T

FASTA = ">s1 first record\nACGTacgt\nNNnn\n>s2\r\nMKV*\r\n>s3 x\nAC GT\n"


@pytest.mark.parametrize("name", ["a.fa", "a.fa.gz"])
def test_fasta_records(spark, write, name):
    rows = Q.with_ordinal(Q.read_fasta(spark, write(name, FASTA))).orderBy("rec").collect()
    assert [(r.rec, r.id, r.header, r.seq) for r in rows] == [
        (0, "s1", "s1 first record", "ACGTacgtNNnn"),
        (1, "s2", "s2", "MKV*"),
        (2, "s3", "s3 x", "ACGT"),
    ]


def test_fasta_pieces_know_their_offset(spark, write):
    rows = Q.read_fasta_pieces(spark, write("a.fa", FASTA)).orderBy("rec", "start").collect()
    assert [(r.rec, r.id, r.start, r.bases) for r in rows] == [
        (0, "s1", 1, "ACGTacgt"),
        (0, "s1", 9, "NNnn"),
        (1, "s2", 1, "MKV*"),
        (2, "s3", 1, "ACGT"),
    ]


def test_fasta_order_survives_many_splits(spark, write):
    rng = random.Random(5)
    records = [(f"r{i}", "".join(rng.choice("ACGTacgt") for _ in range(rng.randint(1, 300)))) for i in range(3000)]
    path = write("big.fa", "".join(f">{i} d\n{s}\n" for i, s in records))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = Q.with_ordinal(Q.read_fasta(spark, path)).orderBy("rec").select("rec", "id", "seq").collect()
        whole = Q.read_fasta_pieces(spark, path).groupBy("id").agg(F.sum(F.length("bases")).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.id, r.seq) for r in rows] == records
    assert [r.rec for r in rows] == list(range(3000))
    assert {r.id: r.n for r in whole} == {i: len(s) for i, s in records}


@pytest.mark.parametrize(
    "text, reason",
    [
        ("ACGT\n>a\nAC\n", "sequence_before_header"),
        (">a\nAC\n>a\nGT\n", "repeated_id"),
        (">a\n>b\nAC\n", "empty_sequence"),
        (">\nAC\n>b\nAC\n", "empty_header"),
        ("\n\n", "no_records"),
    ],
)
def test_strict_fasta_rejects(spark, write, text, reason):
    path = write("bad.fa", text)
    assert reason in {r.reason for r in Q.fasta_problems(spark, path).collect()}
    with pytest.raises(ValueError, match=reason):
        Q.read_fasta(spark, path, strict=True)


def test_fasta_writer_wraps(spark, tmp_path):
    df = spark.createDataFrame([("a", "A" * 80), ("b", "C" * 81), ("c", "G")], "header string, seq string").coalesce(1)
    out = str(tmp_path / "out")
    sinks.write_fasta(df, out)
    lines = "\n".join(r.value for r in spark.read.text(out).collect()).split("\n")
    assert lines == [">a", "A" * 80, ">b", "C" * 80, "C", ">c", "G"]


def test_fastq(spark, write):
    text = "@r1/1\nACGT\n+\n@@@@\n@r2\nAC\n+x\nI\n@r3\nA\n"
    rows = Q.read_fastq(spark, write("a.fq", text)).orderBy("rec").collect()
    assert [(r.header, r.seq, r.reason) for r in rows] == [
        ("@r1/1", "ACGT", None),
        ("@r2", "AC", "quality_length"),
        ("@r3", "A", "incomplete"),
    ]
    with pytest.raises(ValueError):
        Q.read_fastq(spark, write("b.fq", text), strict=True)


GFF = "\n".join(
    [
        "##gff-version 3",
        "##sequence-region chr1 1 5000",
        "# comment",
        "chr1\tx\tgene\t1\t900\t.\t+\t.\tID=g%3B1;Name=a+b",
        "chr1\tx\tmRNA\t1\t900\t.\t+\t.\tID=t1;Parent=g%3B1",
        "chr1\tx\tCDS\t1\t90\t.\t+\t0\tParent=t1,t%2C2;protein_id=p1;flag",
        "chr1\tx\tCDS\t90\t1\t.\t+\t0\tParent=t1",
        "chr1\tx\tCDS\t1\t90\t.\t+\t0\tParent=t1;Parent=t2",
        "too\tshort",
        "##FASTA",
        ">chr1",
        "ACGT\tnot\ta row",
    ]
)


def test_gff3_lenient_and_reasons(spark, write):
    path = write("a.gff3", GFF)
    rows = X.read_gff3(spark, path).orderBy("block", "pos").collect()
    assert [r.kind for r in rows] == ["gene", "mRNA", "CDS", "CDS", "CDS"]
    assert rows[0].fid == "g;1" and rows[0].attrs["Name"] == "a+b"
    assert rows[1].parents == ["g;1"] and rows[2].parents == ["t1", "t,2"]
    assert rows[4].parents == ["t2"]
    reasons = [r.reason for r in X.scan_gff3(spark, path).orderBy("block", "pos").collect()]
    assert reasons == [None, None, "attributes", "coordinates", "attributes", "width"]
    with pytest.raises(ValueError):
        X.read_gff3(spark, path, strict=True)
    region = X.read_regions(spark, path).collect()
    assert [(r.seqid, r.start, r.end) for r in region] == [("chr1", 1, 5000)]


def test_gtf_identifiers(spark, write):
    head = "c\tx\t{}\t1\t9\t.\t+\t.\t{}"
    cases = [
        ("CDS", 'transcript_id "t"; gene_id "g1"', "g1", "gene_id_attribute", None),
        ("CDS", "gene_id g2;", "g2", "gene_id_attribute", None),
        ("CDS", "gene_id=g3", "g3", "gene_id_attribute", None),
        ("gene", "ID=g4;Name=x", "g4", "gene_feature_ID", None),
        ("gene", "g5;", "g5", "bare_gene_feature_ID", None),
        ("gene", ".", None, None, "no_identifier"),
        ("CDS", 'gene_id "a"; gene_id "b"', None, None, "repeated_gene_id"),
        ("CDS", "Parent=t1", None, None, None),
    ]
    path = write("a.gtf", "\n".join(head.format(k, a) for k, a, *_ in cases))
    rows = X.read_gtf(spark, path).orderBy("pos").collect()
    assert [(r.gene_id, r.format, r.problem) for r in rows] == [c[2:] for c in cases]


def test_hits_domains_annotation(spark, write):
    good = ["q1", "s1", "90"] + ["1"] * 7 + ["1e-5", "200.5", "9", "9", "50", "60", 'a "quoted" title']
    path = write("h.tsv", "\t".join(good) + "\n" + "\t".join(good[:16]) + "\n\n")
    rows = T.read_hits(spark, path).collect()
    assert len(rows) == 1 and rows[0].evalue == 1e-5 and rows[0].stitle == 'a "quoted" title'
    path = write("d.tsv", "p1\tx\tIPR000001\tGO:0000001(A)|GO:0000002\np1\tIPR123\tGO:12\n")
    rows = T.read_domains(spark, path).collect()
    assert rows[0].domains == ["IPR000001"] and rows[0].terms == ["GO:0000001", "GO:0000002"]
    assert rows[1].domains == [] and rows[1].terms == []
    path = write("a.tsv", "s1\tone\ttwo\ns2\tthree\n")
    keys = spark.createDataFrame([("s1",)], "sseqid string")
    assert [tuple(r) for r in T.read_id_annotation(spark, path, keys).collect()] == [("s1", "one\ttwo")]


def test_tables_with_marks_and_torn_lines(spark, write):
    path = write("t.tsv", "﻿query\tn\na\t1\nb\t2\n")
    assert [tuple(r) for r in T.read_tsv(spark, path, "query string, n int").collect()] == [("a", 1), ("b", 2)]
    from pyspark.sql import types as ty

    schema = ty.StructType([ty.StructField("k", ty.LongType())])
    rows = T.read_records(spark, write("r.jsonl", '{"k": 1}\n{"k": 2}\n{"k"'), schema).collect()
    assert [r.k for r in rows] == [1, 2, None] and rows[2]._corrupt_record == '{"k"'


def test_checksums_and_inventory(spark, write, tmp_path):
    import hashlib

    a, b = "a" * 64, "b" * 64
    path = write("sums/list.txt", f"{a}  x/1\n{b} *x/2\n{b}  x/1\nnonsense\n")
    lines = T.read_checksums(spark, path)
    assert lines.where("not valid").count() == 1
    got = {r.path: (r.sha256, r.conflict) for r in T.resolve_checksums(lines).collect()}
    assert got == {"x/1": (None, True), "x/2": (b, False)}
    write("tree/sub/f.bin", "hello")
    rows = T.inventory_files(spark, str(tmp_path / "tree")).collect()
    assert [(r.size_bytes, r.sha256) for r in rows] == [(5, hashlib.sha256(b"hello").hexdigest())]
    # In small reads, as a file of any size is read.
    name = write("big file.bin", "0123456789" * 1000)
    want = hashlib.sha256(b"0123456789" * 1000).hexdigest()
    assert T.file_digest(name, 7) == want == T.file_digest(f"file:{name}", 1 << 20)


def test_a_file_without_digest_is_there(spark):
    from genomeloom.operators import reconcile as C
    from pyspark.sql import functions as F

    files = spark.createDataFrame([("a", 3_000_000_000, None), ("b", 5, "y")], "path string, size_bytes long, sha256 string")
    listed = spark.createDataFrame([("a", 3_000_000_000, "x"), ("b", 5, "y"), ("c", 1, "z")], files.schema)
    reasons = {r.path: r.reason for r in C.verify_bundle(listed, files).collect()}
    assert reasons == {"a": "unverified", "b": "ok", "c": "missing"}
    sums = listed.select("path", "sha256", F.lit(False).alias("conflict"))
    r = C.source_receipts(sums, files, F.lit("all")).first()
    assert (r.verified, r.unverified, r.missing, r.changed) == (1, 1, 1, 0)


def test_logs(spark, write, tmp_path):
    write("logs/a.log", "x\n 93.456% overall alignment rate\n")
    write(
        "logs/b.log",
        "# BUSCO was run in mode: proteins\n# The lineage dataset is: fungi_odb10 (x)\n C:97.4%[S:90.0%,D:7.4%],F:1.0%,M:1.6%,n:758\nVersion : 3.9\n",
    )
    logs = T.read_logs(spark, str(tmp_path / "logs"))
    rows = T.parse_versions(T.parse_completeness(T.parse_alignment_rate(logs))).orderBy("file").collect()
    assert rows[0].alignment_rate_pct == 93.46 and not rows[0].parsed
    assert (rows[1].complete_pct, rows[1].n, rows[1].lineage, rows[1].mode, rows[1].version) == (97.4, 758, "fungi_odb10", "proteins", "3.9")


def test_publish_refuses_overwrite(spark, tmp_path):
    df = spark.range(10)
    out = str(tmp_path / "table")
    assert sinks.publish(df, out)["rows"] == 10
    with pytest.raises(FileExistsError):
        sinks.publish(df, out)
    assert spark.read.parquet(out).count() == 10


def test_discovery_merges_copies(spark):
    names = ["GCF_1.1_ASM_genomic.gff.gz", "GCF_1.1_ASM (1)_genomic.gff.gz", "GCF_1.1_ASM_protein.faa", "own_protein.faa", "notes.txt"]
    files = spark.createDataFrame([(n,) for n in names], "name string")
    registry = spark.createDataFrame([("GCF_1.1", "Sp", "fungi")], "accession string, species string, clade string")
    rows = {r.accession: r for r in T.discover_genomes(files, registry).collect()}
    assert set(rows) == {"GCF_1.1", "own"}
    assert rows["GCF_1.1"].copies == 1 and rows["GCF_1.1"].clade == "fungi" and rows["GCF_1.1"].faa
    assert rows["own"].clade == "unknown" and not rows["own"].registered and rows["own"].gff is None


def test_logs_land_in_one_folder(spark, monkeypatch, tmp_path):
    """A folder per log would be made, moved and listed one after the other."""
    from genomeloom import catalog
    from genomeloom.catalog import files

    monkeypatch.setattr(files, "scratch", lambda session, label: str(tmp_path / label))
    rows = catalog.load()["tool_summaries"].run(spark, "/root/testdata/sf0.01").collect()
    logs = list((tmp_path / "logs").rglob("part-*"))
    assert len(rows) == len(logs) == 100 and {p.parent for p in logs} == {tmp_path / "logs"}
    assert len({p.name.split("-")[1] for p in logs}) > 1  # written by more than one task
