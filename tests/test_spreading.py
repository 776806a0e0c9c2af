"""Work on one hot key or file is spread: pages of a gzip file, medians by ranges, regions by pieces."""

import gzip
import math
import random
import re
import statistics
from collections import Counter

from pyspark.sql import functions as F

from genomeloom.operators import sequences as Q
from genomeloom.operators import spread as W
from genomeloom.sources import sequences as S
from genomeloom.sources.features import read_gff3


def test_gzip_equals_plain_over_many_pages(spark, tmp_path, monkeypatch):
    lines = [x for i in range(400) for x in (f"@r{i}", "ACGT", "+", "IIII")]
    text = "\n".join(lines) + "\n"
    (tmp_path / "a.fastq").write_text(text)
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(text.encode()))
    # Small pages: the buckets of one split.
    monkeypatch.setattr(S, "page", lambda: F.struct("block", F.shiftright("pos", 5).alias("page")))
    lines_of = S.read_lines(spark, str(tmp_path / "b.fastq.gz"))
    assert lines_of.select(S.page()).distinct().count() == 50
    rows = [sorted(map(tuple, S.read_fastq(spark, str(tmp_path / n)).drop("file").collect())) for n in ("a.fastq", "b.fastq.gz")]
    assert rows[0] == rows[1] and len(rows[0]) == 400


def test_repeated_keys_keep_the_last(spark, write):
    body = "c\tx\tgene\t1\t9\t.\t+\t.\tID=a;note=1;flag;note=2;;ID=b;empty=\n"
    row = read_gff3(spark, write("r.gff3", body)).first()
    assert row.fid == "b" and row.attrs == {"ID": "b", "note": "2", "empty": ""}


def test_median_by_narrowing_ranges(spark, monkeypatch):
    """Keys with more values than a task may hold: odd and even counts, heavy values, negative and fractional ones, ties."""
    rng = random.Random(4)
    groups = {
        "odd": [rng.uniform(-1e6, 1e9) for _ in range(3001)],
        "even": [rng.gauss(0, 1) for _ in range(2000)],
        "heavy": [5.0] * 4000 + [float(i) for i in range(1500)],
        "spread": [10.0**e for e in range(-150, 150)] * 3,
        "two": [1.0, 2.0],
        "few": [3.0] * 7,
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("none", None)], "k string, v double")
    want = {k: statistics.median(v) for k, v in groups.items()}
    for most in (100, 10**6):
        monkeypatch.setattr(W, "MEDIAN_VALUES", most)
        got = {r["k"]: r["m"] for r in W.exact_median(df, ["k"], "v", "m").collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) <= 1e-9 * abs(want[k]) for k in want)
    whole = df.withColumn("v", F.floor("v").cast("long")).where("abs(v) < 1e9")
    plain = {k: statistics.median([math.floor(x) for x in v if abs(math.floor(x)) < 1e9]) for k, v in groups.items()}
    monkeypatch.setattr(W, "MEDIAN_VALUES", 100)
    assert {r["k"]: r["m"] for r in W.exact_median(whole, ["k"], "v", "m").collect()} == plain


def test_regions_of_records_in_pieces(spark):
    records = {"a": "NNNNacgtacgtNN" * 30, "b": "a" * 500, "c": "N" * 90, "d": ""}
    rows = [(k, i + 1, v[i : i + 37]) for k, v in records.items() for i in range(0, len(v), 37)]
    pieces = spark.createDataFrame(rows, "id string, start long, bases string").repartition(3)
    regions = [("a", 5, 12, "soft"), ("a", 5, 13, "soft"), ("a", 1, 4, "hard"), ("a", 1, 4, "soft"), ("a", 13, 18, "hard"), ("b", 1, 500, "soft"), ("b", 400, 501, "soft"),
               ("b", 0, 3, "soft"), ("b", 9, 8, "soft"), ("c", 1, 90, "hard"), ("c", 90, 90, "hard"), ("c", 90, 90, "hard"), ("d", 1, 1, "soft"), ("gone", 1, 2, "soft")]
    asked = spark.createDataFrame(regions, "id string, start long, end long, expected string")
    whole = spark.createDataFrame(list(records.items()), "id string, seq string")

    def outcome(ident, start, end, expected):
        seq = records[ident]
        if not 1 <= start <= end <= len(seq):
            return "outside"
        return "as_declared" if re.fullmatch("[acgt]+" if expected == "soft" else "N+", seq[start - 1 : end]) else "differs"

    want = Counter((*r, outcome(*r)) for r in regions if r[0] in records)
    cols = ("id", "start", "end", "expected", "outcome")
    assert Counter(tuple(r[c] for c in cols) for r in Q.check_regions(whole, asked, "id").collect()) == want
    some = Counter({k: n for k, n in want.items() if k[0] != "d"})
    assert Counter(tuple(r[c] for c in cols) for r in Q.check_piece_regions(pieces, asked, ["id"]).collect()) == some
