"""Block gzip by ranges of compressed bytes against the plain lines."""

import gzip
import random

import pytest

from genomeloom.sources import blockgzip as B
from genomeloom.sources import sequences as S


def _members(text, sizes):
    out, at = b"", 0
    while at < len(text):
        n = next(sizes)
        out += B.member(text[at : at + n])
        at += n
    return out + B.member(b"")


def _lines(rng, n):
    long = ["x" * 70_000 if i == n // 2 else "".join(rng.choices("ACGT@+é", k=rng.choice([0, 1, 5, 80, 300]))) for i in range(n)]
    return long


@pytest.mark.parametrize("ending", ["\n", ""])
def test_ranges_give_every_line_once(spark, tmp_path, ending):
    rng = random.Random(len(ending))
    lines = _lines(rng, 1500) + ["end"]
    text = ("\n".join(lines) + ending).encode()
    data = _members(text, iter(lambda: rng.choice([1, 60, 900, 5000, 65_000]), None))
    assert gzip.decompress(data) == text
    path = tmp_path / "a.gz"
    path.write_bytes(data)
    for step in (200, 3000, 1 << 20):
        df = B.read_block_gzip_lines(spark, str(path), step)
        rows = sorted(df.collect(), key=lambda r: (r["block"], r["pos"]))
        assert [r["value"] for r in rows] == lines
        assert len({r["block"] for r in rows}) > 1 or step > len(data)
        numbered = {r["line"]: r["value"] for r in S.numbered_lines(df).collect()}
        assert numbered == dict(enumerate(lines))


def test_plain_gzip_is_one_range(spark, tmp_path):
    text = b"a\nb\r\n\nc" * 500
    (tmp_path / "a.gz").write_bytes(gzip.compress(text[:900]) + gzip.compress(text[900:]))
    rows = B.read_block_gzip_lines(spark, str(tmp_path / "*.gz"), 100).orderBy("pos").collect()
    assert [r["value"] for r in rows] == text.decode().replace("\r", "").split("\n")
    assert {r["block"] for r in rows} == {0}


def test_magic_inside_a_member_is_no_member():
    whole = B.member(b"line\n" * 50)
    noise = b"zz" + B.MAGIC + bytes(6) + (6).to_bytes(2, "little") + B.SIZE_FIELD + (99).to_bytes(2, "little")
    assert B.first_member(noise + bytes(200) + whole, True) == len(noise) + 200
    assert B.first_member(noise, True) is None


def test_fastq_in_blocks_equals_plain(spark, tmp_path):
    rng = random.Random(2)
    reads = [(f"r{i}", "".join(rng.choices("ACGTN", k=rng.randint(1, 150)))) for i in range(900)]
    text = "".join(f"@{h}\n{s}\n+\n{'@' * len(s)}\n" for h, s in reads) + "@cut\nAC\n"
    (tmp_path / "plain.fastq").write_text(text)
    (tmp_path / "block.fastq.gz").write_bytes(_members(text.encode(), iter(lambda: 1000, None)))
    plain = S.read_fastq(spark, str(tmp_path / "plain.fastq"))
    lines = B.read_block_gzip_lines(spark, str(tmp_path / "block.fastq.gz"), 2000)
    assert lines.rdd.getNumPartitions() > 5
    block = S.fastq_records(lines)
    key = lambda df: sorted(map(tuple, df.drop("file").collect()))
    assert key(block) == key(plain) == key(S.read_fastq(spark, str(tmp_path / "block.fastq.gz"), block_gzip=True))
    # Lines are numbered in place: records meet in one exchange.
    assert block._jdf.queryExecution().executedPlan().toString().count(" Exchange hashpartitioning") == 1


def test_written_parts_are_read_back(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('line ', id, repeat('x', id % 90)) AS value").repartition(3)
    files = B.write_block_gzip(rows, str(tmp_path / "out"), member_bytes=700)
    assert len(files) == 3
    got = B.read_block_gzip_lines(spark, files, 1500)
    assert sorted(r["value"] for r in got.collect()) == sorted(r["value"] for r in rows.collect())
