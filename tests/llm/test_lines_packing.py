"""Line dedup, packing and the pipeline against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from genomeloom.llm import lines, packing
from genomeloom.session import written


def words_with_lines(text):
    """Words, the place of each in the text, and which ones begin a line or sentence."""
    spans = [(m.start(), m.end()) for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", text)]
    begins = {
        n
        for n, (a, _) in enumerate(spans)
        if n == 0 or b"\n" in text[spans[n - 1][1] : a] or text[spans[n - 1][1] - 1 : spans[n - 1][1]] in (b".", b"!", b"?")
    }
    return [text[a:b] for a, b in spans], spans, begins


def plain_elected(words, least):
    """The last smallest rolling line of every ``least`` of them."""
    powers = [pow(lines.ODD[0], k, 1 << 64) for k in range(least)]
    values = [int.from_bytes(xxhash.xxh3_128_digest(w)[:8], "little") for w in words]
    hashes = []
    for at in range(len(words) - least + 1):
        found = sum(v * p for v, p in zip(values[at : at + least], powers)) % (1 << 64)
        hashes.append((found ^ found >> 31) * lines.ODD[0] % (1 << 64) >> lines.PLACE_BITS)
    out = set()
    for at in range(max(1, len(hashes) - least + 1) if hashes else 0):
        part = hashes[at : at + least]
        out.add(at + max(n for n, h in enumerate(part) if h == min(part)))
    # Of neighbours that are equal rolling lines every so many, and the last.
    kept, since = set(), 0
    for at in sorted(out):
        line = words[at : at + least]
        since = since + 1 if at - 1 in out and words[at - 1 : at - 1 + least] == line else 0
        if since % least == 0 or at + 1 not in out or words[at + 1 : at + 1 + least] != line:
            kept.add(at)
    return kept


def plain_dedup(rows, least, edge=lines.EDGE):
    """What stood before goes, as far as the first place of an elected rolling line agrees with a later one."""
    order = sorted({(i is None, i or 0, t) for i, t in rows}, key=lambda r: (r[0], r[1], r[2] or ""))
    seen, out, cut = {}, {}, [words_with_lines((t or "").encode()) for _, _, t in order]
    for number, (missing, i, t) in enumerate(order):
        words, spans, begins = cut[number]
        gone = set()
        for at in sorted(plain_elected(words, least)):
            source, first = seen.setdefault(tuple(words[at : at + least]), (number, at))
            if source == number and at < first + least:
                continue
            other = cut[source][0]
            a, x = at, first
            while a > 0 and x > 0 and at - a < least - 1 and words[a - 1] == other[x - 1]:
                a, x = a - 1, x - 1
            b, y = at + least, first + least
            while b < len(words) and y < len(other) and b - at < 2 * least - 1 and words[b] == other[y]:
                b, y = b + 1, y + 1
            gone |= set(range(a, b))
        text, keep = (t or "").encode(), []
        starts = [n for n in sorted(gone) if n - 1 not in gone]
        for a in starts:
            b = a
            while b in gone:
                b += 1
            a = next((n for n in range(a, min(a + edge, len(words))) if n in begins), a)
            if b < len(words) and b not in begins:
                b = next((n for n in range(b - 1, max(0, b - edge + 1) - 1, -1) if n in begins), b)
            if a < b:
                keep.append((spans[a][0] if a else 0, spans[b][0] if b < len(words) else len(text)))
        for a, b in reversed(keep):
            text = text[:a] + text[b:]
        out[None if missing else i, t] = None if t is None else text.decode()
    return out


@pytest.mark.parametrize("least", [8, 20])
def test_lines_against_plain(hard, hard_rows, empty, least):
    # One id with two texts is ordered by hash, which the plain version does not know: it has no part here.
    rows = [r for r in hard_rows if r[0] is not None or r[1] is None]
    rows = [r for r in rows if r[0] != 10]
    got = lines.dedup_lines(hard.where("(doc_id is not null or text is null) and not doc_id <=> 10"), min_words=least)
    want = plain_dedup([(r[0], r[1]) for r in rows], least)
    texts = Counter((r["doc_id"], r["text"]) for r in got.collect())
    assert texts == Counter((r[0], want[r[0], r[1]]) for r in rows)
    assert got.columns == [*hard.columns, "n_removed"]
    assert lines.dedup_lines(empty).count() == 0


def test_every_run_of_fifty_words_is_met(llm):
    """Verbatim runs at any place of unpunctuated texts, in texts that differ everywhere else."""
    rng = random.Random(5)

    def own(n):
        return ["w%x" % rng.getrandbits(40) for _ in range(n)]

    runs = [own(n) for n in (39, 45, 50, 50, 60, 92, 400)]
    rows, spots = [], {}
    for i in range(120):
        run = runs[i % len(runs)]
        head = own(rng.randint(0, 70))
        rows.append((i, " ".join(head + run + own(rng.randint(0, 70)))))
        spots[i] = set(run)
    got = {r["doc_id"]: r for r in lines.op3_winnowed_lines(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        left, before = got[i]["text"].split(), text.split()
        if i < len(runs):
            assert left == before and got[i]["n_removed"] == 0
            continue
        # Runs are drawn back by fewer than EDGE words at the beginning or end of the whole text only.
        assert [w for w in before if w not in spots[i]] == [w for w in left if w not in spots[i]]
        assert got[i]["n_removed"] == len(before) - len(left) == len(spots[i])


def test_periodic_texts_and_null_rows(llm):
    rows = [(1, "la " * 500), (2, "la " * 500), (2, "la " * 500), (None, "la " * 30), (3, None), (4, ""), (5, "  \n ")]
    got = lines.op3_winnowed_lines(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {(r["doc_id"], r["n_removed"]): r["text"] for r in got}
    assert len(got) == 7 and by[3, 0] is None and by[4, 0] == "" and by[5, 0] == "  \n "
    assert [r["text"] for r in got if r["doc_id"] == 2] == ["", ""] and by[None, 30] == ""
    first = next(r for r in got if r["doc_id"] == 1)
    assert 20 <= len(first["text"].split()) < 60 and first["n_removed"] == 500 - len(first["text"].split())


def test_the_first_of_equal_passages_stays(llm):
    passage = "\n".join(f"line {n} of a passage that comes again word for word" for n in range(6))
    rows = [(i, f"own start {i}.\n{passage}\nown end {i}.") for i in range(1, 40)]
    got = dict(lines.dedup_lines(llm.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect())
    assert got[1] == rows[0][1]
    assert all(got[i] == f"own start {i}.\nown end {i}." for i in range(2, 40))


def test_a_short_common_line_stays(llm):
    rows = [(i, f"All rights reserved.\nA text that is like no other, number {i}.") for i in range(20)]
    got = lines.dedup_lines(llm.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in got.select("doc_id", "text").collect()) == rows


def test_texts_are_read_twice_and_prints_given_back(llm, monkeypatch):
    """Once for the fingerprints, once to meet what names them; only prints that stand twice are ordered."""
    from pyspark.sql import functions as F

    seen, stored, real = llm.sparkContext.accumulator(0), {}, lines.materialize

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def kept(df, label):
        out = real(df, label)
        stored[label] = out.count()
        return out

    monkeypatch.setattr(lines, "materialize", kept)
    before = set(written())
    rng = random.Random(8)
    own = lambda n: " ".join("w%x" % rng.getrandbits(40) for _ in range(n))
    passage = own(60)
    rows = [(i, own(200)) for i in range(30)] + [(i, f"{own(30)}\n{passage}\n{own(30)}") for i in range(30, 36)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.mapInArrow(counted, docs.schema).withColumn("nothing", F.lit(None))
    got = lines.dedup_lines(docs)
    left = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.columns == ["doc_id", "text", "nothing", "n_removed"]
    assert left == {i: t.replace(passage + "\n", "") if i > 30 else t for i, t in rows}
    assert seen.value == 2 * len(rows)
    assert stored["met"] == len(rows) and stored["again"] * 4 < stored["prints"]
    assert not [p for p in written() if p not in before and "/prints-" in p]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.word_tokenizer())


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(hard, hard_rows, tokenizer, capacity):
    got = packing.pack(hard, packing.word_tokenizer(), capacity=capacity)
    rows = got.collect()
    want = Counter()
    for i, t, *_ in hard_rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4").tobytes()
            want[i, k // capacity, k, len(part) // 4, zlib.crc32(part), part] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert least <= len(by) <= least * 1.03 + 1
    if capacity == 16:
        whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(got).collect()}
        assert sum(map(len, whole.values())) == 4 * sum(r["length"] for r in rows)


def test_plan_of_counts():
    plan = packing.best_fit({10: 3, 6: 4, 4: 3, 1: 9}, 10)
    assert sum(n for _, _, n, *_ in plan) == 19
    assert len({first + x // per for _, _, n, first, per, _ in plan for x in range(n)}) == 8  # 75 tokens: eight bins


def test_nothing_to_pack(empty):
    assert packing.pack(empty, packing.word_tokenizer()).count() == 0


def test_pipeline_stages(hard, hard_rows, llm, tmp_path):
    """Each stage on all that the one before kept; documents keep their columns up to the last."""
    names = ["doc_id", "text", "lang", "source"]
    docs = hard.select(*names).selectExpr("*", "cast(length(text) as bigint) as n_chars")
    labels = llm.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(llm, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        kept = llm.read.parquet(str(tmp_path / name))
        if number < 4:
            assert kept.columns == docs.columns
        if name == "quality":
            assert kept.count() == sum(len((t or "").split()) >= 20 for _, t, *_ in hard_rows) - 1  # the text of repeats
        if name == "lines":
            assert kept.count() == docs.count()
            assert kept.where("n_chars <> length(text)").count() == 0
        if name == "near":
            assert kept.count() <= docs.count() and kept.exceptAll(docs).count() == 0
        if name == "mixing":
            assert kept.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
        if name == "packing":
            assert kept.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
            assert kept.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
        docs = kept
