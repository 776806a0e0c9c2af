"""Exact dedup and sharding against plain Python."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from genomeloom.llm import exact, shard


def test_every_row_is_decided(hard, hard_rows):
    got = exact.exact_dedup(hard).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in hard_rows:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(doc_id)
    assert len(got) == len(hard_rows)
    seen = defaultdict(list)
    for r in got:
        ids = [i for i in groups[r["text_sha256"]] if i is not None]
        assert r["group_size"] == len(groups[r["text_sha256"]])
        assert r["keep_id"] == max(ids, default=None)
        seen[r["text_sha256"]].append(r)
    for rows in seen.values():
        assert [r["doc_id"] for r in rows if r["kept"]] == [rows[0]["keep_id"]]
    assert {r["shard"] for r in got} == {"mine"}


def test_frequent_digests_are_split_off(llm):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 40}") for i in range(3000)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    digests = docs.select(F.sha2("text", 256).alias("text_sha256"))
    hot = hashlib.sha256(b"hot").hexdigest()
    assert hot in [r[0] for r in exact.frequent_digests(digests, tracked=32, heavy=8).collect()]
    got = exact.exact_dedup(docs, tracked=32, heavy=8).where("kept").collect()
    assert {(r["doc_id"], r["group_size"]) for r in got if r["text_sha256"] == hot} == {(2997, 1000)}
    assert len(got) == len({t for _, t in rows})


def test_copies_drop_and_columns_stay(hard, hard_rows):
    kept = exact.drop_copies(hard)
    assert kept.columns == hard.columns
    assert kept.count() == len({(t or "") for _, t, *_ in hard_rows})


def test_empty_tables(empty):
    assert exact.exact_dedup(empty).count() == 0
    assert shard.shuffle_shards(empty).count() == 0


def _slots(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return by


def test_shards_hold_every_row_once(hard, hard_rows):
    got = shard.shuffle_shards(hard, shards=7, cell_rows=5).collect()
    by = _slots(got)
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1 and set(by) == set(range(7))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    plain = lambda rows: sorted(str(r) for r in rows)
    assert plain((r["doc_id"], r["text"]) for r in got) == plain((i, t) for i, t, *_ in hard_rows)


def test_fewer_rows_than_shards(hard):
    by = _slots(shard.shuffle_shards(hard.limit(5), shards=16).collect())
    assert sorted(map(len, by.values())) == [1] * 5


def test_matrix_has_exact_margins_over_two_levels(llm):
    counts = [(i, (i * 37) % 50) for i in range(150)]
    got = shard.communication_matrix(llm.createDataFrame(counts, "part long, n long"), 8, seed=5).collect()
    assert {r["part"]: sum(r["room"]) for r in got} == dict(counts)
    totals = [sum(r["room"][j] for r in got) for j in range(8)]
    assert max(totals) - min(totals) <= 1 and sum(totals) == sum(n for _, n in counts)


def test_draws_follow_the_hypergeometric_law(llm):
    from math import comb

    total, marked, drawn, n = 40, 13, 9, 20_000
    u = (F.col("id") + 0.5) / n
    got = llm.range(n).select(
        shard.hypergeometric(u, F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(drawn).cast("long")).alias("x")
    )
    seen = {r["x"]: r["count"] / n for r in got.groupBy("x").count().collect()}
    for x in range(10):
        law = comb(marked, x) * comb(total - marked, drawn - x) / comb(total, drawn)
        assert abs(seen.get(x, 0) - law) <= 1.5 / n


def test_slots_are_uniform(llm):
    """Chi-square over places of rows that lie together in the input."""
    docs = llm.range(4000).repartition(4).withColumnRenamed("id", "doc_id")
    got = shard.shuffle_shards(docs, shards=4, seed=9).collect()
    cells = defaultdict(int)
    for r in got:
        cells[(r["doc_id"] // 1000, r["shard"], r["slot"] // 250)] += 1
    assert len(cells) == 64
    assert sum((n - 62.5) ** 2 / 62.5 for n in cells.values()) < 110  # 45 degrees of freedom
