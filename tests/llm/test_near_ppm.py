"""Near-duplicates and partial matching against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from genomeloom.llm import near, ppm


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_is_exact_inside_the_band():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.randrange(rng.choice([2, 6])) for _ in range(rng.randrange(14))]
        b = list(a) if rng.random() < 0.6 else [rng.randrange(4) for _ in range(rng.randrange(14))]
        for _ in range(rng.randrange(4)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(6))
            b.pop(rng.randrange(len(b)))
        limit, d = rng.randrange(8), distance(a, b)
        assert near.banded_distance(a, b, limit) == (d if d <= limit else None)


def test_sketch_keeps_text_order_and_occurrences():
    words = np.random.default_rng(2).integers(0, 1 << 62, 300).astype(np.uint64)
    factors = np.random.default_rng(3).integers(0, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)
    own = near.order_sketch(near.labelled_shingles(words), factors)
    half = np.concatenate([words[150:], words[:150]])  # the same parts in another order
    edited = words.copy()
    edited[150] += np.uint64(1)
    same = lambda x: (near.order_sketch(near.labelled_shingles(x), factors) == own).sum()
    assert same(edited) > 50 and same(half) < 20
    twice = near.labelled_shingles(np.concatenate([words, words]))
    assert len(np.unique(twice)) == len(twice)
    assert set(near.labelled_shingles(words).tolist()) <= set(twice.tolist())


def _classes(rows, similarity=0.8):
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    words = [(t or "").encode().split() for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            longest = max(len(words[i]), len(words[j]))
            limit = near.edit_limit(len(words[i]), len(words[j]), similarity)
            equal = (rows[i][1] or "") == (rows[j][1] or "")
            if equal or (longest and near.banded_distance(words[i], words[j], limit) is not None):
                up[max(top(i), top(j))] = min(top(i), top(j))
    out = defaultdict(set)
    for i in range(len(rows)):
        out[top(i)].add(i)
    return list(out.values())


def test_near_classes(hard, hard_rows, empty):
    got = near.near_classes(hard).collect()
    assert len(got) == len(hard_rows)
    rows = [(r["doc_id"], r["text"]) for r in got]
    for members in _classes(rows):
        ids = sorted(rows[i][0] for i in members if rows[i][0] is not None)
        assert {got[i]["class_id"] for i in members} == {ids[0] if ids else None}
        assert {got[i]["class_size"] for i in members} == {len(members)}
        assert sum(got[i]["kept"] for i in members) == 1
    assert near.near_classes(empty).count() == 0


def test_shared_passage_is_no_copy_and_chains_are_classes(llm):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(60)
    rows = [(i, " ".join(words(40) + passage + words(40))) for i in range(80)]
    chain, text = [], words(200)
    for i in range(100, 112):  # each close to the one before, the ends far from each other
        text = list(text)
        for at in rng.sample(range(200), 12):
            text[at] = f"c{rng.randrange(10**6)}"
        chain.append((i, " ".join(text)))
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(llm.createDataFrame(rows + chain, "doc_id long, text string")).collect()}
    assert all(got[i] == i for i in range(80))
    assert {got[i] for i, _ in chain} == {100}


def test_pairs_at_the_limit_share_a_bucket(llm):
    """20 edits per 100 words, evenly spread or not, and one edit in a text of a few words."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**9)}"
    rows = []
    for n in [*range(5, 45), *[150] * 20, *[400] * 10]:
        text = [word() for _ in range(n)]
        other, edits = list(text), n // 5
        even = [(2 * i + 1) * n // (2 * edits) for i in range(edits)]
        for at in even if n % 2 else rng.sample(range(n), edits):
            other[at] = word()
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(other))]
    rows += [(1000, "a b c d e f"), (1001, "a b c d f"), (1002, "x x y x z z"), (1003, "x y x z z")]
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == i - i % 2 for i in got)


def test_every_member_of_a_class_is_tried(llm, monkeypatch):
    """Texts that are near one member of a large class only, all in one bucket."""
    rng = random.Random(4)

    def edited(text, places, tag):
        return [f"{tag}{i}" if i in places else w for i, w in enumerate(text)]

    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        member = edited(base, set(rng.sample(range(100), 16)), f"m{i}_")  # at most 32 edits from each other
        rows += [(i, " ".join(member)), (100 + i, " ".join(edited(member, set(rng.sample(range(100, 200), 38)), f"b{i}_")))]
    buckets = lambda keyed, *_, **__: keyed.select(
        F.lit(1).cast("long").alias("bucket"), "key", F.lit(200).alias("words")
    )
    monkeypatch.setattr(near, "sketches", buckets)
    got = near.near_classes(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0}


def test_labels_of_stars_take_one_sum_and_links_between_classes_move_labels_only(llm, monkeypatch):
    stored, real = [], near.materialize
    monkeypatch.setattr(near, "materialize", lambda df, label: stored.append(label) or real(df, label))

    def labelled(edges):
        return dict(near.components(llm.createDataFrame(edges, "a long, b long")).collect())

    stars = [(hub, hub + leaf) for hub in (0, 100) for leaf in range(1, 40)]
    assert labelled(stars + stars[:5] + [(7, 7)]) == {k: min(e) // 100 * 100 for e in stars for k in e}
    assert stored == ["edges", "least"]
    rng = random.Random(7)
    for edges in ([(i, i + 1) for i in range(40)], [(rng.randrange(90), rng.randrange(90)) for _ in range(60)], [(9, 3), (9, 5), (2, 9), (8, 8)]):
        want = {k: k for e in edges if e[0] != e[1] for k in e}
        for _ in want:
            for a, b in edges:
                if a != b:
                    want[a] = want[b] = min(want[a], want[b])
        assert labelled(edges) == want
    assert labelled([(1, 1)]) == {}

    walked, components = [], near.components
    monkeypatch.setattr(near, "components", lambda edges: walked.extend(map(tuple, edges.collect())) or components(edges))
    labels = llm.createDataFrame([(0, 0), (1, 0), (2, 0), (10, 10), (11, 10), (20, 20), (21, 20)], "key long, label long")
    links = llm.createDataFrame([(10, 0), (30, 10), (40, 41)], "la long, lb long")
    got = near.united(labels, links).collect()
    assert len(got) == 10 and dict(got) == {**dict.fromkeys((0, 1, 2, 10, 11, 30), 0), 20: 20, 21: 20, 40: 40, 41: 40}
    assert sorted(walked) == [(10, 0), (30, 10), (40, 41)]


def plain_ppm(texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        s = [257] * order + list(t) + [256]
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[i - k : i])][s[i]] += 1

    def one(context, symbol):
        total, gone = 0.0, set()
        for k in range(order, -1, -1):
            seen = counts[k].get(tuple(context[order - k :]))
            if not seen:
                continue
            left = {x: n for x, n in seen.items() if x not in gone}
            if left:
                whole = sum(left.values()) + len(left)
                if symbol in left:
                    return total + math.log10(left[symbol] / whole)
                total += math.log10(len(left) / whole)
                gone |= set(left)
        return total - math.log10(257 - len(gone))

    def text(t):
        s = [257] * order + list(t) + [256]
        return sum(one(s[i - order : i], s[i]) for i in range(order, len(s)))

    return one, text


def test_members_of_a_bucket_meet_in_chunks_and_leave_as_one_row_per_text(llm, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for key in range(24):  # some alike, most too far from each other
        words = list(base)
        for place in rng.sample(range(60), rng.choice([4, 30])):
            words[place] = f"x{key}_{place}"
        texts[key] = " ".join(words)
    table = llm.createDataFrame([(k, bytearray(v.encode())) for k, v in texts.items()], "key long, text binary")
    members = llm.createDataFrame([(7, k, 60) for k in texts], "bucket long, key long, words int")
    labels = llm.createDataFrame([(1, 0), (0, 0)], "key long, label long")
    bag = {k: Counter(v.split()) for k, v in texts.items()}
    want = {
        (a, b) for a in texts for b in texts
        if a < b and (a, b) != (0, 1) and 60 - sum((bag[a] & bag[b]).values()) <= 12
    }
    assert 10 < len(want) < 150
    for chunk in (1024, 4):
        monkeypatch.setattr(near, "CHUNK", chunk)
        rows = near._open_pairs(members, labels, table, 0.8).collect()
        assert len(rows) == len({r.a for r in rows}) <= len(texts)
        found = {(r.a, b) for r in rows for b in (*r.first, *r.rest)}
        assert found >= want
        # Bags tell most of the others apart, too.
        assert len(found) <= len(want) + 10


def test_smallest_values_are_the_same_with_and_without_the_bound():
    values = np.random.default_rng(5).integers(0, 1 << 64, (200, 90), np.uint64)
    values[3] |= np.uint64(1 << 63)  # a row without small values
    for rows in (values, np.delete(values, 3, axis=0)):
        want = np.sort(np.argsort(rows, axis=1)[:, :3], axis=1)
        assert (near.smallest(rows, 3) == want).all()


def test_scores_against_plain(hard, hard_rows, empty):
    held = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == 1
    got = ppm.score_documents(hard, held, order=3).collect()
    assert len(got) == len(hard_rows)
    lowered = [(i, (t or "").encode().lower()) for i, t, *_ in hard_rows]
    learn = [t for i, t in lowered if (i or 0) % 4 != 1]
    words = Counter(w for t in learn for w in t.split())
    n, kinds = sum(words.values()) + len(learn), len(words) + 1
    one, whole = plain_ppm(learn, 3)
    assert abs(sum(10 ** one([97, 98, 32], s) for s in range(257)) - 1) < 1e-9
    want = Counter()
    for i, t in lowered:
        own = t.split()
        base = sum(math.log10((words[w] + 1) / (n + kinds + 1)) for w in own) + math.log10((len(learn) + 1) / (n + kinds + 1))
        want[i, (i or 0) % 4 == 1, len(own) + 1, sum(words[w] > 0 for w in own) + 1, n, round(base, 4), round(whole(t), 4)] += 1
    seen = Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 4))
        for r in got
    )
    assert seen == want
    assert ppm.score_documents(empty, F.lit(False)).count() == 0


def test_nothing_to_learn_from(hard):
    row = ppm.score_documents(hard.where("doc_id = 82"), F.lit(True)).first()
    assert row["n_known"] == 0 and row["train_tokens"] == 0
    assert abs(row["score"] + math.log10(257)) < 1e-9


def test_shards_give_the_same_scores(hard, monkeypatch):
    held = F.col("doc_id") % 3 == 0
    docs = hard.where("doc_id < 40")
    key = lambda rows: sorted((r["doc_id"], r["text"] if "text" in r else "", round(r["score"], 6)) for r in rows)
    one = key(ppm.score_documents(docs, held).collect())
    monkeypatch.setattr(ppm, "SHARD_NODES", 3000)
    monkeypatch.setattr(ppm, "CHUNK_TOKENS", 100)
    assert key(ppm.score_documents(docs, held).collect()) == one


def test_values_that_a_worker_does_not_hold_meet_their_places_by_a_join(hard, hard_rows, monkeypatch):
    """However few are held, down to none, the scores are those of plain Python, of unseen grams too."""
    lowered = [(i, (t or "").encode().lower()) for i, t, *_ in hard_rows if i is not None and i < 30]
    _, whole = plain_ppm([t for i, t in lowered if i % 4 != 1], 4)
    want = Counter((i, round(whole(t), 4)) for i, t in lowered)
    for held in (200, 0):
        monkeypatch.setattr(ppm, "SHARD_NODES", held)
        got = ppm.score_documents(hard.where("doc_id < 30"), F.col("doc_id") % 4 == 1, order=4).collect()
        assert Counter((r["doc_id"], round(r["score"], 4)) for r in got) == want


def test_a_task_reads_the_values_once_whatever_its_number_of_chunks(llm, hard_rows, monkeypatch):
    texts = [(t or "").encode() for _, t, *_ in hard_rows]
    monkeypatch.setattr(ppm, "SHARD_NODES", 3000)
    learned = llm.createDataFrame([(bytearray(t), i % 4 != 1) for i, t in enumerate(texts)], "text binary, learn boolean")
    model = ppm.train(learned.repartition(3), 3)
    tables, read = [], pq.read_table
    monkeypatch.setattr(pq, "read_table", lambda *a, **b: tables.append(read(*a, **b)) or tables[-1])

    class Rows:
        def mapInArrow(self, function, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["row", "text"])
            return list(function(iter([batch])))

    taken = []
    for symbols in (1 << 19, 1000):
        monkeypatch.setattr(ppm, "CHUNK_SYMBOLS", symbols)
        tables.clear()
        ppm.score_texts(Rows(), model)
        taken.append((len(tables), sum(t.num_rows for t in tables)))
    assert taken[0] == taken[1] and taken[0][1] <= 3000


def test_grams_are_counted_once_per_task_where_they_fit(llm, monkeypatch):
    monkeypatch.setattr(ppm, "TRAIN_SYMBOLS", 500)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["ab", "cd", "e"]) for _ in range(80)).encode() for _ in range(90)]
    rows = []

    class Texts:
        def mapInArrow(self, function, schema):
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array([i % 3 > 0 for i in range(90)])], ["text", "learn"])
            rows.extend(x for b in function(iter([batch])) for x in zip(*(c.to_pylist() for c in b.columns), strict=True))
            return llm.createDataFrame(rows, schema)

    got = {r["gram"]: (r["n"], r["uses"]) for r in ppm.count_grams(Texts(), 3).collect()}
    want = defaultdict(lambda: [0, 0])
    for i, t in enumerate(texts):
        for g in ppm.grams([t], 3)[0].tolist():
            want[g][0] += i % 3 > 0
            want[g][1] += 1
    assert got == {g: tuple(n) for g, n in want.items()}
    assert len(rows) == len(got) < 500


def test_held_out_text_is_predicted_better_than_chance(llm):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60))) for i in range(40)]
    got = ppm.score_documents(llm.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 30)
    bits = [-r["score"] * math.log2(10) / 60 for r in got.where("held_out").collect()]
    assert max(bits) < 2.6  # two bits a word are in the draw itself
