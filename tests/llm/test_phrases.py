"""Collocations against plain Python, the trie against counting, and the SQL twin."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from genomeloom.llm import phrases, queries


def plain(rows, min_count, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    often = {k: a for k, a in f.items() if a >= min_count and len(k[1]) > 1}
    inside = {}
    for (lang, words), a in often.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                key = (lang, words[i : i + m])
                inside[key] = max(inside.get(key, 0), a)
    out = {}
    for (lang, w), a in often.items():
        if inside.get((lang, w), 0) >= a:
            continue
        cuts = [
            (1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
            for k in range(1, len(w))
        ]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((" ".join(w), a, left, right, n[lang], score))
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        yield from ((lang, i, *x) for i, x in enumerate(found[:top], 1))


def prose(seed, texts=40):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta", "é", "o", "the", "THE", "der", "und,", "end.", "a;b", "x\ty", "\n", "z\x0cz", "😀"]
    weights = [1 + i % 5 for i in range(len(words))]
    out = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 120))), rng.choice(["en", "de", None, "und"]), "s") for i in range(texts)]
    out += [(90, None, "en", "s"), (91, "", None, None), (92, " \t\n", "fr", "s"), (93, "one two one two " * 900, "en", "s")]
    return out + [(94, "the end of it all", "en", "s")] * 30


def names():
    return ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def test_against_plain_python(llm, hard_rows):
    for rows, least in ((prose(1), 4), (prose(2) + hard_rows, 9), (hard_rows, 2)):
        docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
        # Small containers and tries: nodes burst and subtrees leave often.
        got = phrases.collocations(docs, min_count=least, top=50, burst=2, max_entries=40)
        assert Counter(tuple(r[c] for c in names()) for r in got.collect()) == Counter(plain(rows, least, 50))


def test_odd_tables(llm, hard, empty):
    assert phrases.op11_collocations(empty).count() == 0
    assert phrases.op11_collocations(empty).columns == list(names())
    assert phrases.collocations(hard, min_count=3).columns == list(names())


def test_products_beyond_64_bits(llm):
    big = 3_000_000_000_000
    found = llm.createDataFrame(
        [("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7)], "lang string, size int, phrase string, n long"
    )
    totals = llm.createDataFrame([("en", 5 * big)], "lang string, total long")
    (row,) = phrases.scored(found, totals).collect()
    assert row["best"]["score"] == 1000 * (big - 7) * 5 * big // (big * (big - 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=60), st.integers(1, 5), st.integers(0, 20))
def test_trie_counts(windows, burst, keep):
    trie, padded = phrases.PhraseTrie(4, burst), [w + [0] * (4 - len(w)) for w in windows]
    for i in range(0, len(padded), 7):
        trie.add(np.array(padded[i : i + 7], np.int32))
    got = Counter()
    for rows, counts in [*trie.leave(keep), *trie.leave()]:
        for row, n in zip(rows.tolist(), counts.tolist()):
            got[tuple(row)] += n
    assert got == Counter(map(tuple, padded))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB é.,\t\n!", max_size=12), max_size=6))
def test_words_of(texts):
    words, breaks = phrases.words_of(pa.array([t.encode() for t in texts], pa.binary()))
    want = []
    for text in texts:
        for piece in re.split("[.,;:!?\n-\r]", text):
            want += [(w.lower().encode(), i == 0) for i, w in enumerate(re.findall("[^ \t]+", piece))]
    assert list(zip(words.to_pylist(), breaks.tolist())) == want


def test_query_and_sql_twin(llm, tmp_path):
    rows = [(i, t, lang, "s") for i, t, lang, _ in prose(5) * 4]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = queries.queries()["op11_collocations"](llm, str(tmp_path))
    want = con.sql(queries.oracle_sql()["op11_collocations"])
    assert tuple(want.columns) == tuple(got.columns) == names()
    rows = want.fetchall()
    assert rows and Counter(tuple(r) for r in got.collect()) == Counter(rows)
