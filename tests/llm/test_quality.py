"""Quality rules: metrics against plain Python, cutoffs against exact binomial sums, and the SQL twin."""

import re
from collections import Counter
from math import comb

import duckdb
from pyspark.sql import functions as F

from genomeloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_metrics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if often[w] > 1 for d in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_metrics(hard, hard_rows, empty, llm):
    rows = [*hard_rows, (200, "a b c d e f g h " * 5 + " x 😀# |", "en", "s"), (201, "q w e r t y u i\n\nq w e r t y u i", "en", "s")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r["text"], *(r[c] for c in names)) for r in quality.measure(docs).collect())
    assert got == Counter((t, *plain_metrics(t)) for _, t, *_ in rows)


def test_judge_handles_odd_rows(hard, hard_rows, empty, llm):
    labels = llm.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (999, 1)], "doc_id long, quality int")
    got = quality.judge(hard, labels)
    assert got.count() == len(hard_rows)
    assert quality.keep_good(hard, labels).columns == hard.columns
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(hard, labels.limit(0)).where("kept <> (NOT base_failed)").count() == 0


def test_binomial_tail(llm):
    rows = [(n, k) for n in (1, 7, 60, 400) for k in (0, 1, 5, 30) if k <= n]
    df = llm.createDataFrame(rows, "n long, k long").withColumn("p", quality.binomial_at_most(F.col("k"), F.col("n"), 0.03))
    for r in df.collect():
        want = sum(comb(r["n"], j) * 0.03**j * 0.97 ** (r["n"] - j) for j in range(r["k"] + 1))
        assert abs(r["p"] - want) < 1e-9


def _labelled(llm, n=600):
    good = "plain words of a good document that goes on for a while and ends here with a few more of them today ok"
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [f"{w}{i}" for w in good.split()]
        rows.append((i, " ".join(w + "###" if bad else w for w in words), "en"))
        labels.append((i, int(not bad)))
    return llm.createDataFrame(rows, "doc_id long, text string, lang string"), llm.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_reject_bad_and_keep_good(llm):
    docs, labels = _labelled(llm)
    got = quality.judge(docs, labels).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    assert {(r["quality"], r["kept"]): r["count"] for r in got} == {(1, True): 480, (0, False): 120}


def test_too_few_labels_certify_nothing(llm):
    docs, labels = _labelled(llm, 60)
    assert quality.judge(docs, labels).where("not kept").count() == 0


def test_sql_twin(llm):
    docs, labels = _labelled(llm)
    odd = [(900, None, None), (901, "", "en"), (902, "q w e r t y u i o\n" * 9, "fr")]
    docs = docs.unionByName(llm.createDataFrame(odd, docs.schema))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", labels.toArrow())
    names = con.sql(quality.SQL).columns
    want = Counter(con.sql(quality.SQL).fetchall())
    assert Counter(tuple(r[c] for c in names) for r in quality.op7_certified_cutoffs(docs, labels).collect()) == want
