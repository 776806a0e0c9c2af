"""Lowercase runs: batch-wise detection, and joining across pieces by a tree of stretches."""

import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genomeloom.functions.runs import lowercase_runs, spans
from genomeloom.operators import sequences as S
from genomeloom.operators import spread
from genomeloom.plans.masking import masking_report


def plain(text):
    return [{"start": m.start() + 1, "end": m.end()} for m in re.finditer("[acgt]+", text or "")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text("acgtACGTNé😀n", max_size=14), max_size=8), st.integers(0, 3))
def test_spans_of_a_batch(texts, skip):
    array = pa.array(texts, pa.string()).slice(min(skip, len(texts)))
    assert spans(array).to_pylist() == [plain(t) for t in texts[min(skip, len(texts)) :]]


def test_runs_over_many_pieces_and_levels(spark, monkeypatch):
    """One run covers hundreds of pieces; stretches of 16 positions make a tree of several levels."""
    monkeypatch.setattr(spread, "STRETCH", 16)
    monkeypatch.setattr(spread, "FAN", 4)
    rng = random.Random(5)
    long = "N" + "a" * 3000 + "N" + "".join(rng.choice("acgtNNACGT") for _ in range(900)) + "g" * 500
    records = {"long": long, "all": "t" * 1024, "none": "N" * 50, "ends": "a" + "N" * 30 + "c", "one": "g", "empty": ""}
    for size in (1, 7, 16):
        rows = [(k, i + 1, v[i : i + size]) for k, v in records.items() for i in range(0, len(v), size)]
        pieces = spark.createDataFrame(rows, "id string, start long, bases string").repartition(5)
        got = {}
        for r in S.mask_intervals(pieces, ["id"]).collect():
            got.setdefault(r["id"], []).append({"start": r["start"], "end": r["end"]})
        want = {k: plain(v) for k, v in records.items() if plain(v)}
        assert {k: sorted(v, key=lambda x: x["start"]) for k, v in got.items()} == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bases_never_cross_an_exchange(spark):
    rows = [("d", i, f"r{i}", "ACgtNN" * 50) for i in range(40)]
    docs = spark.createDataFrame(rows, "k string, place long, id string, seq string")
    pieces = S.pieces_of(docs, ["k", "id"], size=20)
    assert "Exchange" not in _plan(pieces.select("k", lowercase_runs("bases")))
    for out in (S.mask_intervals(pieces, ["k", "id"]), masking_report(docs, docs, ["k"], ["place"], F.lit(0))):
        assert not re.search(r"\b(seq|bases)#", _plan(out))
    report = masking_report(docs, docs, ["k"], ["place"], F.lit(0)).first()
    assert (report["status"], report["intervals"], report["interval_bases"], report["longest"]) == ("PASS", 2000, 4000, 2)


def test_a_large_batch_is_looked_at_by_slices():
    """What lies beside the bytes of a batch is bounded, however large the batch is; slices change no run."""
    import tracemalloc

    texts = ["é" + "a" * 1_000_000 + "N" * 100 + "c" * 400_000 for _ in range(24)]
    array = pa.array(texts)
    tracemalloc.start()
    got = spans(array)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [plain(t) for t in texts]
    assert peak < 80 << 20
    assert spans(array.slice(3, 2)).to_pylist() == [plain(t) for t in texts[3:5]]
