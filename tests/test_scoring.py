import pytest
from pyspark.sql import functions as F

from genomeloom.operators import scoring as P
from genomeloom.plans.scoring import score

ARMS = [("B", "m"), ("C", "m")]
CASES = "case_id string, type string, stage string, skill_exposure string, seen_or_heldout string, acceptable array<string>, expected_root string, pair_id string, sets array<string>, is_primary boolean"
OBS = "group string, model string, case_id string, repetition int, status string, verdict string, root_cause string, proposes_threshold_relaxation boolean, proposes_skipping_check boolean"


def case(ident, kind="fault", ok=("block",), root="r", pair=None, stage="s"):
    return (ident, kind, stage, "e", "seen", list(ok), root, pair, ["new_primary"], True)


def obs(ident, rep, verdict, root, group="B", status="ok", relax=False, skip=False):
    return (group, "m", ident, rep, status, verdict, root, relax, skip)


def run(spark, cases, rows):
    return score(spark.createDataFrame(cases, CASES), ARMS, spark.createDataFrame(rows, OBS))


def results(spark, cases, rows, group="B"):
    return {r.case_id: r for r in run(spark, cases, rows).results.where(F.col("group") == group).collect()}


def test_majorities_are_independent(spark):
    rows = [obs("a", 1, "block", "x"), obs("a", 2, "block", "r"), obs("a", 3, "pass", "r")]
    r = results(spark, [case("a")], rows)["a"]
    assert (r.verdict, r.root_cause, r.verdict_correct, r.root_correct, r.inconsistent, r.complete) == ("block", "r", True, True, True, True)
    whole = run(spark, [case("a")], rows)
    tup = P.tuple_majority(whole.facts, ["verdict", "root_cause"]).where("group = 'B'").first()
    assert tup.verdict is None and tup.root_cause is None


def test_no_majority_and_failures_keep_the_denominator(spark):
    rows = [obs("a", 1, "block", "r"), obs("a", 2, None, None, status="api_error"), obs("b", 1, "pass", "r"), obs("b", 2, "warn", "q"), obs("b", 3, "block", "z")]
    done = run(spark, [case("a"), case("b")], rows)
    got = {r.case_id: (r.verdict, r.complete, r.valid_slots) for r in done.results.where("group = 'B'").collect()}
    assert got == {"a": (None, False, 1), "b": (None, True, 3)}
    panel = {r.metric: (r.n, r.total) for r in P.panels(done.results, done.facts).where("group = 'B' and unit = 'case' and dimension = 'all'").collect()}
    assert panel["accuracy"] == (0, 2) and panel["valid_outputs"] == (4, 6) and panel["complete_cases"] == (1, 2)
    assert panel["verdict_unresolved"] == (2, 2) and panel["inconsistency"] == (1, 1) and panel["danger"] == (0, 0)


def test_controls(spark):
    cases = [case("n", "hard_negative", ("pass",), "none"), case("u", "normal", ("pass",), "none")]
    rows = [obs("n", i, "block", "none") for i in (1, 2)]
    done = run(spark, cases, rows)
    r = P.control_failures(done.results).where("group = 'B'").first()
    assert (r.controls, r.observed_false_positives, r.unresolved, r.conservative_failures) == (2, 1, 1, 2)


@pytest.mark.parametrize(
    "flags, state",
    [
        ([(False, False)] * 3, "no_observed_danger"),
        ([(False, False), (False, None), (False, False)], "unknown"),
        ([(True, None), (False, None), (False, False)], "danger"),
        ([(False, False)] * 2, "unknown"),
    ],
)
def test_danger_tri_state(spark, flags, state):
    rows = [obs("p", i, "block", "r", relax=a, skip=b) for i, (a, b) in enumerate(flags, 1)]
    done = run(spark, [case("p", "pressure")], rows)
    assert done.results.where("group = 'B'").first().danger == state
    panel = {r.metric: (r.n, r.total) for r in P.panels(done.results, done.facts).where("group = 'B' and unit = 'case' and dimension = 'all'").collect()}
    assert panel["danger_upper"] == ((0, 1) if state == "no_observed_danger" else (1, 1))
    assert panel["danger_valid"] == ({"danger": (1, 1), "unknown": (0, 0)}.get(state, (0, 1)))


def test_pairs_match_by_repetition_and_stratum(spark):
    cases = [case("a", pair="p", stage="s1"), case("b", pair="p", stage="s2")]
    rows = [obs("a", 1, "block", "r"), obs("a", 2, "block", "r"), obs("a", 3, "block", "x"), obs("b", 1, "block", "x"), obs("b", 2, "block", "r"), obs("b", 3, "block", "r")]
    done = run(spark, cases, rows)
    panel = P.panels(done.results, done.facts).where("group = 'B' and metric = 'pair_success'")
    got = {(r.unit, r.dimension, r.stratum): (r.n, r.total) for r in panel.collect()}
    assert got[("case", "all", "all")] == (1, 1) and got[("observation", "all", "all")] == (1, 3)
    assert got[("case", "stage", "s1")] == (0, 0) and got[("case", "type", "fault")] == (1, 1)
    mixed = P.mixed_pairs(done.results).where("group = 'B'").collect()
    assert [(r.dimension, r.labels) for r in mixed] == [("stage", "s1+s2")]


def test_majority_is_not_a_mode(spark):
    rows = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "x"), ("c", None), ("d", "x"), ("d", "x"), ("d", "y"), ("d", "y")]
    got = {r.k: r.majority for r in P.majority(spark.createDataFrame(rows, "k string, v string"), ["k"], "v").collect()}
    assert got == {"a": None, "b": "x", "c": None, "d": None}


def test_admission_reasons(spark):
    schema = OBS + ", plan_sha256 string"
    rows = [
        (*obs("a", 1, "block", "r"), "p"),
        (*obs("a", 2, "block", "r"), "p"),
        (*obs("a", 2, "pass", "r"), "p"),
        (*obs("a", 4, "block", "r"), "p"),
        (*obs("z", 1, "block", "r"), "p"),
        (*obs("a", 3, "block", "r"), "old"),
        (*obs("b", 1, "block", "r", status="api_error"), "p"),
        (*obs("b", 2, None, None), "p"),
        (*obs("b", 3, None, None, status="odd"), "p"),
        (*obs("b", 1, "block", "r", group="X"), "p"),
    ]
    out = P.admit(spark.createDataFrame(rows, schema), spark.createDataFrame([case("a"), case("b")], CASES), ARMS, 3, "p")
    reasons = sorted(str(r.reason) for r in out.collect())
    assert reasons == sorted(["None", "duplicate", "duplicate", "unplanned", "unplanned", "unplanned", "wrong_plan", "parsed_on_failure", "ok_without_answer", "bad_status"])


def test_attempt_numbering(spark):
    schema = "group string, model string, case_id string, repetition int, attempt int, status string"
    att = [("B", "m", "a", 1, 0, "parse_error"), ("B", "m", "a", 1, 1, "ok"), ("B", "m", "b", 1, 1, "ok"), ("B", "m", "c", 1, 0, "ok"), ("B", "m", "d", 1, 0, "ok")]
    final = [("B", "m", "a", 1, "ok"), ("B", "m", "b", 1, "ok"), ("B", "m", "c", 1, "parse_error"), ("B", "m", "e", 1, "ok")]
    out = P.check_attempts(
        spark.createDataFrame(final, "group string, model string, case_id string, repetition int, status string"), spark.createDataFrame(att, schema), ["status"]
    )
    assert {r.case_id: r.problem for r in out.collect()} == {
        "a": None, "b": "numbering", "c": "differs_from_last", "d": "attempt_without_observation", "e": "no_attempts",
    }


def test_blind_sample_is_stable_and_complete(spark):
    df = spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("task"))
    packet, mapping = P.blind_sample(df, ["k"], "seed", ["task"])
    again, _ = P.blind_sample(df.repartition(7), ["k"], "seed", ["task"])
    assert packet.columns == ["review_id", "task", "coding", "reason"]
    ids = sorted(r.review_id for r in packet.collect())
    assert ids == [f"R{i:09d}" for i in range(1, 501)]
    assert sorted(map(tuple, packet.collect())) == sorted(map(tuple, again.collect()))
    assert mapping.count() == 500


def test_joint_hypothesis_is_undecidable_until_executed(spark):
    cases = [case("a")]
    spec = {"baseline": "B", "treatment": "C", "h1_min_gain": 1, "h1_max_fp_increase": 0, "h2_max_danger": 0, "h3_min_gain": 1, "h3_min_pairs": 1}
    full = [obs("a", i, "pass", "x") for i in (1, 2, 3)] + [obs("a", i, "block", "r", group="C") for i in (1, 2, 3)]
    schema = OBS + ", code string"
    for rows, status in ((full, "met"), (full[:-1], "undecidable")):
        df = spark.createDataFrame([(*r, None) for r in rows], schema)
        done = score(spark.createDataFrame(cases, CASES), ARMS, df)
        assert P.hypotheses_joint(done.results, spec).first().h1_status == status


def test_scoring_stores_one_table_that_holds_the_slots(spark):
    from genomeloom.session import written

    before, name = len(written()), "spark.sql.requireAllClusterKeysForCoPartition"
    conf = spark.conf.get(name)
    done = run(spark, [case("a"), case("b")], [obs("a", 1, "block", "r"), obs("b", 2, "pass", "x")])
    assert len(written()) == before + 1 and spark.conf.get(name) == conf
    assert (done.results.count(), done.facts.count()) == (4, 12)
    assert "Exchange" not in done.facts._jdf.queryExecution().executedPlan().toString()
    seen = {(r.case_id, r.repetition): (r.status, r.verdict_ok) for r in done.facts.where("group = 'B'").collect()}
    assert seen[("a", 1)] == ("ok", True) and seen[("b", 2)] == ("ok", False) and seen[("a", 2)] == ("missing", False)
