"""Quality rules whose cutoffs come with a guarantee.

Each rule rejects a document when one metric exceeds a cutoff. Cutoffs are chosen on labelled
documents, per stratum: for every cutoff of a fixed grid, an exact binomial test asks whether more
than a share ``alpha / rules`` of the good documents could be rejected. The grid is tested from the
loosest cutoff on and stops at the first that fails, so a stratum and rule need one test level;
the levels of all strata and rules together are held to ``delta`` (Bonferroni). Hence, with chance
1 - delta, no stratum loses more than ``alpha`` of its good documents. Among the cutoffs that passed,
the one is taken that rejects most bad documents net of good ones; on a tie the loosest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded, materialize
from .common import SPACE_CHARS, SPACES, bind, whole_text, without

WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Share of good documents that a stratum may lose, and the chance that the promise fails.
ALPHA = 0.10
DELTA = 0.05
# A good document that is rejected counts as much as so many bad ones that stay.
GOOD_WEIGHT = 20
# Rule -> (numerator, denominator), and the cutoffs in percent from loose to strict.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "shouting": ("n_exclaim", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
}
GRID = (80, 60, 50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1)

METRICS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim",
)


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that the text holds twice or more."""
    k = WINDOW_WORDS

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k),
            lambda i: F.xxhash64(*[F.get(hashes, i + d) for d in range(k)]),
        )

    def covered(ordered: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            near = lambda j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
            return near(i + 1) | (F.when(i > 0, near(i - 1)).otherwise(F.lit(False)))

        starts = F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["at"]))
        nothing = F.struct(F.lit(-k).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            starts,
            nothing,
            lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(k), p - s["last"])).alias("n")),
            lambda s: s["n"],
        )

    def inside(found: Column) -> Column:
        """Only a text with a repeated window needs the ordered search."""
        located = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(
            bind(located, covered)
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    counted = bind(hashed, lambda hashes: bind(windows(hashes), inside))
    return F.when(F.size(words) < k, F.lit(0).cast("long")).otherwise(counted)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the metrics of every whole text (null: no text) as longs."""
    text = whole_text(text_col)
    words = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    staged = without(docs, METRICS).withColumns({"__llm_words": words, "__llm_lines": lines})
    cols = {
        "n_words": F.size("__llm_words"),
        "word_chars": F.length(F.translate(text, SPACE_CHARS, "")),
        "n_symbols": count_chars(text, SYMBOLS),
        "n_exclaim": count_chars(text, "!"),
        "n_lines": F.size("__llm_lines"),
        "n_dup_lines": F.size("__llm_lines") - F.size(F.array_distinct("__llm_lines")),
        "n_repeat_words": repeated_words(F.col("__llm_words")),
    }
    return staged.withColumns({k: v.cast("long") for k, v in cols.items()}).drop("__llm_words", "__llm_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def exceeds(rule: str, percent: Column | int) -> Column:
    """True where the metric of ``rule`` is above so many percent; in whole numbers."""
    over, under = RULES[rule]
    return 100 * F.col(over) > percent * F.col(under)


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), summed term by term from the logarithm of each term."""
    odds = math.log(p) - math.log1p(-p)
    start = F.struct((n * math.log1p(-p)).alias("log"), F.lit(0.0).alias("sum"))

    def step(s: Column, x: Column) -> Column:
        following = s["log"] + F.log((n - x).cast("double") / (x + 1)) + odds
        return F.struct(
            F.when(x < n, following).otherwise(s["log"]).alias("log"), (s["sum"] + F.exp(s["log"])).alias("sum")
        )

    return F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, step, lambda s: s["sum"])


def certified_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str,
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """(stratum, one column ``cut_<rule>`` per rule in percent; null: no cutoff is safe).

    A document with several labels counts as good if one of them says so; labels that are null or
    name no document are left aside. Documents that fail the base rules are not the method's to reject
    and do not enter.
    """
    said = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("__llm_good")
    )
    held = measured.where(~base_failed()).join(said, "doc_id")
    good = F.col("__llm_good") == 1
    counted = held.groupBy(F.col(stratum).alias("stratum")).agg(
        F.count_if(good).alias("n"),
        *[
            F.count_if(exceeds(rule, c) & (good if kind == "good" else ~good)).alias(f"{kind}_{rule}_{c}")
            for rule in RULES
            for c in GRID
            for kind in ("good", "bad")
        ],
    )
    cells = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(i).alias("step"),
            F.lit(c).alias("cut"),
            F.col(f"good_{rule}_{c}").alias("good"),
            F.col(f"bad_{rule}_{c}").alias("bad"),
        )
        for rule in RULES
        for i, c in enumerate(GRID)
    ]
    grid = counted.select("stratum", "n", F.explode(F.array(*cells)).alias("c")).select("stratum", "n", "c.*")
    strata = counted.select(F.count("*").alias("strata"))
    level = F.lit(delta) / (F.col("strata") * len(RULES))
    so_far = Window.partitionBy("stratum", "rule").orderBy("step")
    tested = (
        grid.crossJoin(F.broadcast(strata))  # one row
        .withColumn("passed", binomial_at_most(F.col("good"), F.col("n"), alpha / len(RULES)) <= level)
        .withColumn("passed", F.min("passed").over(so_far))
        .withColumn("gain", F.col("bad") - GOOD_WEIGHT * F.col("good"))
        .where(F.col("passed") & (F.col("gain") > 0))
    )
    best = tested.groupBy("stratum", "rule").agg(
        F.max_by("cut", F.struct(F.col("gain"), F.col("cut"))).alias("cut")
    )
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES]
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
    carry: list[str] | None = None,
) -> DataFrame:
    """``carry`` columns (default: all), the metrics, ``base_failed`` and ``kept`` for every row.

    A null text has no words and fails the base rules. Null strata form one stratum with the empty name.
    Repeated rows are judged alike; an empty table gives an empty table; without labels no cutoff is
    safe and only the base rules reject. Input columns named like an output are replaced.
    """
    outputs = (*METRICS, "base_failed", "kept")
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in outputs]
    inputs = dict.fromkeys([*names, "doc_id", stratum])
    extra = [c for c in inputs if c not in names]
    wide = docs.withColumn("__llm_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    measured = measure(wide).select(*[f"`{c}`" for c in names], *extra, "__llm_stratum", *METRICS)
    measured = materialize(measured, "metrics")
    cuts = materialize(certified_cutoffs(measured, labels, "__llm_stratum", alpha, delta), "cutoffs")
    joined = measured.join(bounded(cuts), F.col("__llm_stratum") == F.col("stratum"), "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(exceeds(rule, F.col(f"cut_{rule}")), F.lit(False))
    return joined.select(
        *[f"`{c}`" for c in names],
        *METRICS,
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with the columns of ``docs``."""
    marks = [c for c in docs.columns if c.lower() in (*METRICS, "base_failed", "kept")]
    safe = docs.withColumnsRenamed({c: f"__llm_in_{c}" for c in marks})
    kept = judge(safe, labels, **options).where("kept")
    return kept.select(*[f"`__llm_in_{c}`" if c in marks else f"`{c}`" for c in docs.columns]).withColumnsRenamed(
        {f"__llm_in_{c}": c for c in marks}
    )


def op7_certified_cutoffs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels, carry=["doc_id"]).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _sql() -> str:
    level = "a.delta / (s.strata * a.rules)"
    cells = "\n  UNION ALL ".join(
        f"SELECT stratum, q, '{rule}' AS rule, {i} AS step, {c} AS cut, "
        f"100 * {RULES[rule][0]} > {c} * {RULES[rule][1]} AS above FROM held"
        for rule in RULES
        for i, c in enumerate(GRID)
    )
    rejects = " OR ".join(
        f"coalesce(100 * {over} > c.cut_{rule} * {under}, false)" for rule, (over, under) in RULES.items()
    )
    pivot = ", ".join(f"max(cut) FILTER (rule = '{r}') AS cut_{r}" for r in RULES)
    slots = ", ".join(f"w[i + {d}]" for d in range(WINDOW_WORDS))
    spaces = "[ \\t-\\r]"
    return f"""
WITH a AS (SELECT {ALPHA} / {len(RULES)} AS p, {DELTA} AS delta, {len(RULES)} AS rules),
t AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS x,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{spaces}+'), lambda e: e <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda e: regexp_matches(e, '[^ \\t-\\r]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, list_transform(range(1, len(w) - {WINDOW_WORDS - 2}), lambda i: concat_ws(' ', {slots})) AS g FROM t
), grams AS (
  SELECT doc_id, unnest(g) AS gram, generate_subscripts(g, 1) AS pos FROM windows
), twice AS (
  SELECT doc_id, pos FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT pos + d.d) AS n
  FROM twice, (SELECT unnest(range(0, {WINDOW_WORDS})) AS d) d GROUP BY doc_id
), m AS (
  SELECT t.doc_id, stratum, len(w)::BIGINT AS n_words,
         length(regexp_replace(x, '{spaces}', '', 'g'))::BIGINT AS word_chars,
         (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(x) - length(replace(x, '!', '')))::BIGINT AS n_exclaim,
         len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN covered c ON c.doc_id = t.doc_id
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
), held AS (
  SELECT b.*, q FROM b JOIN (
    SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
  ) y ON y.doc_id = b.doc_id WHERE NOT base_failed
), cells AS (
  {cells}
), s AS (SELECT count(DISTINCT stratum) AS strata FROM held),
counted AS (
  SELECT stratum, rule, step, cut, count(*) FILTER (q = 1) AS n,
         count(*) FILTER (q = 1 AND above) AS good, count(*) FILTER (q <> 1 AND above) AS bad
  FROM cells GROUP BY ALL
), tested AS (
  SELECT stratum, rule, step, cut, bad - {GOOD_WEIGHT} * good AS gain,
         list_sum(list_transform(range(0, good + 1), lambda j:
           CASE WHEN n = 0 THEN 1.0
                ELSE exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(a.p) + (n - j) * ln(1 - a.p)) END
         )) <= {level} AS passed
  FROM counted, a, s
), safe AS (
  SELECT *, min(passed::INT) OVER (PARTITION BY stratum, rule ORDER BY step) AS ok FROM tested
), best AS (
  SELECT stratum, rule, arg_max(cut, gain * 1000 + cut) AS cut FROM safe
  WHERE ok = 1 AND gain > 0 GROUP BY stratum, rule
), c AS (SELECT stratum, {pivot} FROM best GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({rejects}) AS kept
FROM b LEFT JOIN c ON c.stratum = b.stratum
"""


SQL = _sql()
