"""URL filters: written rules first, a logistic regression over hashed character n-grams for the rest.

Everything runs in SQL functions. The model learns from a small, bounded table of labelled URLs by gradient
descent with momentum: each step is one sum per URL and one per feature. Its weights, one for each of ``BUCKETS`` hash buckets, are a
constant in the plan, so that judging a page needs no exchange, whatever the number of pages.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bind, prepare, without

# Fixed values: (host and path, what becomes of URLs below them).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

SIZES = (3, 4, 5)
BUCKETS = 1 << 14
STEPS, RATE, MOMENTUM, SHRINK = 100, 4.0, 0.9, 0.001
# A page is blocked if the model gives it this probability at least.
SURE = 0.6
# The labelled table is small by definition; a larger one is refused.
MAX_LABELLED = 10_000

# Labelled hosts, written by hand: what a page of such a host most likely is.
BLOCKED = """
best-pills.example.com cheap-meds.example.net online-pharmacy-deals.example.org pills4less.example.com
discount-viagra.example.net diet-pills.example.org cheap-viagra.example.com
royal-casino.example.com casino777.example.org lucky-slots.example.net poker-bets.example.com sports-betting.example.org
free-spins.example.net jackpot-win.example.com bets-now.example.net casino-bonus.example.com bingo-win.example.org
adult-videos.example.com xxx-clips.example.net adult-dating.example.org hot-porn.example.com sexcams.example.net
adult-chat.example.com adults-only.example.net porn-tube.example.org xxx-adult.example.com
ad-track.example.com ads.tracker.example.net click-ads.example.org adserver.example.com banner-ads.example.net
popup-ads.example.org pixel-track.example.com
spam-links.example.net link-farm.example.org seo-spam.example.com content-farm.example.net spam-mailer.example.org
warez-crack.example.com free-keygen.example.net cracked-games.example.org free-iphone-win.example.com
get-rich-quick.example.net easy-loans.example.com payday-loans.example.org replica-watches.example.net
fake-docs.example.com phish-login.example.org
"""
ALLOWED = """
news.example.com dailypost.example.net city-library.example.org university.example.com school-books.example.net
museum.example.org garden-notes.example.com recipes.example.net cooking-blog.example.org travel-journal.example.com
weather.example.net maps.example.org docs.example.com wiki.example.net forum.example.org support.example.com
developer-handbook.example.net open-data.example.org health-service.example.com hospital.example.net
medicine-journal.example.org science.example.com physics-lectures.example.net thehistory.example.org
theatre.example.com music-school.example.net orchestra.example.org painting.example.com poetry.example.net
football-club.example.com running.example.org mountain-hiking.example.net bicycle-repair.example.com railway.example.org
parliament.example.net city-council.example.com statistics-office.example.org courts.example.net baking.example.com
knitting.example.net woodworking.example.org photography.example.com astronomy.example.net gardening.example.org
farmers-market.example.com tracking-wildlife.example.net addresses.example.org casting.example.com
windows-help.example.net betterhomes.example.org essex-news.example.com software-letters.example.net
the-other-side.example.org nation.example.com western-stories.example.net
"""
# Both classes get the same prefixes and paths, so that neither says anything.
PREFIXES = ("", "www.", "m.", "blog.")
PATHS = ("/", "/en/12", "/fr/340", "/de/7.html", "/es/55", "/article/2021/03/story", "/index.html")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked): the table of this module."""
    rows = [
        (f"https://{PREFIXES[i % len(PREFIXES)]}{host}{PATHS[i % len(PATHS)]}", label)
        for label, hosts in ((1, BLOCKED), (0, ALLOWED))
        for i, host in enumerate(hosts.split())
    ]
    return spark.createDataFrame(rows, "url string, blocked int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, path


def grams(text: Column, tag: str) -> Column:
    """Hash buckets of all character n-grams of a part; repeated ones stay."""

    def of_size(whole: Column, n: int) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(1), F.length(whole) - n + 1), lambda i: F.concat(F.lit(tag), F.substring(whole, i, n))
        )
        return F.when(F.length(whole) >= n, pieces).otherwise(F.array().cast("array<string>"))

    def bucket(gram: Column) -> Column:
        return (F.conv(F.substring(F.md5(gram), 1, 8), 16, 10).cast("long") % BUCKETS).cast("int")

    edged = F.concat(F.lit("^"), text, F.lit("$"))
    return F.transform(bind(edged, lambda whole: F.concat(*[of_size(whole, n) for n in SIZES])), bucket)


def features(host: Column, path: Column) -> Column:
    """Both parts as (buckets, value of each of them): each part has length one if its n-grams differ."""

    def part(found: Column) -> Column:
        return bind(
            found,
            lambda b: F.struct(b.alias("buckets"), (1 / F.sqrt(F.greatest(F.size(b), F.lit(1)))).alias("value")),
        )

    return F.array(part(grams(host, "h")), part(grams(path, "p")))


def train(labelled: DataFrame) -> DataFrame:
    """(bucket, w): the weights of the regularised logistic regression, without bias: an unknown URL scores zero.

    A null label or URL is left aside; without labelled rows there are no weights. The table is bounded, so all
    of its features are one row, and the steps are one fold over it: margins per URL, then slopes per feature.
    """
    host, path = host_and_path(F.col("url"))
    known = labelled.where(F.col("url").isNotNull() & F.col("blocked").isNotNull())
    if known.limit(MAX_LABELLED + 1).count() > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled URLs")
    rows = materialize(
        known.select(
            F.xxhash64("url", "blocked", F.monotonically_increasing_id()).alias("row"),
            F.col("blocked").cast("double").alias("y"),
            features(host, path).alias("parts"),
        ),
        "labelled-urls",
    )
    listed = rows.select("row", "y", F.explode("parts").alias("p")).select(
        "row", "y", F.explode("p.buckets").alias("bucket"), F.col("p.value").alias("x")
    )
    held = listed.groupBy("row", "y", "bucket").agg(F.sum("x").alias("x"))
    whole = Window.partitionBy(F.lit(0))  # MAX_LABELLED rows at most
    held = held.withColumns(
        {
            "r": F.dense_rank().over(whole.orderBy("row")) - 1,
            "f": F.dense_rank().over(whole.orderBy("bucket")) - 1,
        }
    )
    held = materialize(held, "url-features")
    by_row = held.groupBy("r").agg(F.first("y").alias("y"), F.collect_list(F.struct("f", "x")).alias("cells"))
    by_feature = held.groupBy("f", "bucket").agg(F.collect_list(F.struct("r", "x")).alias("cells"))
    one = by_row.agg(F.sort_array(F.collect_list(F.struct("r", "y", "cells"))).alias("urls")).join(
        by_feature.agg(F.sort_array(F.collect_list(F.struct("f", "bucket", "cells"))).alias("features")), how="cross"
    )  # one row to one row
    n = F.size("urls")
    nothing = F.transform("features", lambda _: F.lit(0.0))

    def dot(cells: Column, at: str, values: Column) -> Column:
        return F.aggregate(cells, F.lit(0.0), lambda s, c: s + c["x"] * F.get(values, c[at]))

    def step(state: Column, _: Column) -> Column:
        def missed(u: Column) -> Column:
            return 1 / (1 + F.exp(-dot(u["cells"], "f", state["w"]))) - u["y"]

        def speeds(errors: Column) -> Column:
            def speed(x: Column, i: Column) -> Column:
                slope = dot(x["cells"], "r", errors) / n + SHRINK * F.get(state["w"], i)
                return MOMENTUM * F.get(state["v"], i) - RATE * slope

            return F.transform("features", speed)

        def moved(v: Column) -> Column:
            return F.struct(F.zip_with(state["w"], v, lambda a, b: a + b).alias("w"), v.alias("v"))

        return bind(bind(F.transform("urls", missed), speeds), moved)

    start = F.struct(nothing.alias("w"), nothing.alias("v"))
    learned = one.select("features", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step).alias("state"))
    pairs = F.zip_with("features", F.col("state.w"), lambda x, w: F.struct(x["bucket"].alias("bucket"), w.alias("w")))
    return learned.select(F.explode(pairs).alias("p")).select("p.*")


def blocked_by_model(weights: dict[int, float], host: Column, path: Column) -> Column:
    """True where the model is sure enough that a URL is one to block."""
    text = " ".join(repr(weights.get(i, 0.0)) for i in range(BUCKETS))
    table = F.split(F.lit(text), " ").cast("array<double>")  # folded into one constant

    def part(p: Column) -> Column:
        return p["value"] * F.aggregate(p["buckets"], F.lit(0.0), lambda s, b: s + F.get(table, b))

    score = F.aggregate(features(host, path), F.lit(0.0), lambda s, p: s + part(p))
    return score > math.log(SURE / (1 - SURE))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that begins like the rule's."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, rule).otherwise(found)
    return found


def judge_urls(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, url: str = "url"
) -> DataFrame:
    """The rows with host, path, rule and verdict (allow or block).

    Null URLs and those without ``://`` have an empty host and path, which no rule fits; the model judges
    them like any other. Rows that repeat are judged alike, an empty table gives an empty table, and input columns
    named like an output are replaced. ``rules`` is a list written by people; it becomes one expression.
    """
    spark = prepare(pages.sparkSession)
    learned = train(labelled_urls(spark) if labelled is None else labelled)
    weights = {r["bucket"]: r["w"] for r in learned.collect()}  # BUCKETS numbers at most
    host, path = host_and_path(F.col(url))
    split = without(pages, [c for c in ("host", "path", "rule", "verdict") if c != url]).withColumns(
        {"host": host, "path": path}
    )
    said = split.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, what in rules:
        verdict = F.when(F.col("rule") == rule, what).otherwise(verdict)
    model = F.when(blocked_by_model(weights, F.col("host"), F.col("path")), "block").otherwise("allow")
    return said.withColumn("verdict", F.when(F.col("rule").isNull(), model).otherwise(verdict))


def op13_url_filter(pages: DataFrame) -> DataFrame:
    """Host, path, rule and verdict of every page; see ``judge_urls``."""
    return judge_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    labelled = ",\n  ".join(
        f"('https://{PREFIXES[i % len(PREFIXES)]}{host}{PATHS[i % len(PATHS)]}', {label})"
        for label, hosts in ((1, BLOCKED), (0, ALLOWED))
        for i, host in enumerate(hosts.split())
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def cut(table: str, keep: str) -> str:
        return f"""SELECT {keep}, translate(h, '{upper}', '{lower}') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path
  FROM (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM (
    SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {table}))"""

    def parts(table: str, keys: str) -> str:
        return f"""SELECT {keys}, 'h' AS tag, '^' || host || '$' AS s FROM {table}
  UNION ALL SELECT {keys}, 'p', '^' || path || '$' FROM {table}"""

    def hashed(table: str, keys: str) -> str:
        sizes = " UNION ALL ".join(
            f"SELECT {keys}, tag, unnest(list_transform(range(1, length(s) - {n} + 2), lambda i: substr(s, i, {n}))) AS g "
            f"FROM {table} WHERE length(s) >= {n}"
            for n in SIZES
        )
        return f"""SELECT {keys}, bucket, sum(1 / sqrt(n)) AS x FROM (
    SELECT {keys}, ('0x' || substr(md5(tag || g), 1, 8))::BIGINT % {BUCKETS} AS bucket,
           count(*) OVER (PARTITION BY {keys}, tag) AS n FROM ({sizes})) GROUP BY ALL"""

    best = "NULL"
    for rule, _ in sorted(RULES, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        best = (
            f"CASE WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') "
            f"THEN '{rule}' ELSE {best} END"
        )
    said = " ".join(f"WHEN '{rule}' THEN '{what}'" for rule, what in RULES)
    return f"""
WITH RECURSIVE labelled AS (SELECT row_number() OVER () AS id, * FROM (VALUES
  {labelled}) v(url, y)),
learned AS MATERIALIZED (
  {cut("labelled", "id, y::DOUBLE AS y")}
), lparts AS (
  {parts("learned", "id, y")}
), held AS MATERIALIZED (
  {hashed("lparts", "id, y")}
), w AS (
  SELECT 0 AS step, bucket, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM (SELECT DISTINCT bucket FROM held)
  UNION ALL
  SELECT step + 1, bucket, w + speed, speed FROM (
    SELECT w.step, w.bucket, w.w,
           {MOMENTUM} * w.v - {RATE} * (s.g + {SHRINK} * w.w) AS speed
    FROM w JOIN (
      SELECT h.bucket, sum(h.x * e.e) / (SELECT count(*) FROM labelled) AS g
      FROM held h JOIN (
        SELECT held.id, 1 / (1 + exp(-sum(held.x * w.w))) - held.y AS e
        FROM held JOIN w ON w.bucket = held.bucket GROUP BY held.id, held.y
      ) e ON e.id = h.id GROUP BY h.bucket
    ) s ON s.bucket = w.bucket
    WHERE w.step < {STEPS})
), model AS (SELECT bucket, w FROM w WHERE step = {STEPS}),
judged AS (
  SELECT *, {best} AS rule FROM (
  {cut("(SELECT row_number() OVER () AS id, page_id, url FROM pages)", "id, page_id")})
), pparts AS (
  {parts("judged", "id")}
), pheld AS (
  {hashed("pparts", "id")}
), scores AS (
  SELECT id, sum(x * w) AS score FROM pheld JOIN model USING (bucket) GROUP BY id
)
SELECT page_id, host, path, rule,
       CASE rule {said} ELSE
         CASE WHEN coalesce(score, 0) > {math.log(SURE / (1 - SURE))} THEN 'block' ELSE 'allow' END END AS verdict
FROM judged LEFT JOIN scores USING (id)
"""


SQL = _sql()
