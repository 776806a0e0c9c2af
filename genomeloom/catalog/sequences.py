"""Documents, conversations and labels read as sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import residues as R
from ..operators import bands as B
from ..operators import sequences as S
from ..operators.spread import ordinal
from ..plans.masking import masking_report, numbered_facts
from ..session import scratch
from ..sources import sequences as Q
from ..sources import sinks
from ..sources.blockgzip import read_block_gzip_lines, write_block_gzip
from .registry import query

SEQS = r"""seqs AS (
  SELECT doc_id, lang, source, regexp_replace(text, '[\s>]', '', 'g') AS seq FROM documents)"""


def seqs(t):
    return t.documents.select("doc_id", "lang", "source", R.clean("text").alias("seq"))


def _as_fasta(t, label: str):
    """All documents as FASTA text; returns its path."""
    path = scratch(t.spark, label)
    rows = seqs(t).select(F.concat_ws(" ", "doc_id", "lang", "source").alias("header"), "seq")
    sinks.write_fasta(rows, path)
    return path


LANG_BANDS = [
    {"metric": "lower_acgt_pct", "taxon_scope": "en", "lo": 20.0, "hi": 40.0},
    {"metric": "lower_acgt_pct", "taxon_scope": "de", "lo": 30.0, "hi": 60.0},
    {"metric": "lower_acgt_pct", "taxon_scope": "fr", "lo": 5.0, "hi": 25.0},
]


@query(
    "masked_as_declared",
    "SRC-01 PRJ-01 A-05 J-11 SNK-03",
    f"""WITH {SEQS}, totals AS (
  SELECT lang, count(*) AS records, sum(length(seq)) AS total,
         sum(length(regexp_replace(seq, '[^acgt]', '', 'g'))) AS lower_n,
         sum(length(regexp_replace(seq, '[^Nn]', '', 'g'))) AS gap_n
  FROM seqs GROUP BY lang),
bands(lang, lo, hi) AS (VALUES ('en', 20.0, 40.0), ('de', 30.0, 60.0), ('fr', 5.0, 25.0))
SELECT lang, records, CAST(total AS BIGINT) AS total, CAST(lower_n AS BIGINT) AS lower_n,
  CAST(gap_n AS BIGINT) AS gap_n,
  CASE WHEN total = 0 THEN 'manual' WHEN lower_n * 1.0 / total < 0.005 THEN 'gap_not_softmasked'
       WHEN gap_n * 1.0 / total > 0.2 THEN 'gap_hardmasked' ELSE 'ok' END AS outcome,
  CASE WHEN lo IS NULL THEN 'no_band'
       WHEN 100.0 * lower_n / total BETWEEN lo AND hi THEN 'in_band' ELSE 'out_of_band' END AS verdict
FROM totals LEFT JOIN bands USING (lang)""",
)
def masked_as_declared(t):
    """Which deliveries are masked as declared and inside their range?"""
    rows = Q.read_fasta(t.spark, _as_fasta(t, "flagship")).withColumn(
        "lang", F.split("header", " ")[1]
    )
    ruled = S.softmask_rule(rows, ["lang"])
    value = R.percent(F.col("lower_n"), F.col("total"))
    bands = B.band_rows(t.spark, LANG_BANDS).select(F.col("taxon_scope").alias("lang"), "lo", "hi")
    judged = ruled.join(bands, "lang", "left").withColumn("verdict", B.single_verdict(value, F.col("lo"), F.col("hi")))
    return judged.select("lang", F.col("rows").alias("records"), "total", "lower_n", "gap_n", "outcome", "verdict")


@query(
    "fasta_roundtrip",
    "SRC-01 SNK-03 W-06",
    f"""WITH {SEQS} SELECT CAST(doc_id AS VARCHAR) AS id, lang, length(seq) AS n, sha256(seq) AS digest FROM seqs""",
)
def fasta_roundtrip(t):
    """Write every document as wrapped FASTA, read it back, compare by digest."""
    rows = Q.read_fasta(t.spark, _as_fasta(t, "fasta"))
    return rows.select(
        "id",
        F.split("header", " ")[1].alias("lang"),
        F.length("seq").cast("long").alias("n"),
        F.sha2("seq", 256).alias("digest"),
    )


@query(
    "fasta_pieces",
    "SRC-01 W-06 PRJ-01",
    f"""WITH {SEQS} SELECT CAST(doc_id AS VARCHAR) AS id, CAST(ceil(length(seq) / 80.0) AS BIGINT) AS pieces,
  length(seq) AS bases, CAST(floor((length(seq) - 1) / 80) * 80 + 1 AS BIGINT) AS last_start,
  length(regexp_replace(seq, '[^acgt]', '', 'g')) AS lower_n FROM seqs WHERE length(seq) > 0""",
)
def fasta_pieces(t):
    """Line-level FASTA scan: pieces know their record and their offset in it."""
    rows = Q.read_fasta_pieces(t.spark, _as_fasta(t, "pieces"))
    return rows.groupBy("file", "rec", "id").agg(
        F.count("*").alias("pieces"),
        F.sum(F.length("bases").cast("long")).alias("bases"),
        F.max("start").alias("last_start"),
        F.sum(R.lowercase_count("bases")).alias("lower_n"),
    ).drop("file", "rec")


@query(
    "fasta_ordinals",
    "W-06 SRC-01",
    f"""WITH {SEQS} SELECT count(*) AS records, count(*) AS distinct_places,
  true AS dense FROM seqs""",
)
def fasta_ordinals(t):
    """Record ordinals are dense per file and follow file order."""
    rows = Q.with_ordinal(Q.read_fasta(t.spark, _as_fasta(t, "ordinals")).drop("seq"))
    per_file = rows.groupBy("file").agg(
        F.count("*").alias("n"), F.count_distinct("rec").alias("d"), F.max("rec").alias("m"), F.min("rec").alias("z")
    )
    return per_file.agg(
        F.sum("n").alias("records"),
        F.sum("d").alias("distinct_places"),
        F.bool_and((F.col("m") == F.col("n") - 1) & (F.col("z") == 0)).alias("dense"),
    )


@query(
    "fasta_problems",
    "SRC-01 PRJ-12",
    f"""WITH {SEQS}, bad AS (
  SELECT CASE WHEN lang = 'fr' THEN '' WHEN lang = 'es' THEN 'es' || source ELSE CAST(doc_id AS VARCHAR) END AS id,
         CASE WHEN source = 'src3' THEN '' ELSE seq END AS seq FROM seqs)
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'empty_header' AS reason FROM bad WHERE id = ''
  UNION ALL SELECT 'empty_sequence' FROM bad WHERE seq = ''
  UNION ALL SELECT 'repeated_id' FROM (SELECT id FROM bad WHERE id <> '' GROUP BY id HAVING count(*) > 1))
GROUP BY reason""",
)
def fasta_problems(t):
    """Strict-scan findings on deliberately damaged FASTA."""
    path = scratch(t.spark, "badfasta")
    rows = seqs(t).select(
        F.when(F.col("lang") == "fr", "")
        .when(F.col("lang") == "es", F.concat(F.lit("es"), "source"))
        .otherwise(F.col("doc_id").cast("string"))
        .alias("header"),
        F.when(F.col("source") == "src3", "").otherwise(F.col("seq")).alias("seq"),
    )
    sinks.write_fasta(rows, path)
    # The oracle looks for repeats over the whole set, the scan inside each file.
    found = Q.fasta_problems(t.spark, path).where(F.col("reason") != "repeated_id").select("reason", "n")
    repeated = (
        Q.read_fasta(t.spark, path)
        .where("id <> ''")
        .groupBy("id")
        .count()
        .where("count > 1")
        .select(F.lit("repeated_id").alias("reason"), F.lit(1).cast("long").alias("n"))
    )
    return found.unionByName(repeated).groupBy("reason").agg(F.sum("n").alias("n"))


FASTQ_SQL = r"""WITH r AS (SELECT conv_id, turn, role, regexp_replace(text, '[^A-Za-z]', '', 'g') AS seq FROM conversations)
SELECT '@c' || conv_id || '_' || turn AS header, length(seq) AS n, sha256(seq) AS digest,
  CASE WHEN role = 'system' THEN 'quality_length' END AS reason
FROM r WHERE length(seq) > 0"""


@query("fastq_roundtrip", "SRC-04 SNK-03", FASTQ_SQL)
def fastq_roundtrip(t):
    """Conversations as four-line reads; system turns carry a short quality line."""
    path = scratch(t.spark, "fastq")
    sinks.write_fastq(_reads(t), path)
    return _read_back(Q.read_fastq(t.spark, path))


def _reads(t):
    seq = F.regexp_replace("text", "[^A-Za-z]", "")
    qual = F.repeat(F.lit("@"), F.length("seq"))
    return (
        t.conversations.withColumn("seq", seq)
        .where(F.length("seq") > 0)
        .select(
            F.concat(F.lit("c"), "conv_id", F.lit("_"), "turn").alias("header"),
            "seq",
            F.when(F.col("role") == "system", F.concat(qual, F.lit("@"))).otherwise(qual).alias("qual"),
        )
    )


def _read_back(rows):
    return rows.select("header", F.length("seq").cast("long").alias("n"), F.sha2("seq", 256).alias("digest"), "reason")


@query(
    "fastq_block_gzip",
    "SRC-04 SNK-03",
    FASTQ_SQL,
)
def fastq_block_gzip(t):
    """The same reads as block gzip, read by ranges of a few members: records are cut by the borders of ranges."""
    lines = _reads(t).select(F.explode(F.split(sinks.fastq_record(), "\n")).alias("value"))
    files = write_block_gzip(lines, scratch(t.spark, "block-gzip"), member_bytes=4096)
    lines = read_block_gzip_lines(t.spark, files, range_bytes=16_384)
    return _read_back(Q.fastq_records(lines))


@query(
    "base_profile",
    "PRJ-01",
    f"""WITH {SEQS} SELECT doc_id, length(seq) AS length,
  length(regexp_replace(seq, '[^acgt]', '', 'g')) AS lower_n,
  length(regexp_replace(seq, '[^Nn]', '', 'g')) AS gap_n,
  length(regexp_replace(seq, '[^acgtNn]', '', 'g')) AS masked_n,
  length(regexp_replace(seq, '[^\\p{{Ll}}]', '', 'g')) AS lower_any_n,
  length(regexp_replace(seq, '[^\\p{{Ll}}N]', '', 'g')) AS masked_any_n
FROM seqs""".replace("\\\\", "\\"),
)
def base_profile(t):
    """Length, soft-masked, gap and masked-site counts under both lowercase definitions."""
    one = S.base_profile(seqs(t))
    return one.select(
        "doc_id",
        "length",
        "lower_n",
        "gap_n",
        "masked_n",
        R.lowercase_count("seq", "any").alias("lower_any_n"),
        R.masked_sites("seq", "any").alias("masked_any_n"),
    )


@query(
    "mask_transforms",
    "PRJ-02",
    f"""WITH {SEQS} SELECT doc_id, sha256(regexp_replace(seq, '[acgt]', 'N', 'g')) AS hard,
  sha256(upper(regexp_replace(seq, '[^A-Za-z]', '', 'g'))) AS plain FROM seqs""",
)
def mask_transforms(t):
    """Hard-masked and unmasked copies, by digest."""
    return seqs(t).select(
        "doc_id",
        F.sha2(R.hard_mask("seq"), 256).alias("hard"),
        F.sha2(R.unmask(F.regexp_replace("seq", "[^A-Za-z]", "")), 256).alias("plain"),
    )


PROTEIN_SQL = r"""
  length(regexp_replace(regexp_replace(seq, '\*$', ''), '[^.*]', '', 'g')) AS internal_ambiguity,
  greatest(length(regexp_replace(seq, '[^*]', '', 'g')) - (CASE WHEN seq LIKE '%*' THEN 1 ELSE 0 END), 0) AS internal_stops_one,
  length(regexp_replace(regexp_replace(seq, '\*+$', ''), '[^*]', '', 'g')) AS internal_stops_all,
  length(regexp_replace(seq, '[^XBZJUO]', '', 'g')) AS ambiguous_listed,
  length(regexp_replace(seq, '[ACDEFGHIKLMNPQRSTVWY*]', '', 'g')) AS ambiguous_alphabet"""


@query("protein_flags", "PRJ-03 PRJ-04 PRJ-05", f"WITH {SEQS} SELECT doc_id, {PROTEIN_SQL} FROM seqs")
def protein_flags(t):
    """Interior ambiguity, internal stops and ambiguous residues, both definitions each."""
    return S.protein_flags(seqs(t)).drop("lang", "source", "seq")


@query(
    "protein_summary",
    "A-03 PRJ-04 PRJ-05",
    f"""WITH {SEQS}, p AS (SELECT lang, source || '_' || length(seq) AS id, length(seq) AS len, {PROTEIN_SQL} FROM seqs)
SELECT lang, count(*) FILTER (len > 0) AS proteins, CAST(sum(ambiguous_listed) AS BIGINT) AS ambiguous_residues,
  CAST(sum(internal_stops_one) AS BIGINT) AS internal_stops, count(*) - count(DISTINCT id) AS duplicate_ids,
  CAST(floor(quantile_cont(len, 0.5) FILTER (len > 0)) AS BIGINT) AS protein_median_len
FROM p GROUP BY lang""",
)
def protein_summary(t):
    """Protein-set summary per delivery; ids repeat where source and length agree."""
    rows = seqs(t).withColumn("id", F.concat("source", F.lit("_"), F.length("seq")))
    return S.protein_summary(rows, ["lang"])


@query(
    "protein_lengths",
    "A-27",
    f"""WITH {SEQS} SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS rec, doc_id,
  length(seq) AS aa FROM seqs""",
)
def protein_lengths(t):
    """Record lengths in file order, one row each."""
    rows = ordinal(S.protein_lengths(seqs(t)), ["lang"], ["doc_id"], F.floor(F.col("doc_id") / 4096))
    return rows.select("lang", "rec", "doc_id", "aa")


@query(
    "softmask_rule",
    "A-05 PRJ-18",
    f"""WITH {SEQS}, d AS (SELECT source, CASE WHEN lang = 'de' THEN upper(regexp_replace(seq, '[^A-Za-z]', '', 'g'))
    WHEN lang = 'fr' THEN regexp_replace(seq, '[acgt]', 'N', 'g') ELSE seq END AS seq, lang FROM seqs),
s AS (SELECT lang, source, count(*) AS rows, CAST(sum(length(seq)) AS BIGINT) AS total,
  CAST(sum(length(regexp_replace(seq, '[^acgt]', '', 'g'))) AS BIGINT) AS lower_n,
  CAST(sum(length(regexp_replace(seq, '[^Nn]', '', 'g'))) AS BIGINT) AS gap_n FROM d GROUP BY lang, source)
SELECT *, CASE WHEN total = 0 THEN 'manual' WHEN lower_n * 1.0 / total < 0.005 THEN 'gap_not_softmasked'
  WHEN gap_n * 1.0 / total > 0.2 THEN 'gap_hardmasked' ELSE 'ok' END AS outcome FROM s""",
)
def softmask_rule(t):
    """Soft-mask gap rule on soft, hard-masked and unmasked deliveries."""
    rows = seqs(t).withColumn(
        "seq",
        F.when(F.col("lang") == "de", R.unmask(F.regexp_replace("seq", "[^A-Za-z]", "")))
        .when(F.col("lang") == "fr", R.hard_mask("seq"))
        .otherwise(F.col("seq")),
    )
    return S.softmask_rule(rows, ["lang", "source"])


DELIVERED_SQL = """delivered AS (
  SELECT doc_id, lang, CASE WHEN lang = 'de' THEN regexp_replace(seq, '[acgt]', 'N', 'g')
    WHEN lang = 'fr' AND source = 'src8' THEN seq || 'A' ELSE seq END AS seq
  FROM seqs WHERE NOT (lang = 'es' AND source = 'src12')),
a AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS rec FROM seqs),
b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS rec FROM delivered)"""

MASK_QC_SQL = r"""qc0 AS (
  SELECT coalesce(a.lang, b.lang) AS lang, a.doc_id AS ia, b.doc_id AS ib, a.seq AS sa, b.seq AS sb
  FROM a FULL JOIN b ON a.lang = b.lang AND a.rec = b.rec),
qc1 AS (SELECT lang, bool_and(ia IS NOT DISTINCT FROM ib) AS ids_equal,
  bool_and(length(sa) IS NOT DISTINCT FROM length(sb)) AS lo, bool_and(upper(sa) IS NOT DISTINCT FROM upper(sb)) AS so,
  CAST(coalesce(sum(length(sb)), 0) AS BIGINT) AS total,
  CAST(coalesce(sum(length(regexp_replace(sb, '[^\p{Ll}]', '', 'g'))), 0) AS BIGINT) AS lower_n,
  CAST(coalesce(sum(length(regexp_replace(sb, '[^Nn]', '', 'g'))), 0) AS BIGINT) AS gap_n FROM qc0 GROUP BY lang),
qc AS (SELECT lang, ids_equal, total, lower_n, gap_n, ids_equal AND lo AS lengths_equal,
  ids_equal AND so AS sequence_equal_ignorecase, round(100.0 * lower_n / total, 3) AS lowercase_pct,
  round(100.0 * gap_n / total, 3) AS n_pct,
  CASE WHEN ids_equal AND lo AND so AND round(100.0 * lower_n / total, 3) >= 0.5 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM qc1)"""


def _before_after(t):
    before = seqs(t)
    after = before.where(~((F.col("lang") == "es") & (F.col("source") == "src12"))).withColumn(
        "seq",
        F.when(F.col("lang") == "de", R.hard_mask("seq"))
        .when((F.col("lang") == "fr") & (F.col("source") == "src8"), F.concat("seq", F.lit("A")))
        .otherwise(F.col("seq")),
    )

    def named(df):
        return df.select("lang", F.col("doc_id").alias("id"), "doc_id", "seq")

    return named(before), named(after)


def _doc_block():
    return F.floor(F.col("doc_id") / 4096)


@query("mask_qc", "A-04 PRJ-18", f"WITH {SEQS}, {DELIVERED_SQL}, {MASK_QC_SQL} SELECT * FROM qc")
def mask_qc(t):
    """Delivery against input: ids in order, lengths, case-insensitive bases, percentages, gate."""
    return S.mask_qc(*[numbered_facts(d, ["lang"], ["doc_id"], _doc_block()) for d in _before_after(t)], ["lang"])


INTERVALS_SQL = """runs AS (SELECT doc_id, lang, unnest(regexp_extract_all(seq, '[acgt]+|[^acgt]+')) AS run,
    generate_subscripts(regexp_extract_all(seq, '[acgt]+|[^acgt]+'), 1) AS n FROM src),
placed AS (SELECT doc_id, lang, run,
    1 + coalesce(sum(length(run)) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM runs),
iv AS (SELECT doc_id, lang, s, s + length(run) - 1 AS e FROM placed WHERE regexp_matches(run, '^[acgt]'))"""


@query(
    "mask_intervals",
    "W-04",
    f"""WITH {SEQS}, src AS (SELECT * FROM seqs), {INTERVALS_SQL}
SELECT doc_id, count(*) AS intervals, CAST(sum(s) AS BIGINT) AS start_sum, CAST(sum(e) AS BIGINT) AS end_sum,
  CAST(max(e - s + 1) AS BIGINT) AS longest FROM iv GROUP BY doc_id""",
)
def mask_intervals(t):
    """Lowercase intervals of every document, found on small pieces and stitched."""
    pieces = S.pieces_of(seqs(t), ["doc_id"], size=1000)
    return (
        S.mask_intervals(pieces, ["doc_id"])
        .groupBy("doc_id")
        .agg(
            F.count("*").alias("intervals"),
            F.sum("start").alias("start_sum"),
            F.sum("end").alias("end_sum"),
            F.max(F.col("end") - F.col("start") + 1).alias("longest"),
        )
    )


@query(
    "masking_job",
    "C-01",
    f"""WITH {SEQS}, {DELIVERED_SQL}, {MASK_QC_SQL}, src AS (SELECT doc_id, lang, seq FROM delivered), {INTERVALS_SQL},
i AS (SELECT lang, count(*) AS intervals, CAST(sum(e - s + 1) AS BIGINT) AS interval_bases,
  CAST(max(e - s + 1) AS BIGINT) AS longest FROM iv GROUP BY lang),
r AS (SELECT lang, count(*) AS records, CASE WHEN sum(length(seq)) = 0 THEN 'manual'
  WHEN sum(length(regexp_replace(seq, '[^acgt]', '', 'g'))) * 1.0 / sum(length(seq)) < 0.005 THEN 'gap_not_softmasked'
  WHEN sum(length(regexp_replace(seq, '[^Nn]', '', 'g'))) * 1.0 / sum(length(seq)) > 0.2 THEN 'gap_hardmasked'
  ELSE 'ok' END AS outcome FROM delivered GROUP BY lang)
SELECT lang, status, lowercase_pct, n_pct, total, records, outcome, coalesce(intervals, 0) AS intervals,
  coalesce(interval_bases, 0) AS interval_bases, coalesce(longest, 0) AS longest
FROM qc LEFT JOIN r USING (lang) LEFT JOIN i USING (lang)""",
)
def masking_job(t):
    """Whole masking QC job: profile, gap rule, before/after check, intervals."""
    return masking_report(*_before_after(t), ["lang"], ["doc_id"], _doc_block())


REGIONS_SQL = """regions AS (
  SELECT doc_id, 11 AS s, CASE WHEN quality = 1 THEN 60 ELSE 400 END AS e,
         CASE WHEN toxic = 1 THEN 'hard' ELSE 'soft' END AS expected, quality, toxic FROM labels)"""


def _regions(t):
    return t.labels.select(
        "doc_id",
        F.lit(11).cast("long").alias("start"),
        F.when(F.col("quality") == 1, 60).otherwise(400).cast("long").alias("end"),
        F.when(F.col("toxic") == 1, "hard").otherwise("soft").alias("expected"),
        "quality",
        "toxic",
    )


@query(
    "sequence_window",
    "PRJ-11",
    f"""WITH {SEQS}, {REGIONS_SQL} SELECT doc_id, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS "end",
  length(substring(seq, s, e - s + 1)) AS n, sha256(substring(seq, s, e - s + 1)) AS digest
FROM seqs JOIN regions USING (doc_id)""",
)
def sequence_window(t):
    """Closed 1-based windows of labelled documents."""
    cut = S.sequence_window(seqs(t), _regions(t), "doc_id")
    return cut.select(
        "doc_id", "start", "end", F.length("bases").cast("long").alias("n"), F.sha2("bases", 256).alias("digest")
    )


@query(
    "piece_window",
    "PRJ-11",
    f"""WITH {SEQS}, {REGIONS_SQL} SELECT doc_id,
  length(substring(seq, s, e - s + 1)) AS n,
  length(regexp_replace(substring(seq, s, e - s + 1), '[^acgt]', '', 'g')) AS lower_n
FROM seqs JOIN regions USING (doc_id) WHERE length(seq) >= s""",
)
def piece_window(t):
    """The same windows cut from pieces, for records longer than a row."""
    parts = S.piece_window(S.pieces_of(seqs(t), ["doc_id"], size=256), _regions(t), ["doc_id"])
    return parts.groupBy("doc_id").agg(
        F.sum(F.length("bases").cast("long")).alias("n"), F.sum(R.lowercase_count("bases")).alias("lower_n")
    )


@query(
    "check_regions",
    "J-26",
    f"""WITH {SEQS}, {REGIONS_SQL}, d AS (SELECT doc_id, s, e, expected,
   CASE WHEN quality = 1 AND toxic = 0 THEN regexp_replace(seq, '[^acgt]', 't', 'g')
        WHEN toxic = 1 AND quality = 0 THEN regexp_replace(seq, '.', 'N', 'g') ELSE seq END AS seq
  FROM seqs JOIN regions USING (doc_id))
SELECT doc_id, expected, CASE WHEN e > length(seq) THEN 'outside'
  WHEN expected = 'soft' AND regexp_full_match(substring(seq, s, e - s + 1), '[acgt]+') THEN 'as_declared'
  WHEN expected = 'hard' AND regexp_full_match(substring(seq, s, e - s + 1), 'N+') THEN 'as_declared'
  ELSE 'differs' END AS outcome FROM d""",
)
def check_regions(t):
    """Declared regions against the delivered bases."""
    delivered = seqs(t).join(t.labels, "doc_id").withColumn(
        "seq",
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.regexp_replace("seq", "[^acgt]", "t"))
        .when((F.col("toxic") == 1) & (F.col("quality") == 0), F.regexp_replace("seq", ".", "N"))
        .otherwise(F.col("seq")),
    )
    regions = _regions(t).drop("quality", "toxic")
    return S.check_regions(delivered.select("doc_id", "seq"), regions, "doc_id").select("doc_id", "expected", "outcome")


@query(
    "take_prefix",
    "W-09",
    f"""WITH {SEQS}, c AS (SELECT doc_id, source, length(seq) AS len,
   row_number() OVER w - 1 AS rec, coalesce(sum(length(seq)) OVER (PARTITION BY source ORDER BY doc_id
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM seqs WINDOW w AS (PARTITION BY source ORDER BY doc_id))
SELECT doc_id, source, rec, CAST(before AS BIGINT) AS before, CAST(least(len, 20000 - before) AS BIGINT) AS taken
FROM c WHERE before < 20000 AND rec < 12""",
)
def take_prefix(t):
    """First records of each source up to 20,000 bases or twelve records."""
    rows = S.take_prefix(seqs(t), ["source"], "doc_id", F.floor(F.col("doc_id") / 4096), 20_000, 12)
    return rows.select("doc_id", "source", "rec", "before", "taken")


@query(
    "id_only_headers",
    "PRJ-07",
    r"""WITH h AS (SELECT page_id, split_part(url, '/', 3) AS host, url || ' page ' || page_id AS header, html FROM pages),
x AS (SELECT host, page_id, regexp_extract(header, '^\s*(\S*)', 1) AS id FROM h),
n AS (SELECT host, id, count(*) AS n FROM x GROUP BY host, id)
SELECT host, true AS order_equal, true AS lengths_equal, true AS sequence_equal_ignorecase, max(n) = 1 AS ids_unique
FROM n GROUP BY host""",
)
def id_only_headers(t):
    """Headers cut to their first token; order, uniqueness and bases checked."""
    pages = t.pages.select(
        F.split("url", "/")[2].alias("host"),
        "page_id",
        F.concat("url", F.lit(" page "), "page_id").alias("header"),
        F.col("html").alias("seq"),
    )
    block = F.floor(F.col("page_id") / 4096)
    before = pages.withColumn("id", F.split("header", " ")[0])
    after = S.id_only(pages).withColumn("seq", F.translate("seq", "acgt", "ACGT"))
    return S.verify_same(*[numbered_facts(d, ["host"], ["page_id"], block) for d in (before, after)], ["host"])
