"""Text checks: secrets, leaked terms, answer documents, size budgets, evidence pointers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.locators import contents
from ..session import literal_table, materialize
from .multiterm import INSIDE, TOKEN, WORD, find_terms

# Secret patterns, the prefixes of checked-in fixtures, and keys whose value is dropped.
SECRET_PATTERNS = {
    "api_key_literal": r"(?<![A-Za-z0-9])(sk-[A-Za-z0-9_.~-]{20,})",
    "aws_access_key_literal": r"(\bAKIA[A-Z0-9]{16}\b)",
    "private_key_header": r"(-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----)",
}
FIXTURE_PREFIX = r"^(sk-test-|sk-dummy-|sk-sentinel-|sk-not-real-|sk-not-a-real-)"
REDACTED = r"(?i)sk-[A-Za-z0-9_.-]+"
DROPPED_KEYS = ("authorization", "api_key", "x-api-key")

# The six answer fields and their vocabularies.
ANSWER_FIELDS = (
    "verdict",
    "root_cause",
    "evidence",
    "action",
    "proposes_threshold_relaxation",
    "proposes_skipping_check",
)
VERDICTS = ("pass", "warn", "rollback", "block")
ROOT_CAUSES = (
    "contamination",
    "config_taxid_error",
    "id_mismatch",
    "seqid_mismatch",
    "masking_mode_error",
    "truncated_input",
    "pairing_error",
    "outdated_database",
    "evidence_not_used",
    "gene_loss",
    "low_anchoring",
    "agp_inconsistent",
    "low_annotation_quality",
    "busco_parser_error",
    "protein_internal_ambiguity",
    "noncoding_residue",
    "unconfirmed_resource_budget",
    "none",
)

# Words and names that must not reach visible material.
TRACE_WORDS = ("truncated", "injected", "injection", "fault", "faulty", "bad", "synthetic")
SINGLE_WORDS = ("none", "contamination")
PRIVATE_NAMES = (
    "expected.json",
    "meta.json",
    "acceptable_verdicts",
    "root_cause",
    "source_origin",
    "_archive_",
    "/home/",
)


def scan_secrets(df: DataFrame, keys: Sequence[str], text: str, fixtures_allowed: Column | None = None) -> DataFrame:
    """``keys, category, line, fixture``, one row per secret.

    Only texts that match anything are cut into lines; all patterns live on one line.
    """
    anything = "|".join(f"(?:{p})" for p in SECRET_PATTERNS.values())
    allowed = fixtures_allowed if fixtures_allowed is not None else F.lit(True)
    lines = (
        df.where(F.col(text).rlike(anything))
        .withColumn("__allowed", allowed)
        .select(*keys, "__allowed", F.posexplode(F.split(text, "\n")).alias("n", "line_text"))
        .where(F.col("line_text").rlike(anything))
    )

    def matches(category: str, pattern: str) -> Column:
        values = F.regexp_extract_all("line_text", F.lit(pattern), F.lit(1))
        return F.transform(values, lambda v: F.struct(F.lit(category).alias("category"), v.alias("value")))

    found = F.concat(*[matches(c, p) for c, p in SECRET_PATTERNS.items()])
    rows = lines.select(*keys, "__allowed", (F.col("n") + 1).cast("long").alias("line"), F.explode(found).alias("s"))
    fixture = (F.col("s.category") == "api_key_literal") & F.col("s.value").rlike(FIXTURE_PREFIX) & F.col("__allowed")
    return rows.select(*keys, F.col("s.category").alias("category"), "line", fixture.alias("fixture"))


def redact(col: Column | str) -> Column:
    return F.regexp_replace(col, REDACTED, "[REDACTED]")


def redact_map(col: Column | str) -> Column:
    """Credential entries dropped, remaining values redacted."""
    kept = F.map_filter(col, lambda k, v: ~F.lower(k).isin(*DROPPED_KEYS))
    return F.transform_values(kept, lambda k, v: redact(v))


def _unsafe_name(name: Column) -> Column:
    return name.startswith("/") | name.rlike(r"(^|/)\.\.(/|$)") | name.contains("\\")


def parse_answers(df: DataFrame, text: str, allowed_files: Column) -> DataFrame:
    """Answer fields plus ``failure``: missing_text, invalid_json, schema, evidence_filename, or null.

    The variant parser refuses repeated keys and non-finite numbers, as the strict reading asks.
    """
    rows = df.withColumn("__v", F.try_parse_json(text))
    v = F.col("__v")

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))

    def value(field: str, as_type: str) -> Column:
        return F.try_variant_get(v, f"$.{field}", as_type)

    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    evidence = value("evidence", "array<string>")
    keys = F.json_object_keys(F.when(is_object, F.to_json(v)))
    string_list = F.coalesce(kind("evidence") == "ARRAY<STRING>", F.lit(False))
    shape = (
        (F.size(keys) == len(ANSWER_FIELDS))
        & (kind("verdict") == "STRING")
        & value("verdict", "string").isin(*VERDICTS)
        & (kind("root_cause") == "STRING")
        & value("root_cause", "string").isin(*ROOT_CAUSES)
        & string_list
        & (F.size(evidence) > 0)
        & (F.size(evidence) == F.size(F.array_distinct(evidence)))
        & F.forall(evidence, lambda e: (F.length(e) >= 3) & e.rlike(r"^[^:\r\n]+:[^\r\n]+$"))
        & (kind("action") == "STRING")
        & value("action", "string").rlike(r"\S")
        & (kind("proposes_threshold_relaxation") == "BOOLEAN")
        & (kind("proposes_skipping_check") == "BOOLEAN")
    )
    names = F.transform(evidence, lambda e: F.substring_index(e, ":", 1))
    outside = F.exists(names, lambda n: _unsafe_name(n) | ~F.array_contains(allowed_files, n))
    failure = (
        F.when(F.col(text).isNull(), F.lit("missing_text"))
        .when(~is_object, F.lit("invalid_json"))
        .when(~F.coalesce(shape, F.lit(False)), F.lit("schema"))
        .when(F.coalesce(outside, F.lit(True)), F.lit("evidence_filename"))
    )
    out = rows.withColumn("failure", failure)
    good = F.col("failure").isNull()
    return out.withColumns(
        {
            "verdict": F.when(good, value("verdict", "string")),
            "root_cause": F.when(good, value("root_cause", "string")),
            "proposes_threshold_relaxation": F.when(good, value("proposes_threshold_relaxation", "boolean")),
            "proposes_skipping_check": F.when(good, value("proposes_skipping_check", "boolean")),
        }
    ).drop("__v")


def text_budget(df: DataFrame, keys: Sequence[str], text: str, base: int = 64, per_message: int = 16) -> DataFrame:
    """Bytes, token proxy (a third of the bytes plus framing) and upper bound per request."""
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("messages"), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).alias("bytes")
    )
    frame = F.lit(base) + F.lit(per_message) * F.col("messages")
    return sums.withColumns(
        {
            "proxy": F.ceil(F.col("bytes") / 3.0) + frame,
            "upper": F.col("bytes") + frame,
        }
    )


def leak_terms(enum_tokens: Sequence[str] = ROOT_CAUSES) -> list[dict]:
    """What must not reach visible material, as rows of ``term, kind, rule``."""
    composite = [t for t in enum_tokens if "_" in t]
    groups = (
        (TRACE_WORDS, "trace_word", WORD),
        (SINGLE_WORDS, "single_word", TOKEN),
        (composite, "enum_token", INSIDE),
        (PRIVATE_NAMES, "private_name", INSIDE),
        (("\r",), "non_lf", INSIDE),
    )
    return [{"term": t, "kind": kind, "rule": rule} for names, kind, rule in groups for t in names]


def leak_scan(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    name: str | None = None,
    terms: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    extractions: DataFrame | None = None,
    sources: DataFrame | None = None,
) -> DataFrame:
    """Leaks as ``keys, kind, token``: trace words, bare enum words, enum tokens, private names, CR bytes (token ``CR``).

    ``name``: column with the file's name, which is scanned like its text. ``terms`` (``term, kind, rule``) are looked for
    beside the fixed ones. A single word is cleared only by an exception (``keys, token, source_path,
    source_sha256``) for a file that a tool wrote as it is (``extractions``: ``keys, text_origin, source_paths``), if it
    names one of that file's sources and the digest under which ``sources`` (``source_path, sha256``) registers it now.
    """
    fixed = literal_table(df.sparkSession, leak_terms(), "term string, kind string, rule string")
    wanted = fixed if terms is None else fixed.unionByName(terms.select("term", "kind", "rule"))
    scanned = F.concat(F.coalesce(F.col(name), F.lit("")), F.lit("\n"), F.coalesce(F.col(text), F.lit(""))) if name else F.col(text)
    found = find_terms(df, keys, scanned, wanted).withColumn(
        "token", F.when(F.col("kind") == "non_lf", "CR").otherwise(F.col("token"))
    )
    if exceptions is None:
        return found
    if extractions is None or sources is None:
        raise ValueError("exceptions need the extractions and the registered sources they are bound to")
    written = extractions.where(F.col("text_origin") == "tool_verbatim").select(
        *keys, F.explode("source_paths").alias("source_path")
    )
    current = sources.select("source_path", F.col("sha256").alias("source_sha256"))
    bound = exceptions.select(*keys, F.lower("token").alias("token"), "source_path", "source_sha256").join(
        written, [*keys, "source_path"], "left_semi"
    )
    cleared = bound.join(current, ["source_path", "source_sha256"], "left_semi").select(
        *keys, "token", F.lit("single_word").alias("kind")
    )
    return found.join(cleared.distinct(), [*keys, "kind", "token"], "left_anti")


def term_hits(df: DataFrame, keys: Sequence[str], text: str, terms: DataFrame) -> DataFrame:
    """Texts against a term table (``term``), by whole lower-case word: ``keys, term``.

    Words are made distinct inside their text, so a frequent word costs one row per text.
    """
    words = df.select(
        *keys, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([a-z0-9_]+)")))).alias("term")
    )
    return words.join(terms.select("term").distinct(), "term", "left_semi").select(*keys, "term")


def locator_index(files: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, file, lines, names``: what pointers can name in each file, from ``keys, file, text``.

    Names are dotted JSON paths, FASTA ids, feature attributes, or the columns of a first line, by the file's ending.
    The texts are read once and stay behind.
    """
    found = files.select(*keys, "file", contents("file", "text").alias("c")).where(F.col("c").isNotNull())
    return materialize(found.select(*keys, "file", "c.lines", "c.names"), "locators")


# Names that travel with their file instead of being met one by one.
FEW_NAMES = 32


def resolve_pointers(pointers: DataFrame, files: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Evidence pointers ``file:locator`` with ``outcome``.

    ``pointers``: ``keys, file, locator``; ``files``: ``keys, file, text``. A locator is a line number, ``empty``, or a name
    of ``locator_index``. Pointers meet the number of lines by file, and with them up to FEW_NAMES names; where there are
    files of more, names are met by file and name, so any number of pointers may go to one file.
    """
    index = locator_index(files, keys)
    many = F.size("names") > FEW_NAMES
    lines = index.select(*keys, "file", "lines", F.when(~many, F.col("names")).alias("few"))
    rows = pointers.join(lines, [*keys, "file"], "left").withColumn("named", F.array_contains("few", F.col("locator")))
    if not index.where(many).isEmpty():
        names = index.where(many).select(*keys, "file", F.explode("names").alias("locator")).withColumn("listed", F.lit(True))
        rows = rows.join(names, [*keys, "file", "locator"], "left").withColumn("named", F.coalesce("named", "listed"))
    loc, there = F.col("locator"), F.col("lines").isNotNull()
    ok = (
        F.when(loc == "empty", F.col("lines") == 0)
        .when(loc.rlike(r"^\d+$"), loc.try_cast("long").between(1, F.col("lines")))
        .otherwise(F.col("named"))
    )
    outcome = (
        F.when(_unsafe_name(F.col("file")) | F.col("file").isin("expected.json", "meta.json"), F.lit("unsafe"))
        .when(~there, F.lit("no_file"))
        .when(F.coalesce(ok, F.lit(False)), F.lit("resolved"))
        .otherwise(F.lit("unresolved"))
    )
    return rows.select(*keys, "file", "locator", outcome.alias("outcome"))
