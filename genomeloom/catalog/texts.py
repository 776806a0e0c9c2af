"""Text-scan queries over documents, pages, conversations and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import textscan as X
from ..operators.multiterm import find_terms
from .registry import query

# Planted tokens of the corpus become key literals; some texts gain an access key or a key header.
KEYED_SQL = """keyed AS (SELECT doc_id, source, CASE WHEN source = 'src8' THEN replace(text, 'token = "', 'k = sk-test-') ELSE replace(text, 'token = "', 'k = sk-') END
  || CASE WHEN lang = 'es' THEN chr(10) || 'id AKIA' || upper(substring(sha256(text), 1, 16)) || ' end' ELSE '' END
  || CASE WHEN lang = 'de' AND source = 'src6' THEN chr(10) || '-----BEGIN RSA PRIVATE KEY-----' ELSE '' END AS text FROM documents)"""


def keyed(t):
    text = F.when(F.col("source") == "src8", F.replace("text", F.lit('token = "'), F.lit("k = sk-test-"))).otherwise(
        F.replace("text", F.lit('token = "'), F.lit("k = sk-"))
    )
    access = F.concat(F.lit("\nid AKIA"), F.upper(F.substring(F.sha2("text", 256), 1, 16)), F.lit(" end"))
    return t.documents.select(
        "doc_id",
        "source",
        F.concat(
            text,
            F.when(F.col("lang") == "es", access).otherwise(""),
            F.when((F.col("lang") == "de") & (F.col("source") == "src6"), "\n-----BEGIN RSA PRIVATE KEY-----").otherwise(""),
        ).alias("text"),
    )


@query(
    "scan_secrets",
    "PRJ-14",
    rf"""WITH {KEYED_SQL}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM keyed),
f AS (SELECT doc_id, line, 'api_key_literal' AS category, unnest(regexp_extract_all(s, '(?:^|[^A-Za-z0-9])(sk-[A-Za-z0-9_.~-]{{20,}})', 1)) AS v FROM l
  UNION ALL SELECT doc_id, line, 'aws_access_key_literal', unnest(regexp_extract_all(s, '\bAKIA[A-Z0-9]{{16}}\b')) FROM l
  UNION ALL SELECT doc_id, line, 'private_key_header', unnest(regexp_extract_all(s, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----')) FROM l)
SELECT doc_id, category, line, category = 'api_key_literal' AND v LIKE 'sk-test-%' AS fixture FROM f""",
)
def scan_secrets(t):
    """Secrets per document with line number; test-key literals are fixtures."""
    return X.scan_secrets(keyed(t), ["doc_id"], "text")


@query(
    "redact",
    "PRJ-14",
    rf"""WITH {KEYED_SQL} SELECT doc_id, sha256(regexp_replace(text, '(?i)sk-[A-Za-z0-9_.-]+', '[REDACTED]', 'g')) AS digest,
  regexp_matches(text, '(?i)sk-[A-Za-z0-9_.-]+') AS touched FROM keyed""",
)
def redact(t):
    """Key literals replaced in every document."""
    rows = keyed(t)
    return rows.select(
        "doc_id", F.sha2(X.redact("text"), 256).alias("digest"), F.col("text").rlike(X.REDACTED).alias("touched")
    )


@query(
    "redact_map",
    "PRJ-14",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS kept, '[REDACTED]' AS note FROM events""",
)
def redact_map(t):
    """Credential entries dropped from header maps, other values redacted."""
    headers = F.map_filter(
        F.create_map(
            F.lit("Authorization"), F.lit("Bearer x"),
            F.lit("X-Api-Key"), F.col("user_id").cast("string"),
            F.lit("note"), F.concat(F.lit("sk-"), "user_id"),
            F.lit("type"), F.when(F.col("event_type") != "error", F.col("event_type")),
        ),
        lambda k, v: v.isNotNull(),
    )
    rows = t.events.select("event_id", X.redact_map(headers).alias("h"))
    return rows.select("event_id", F.size("h").alias("kept"), F.col("h")["note"].alias("note"))


ANSWER_SQL = """a AS (SELECT o_orderkey, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS price, o_custkey AS c FROM orders)"""


@query(
    "parse_answers",
    "PRJ-15",
    f"""WITH {ANSWER_SQL}, f AS (SELECT *, CASE WHEN price > 480000 THEN 'missing_text' WHEN price > 460000 OR price BETWEEN 440000 AND 460000 OR price BETWEEN 420000 AND 440000 OR price BETWEEN 400000 AND 420000 THEN 'invalid_json'
   WHEN pr = '1-URGENT' OR (pr = '2-HIGH' AND st = 'P') OR c < 100 OR c BETWEEN 100 AND 150 THEN 'schema' WHEN c BETWEEN 151 AND 200 THEN 'evidence_filename' END AS failure FROM a)
SELECT o_orderkey, failure, CASE WHEN failure IS NULL THEN CASE WHEN st = 'F' THEN 'block' ELSE 'pass' END END AS verdict, CASE WHEN failure IS NULL THEN 'none' END AS root_cause,
  CASE WHEN failure IS NULL THEN price > 300000 END AS proposes_threshold_relaxation FROM f""",
)
def parse_answers(t):
    """Answer documents under the strict reading, by failure reason."""
    price, pr, st, c = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_custkey")
    verdict = F.when(st == "F", "block").otherwise("pass")
    verdict = F.when(pr == "1-URGENT", "maybe").otherwise(verdict)
    evidence = (
        F.when(c < 100, "[]")
        .when(c <= 150, '["task.md:1", "task.md:1"]')
        .when(c <= 200, '["../secret.md:1"]')
        .otherwise('["task.md:1", "models.gff3:ID"]')
    )
    skip = F.when((pr == "2-HIGH") & (st == "P"), '"no"').otherwise("false")
    good = F.concat(
        F.lit('{"verdict": "'), verdict, F.lit('", "root_cause": "none", "evidence": '), evidence,
        F.lit(', "action": "repair first", "proposes_threshold_relaxation": '), (price > 300000).cast("string"),
        F.lit(', "proposes_skipping_check": '), skip,
    )
    text = (
        F.when(price > 480000, None)
        .when(price > 460000, F.lit("I think it is fine"))
        .when(price >= 440000, F.concat(good, F.lit(', "verdict": "warn"}')))
        .when(price >= 420000, F.lit("[1, 2]"))
        .when(price >= 400000, F.concat(good, F.lit(', "score": NaN}')))
        .otherwise(F.concat(good, F.lit("}")))
    )
    rows = t.orders.select("o_orderkey", text.alias("text"))
    allowed = F.array(F.lit("task.md"), F.lit("models.gff3"))
    out = X.parse_answers(rows, "text", allowed)
    return out.select("o_orderkey", "failure", "verdict", "root_cause", "proposes_threshold_relaxation")


@query(
    "text_budget",
    "PRJ-16",
    """SELECT conv_id, count(*) AS messages, CAST(sum(strlen(text)) AS BIGINT) AS bytes, CAST(ceil(sum(strlen(text)) / 3.0) AS BIGINT) + 64 + 16 * count(*) AS proxy,
  CAST(sum(strlen(text)) AS BIGINT) + 64 + 16 * count(*) AS upper FROM conversations GROUP BY conv_id""",
)
def text_budget(t):
    """Byte and token budgets of every conversation."""
    return X.text_budget(t.conversations, ["conv_id"], "text")


LEAK_SQL = r"""x AS (SELECT doc_id, source, lang,
   CASE WHEN source = 'src7' THEN 'artifacts/truncated_' WHEN source = 'src9' THEN 'artifacts/low_anchoring/' ELSE 'artifacts/' END || doc_id || '.txt' || chr(10)
   || lower(text) || CASE WHEN source IN ('src2', 'src3') THEN ' none ' WHEN source = 'src4' THEN ' (bad) masking_mode_error' WHEN source = 'src5' THEN ' see /home/x meta.json' ELSE '' END AS s FROM documents),
tk AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(s, '[a-z0-9]+'))) AS w FROM x), tu AS (SELECT doc_id, source, lang, unnest(list_distinct(regexp_extract_all(s, '[a-z0-9_]+'))) AS w FROM x),
r AS (SELECT doc_id, 'trace_word' AS kind, w AS token FROM tk WHERE w IN ('truncated', 'injected', 'injection', 'fault', 'faulty', 'bad', 'synthetic')
  UNION ALL SELECT doc_id, 'single_word', w FROM tu WHERE w IN ('none', 'contamination') AND NOT (w = 'none' AND lang IN ('fr', 'de') AND source <> 'src3' AND doc_id % 5 <> 0)
  UNION ALL SELECT doc_id, 'enum_token', n FROM x, (VALUES ('masking_mode_error'), ('low_anchoring')) v(n) WHERE contains(s, n)
  UNION ALL SELECT doc_id, 'private_name', n FROM x, (VALUES ('meta.json'), ('/home/')) v(n) WHERE contains(s, n))"""


@query("leak_scan", "C-13", f"WITH {LEAK_SQL} SELECT doc_id, kind, token FROM r")
def leak_scan(t):
    """Answer leaks in documents and their names.

    French and German texts may quote the tool's own "none": but for those from a source whose digest has
    changed since (src3), and for every fifth document, which no tool wrote as it is.
    """
    source = F.col("source")
    extra = (
        F.when(source.isin("src2", "src3"), " none ")
        .when(source == "src4", " (bad) masking_mode_error")
        .when(source == "src5", " see /home/x meta.json")
        .otherwise("")
    )
    folder = (
        F.when(source == "src7", "artifacts/truncated_").when(source == "src9", "artifacts/low_anchoring/").otherwise("artifacts/")
    )
    docs = t.documents.select(
        "doc_id", F.concat(folder, "doc_id", F.lit(".txt")).alias("name"), F.concat("text", extra).alias("text")
    )
    digest = F.sha2(source, 256)
    exceptions = t.documents.where("lang IN ('fr', 'de')").select(
        "doc_id", F.lit("none").alias("token"), source.alias("source_path"), digest.alias("source_sha256")
    )
    origin = F.when(F.col("doc_id") % 5 == 0, "edited").otherwise("tool_verbatim")
    extractions = t.documents.select("doc_id", origin.alias("text_origin"), F.array("source").alias("source_paths"))
    registered = t.documents.select("source").distinct().select(
        source.alias("source_path"), F.when(source == "src3", F.sha2(F.lit("new"), 256)).otherwise(digest).alias("sha256")
    )
    return X.leak_scan(
        docs, ["doc_id"], "text", name="name", exceptions=exceptions, extractions=extractions, sources=registered
    )


PHRASES_SQL = r"""b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\s]+') AS w FROM benchmark),
p AS (SELECT DISTINCT unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS phrase FROM b),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\s]+') AS w, ' ' || array_to_string(regexp_extract_all(lower(text), '[^\s]+'), ' ') || ' ' AS s FROM documents),
g AS (SELECT DISTINCT doc_id, s, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS phrase FROM d)"""


@query(
    "phrase_hits",
    "C-13",
    f"WITH {PHRASES_SQL} SELECT doc_id, count(*) AS phrases FROM g JOIN p USING (phrase) GROUP BY doc_id".replace("\\\\", "\\"),
)
def phrase_hits(t):
    """Five-word phrases of the benchmark in each document: the term table is the benchmark itself."""

    def words(col):
        return F.regexp_extract_all(F.lower(col), F.lit(r"(\S+)"))

    w = F.col("w")
    phrases = (
        t.benchmark.select(words("text").alias("w"))
        .where(F.size(w) >= 5)
        .select(F.explode(F.sequence(F.lit(1), F.size(w) - 4)).alias("i"), "w")
        .select(F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("i"), F.lit(5)), " "), F.lit(" ")).alias("term"))
    )
    terms = phrases.select("term", F.lit("phrase").alias("kind"), F.lit("inside").alias("rule"))
    line = F.concat(F.lit(" "), F.array_join(words("text"), " "), F.lit(" "))
    return find_terms(t.documents, ["doc_id"], line, terms).groupBy("doc_id").agg(F.count("*").alias("phrases"))


def _term_sql(table: str, key: str, text: str) -> str:
    return f"""WITH terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS term FROM benchmark),
w AS (SELECT DISTINCT {key}, unnest(regexp_extract_all(lower({text}), '[a-z0-9_]+')) AS term FROM {table})
SELECT {key}, count(*) AS terms FROM w JOIN terms USING (term) GROUP BY {key}"""


@query("term_hits_documents", "C-13", _term_sql("documents", "doc_id", "text"))
def term_hits_documents(t):
    """Benchmark words found in each document."""
    return _term_hits(t, t.documents, "doc_id", "text")


@query("term_hits_pages", "C-13", _term_sql("pages", "page_id", "html"))
def term_hits_pages(t):
    """Benchmark words found in each page."""
    return _term_hits(t, t.pages, "page_id", "html")


def _term_hits(t, df, key, text):
    terms = t.benchmark.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([a-z0-9_]+)"))).alias("term")).distinct()
    return X.term_hits(df, [key], text, terms).groupBy(key).agg(F.count("*").alias("terms"))


@query(
    "resolve_pointers",
    "C-14",
    """WITH e AS (SELECT event_id, event_type AS ty, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
p AS (SELECT event_id, unnest(['props.json', 'props.json', 'props.json', 'table.tsv', 'notes.md', 'notes.md', '../x.json', 'gone.md', 'seq.fa']) AS file,
  unnest(['k', ty || '.0', 'list.2', 'ts', CAST(k AS VARCHAR), 'empty', 'k', '1', 'e1']) AS locator, ty, k FROM e)
SELECT event_id, file, locator, CASE WHEN file = '../x.json' THEN 'unsafe' WHEN file = 'gone.md' THEN 'no_file' WHEN file = 'props.json' AND locator = 'k' THEN 'resolved'
  WHEN file = 'props.json' AND locator = 'list.2' THEN 'unresolved' WHEN file = 'props.json' THEN CASE WHEN ty = 'list' THEN 'resolved' ELSE 'unresolved' END
  WHEN file = 'table.tsv' THEN CASE WHEN ty = 'click' THEN 'unresolved' ELSE 'resolved' END
  WHEN locator = 'empty' THEN CASE WHEN ty = 'view' THEN 'resolved' ELSE 'unresolved' END WHEN file = 'seq.fa' THEN CASE WHEN k = 1 THEN 'resolved' ELSE 'unresolved' END
  ELSE CASE WHEN ty <> 'view' AND k BETWEEN 1 AND 50 THEN 'resolved' ELSE 'unresolved' END END AS outcome FROM p""",
)
def resolve_pointers(t):
    """Evidence pointers of every event: JSON paths, TSV columns, line numbers, FASTA ids, empty files."""
    k = F.get_json_object("props", "$.k")

    def item(name, value):
        return F.struct(F.lit(name).alias("file"), value.alias("value"))

    document = F.concat(F.lit('{"list": [7, 8], "k": '), k, F.lit("}"))
    files = t.events.select(
        "event_id",
        F.explode(
            F.array(
                item("props.json", document),
                item("table.tsv", F.when(F.col("event_type") == "click", "a\tb\n1\t2").otherwise("a\tts\n1\t2")),
                item("notes.md", F.when(F.col("event_type") == "view", "").otherwise(F.repeat(F.lit("x\n"), F.lit(50)))),
                item("seq.fa", F.concat(F.lit(">e"), k, F.lit(" d\nACGT\n"))),
            )
        ).alias("f"),
    ).select("event_id", "f.file", F.col("f.value").alias("text"))
    pointers = t.events.select(
        "event_id",
        F.explode(
            F.array(
                item("props.json", F.lit("k")),
                item("props.json", F.concat("event_type", F.lit(".0"))),
                item("props.json", F.lit("list.2")),
                item("table.tsv", F.lit("ts")),
                item("notes.md", k),
                item("notes.md", F.lit("empty")),
                item("../x.json", F.lit("k")),
                item("gone.md", F.lit("1")),
                item("seq.fa", F.lit("e1")),
            )
        ).alias("p"),
    ).select("event_id", "p.file", F.col("p.value").alias("locator"))
    return X.resolve_pointers(pointers, files, ["event_id"])
