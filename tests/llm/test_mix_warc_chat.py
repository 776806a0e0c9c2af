"""Mixing, derived records and tool calls against plain Python."""

import base64
import hashlib
import json
import math
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pytest

from genomeloom.llm import chat, mixing, warc


def sources(rows):
    tokens = Counter()
    for _, text, _, source in rows:
        tokens[source] += len((text or "").split())
    return tokens


def test_every_document_is_used_in_whole_epochs(hard, hard_rows, empty):
    got = mixing.mix(hard, max_repeats=2.0).collect()
    tokens = sources(hard_rows)
    first = Counter((r["doc_id"], r["text"]) for r in got if r["epoch"] == 0)
    assert first == Counter((i, t) for i, t, *_ in hard_rows)
    used = defaultdict(list)
    for r in got:
        used[r["source"]].append(r)
    for source, rows in used.items():
        total = sum(r["n_tokens"] for r in rows)
        assert total <= 2.01 * tokens[source]
        spans = sorted((r["start_token"], r["n_tokens"]) for r in rows if r["n_tokens"])
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))  # gapless
        assert all(0 <= r["position"] < 1 or not r["n_tokens"] for r in rows)
    assert mixing.mix(empty).count() == 0
    assert all(r["slot"] == "mine" for r in got)


def test_exponent_meets_the_repetition_limit(llm):
    counted = llm.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "k string, n long")
    got = mixing.plan_mix(counted, "k", "n", max_repeats=3.0)
    want = 1 - math.log(3) / math.log(100)  # (n_min / n_max) ** (exponent - 1) = 3
    assert abs(got.exponent - want) < 1e-6
    plan = {r["key"]: r for r in got.sources.collect()}
    assert plan["a"]["budget"] == 1000 and plan["c"]["budget"] == 30
    assert abs(sum(r["weight"] for r in plan.values()) - 1) < 1e-9


def test_exponent_meets_the_entropy(llm):
    counted = llm.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "k string, n long")
    goal = 0.9
    got = mixing.plan_mix(counted, "k", "n", entropy=goal, max_repeats=None, budget=500.0)
    weights = [r["weight"] for r in got.sources.collect()]
    assert abs(-sum(w * math.log(w) for w in weights) - goal) < 1e-6
    assert abs(sum(r["budget"] for r in got.sources.collect()) - 500) <= 2


def test_budget_cuts_the_last_epoch(llm):
    rows = [(i, "w " * 10, "en", "a" if i % 2 else "b") for i in range(200)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, entropy=math.log(2) - 1e-9, budget=1555.0).collect()
    by = Counter()
    for r in got:
        by[r["source"]] += r["n_tokens"]
    assert by == {"a": 770, "b": 770}
    assert len({r["doc_id"] for r in got}) == len(got)


class Text(HTMLParser):
    """Visible text by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag in warc.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        if tag in warc.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_plain_text_equals_the_parser(llm):
    pages = llm.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for p in pages:
        parser = Text()
        parser.feed(p["html"])
        parser.close()
        want = [" ".join(x.split()) for x in "".join(parser.out).split("\n")]
        assert warc.plain_text(p["html"]).split("\n") == [x for x in want if x]


@pytest.mark.parametrize(
    "markup, text",
    [
        ("", ""),
        ("a < b &amp; c", "a < b & c"),
        ("<p title='1 > 0'>x</p><script>var t='</p>'", "x"),
        ('<p title="open>y</p>z', "y\nz"),
        ("<!-- <p>no</p> --><b>bo</b>ld", "bold"),
        ("<" * 50_000, "<" * 50_000),
    ],
)
def test_broken_markup(markup, text):
    assert warc.plain_text(markup) == text


def test_hidden_elements_keep_their_links_and_the_rest_of_the_page():
    page = (
        '<p>one</p><svg viewBox="0 0 1 1"/><p>two</p><script src=/a.js>var x = "<a href=/no>";</script>'
        '<noscript><img src="/b.png">off</noscript><template><a href="/c">t</a></template><!-- <a href=/d> -->'
        '<style>p { background: "<img src=/e>" }</style><svg><a href="/f">drawn</a></svg><p>three</p><noscript><p>four</p>'
    )
    assert warc.plain_text(page) == "one\ntwo\nthree\nfour"
    assert [x["url"] for x in warc.links(page, "http://h/")] == [f"http://h/{x}" for x in ("a.js", "b.png", "c", "f")]
    assert warc.plain_text("<p>a</p>" + "<svg>" * 20_000 + "<p>b</p>") == "a\nb"
    assert warc.plain_text("a<script>never closed <p>b</p>") == "a"


def test_records_refer_to_their_response(llm, tmp_path):
    rows = [
        (1, "http://e.x/a/", "<html><title>T &amp; t</title><a href='b?c=1&amp;d'>go</a><img src=/i.png>ü</html>"),
        (2, None, None),
        (3, "http://e.x/\r\nWARC-Evil: 1", ""),
        (None, "u", "<p>x"),
        (1, "http://e.x/a/", "other"),
        (4, "u", "same"),
        (4, "u", "same"),
    ]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as record_id", "2 as header")
    responses = warc.responses(pages)
    got = warc.derive(responses).collect()
    assert len(got) == 14
    known = {r["record_id"] for r in responses.collect()}
    assert len(known) == 6
    for r in got:
        data = r["block"].encode()
        assert r["refers_to"] in known and r["content_length"] == len(data)
        assert r["block_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert f"WARC-Refers-To: {r['refers_to']}" in r["header"].split("\r\n")
        assert not any(line.startswith("WARC-Evil") for line in r["header"].split("\r\n"))
    first = next(r for r in got if r["page_id"] == 1 and r["record_type"] == "metadata" and "T & t" in r["block"])
    http = json.loads(first["block"])["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert http["HTML-Metadata"]["Title"] == "T & t"
    assert [x["url"] for x in http["HTML-Metadata"]["Links"]] == ["http://e.x/a/b?c=1&d", "http://e.x/i.png"]
    assert ["Content-Type", "text/html; charset=utf-8"] in http["Headers"]
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
    # Files: every record can be cut out again by its length.
    warc.write_warc(warc.derive(responses), str(tmp_path / "w"), "none")
    seen = 0
    for file in (tmp_path / "w").glob("part-*"):
        rest = file.read_bytes()
        while rest:
            head, rest = rest.split(b"\r\n\r\n", 1)
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b":")[1])
            assert rest[size : size + 4] == b"\r\n\r\n"
            rest = rest[size + 4 :]
            seen += 1
    assert seen == 14


def test_other_heads_and_charsets():
    block = b"HTTP/1.1 404 Not Found\r\ncontent-type: text/html; charset=latin-1\r\nX: a:b\r\n\r\n\xe9"
    assert warc.parse_http(block)[1][1] == ("X", "a:b")
    assert warc.derive_one("<x>", None, "d", block)[1]["block"] == "é"
    assert warc.derive_one("<x>", None, "d", b"no head")[1]["block"] == "no head"


CALLS = "conv long, call_id string, turn long, name string, arguments string, after string, json string"
RESULTS = "conv long, call_id string, turn long, content string"


def test_calls_and_results(llm):
    ok = '{"query":"q","limit":3}'
    calls = [
        (1, "a", 5, "search", ok, "b", "x"),  # comes after a later call
        (1, "b", 7, "search", '{"limit": 1e2, "query": "z\\u00e9"}', None, "x"),
        (1, "c", 9, "search", '{"limit":0}', "zz", "x"),
        (1, "d", 1, "nope", "{", None, "x"),
        (1, "e", 2, "translate", '{"text":"t","text":"u","target":"de"}', None, "x"),
        (2, "a", 1, "count", '{"words":["a",1],"ratio":2}', "b", "x"),
        (2, "b", 2, "count", '{"words":[]}', "a", "x"),  # a circle
        (2, "k", 3, None, None, None, "x"),
        (3, "a", 1, "search", ok, None, "x"),
        (3, "a", 2, "search", ok, None, "x"),  # identifier again
        (None, "a", 1, "search", ok, None, "x"),
        (4, None, 1, "search", ok, None, "x"),
    ]
    results = [(1, "a", 6, "r"), (1, "b", 8, None), (3, "a", 3, "late"), (3, "a", 2, "soon"), (5, "x", 1, "alone"), (None, None, None, None)]
    got = chat.link_calls(llm.createDataFrame(calls, CALLS), llm.createDataFrame(results, RESULTS)).collect()
    by = {(r["conv"], r["call_id"]): r for r in got if r["position"] is not None}
    assert len(got) == 9 + 1 + 3
    one = sorted((r["position"], r["call_id"]) for (c, _), r in by.items() if c == 1)
    assert [x for _, x in one] == ["d", "e", "b", "c", "a"] and [p for p, _ in one] == [0, 1, 2, 3, 4]
    assert by[1, "a"]["depth"] == 1 and by[1, "a"]["valid"] and by[1, "a"]["status"] == "answered"
    assert by[1, "b"]["json"] == '{"arguments":{"limit":100,"query":"zé"},"call_id":"b","name":"search","result":null,"status":"answered"}'
    assert by[1, "c"]["problems"] == ["$.query: missing", "$.limit: below 1", "unknown predecessor"]
    assert by[1, "d"]["problems"] == ["$: not JSON", "unknown tool"]
    assert by[1, "e"]["problems"] == ["$: not JSON"]
    assert by[2, "a"]["problems"] == ["$.words[1]: not string", "$.ratio: above 1", "circular predecessor"]
    assert by[2, "b"]["depth"] is None and not by[2, "b"]["valid"]
    assert by[3, "a"]["repeats"] == 2 and by[3, "a"]["result_turn"] == 2
    assert by[5, "x"]["status"] == "orphan"
    for r in got:
        json.loads(r["json"])


def test_long_chains_get_their_depth(llm):
    n = 300
    calls = [(1, f"c{i:04d}", n - i, "search", "{}", f"c{i - 1:04d}" if i else None) for i in range(n)]
    df = llm.createDataFrame(calls, "conv long, call_id string, turn long, name string, arguments string, after string")
    got = chat.depths(df.select("conv", "call_id", "after")).collect()
    assert {r["call_id"]: r["depth"] for r in got} == {f"c{i:04d}": i for i in range(n)}


def test_empty_conversations(llm):
    turns = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.op5_linked_tool_calls(turns).count() == 0


def test_turns_with_nulls(llm):
    rows = [(1, 0, "user", None), (1, 1, "assistant", None), (None, 0, "user", "a"), (1, None, "user", "b"), (2, 0, None, "x"), (3, 1, "assistant", "y")]
    turns = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.op5_linked_tool_calls(turns).collect()
    assert Counter(r["status"] for r in got) == {"answered": 1, "orphan": 3, "message": 1}


def test_every_turn_is_accounted_for(llm):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "tool", None), (1, 3, "tool", None),
        (2, 0, "system", "alone"), (3, 0, None, "x"), (None, 0, "system", "y"), (3, None, "system", "z"), (4, 1, "assistant", "o"),
        (5, 1, "user", "p"), (5, 3, "user", "q"), (5, 4, "system", "r"), (5, 5, "user", "s"),
    ]
    turns = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.op5_linked_tool_calls(turns).collect()
    assert sum(1 + r["repeats"] + (r["status"] == "answered") for r in got) == len(rows)
    messages = [r for r in got if r["status"] == "message"]
    bodies = Counter((r["conv_id"], r["turn"], *(json.loads(r["json"])[k] for k in ("role", "content"))) for r in messages)
    assert bodies == Counter(r for r in rows if r[2] not in ("user", "assistant"))
    one = sorted((r["position"], r["status"]) for r in got if r["conv_id"] == 1)
    assert one == [(0, "message"), (1, "answered"), (2, "message"), (3, "message")]
    assert [r["position"] for r in messages if r["conv_id"] == 2] == [0]
    assert [r["turn"] for r in sorted((r for r in got if r["conv_id"] == 5), key=lambda r: r["position"])] == [1, 3, 4, 5]
    assert all(r["position"] is None for r in messages if r["conv_id"] is None or r["turn"] is None)


@pytest.mark.parametrize(
    "value, text",
    [
        (0.0, "0"), (-0.0, "0"), (1e2, "100"), (1.5, "1.5"), (1e20, "100000000000000000000"), (1e21, "1e+21"),
        (0.000001, "0.000001"), (1e-7, "1e-7"), (123456789.125, "123456789.125"), (-2.5e-9, "-2.5e-9"),
        (5e-324, "5e-324"), (10, "10"), (True, "true"), (None, "null"), ("€$\u000f\n\"\\", '"€$\\u000f\\n\\"\\\\"'),
        ({"\U0001f600": 1, "דּ": 2, "a": [1, {"b": {}}]}, '{"a":[1,{"b":{}}],"\U0001f600":1,"דּ":2}'),
    ],
)
def test_canonical_json(value, text):
    assert chat.canonical(value) == text
