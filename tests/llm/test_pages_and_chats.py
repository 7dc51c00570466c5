import gzip
import html
import random
import re
import time
from hashlib import sha1

import numpy as np
import pytest

from compare import connect, difference
from tidemark.llm import boosting, dom, html_extraction, queries, tool_calls, warc

from .conftest import SMALL

PAGES = [
    (1, "http://a/1", "x" * 999),
    (2, "http://a/2", "x" * 999),
    (3, None, "y" * 1_000),
    (4, "http://a/4\r\nX-Evil: 1", "y" * 1_000),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (None, None, "y" * 1_000),
    (7, "http://a/7", "é" * 500),
    (8, "http://a/8", "é" * 500),
    (8, "http://a/8", "é" * 500),
    (9, "http://a/9", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40),
    (10, "http://a/10", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40),
]
SCHEMA = "page_id long, url string, html string"


def test_warc_query_agrees_with_sql(llm_spark):
    assert difference(llm_spark, connect(SMALL), SMALL, "op8_warc_transactions") is None


def test_warc_of_awkward_pages(llm_spark):
    pages = llm_spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "'k' as capture", "'d' as digest", "1 as again")
    got = sorted((tuple(r) for r in queries.op8(pages).collect()), key=str)
    want = []
    for key, _, text in PAGES:
        data = (text or "").encode()
        same = [k for k, _, t in PAGES if (t or "").encode() == data and k is not None]
        again = len(data) >= 1_000 and key != max(same)
        want.append((key, len(data), sha1(data).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    assert got == sorted(want, key=str)
    assert queries.op8(pages.limit(0)).count() == 0


def test_archives_hold_whole_captures(llm_spark):
    pages = llm_spark.createDataFrame(PAGES, SCHEMA)
    records = warc.read_records(llm_spark, warc.write_captures(pages))
    rows = warc.assemble(records).collect()
    assert len(rows) == len(PAGES)
    assert all(r.request.type == "request" and r.metadata.type == "metadata" for r in rows)
    kept = sorted((r.response.payload.decode() for r in rows if r.response.type == "response"))
    assert len(kept) == 8 and "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40 in kept
    assert not any("Evil" in (r.response.head.decode()) for r in rows)


def test_compressed_archives_and_odd_headers():
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody"
    record = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID:<a>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    for data in (record * 2, gzip.compress(record) * 2):
        rows = list(warc.parsed(data))
        assert [(r["type"], r["record_id"], r["payload"]) for r in rows] == [("response", "<a>", b"body")] * 2


def article_text(source):
    """The article of a test page, by its template."""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1].replace("<br>", " ")
    blocks = (html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(" ".join(b.split()) for b in blocks if b.strip())


def test_main_text_of_pages(llm_spark, pages):
    rows = {r.page_id: r for r in queries.QUERIES["op10_html_extraction"](llm_spark, SMALL).collect()}
    assert len(rows) == len(pages)
    right = sum(rows[k].text == article_text(source) for k, _, source in pages)
    assert right >= 0.95 * len(pages)
    assert all(r.n_chars == len(r.text) for r in rows.values())


def test_main_text_in_layouts_not_trained_on(pages):
    trees = html_extraction.fit_trees([source for _, _, source in pages], html_extraction.Settings())
    rng = random.Random(11)
    texts = [article_text(source).split("\n") for _, _, source in pages]
    found = missed = wrong = 0
    for main in texts:
        page = dom.parse(html_extraction.layout(main, [t for m in texts for t in m[:2]], rng))
        kept = html_extraction.kept_nodes(page, trees.score(dom.features([page])).tolist())
        for node, _, _ in page.blocks:
            found += kept[node] and bool(page.marked[node])
            wrong += kept[node] and not page.marked[node]
            missed += (not kept[node]) and bool(page.marked[node])
    assert missed <= 0.05 * found and wrong <= 0.05 * found


def test_decoding_takes_the_best_consistent_choice():
    rng = random.Random(5)
    for _ in range(100):
        size = rng.randint(1, 9)
        page = dom.Page(tag=[0] * size, parent=[-1, *(rng.randrange(k) for k in range(1, size))])
        scores = [rng.uniform(-3, 3) for _ in range(size)]

        def worth(chosen):
            return sum(s for s, c in zip(scores, chosen) if c)

        choices = [[bits >> k & 1 for k in range(size)] for bits in range(1 << size)]
        best = max(worth(c) for c in choices if all(not c[k] or c[page.parent[k]] for k in range(1, size)))
        kept = html_extraction.kept_nodes(page, list(scores))
        assert all(not kept[k] or kept[page.parent[k]] for k in range(1, size))
        assert abs(worth(kept) - best) < 1e-9


def test_parsing_of_broken_html():
    page = dom.parse("<p>a &amp; b<p>c&nbsp;d <b>e<br>f</b><script>if (1 < 2) '</p>'</script><li>x<li>y<!-- <p>no</p> --><p title='>'>z")
    assert [t for _, t, _ in page.blocks] == ["a & b", "c d e f", "x", "y", "z"]
    assert dom.parse("").blocks == [] and dom.parse("<" * 2_000).blocks != None  # noqa: E711
    assert [t for _, t, _ in dom.parse("<div>one<p>two</p>three</div>").blocks] == ["one", "two", "three"]


def texts(source):
    return [t for _, t, _ in dom.parse(source).blocks]


def test_tags_without_an_end():
    texts = lambda source: [t for _, t, _ in dom.parse(source).blocks]
    assert texts("<p>if x<y' then it's</p><p>b</p>") == ["if x<y' then it's", "b"]
    assert texts("<p>if x<y 'a>b' then</p><p>b</p>") == ["if x", "b"]  # a tag up to the > outside quotes
    assert texts("<p>one<b class=\"two</p><p>three<i>four</i></p>") == ['one<b class="two', "threefour"]
    assert texts("<p title='a>b'>c</p \"x>d<p>e <") == ["c", "d", "e <"]
    assert texts("a<!-- <p>b</p>") == ["a"] and texts("a<!b<p>c") == ["ac"] and texts("a<!b") == ["a<!b"]


@pytest.mark.parametrize("unit", ["<a'", "x<y' ", '<a "', "<a b='c' \"", "<!--", "<", "<a", "<!", '</a "', "<svg ", "<div>", "</x>", "<header>"])
def test_time_follows_the_length(unit):
    def seconds(size):
        source = "<div>" * (size // 64) + "<svg></svg>" + unit * (size // len(unit))
        start = time.process_time()
        dom.parse(source)
        return time.process_time() - start

    one, two, four = (min(seconds(n << 17) for _ in range(2)) for n in (1, 2, 4))
    assert two < 3.5 * one + 0.1 and four < 7 * one + 0.2  # four and sixteen times, were it quadratic


def test_unclosed_silent_elements_end_with_their_block():
    article = "<article><p>one</p><p>two</p></article>"
    for start in ("<label>", "<button>", "<select><option>a<option>b", "<svg><path d=x>", "<video src=x>", "<textarea>", "<iframe src=x>", "<noscript>", "<canvas>"):
        for page in (f"<div><form>{start}</form></div>{article}", f"<nav>{start}</nav>{article}", f"<body>{start}{article}</body>", f"<body>{start}{article}<p><button>x</button><svg></svg></p>"):
            assert texts(page)[-2:] == ["one", "two"]
    assert texts(f"<div><template><p>no</div>{article}") == ["one", "two"]
    assert texts(f"<head><title>t</head><body>{article}") == ["one", "two"]
    for inside in ("<title/>", "<style/>", "<title>t", "<g/><path/>"):
        assert texts(f"<div><svg>{inside}</svg>more</div>{article}") == ["more", "one", "two"]
        assert texts(f"<div><svg>{inside}</svg></div>{article}<svg><title>t</title></svg>") == ["one", "two"]
    assert texts(f"<ul><li><button>a<li><button>b</button></ul>{article}")[-2:] == ["one", "two"]


def test_closed_silent_elements_hold_no_text():
    inside = "<div>no<p>no</div>no<p>no"
    for tag in ("template", "object", "video", "canvas", "button"):
        assert texts(f"<div>a <{tag}>{inside}</{tag}> b<p>c</p></div>") == ["a b", "c"]
    assert texts("<p>a <template><article>no</article></template><svg><style>p > q</style><text>no</text></svg>b</p>") == ["a b"]
    assert texts("<p>a <select><option>no<option>no</select>b <textarea>no</p></textarea>c</p>") == ["a b c"]
    assert texts("<p>a<script>'<p>no'") == ["a"]


def test_labels_and_formulas_are_text():
    assert texts("<p><label>name</label> is <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> here</p>") == ["name is x=1 here"]


def test_extraction_of_awkward_pages(llm_spark):
    body = "<html><body><nav><a href=/>menu</a></nav><article><h1>T</h1><p>Some words, and more of them.</p></article></body></html>"
    rows = [(1, None, None), (2, "u", ""), (None, "u", body), (3, "u", body), (3, "u", body), (4, "u", "<p>" + "word " * 50_000)]
    df = llm_spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'t' as text", "'s' as spread")
    got = {(r.page_id, r.url): r for r in queries.op10(df).collect()}
    assert got[(1, None)].text == "" and got[(2, "u")].text == ""
    assert queries.op10(df).count() == len(rows)
    assert queries.op10(df.limit(0)).count() == 0
    assert queries.op10(df.where("page_id = 4")).count() == 1  # no page that names its main text


def test_trees_are_fitted_on_different_pages_that_name_their_text(llm_spark, monkeypatch):
    def record(sources, settings):
        return sources

    monkeypatch.setattr(html_extraction, "fit_trees", record)
    plain = [(f"<div><p>no main text {k}</p></div>",) for k in range(40)]
    empty = [(f"<main></main><p>shell {k}</p><!-- <article>no</article> --><script>'<main>{k}'</script>",) for k in range(40)]
    copies = [("<body><article><p>copy</p></article></body>",)] * 40
    named = [(f"<body><MAIN class=x><p>named {k}</p></MAIN></body>",) for k in range(4)]
    df = llm_spark.createDataFrame([*plain, *empty, *copies, *named, (None,)], "html string")
    for pages in (5, 3):
        seen = html_extraction.fit(df, html_extraction.Settings(pages=pages))
        assert len(seen) == len(set(seen)) == pages and set(seen) <= {*(h for h, in named), copies[0][0]}
    assert html_extraction.fit(df.where("html like '<div>%'")) in (None, [])


def test_boosting_separates_classes():
    rng = np.random.default_rng(6)
    rows = rng.random((2_000, 4)).astype(np.float32)
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 2] > 0.3)).astype(float)
    trees = boosting.fit(rows[:1_500], labels[:1_500])
    assert ((trees.score(rows[1_500:]) > 0) == labels[1_500:]).mean() > 0.95


def test_tool_calls_agree_with_sql(llm_spark):
    assert difference(llm_spark, connect(SMALL), SMALL, "op9_tool_calls") is None


CALLS = "conv string, call_id string, position long, name string, arguments string, after array<string>"
RESULTS = "conv string, call_id string, position long, content string"
SCHEMAS = {"sum": {"properties": {"a": "integer", "b": "number", "tags": "array"}, "required": ("a",)}}


def test_links_order_and_validation(llm_spark):
    calls = [
        ("c", "1", 5, "sum", '{"b": 1.5, "a": 2}', ["2"]),  # waits for a later one
        ("c", "2", 6, "sum", '{"a": "x"}', ["3"]),
        ("c", "3", 7, "sum", "[1]", []),
        ("c", "4", 8, "sum", '{"a": 1, "z": 0}', ["5"]),  # a cycle
        ("c", "5", 9, "other", "{}", ["4"]),
        ("d", "1", 1, "sum", '{"a": 1}', ["nowhere"]),
        ("d", "1", 3, "sum", '{"a": 1}', []),  # the id again
        ("d", "1", 1, "sum", '{"a": 1}', ["nowhere"]),  # the row again
        (None, "1", 1, "sum", None, None),
        ("e", None, None, None, None, None),
    ]
    results = [("c", "1", 9, "é\n"), ("d", "1", 2, "r"), ("d", "1", 4, "s"), ("d", "9", 4, None), (None, "1", 1, "t"), (None, None, None, None)]
    rows = tool_calls.linked(llm_spark.createDataFrame(calls, CALLS), llm_spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    by = {(r.conv, r.call_id, r.status, r.result_position): r for r in rows}
    assert len(rows) == len(by) == 13
    stages = {r.call_id: r.stage for r in rows if r.conv == "c"}
    assert stages == {"3": 0, "2": 1, "1": 2, "4": None, "5": None}
    assert by[("c", "1", "linked", 9)].json == '{"arguments":{"a":2,"b":1.5},"id":"1","name":"sum","result":"é\\n"}'
    assert by[("c", "1", "linked", 9)].errors == ""
    assert by[("c", "2", "unanswered", None)].errors == "a: no integer"
    assert by[("c", "3", "unanswered", None)].errors == "arguments: no object"
    assert by[("c", "4", "unanswered", None)].errors == "z: unknown"
    assert by[("c", "5", "unanswered", None)].errors == "tool: unknown"
    assert by[("d", "1", "linked", 2)].copies == 1 and by[("d", "1", "linked", 4)].position == 1
    assert by[("d", "1", "duplicate", None)].position == 3
    assert by[("d", "9", "orphan", 4)].name is None
    assert by[(None, "1", "orphan", 1)] and by[(None, "1", "unanswered", None)] and by[("e", None, "unanswered", None)]
    assert by[(None, None, "orphan", None)].json == '{"arguments":null,"id":null,"name":null,"result":null}'
    none = tool_calls.linked(llm_spark.createDataFrame([], CALLS), llm_spark.createDataFrame([], RESULTS), SCHEMAS)
    assert none.count() == 0


def test_canonical_json(llm_spark):
    rows = [('{"b" : 1, "a": [1, {"d": null, "c": "x"}]}',), ("nonsense",), (None,)]
    got = [r[0] for r in llm_spark.createDataFrame(rows, "j string").select(tool_calls.canonical("j")).collect()]
    assert got == ['{"a":[1,{"c":"x","d":null}],"b":1}', None, None]
