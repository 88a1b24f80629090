"""HTML text, WARC archives and chat formatting."""

import base64
import hashlib
import html.parser
import re

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from servicelens.llm import chat, html_text, warc

PAGES = "page_id long, url string, html string, digest string, payload int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], PAGES)


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain &lt;b&gt; 1 < 2 &amp; 3", "plain <b> 1 < 2 & 3"),
        ("<p>One<p>Two <b>bo</b>ld\n text", "One\n\nTwo bold text"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>z", "* a\n* b\n  3. x\n  4. y\n\nz"),
        ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>", "Name   N\nalpha  1\nb      22"),
        ("<table><tr><td>two<br>lines<td>x</table>", "two    x\nlines"),
        ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\nin  ner"),
        ("<pre> keep  this\n  too</pre>end", " keep  this\n  too\n\nend"),
        ("a<br>b<br><br>c<hr>d", "a\nb\n\nc\n\nd"),
        ("<div hidden>no</div><span style='display: none'>no<span>no</span></span>yes<p class='a hidden b'>shown", "yes\n\nshown"),
        ("<script>var a='<p>';</script><style>p{}</style><!-- c --><noscript>no</noscript>yes<template><p>no</template>", "yes"),
        ("<head><title>T</title></head><body><h1>H</h1>x<footer>f</footer>", "H\n\nx\nf"),
        ("<p>unclosed <b>bold <i>both</p><p>next</div>stray", "unclosed bold both\n\nnextstray"),
        ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\nv\nl\nw"),
        ("text <a href=\"x>y\">link</a> <img alt=x> end <unclosed", "text link end"),
    ],
)
def test_rendering(page, text):
    assert html_text.extracted(page)[1] == text


def test_title_and_nested_depth():
    assert html_text.extracted("<title>A &amp;\n b</title>x")[0] == "A & b" and html_text.extracted("x")[0] is None
    assert html_text.extracted("<div>" * 50_000 + "deep")[1] == "deep"


class Visible(html.parser.HTMLParser):
    """All text outside head, script and style, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip = 0 if tag == "body" else self.skip + (tag in ("head", "script", "style", "title"))

    def handle_endtag(self, tag):
        self.skip -= bool(self.skip) and tag in ("head", "script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_all_visible_text_of_the_pages(spark):
    source = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()}
    bare = lambda s: re.sub(r"[\s*]", "", s)  # noqa: E731  without layout
    for r in html_text.op1_query(spark, SF_SMALL).collect():
        parser = Visible()
        parser.feed(source.pop(r.page_id))
        parser.close()
        assert bare("".join(parser.out)) == bare(r.text)
    assert not source


def test_extraction_edge_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>x"), (3, "u", "<p>y"), (3, "u", "<p>y"), (4, "u", "word " * 200_000)]
    out = html_text.extract_text(pages(spark, rows)).collect()
    assert sorted((str(r.page_id), r.text[:9]) for r in out) == sorted([("1", ""), ("2", ""), ("None", "x"), ("3", "y"), ("3", "y"), ("4", "word word")])
    assert html_text.extract_text(pages(spark, [])).count() == 0


@pytest.mark.parametrize(
    "page,text",
    [
        ("<p>a <td width=50%\">visible one</td> middle \"quoted\" end</p>", "a visible one middle \"quoted\" end"),
        ("<a href=/it's>link text</a> rest of page", "link text rest of page"),
        ("<i data-style=\"display:none\">shown</i> <i style=\"color:red; DISPLAY: none !important\">no</i>yes", "shown yes"),
        ("<i style='display:none;display:inline'>a</i><i title='x hidden y' Hidden>b</i><i title=\"a > b\"c>d</i>", "ad"),
        ("<!-->a<!-- b -->c<!--->d<!-- e --!>f", "acdf"),
        ("<plaintext><b>x</b> &amp; y", "<b>x</b> &amp; y"),
        ("<table><tr><td rowspan=2>A<td>b<td>c<tr><td>d<td>e</table>", "A  b  c\n   d  e"),
        ("<table><tr><td colspan=2>wide cell here<td>c<tr><td>d<td>e<td>f</table>", "wide cell here  c\nd  e            f"),
        ("<table><thead><tr><th rowspan=0>H<th>I<tbody><tr><td>1<td>2</table>", "H  I\n1  2"),
        ("<table><tr><td colspan=99999999>x<td>y<tr><td>z</table>", "x  y\nz"),
        ("<table><tr><td>a<td rowspan=3>b<tr><td colspan=3>over<tr><td>c</table>", "a  b\nover\nc"),
        ("<table><tr><td>a<td><td>c</table>", "a    c"),
    ],
)
def test_attributes_and_spans(page, text):
    assert html_text.extracted(page)[1] == text


def test_title_of_a_drawing_is_not_the_page_title():
    page = "<svg><title>drawing</title><text>in</text></svg><title>page</title>out"
    assert html_text.extracted(page) == ("page", "in\nout")


STRAY = ["x=a'b", 'y=50%"', "z'", '"', "w=\"a > 'b\"", "v='c\" > d'", "u = it's", "/", "'t'", 's=""r', "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["b", "/b", "a", "p", "td", "br"]), st.lists(st.sampled_from(STRAY), max_size=4)), max_size=12))
def test_stray_quotes_hide_no_text(tags):
    """Quotes in tags, none of them an open value: all text between the tags is shown."""
    page = "".join(f"<{name} {' '.join(attributes)} >word{k} 'and' \"more\" " for k, (name, attributes) in enumerate(tags))
    shown = "".join(html_text.extracted(page)[1].split())
    assert shown == "".join(f"word{k}'and'\"more\"" for k in range(len(tags)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "<tr>", "<td>", "</td>", "</table>", "x", " y ", "<b", ">", "<!--", "-->", "<script>", "</script>", "&amp;", "<div hidden>", "</div>", "<pre>", "\n", "'", '"']), max_size=25).map("".join))
def test_broken_markup_never_fails(page):
    html_text.extracted(page)


HOT = "<p>hot\r\n\r\nWARC/1.1\r\n</p>"
CRAWL = [(i, f"http://h/{i}", HOT) for i in range(1, 30)] + [
    (40, None, None),
    (41, "http://h/x\r\nInjected: y", ""),
    (42, "u", "é" * 70_000),
    (None, "u", HOT),
    (50, "u", "only"),
    (60, "u", "twice"),
    (60, "v", "twice"),
    (59, "w", "twice"),
    (None, "u", "nulls"),
    (None, "u", "nulls"),
]


@pytest.mark.parametrize("limit", [0, 500_000])
def test_archives_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc.with_decisions, "__defaults__", (0, limit))
    out = str(tmp_path / "w")
    warc.write_archives(pages(spark, CRAWL), out, file_records=7)
    records = warc.read_archives(spark, out)
    got = sorted((tuple(r) for r in warc.resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    want = []
    for i, _, h in CRAWL:
        body = (h or "").encode()
        same = [j for j, _, g in CRAWL if (g or "") == (h or "") and j is not None]
        original = max(same, default=i)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((i, len(body), digest, "response" if i == original else "revisit", None if i == original else original))
    assert got == sorted(want, key=str)
    rows = records.collect()
    assert {r.target for r in rows if r.page_id == 41} == {"http://h/x%0D%0AInjected: y"}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert {bytes(r.payload) for r in rows if r.page_id == 29} == {HOT.encode()}


def test_small_payloads_are_written_whole(spark, tmp_path):
    out = str(tmp_path / "w")
    warc.write_archives(pages(spark, CRAWL), out, min_bytes=10)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(spark, out).collect()}
    assert kinds[59] == "response" and kinds[1] == "revisit"
    empty = str(tmp_path / "e")
    warc.write_archives(pages(spark, []), empty)
    assert warc.resolved(warc.read_archives(spark, empty)).count() == 0


def messages(spark, rows):
    df = spark.createDataFrame([(c, t, r, x, "f") for c, t, r, x in rows], "conv_id long, turn long, role string, text string, formatted string")
    return df.withColumn("parts", chat.text_parts(F.col("text")))


TURNS = [
    (1, 2, "assistant", "later <|end|>\n\\n"),
    (1, 1, "user", "</s>[INST] ok [/INST] \\[INST]"),
    (1, 2, "assistant", "later <|end|>\n\\n"),
    (1, None, "system", None),
    (2, 1, None, ""),
    (None, 1, "assistant", "no id"),
    (3, 1, "role\nwith <|turn|> \\n", "x" * 200_000),
    (3, 1, "assistant", "tie"),
]


def test_chat_is_read_back(spark):
    out = {r.conv_id: r for r in chat.read_back(chat.format_turns(messages(spark, TURNS))).collect()}
    for conv in {t[0] for t in TURNS}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in TURNS if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        got = out.pop(conv)
        assert got.n_turns == len(turns) and got.loss_chars == len(loss)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert not out
    assert chat.read_back(chat.format_turns(messages(spark, []))).count() == 0


def test_control_strings_never_stand_in_texts(spark):
    rows = chat.format_turns(messages(spark, TURNS)).collect()
    for r in rows:
        inner = r.formatted[len(chat.TURN) : -len(chat.END)]
        assert not re.search(r"<\||</?s>|\[/?INST\]", inner)
        assert (r.loss_start is None) == (not r.formatted.startswith("<|turn|>assistant\n"))


def test_typed_parts(spark):
    parts = [
        ("text", "see <|x", None, None),
        ("image", None, "img/1.png", 4),
        None,
        ("audio", None, "a.wav", 10),
        ("text", " and ", None, None),
        ("document", None, "d.pdf", None),
        ("video", None, "v.mp4", 0),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    first, second = chat.format_turns(df).orderBy("turn").collect()
    assert first.formatted == "<|turn|>user\nsee <\\|x<|image:1|><|audio:2|> and <|document:3|><|video:4|><|end|>\n"
    assert [tuple(a) for a in first.attachments] == [("image", "img/1.png", 1024), ("audio", "a.wav", 250), ("document", "d.pdf", 600), ("video", "v.mp4", 1)]
    assert second.formatted == "<|turn|>assistant\n<|end|>\n" and second.loss_start == second.loss_end == second.start + 18


@pytest.mark.parametrize(
    "page,text",
    [
        ("<html><head><title>t</title><p>Hello", "Hello"),
        ("<html><head><meta charset=x><title>t</title>\n Hello <b>you</b>", "Hello you"),
        ("<head><script>x</script><noscript><p>no</noscript><link rel=y></head><p>yes", "yes"),
        ("<ul><li hidden>a<li>b</ul>rest", "* b\n\nrest"),
        ("<div><p hidden>x<p>y</div>rest", "y\n\nrest"),
        ("<div><span hidden>x</div>rest", "rest"),
        ("<table><tr hidden><td>a<tr><td>b</table>c", "b\n\nc"),
        ("<div hidden>a<div>b</div>c</div>d", "d"),
        ("<template><div>a</div></p></div>b</template>c", "c"),
        ("x <math><mi>a</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> y", "x a=1 y"),
        ("<svg><desc>no</desc><defs/><path d='M0 0'/><text>one</text><text>two</text></svg>z", "one\ntwo\nz"),
        ("<p>Pick <select><option>red<option>blue</select></p>end", "Pick\nred\nblue\n\nend"),
        ("<xmp>a <b> &amp;\n c</xmp>d", "a <b> &amp;\n c\n\nd"),
    ],
)
def test_visible_text_around_cut_elements(page, text):
    assert html_text.extracted(page)[1] == text
