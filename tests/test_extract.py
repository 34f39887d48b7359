import json

import pytest

from newscorpus.operators.extract import extract_body, html_text
from newscorpus.operators.rules import SITE_RULES, Rule, Selector, flat_article_rule

BY_SITE = {}
for _r in SITE_RULES:
    BY_SITE.setdefault(_r.source_name, []).append(_r)


def page(rule: Rule) -> str:
    """A page with this rule's containers around two headings and three paragraphs."""
    inner = (
        "<h2>Head</h2><h3>Sub</h3><p>one <b>two</b>&amp;</p><script>var x='</p>';</script>"
        "<p>three<p> four </p>"
    )
    if rule.kind == "json_html":
        # a script element ends at the first end tag, also inside its JSON
        inner = inner.replace("<script>var x='</p>';</script>", "")
        body = json.dumps({"props": {"pageProps": {"articleShowData": {"body": inner}}}})
        return f'<html><script id="__NEXT_DATA__" type="application/json">{body}</script></html>'
    if rule.kind == "json_text":
        body = json.dumps({"@graph": [{"articleBody": "one two&"}]})
        return f'<html><script type="application/ld+json">{body}</script></html>'
    opens = closes = ""
    for s in rule.path:
        value = s.value + "-x" if s.op == "starts" else s.value
        opens += f'<{s.tag} {s.attr}="{value}">'
        closes = f"</{s.tag}>" + closes
    out = "<p>outside</p>" if rule.path else ""
    return f"<html><body>{out}{opens}{inner}{closes}<div>after</div></body></html>"


EXPECTED = {
    "Forbes": "Head one two& three  four ",
    "Android Central": "Head one two& three  four ",
    "Gizmodo.com": "Sub one two& three  four ",
    "BBC News": "one two&",
    "Euronews": "one two&",
    "ReadWrite": "one two& three",
    "ETF Daily News": "one two& three",
    "The Verge": "Head Sub one two & three four",
    "The Times of India": "HeadSubone two&three four ",
}


def test_every_site_has_its_rule(spark):
    assert len(BY_SITE) == 29
    rows = [(site, page(rules[0])) for site, rules in BY_SITE.items()]
    got = {
        r["source_name"]: r["full_content"]
        for r in extract_body(spark.createDataFrame(rows, "source_name string, html string")).collect()
    }
    for site in BY_SITE:
        assert got[site] == EXPECTED.get(site, "one two& three four"), site


def test_missing_container_unknown_site_and_broken_input(spark):
    rows = [(site, "<html><body><div>nothing</div></body></html>") for site in BY_SITE]
    rows += [("Nowhere", page(BY_SITE["CNN"][0])), (None, "<p>x</p>"), ("CNN", None), ("Euronews", "<script type=\"application/ld+json\">{oops</script>")]
    df = extract_body(spark.createDataFrame(rows, "source_name string, html string"))
    assert all(r["full_content"] is None for r in df.collect())


def test_fallback_rule(spark):
    html = page(BY_SITE["The Times of India"][1])
    df = spark.createDataFrame([("The Times of India", html)], "source_name string, html string")
    text = extract_body(df).first()["full_content"]
    assert text.split() == "Head Sub one two & three four".split()


def test_marker_cuts_the_text():
    rule = BY_SITE["Phys.Org"][0]
    html = page(rule).replace("three", "three More information: here")
    assert html_text(html, rule) == "one two& three"


def test_strict_strip_joins_nodes_without_space():
    rule = BY_SITE["CNN"][0]
    html = '<div class="article__content"><p>a <b>b</b></p><p></p><p>c</p></div>'
    assert html_text(html, rule) == "a b c"
    assert html_text(html, rule, strict_strip=True) == "ab  c"


def test_class_token_and_nested_containers():
    rule = BY_SITE["CNN"][0]
    html = (
        '<div class="x article__content y"><div><p>in</p></div><p>more</p></div>'
        '<div class="article__content"><p>second container</p></div>'
    )
    assert html_text(html, rule) == "in more"
    two = BY_SITE["Globalsecurity.org"][0]
    assert html_text('<div id="main"><p>x</p></div><div id="main"><div id="content"><p>y</p></div></div>', two) is None


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><p>a<p>b</p> loose <p class='k'>c<br>d</p></article><p>no</p>", "a b cd"),
        ("<article>no paragraph</article>", None),
        ("<article><p> </p></article>", None),
        ("<p>x</p>", None),
        ("<article data-k='1'><p>q&quot;&lt;i&gt;&amp;amp;</p></article>", 'q"<i>&amp;'),
    ],
)
def test_flat_rule_equals_the_tag_stack(spark, html, text):
    df = spark.createDataFrame([("s", html)], "source_name string, html string")
    assert extract_body(df, [flat_article_rule("s")]).first()["full_content"] == text
    stack = Rule("s", path=(Selector("article"),))
    assert extract_body(df, [stack]).first()["full_content"] == text


def test_flat_form_equals_tag_reader_on_odd_markup(spark):
    pages = [
        "<ARTICLE><P>a &amp; b</P><p>c</ARTICLE>",
        "<article><p>a<script>var t = '</p><p>x';</script> b</p><style>p{}</style><!-- <p>no</p> --></article>",
        "<Article class=x><p class=y>a <b>b</b><P>c</p></article>",
        "<article><template><p>t</p></template></article>",
    ]
    df = spark.createDataFrame([(i, "s", p) for i, p in enumerate(pages)], "k int, source_name string, html string")
    flat = {r["k"]: r["full_content"] for r in extract_body(df, [flat_article_rule("s")]).collect()}
    read = {r["k"]: r["full_content"] for r in extract_body(df, [Rule("s", path=(Selector("article"),))]).collect()}
    assert flat == read == {0: "a & b c", 1: "a b", 2: "a b c", 3: None}
