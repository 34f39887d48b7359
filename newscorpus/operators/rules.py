"""Where each news site keeps its article text.

A rule is data: a kind, a path of containers to descend, and how to join the
text below.  The table is a source-code literal, so its size is fixed and it may
be sent to every task.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Selector:
    """One container: tag plus attribute test.

    ``op`` is ``is`` (whole attribute value, or one of its class tokens) or
    ``starts`` (attribute value prefix).
    """

    tag: str
    attr: str = ""
    value: str = ""
    op: str = "is"


@dataclass(frozen=True)
class Rule:
    """How to read one site.

    kind        html, flat_html (one un-nested container, pure SQL), json_html or
                json_text (text inside a script element)
    path        containers, outermost first; () means the whole page
    children    text blocks inside the container; () means all its text
    block       "all": every block of the first container; "first": the first
                block of every matching container; "each": all text of every
                matching container
    join        between blocks
    node_join   between the text nodes of a block
    strip       trim blocks and drop empty ones
    drop_last   blocks to leave off at the end
    cut_at      text is cut before this marker
    script      attribute test of the script element for the JSON kinds
    json_path   path of the value inside the script's JSON
    fallback    1 for a rule tried only when rule 0 of the site finds nothing
    """

    source_name: str
    kind: str = "html"
    path: tuple[Selector, ...] = ()
    children: tuple[str, ...] = ("p",)
    block: str = "all"
    join: str = " "
    node_join: str = ""
    strip: bool = True
    drop_last: int = 0
    cut_at: str = ""
    script: str = ""
    json_path: str = ""
    fallback: int = 0


def _cls(value: str, tag: str = "div") -> Selector:
    return Selector(tag, "class", value)


def _id(value: str) -> Selector:
    return Selector("div", "id", value)


def _attr(attr: str, value: str, tag: str = "div") -> Selector:
    return Selector(tag, attr, value)


# One entry per site (two for a site with a fallback).
SITE_RULES: tuple[Rule, ...] = (
    Rule(
        "Business Insider",
        kind="json_html",
        script='id="__NEXT_DATA__"',
        json_path="$.props.pageProps.articleShowData.body",
    ),
    Rule(
        "Forbes",
        path=(_cls("article-body fs-article fs-responsive-text current-article"),),
        children=("h2", "p"),
        strip=False,
    ),
    Rule("Android Central", path=(_id("article-body"),), children=("h2", "p"), strip=False),
    Rule(
        "Gizmodo.com",
        path=(_cls("sc-xs32fe-0 gKylik js_post-content"),),
        children=("h3", "p"),
        strip=False,
    ),
    Rule("BBC News", path=(_attr("data-component", "text-block"),), block="first", strip=False),
    Rule("Al Jazeera English"),
    Rule("AllAfrica - Top Africa News", path=(_cls("story-body"),)),
    Rule("ABC News", path=(_attr("data-testid", "prism-article-body"),)),
    Rule("Globalsecurity.org", path=(_id("main"), _id("content"))),
    Rule("RT", path=(_cls("article"), _cls("article__text text"))),
    Rule("Marketscreener.com", path=(_cls("txt-s4 article-text article-text--clear"),)),
    Rule("Phys.Org", path=(_cls("mt-4 article-main"),), cut_at="More information:"),
    Rule("Time", path=(_id("article-body-main"),)),
    Rule("NPR", path=(_id("storytext"),)),
    Rule("Boing Boing", path=(_cls("entry-content", "section"),)),
    Rule("CNA", path=(_cls("text"), _cls("text-long"))),
    Rule("The Punch", path=(_cls("post-content"),)),
    Rule(
        "Euronews",
        kind="json_text",
        script='type="application/ld+json"',
        json_path="$.@graph[0].articleBody",
    ),
    Rule(
        "Deadline",
        path=(
            _cls(
                "a-content pmc-u-line-height-copy pmc-u-font-family-georgia "
                "pmc-u-font-size-16 pmc-u-font-size-18@desktop"
            ),
        ),
    ),
    Rule("ReadWrite", path=(_cls("entry-content col-md-10"),), drop_last=1),
    Rule("International Business Times", path=(_cls("article-paywall-contents"),)),
    Rule("CNN", path=(_cls("article__content"),)),
    Rule(
        "The Verge",
        path=(
            _cls(
                "duet--article--article-body-component-container clearfix sm:ml-auto "
                "md:ml-100 md:max-w-article-body lg:mx-100"
            ),
        ),
        children=(),
        node_join=" ",
    ),
    Rule("The Indian Express", path=(_cls("story_details"),)),
    Rule("Wired", path=(_cls("body__inner-container"),)),
    Rule("GlobeNewswire", path=(_attr("itemprop", "articleBody"),)),
    Rule("ETF Daily News", path=(_attr("itemprop", "articleBody"),), drop_last=1),
    Rule("The Times of India", path=(_cls("_s30J clearfix"),), children=(), strip=False),
    Rule(
        "The Times of India",
        path=(Selector("article", "class", "artData clr", "starts"),),
        children=(),
        block="each",
        join="\n",
        node_join=" ",
        strip=False,
        fallback=1,
    ),
    Rule("Digital Trends", path=(_attr("itemprop", "articleBody", "article"),)),
)


def flat_article_rule(source_name: str) -> Rule:
    """Paragraphs of the page's one ``<article>`` element, in plain SQL."""
    return Rule(source_name, kind="flat_html", path=(Selector("article"),))
