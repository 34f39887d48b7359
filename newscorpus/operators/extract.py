"""Article text from HTML pages by site rule.

Flat containers and the JSON kinds run as SQL expressions.  Containers that may
nest need a tag stack; those rows, and only those, go through one Arrow UDF.
Rules are matched by source inside the expressions: the rule table is a literal
of fixed size, so there is no join and no skew on popular sources.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.operators.rules import SITE_RULES, Rule, Selector

# Elements without an end tag, elements whose content is not text,
# and entities decoded by the SQL form as patterns (the ampersand last).  The
# final semicolon may be missing, as HTML allows for these names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
#: Comments and such elements, as a pattern.
NO_TEXT = "(?is)<!--.*?-->|" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}>" for t in sorted(SILENT))
ENTITIES = [
    ("&quot;?", '"'),
    ("&#39;|&apos;", "'"),
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&nbsp;?", "\u00a0"),
    ("&amp;?", "&"),
]


def unescape(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.regexp_replace(text, entity, char)
    return text


def flat_paragraphs(html: Column, tag: str = "article") -> Column:
    """Paragraph texts of the page's first ``<tag>`` as an array.

    Tags may be in either case.  A new ``<p>`` closes the one before it; markup,
    comments and what is not text are cut, entities are decoded, and empty
    paragraphs are dropped.
    """
    body = F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    pieces = F.split(F.regexp_replace(body, NO_TEXT, ""), r"(?i)<p(?:\s[^>]*)?>")

    def clean(piece: Column) -> Column:
        text = F.regexp_replace(F.split(piece, "(?i)</p>", 2)[0], r"<[^>]*>", "")
        return F.btrim(unescape(text), F.lit(" \n\t\r"))

    return F.array_remove(
        F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), clean), ""
    )


def flat_body(html: Column, tag: str = "article") -> Column:
    """The paragraphs joined by a space, NULL when there are none."""
    text = F.array_join(flat_paragraphs(html, tag), " ")
    return F.when(text != "", text)


def script_json(html: Column, script: str, json_path: str) -> Column:
    """A value from the JSON inside the script element with this attribute."""
    payload = F.regexp_extract(html, rf"(?s)<script[^>]*{_literal(script)}[^>]*>(.*?)</script>", 1)
    return F.get_json_object(payload, json_path)


def _literal(text: str) -> str:
    return rf"\Q{text}\E"


class _Blocks(HTMLParser):
    """Collects text blocks below the containers of one rule."""

    def __init__(self, rule: Rule, keep_spaces: bool):
        super().__init__(convert_charrefs=True)
        self.rule = rule
        self.keep_spaces = keep_spaces
        self.stack: list[tuple[str, int]] = []  # (tag, container depth before it)
        self.depth = 0  # containers of the path currently open
        self.done = False  # the one wanted container was closed
        self.containers: list[list[list[str]]] = []  # containers > blocks > nodes
        self.open_block: list[str] | None = None
        self.block_at = 0
        self.silent = 0
        if not rule.path:
            self._enter()

    def _enter(self) -> None:
        self.containers.append([])
        if not self.rule.children:
            self.open_block = []
            self.containers[-1].append(self.open_block)

    @property
    def inside(self) -> bool:
        return self.depth == len(self.rule.path) and not self.done

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SILENT:
            self.silent += 1
        if tag in VOID:
            return
        if tag == "p":
            self._close_paragraph()
        before = self.depth
        if not self.done and self.depth < len(self.rule.path):
            if _matches(self.rule.path[self.depth], tag, dict(attrs)):
                self.depth += 1
                if self.inside:
                    self._enter()
        self.stack.append((tag, before))
        if self.inside and tag in self.rule.children and self.open_block is None:
            self.open_block = []
            self.containers[-1].append(self.open_block)
            self.block_at = len(self.stack)

    def _close_paragraph(self) -> None:
        """End an open <p> that was never closed, if it is the innermost block."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag == "p":
                self._pop(i)
                return
            if tag in ("div", "article", "section", "td", "blockquote", "li", "body"):
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT and self.silent:
            self.silent -= 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return

    def _pop(self, i: int) -> None:
        while len(self.stack) > i:
            _, before = self.stack.pop()
            if self.rule.children and self.open_block is not None and len(self.stack) < self.block_at:
                self.open_block = None
            if before < self.depth:
                if self.inside:
                    self.open_block = None
                # only the first container counts, even if its inner one is missing
                self.done = self.rule.block == "all"
                self.depth = before

    def handle_data(self, data: str) -> None:
        if self.silent or self.open_block is None or not self.inside:
            return
        self.open_block.append(data if self.keep_spaces else data.strip())


def _matches(sel: Selector, tag: str, attrs: dict[str, str | None]) -> bool:
    if tag != sel.tag:
        return False
    if not sel.attr:
        return True
    have = attrs.get(sel.attr)
    if have is None:
        return False
    if sel.op == "starts":
        return have.startswith(sel.value)
    if sel.attr == "class":
        return have == sel.value or sel.value in have.split()
    return have == sel.value


def html_text(html: str, rule: Rule, strict_strip: bool = False) -> str | None:
    """Text of one page under one rule; None when nothing is found."""
    keep = not (strict_strip and rule.strip) and not (rule.strip and rule.node_join)
    parser = _Blocks(rule, keep)
    parser.feed(html)
    parser.close()
    if not parser.containers:
        return None
    if rule.block == "first":
        if any(not c for c in parser.containers):
            return None
        blocks = [c[0] for c in parser.containers]
    elif rule.block == "each":
        blocks = [b for c in parser.containers for b in c]
    else:
        blocks = parser.containers[0]
    if rule.drop_last:
        blocks = blocks[: -rule.drop_last]
    texts = []
    for nodes in blocks:
        nodes = [n for n in nodes if n] if not keep else nodes
        text = rule.node_join.join(nodes)
        texts.append(text.strip() if rule.strip else text)
    if rule.strip and not strict_strip:
        texts = [t for t in texts if t]
    out = rule.join.join(texts)
    if rule.cut_at:
        out = out.split(rule.cut_at)[0]
        if not strict_strip:
            out = out.strip()
    return out or None


def _udf(rules: dict[str, list[Rule]], strict_strip: bool):
    """Arrow UDF for the nested rules; a page that cannot be read gives NULL."""

    def read(source: str | None, html: str | None) -> str | None:
        if html is None:
            return None
        for rule in rules.get(source, ()):
            try:
                text = html_text(html, rule, strict_strip)
            except Exception:
                text = None
            if text is not None:
                return text
        return None

    @F.pandas_udf(T.StringType())
    def html_extract(source: pd.Series, html: pd.Series) -> pd.Series:
        return pd.Series([read(s, h) for s, h in zip(source, html, strict=True)], dtype=object)

    return html_extract


def extract_body(
    pages: DataFrame,
    rules: Sequence[Rule] = SITE_RULES,
    source: str = "source_name",
    html: str = "html",
    name: str = "full_content",
    strict_strip: bool = False,
) -> DataFrame:
    """Add the article text of each page, NULL for unknown sites and failures."""
    pages = pages.drop(name)
    nested: dict[str, list[Rule]] = defaultdict(list)
    flat: dict[str, list[str]] = defaultdict(list)
    out = F.lit(None).cast("string")
    markup = F.col(html)
    for rule in rules:
        here = F.col(source) == rule.source_name
        if rule.kind == "flat_html":
            flat[rule.path[0].tag].append(rule.source_name)
            continue
        if rule.kind == "html":
            nested[rule.source_name].append(rule)
            continue
        value = script_json(F.col(html), rule.script, rule.json_path)
        if rule.kind == "json_text":
            out = F.when(here, F.when(value != "", value)).otherwise(out)
        else:
            nested[rule.source_name].append(rule)
            markup = F.when(here, value).otherwise(markup)
    for tag, names in flat.items():
        out = F.when(F.col(source).isin(names), flat_body(F.col(html), tag)).otherwise(out)
    if nested:
        wanted = F.col(source).isin(list(nested))
        # rows of other sites reach the UDF as NULL and cost nothing there
        udf = _udf(dict(nested), strict_strip)
        out = F.when(wanted, udf(F.col(source), F.when(wanted, markup))).otherwise(out)
    # One generated row per page instead of a projection: a later filter on the
    # text would otherwise copy the whole extraction into its condition.
    return pages.select("*", F.explode(F.array(out)).alias(name))
