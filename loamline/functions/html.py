"""HTML to Markdown in Arrow batches, with the standard library's parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DROPPED = {"script", "style", "nav", "footer", "header", "aside", "form", "noscript", "iframe", "svg", "button"}
BLOCKS = {"p", "div", "section", "article", "main", "ul", "ol", "table", "tr", "pre", "blockquote", "br", "h1", "h2", "h3", "h4", "h5", "h6", "li"}
VOID = {"br", "hr", "img", "input", "meta", "link"}


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.dropped, self.pre, self.links = 0, 0, []

    def handle_starttag(self, tag, attrs):
        if tag in DROPPED:
            self.dropped += 1
        elif not self.dropped:
            if tag in BLOCKS:
                self.out.append("\n" if tag in ("li", "br", "tr") else "\n\n")
            if re.fullmatch("h[1-6]", tag):
                self.out.append("#" * int(tag[1]) + " ")
            elif tag == "li":
                self.out.append("- ")
            elif tag == "pre":
                self.pre += 1
                self.out.append("```\n")
            elif tag == "code" and not self.pre:
                self.out.append("`")
            elif tag in ("b", "strong"):
                self.out.append("**")
            elif tag in ("i", "em"):
                self.out.append("*")
            elif tag == "a":
                self.links.append(dict(attrs).get("href"))
                self.out.append("[")

    def handle_endtag(self, tag):
        if tag in DROPPED:
            self.dropped = max(0, self.dropped - 1)
        elif not self.dropped:
            if tag == "pre" and self.pre:
                self.pre -= 1
                self.out.append("\n```\n")
            elif tag == "code" and not self.pre:
                self.out.append("`")
            elif tag in ("b", "strong"):
                self.out.append("**")
            elif tag in ("i", "em"):
                self.out.append("*")
            elif tag == "a" and self.links:
                self.out.append(f"]({self.links.pop() or ''})")
            elif tag in BLOCKS and tag not in ("li", "br", "tr"):
                self.out.append("\n\n")

    def handle_data(self, data):
        if not self.dropped:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def to_markdown(html: str) -> str:
    body = re.search(r"(?is)<(main|article|body)\b[^>]*>(.*)</\1>", html)
    p = _Markdown()
    p.feed(body.group(2) if body else html)
    p.close()
    text = "\n".join(x.strip() if not x.startswith("    ") else x.rstrip() for x in "".join(p.out).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text.replace("[Edit]", "")).strip() + "\n"


def markdown(html: Column | str) -> Column:
    def of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda x: None if x is None else to_markdown(x))

    of.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return F.pandas_udf(of, "string")(F.col(html) if isinstance(html, str) else html)
