"""HTML parsing: text, anchors, next links, structured data; Arrow batches, one page at a time."""

from __future__ import annotations

import json
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DROP = {"script", "style", "noscript", "template", "nav", "header", "footer", "aside", "svg", "form"}
_VOID = {"br", "img", "hr", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "track"}
#: Labels of links to the next page; fixed, lower case.
NEXT = ("next", "next page", "nächste", "weiter", "suivant", "siguiente", "›", "»", ">")


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.drop, self.main, self.body, self.inside = 0, [], [], 0
        self.anchors: list[dict] = []
        self.open: list[dict] = []
        self.scripts: list[str] = []
        self.script: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "script":
            self.script = [] if a.get("type") == "application/ld+json" else None
        if tag in _VOID:
            self.handle_data(" ")
            return
        if tag in _DROP:
            self.drop += 1
        if tag in ("main", "article") or a.get("role") == "main":
            self.inside += 1
        if tag == "a" and a.get("href"):
            self.open.append({"href": a["href"], "rel": a.get("rel") or "", "label": []})
        self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "script" and self.script is not None:
            self.scripts.append("".join(self.script))
            self.script = None
        if tag in _DROP and self.drop:
            self.drop -= 1
        if tag in ("main", "article") and self.inside:
            self.inside -= 1
        if tag == "a" and self.open:
            a = self.open.pop()
            self.anchors.append({**a, "label": " ".join("".join(a["label"]).split())})
        self.handle_data(" ")

    def handle_data(self, data):
        if self.script is not None:
            self.script.append(data)
        if self.open:
            self.open[-1]["label"].append(data)
        if not self.drop:
            self.body.append(data)
            if self.inside:
                self.main.append(data)


def parse(markup: str | None) -> _Page:
    p = _Page()
    p.feed(markup or "")
    p.close()
    return p


def page_text(markup: str | None) -> str:
    """Visible text of the main part, or else of the body."""
    p = parse(markup)
    main = " ".join("".join(p.main).split())
    return main or " ".join("".join(p.body).split())


def next_link(url: str, markup: str | None) -> str | None:
    """The link to the next page of one site: rel=next first, then by label, the page's own path preferred."""
    here, found = urlsplit(url), []
    for a in parse(markup).anchors:
        to = urlsplit(urljoin(url, a["href"]))
        if to.scheme not in ("http", "https") or to.netloc != here.netloc or to.geturl() == url:
            continue
        if "next" in a["rel"].split():
            found.append((0, to.path != here.path, to.geturl()))
        elif a["label"].lower() in NEXT:
            found.append((1, to.path != here.path, to.geturl()))
    return min(found)[2] if found else None


def _typed(node, kind: str):
    """The first object of a type, depth first."""
    if isinstance(node, list):
        return next((x for x in (_typed(n, kind) for n in node) if x), None)
    if isinstance(node, dict):
        names = node.get("@type")
        if kind in (names if isinstance(names, list) else [names]):
            return node
        return _typed(list(node.values()), kind)
    return None


def structured(markup: str | None, kind: str) -> str | None:
    for s in parse(markup).scripts:
        try:
            if x := _typed(json.loads(s), kind):
                return json.dumps(x, sort_keys=True, separators=(",", ":"))
        except ValueError:
            continue
    return None


ANCHORS = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("label", T.StringType())]))


def texts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    f = F.pandas_udf(lambda x: x.map(page_text), T.StringType(), F.PandasUDFType.SCALAR)
    return pages.select(key, f(html).alias("text"))


def anchors(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, ord, href, label) of all anchors in order."""

    def run(batches):
        for b in batches:
            out = [(k, i, a["href"], a["label"]) for k, m in zip(b[key], b[html]) for i, a in enumerate(parse(m).anchors)]
            yield pd.DataFrame(out, columns=[key, "ord", "href", "label"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, ord int, href string, label string")


def longest_labels(found: DataFrame, key: str = "page_id") -> DataFrame:
    """One row a target: its longest label, the first of equal ones, and where it was first seen."""
    best = F.max_by("label", F.struct(F.length("label"), -F.col("ord")))
    return found.groupBy(key, "href").agg(best.alias("label"), F.min("ord").alias("ord"))


def next_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    def run(batches):
        for b in batches:
            yield pd.DataFrame({key: b[key], "next_url": [next_link(u, m) for u, m in zip(b[url], b[html])]})

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url, html).mapInPandas(run, f"{key} {kind}, next_url string")


def structured_data(pages: DataFrame, kind: str, key: str = "page_id", html: str = "html") -> DataFrame:
    def run(batches):
        for b in batches:
            yield pd.DataFrame({key: b[key], "data": [structured(m, kind) for m in b[html]]})

    of = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {of}, data string")
