"""Hyperlinks of stored web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.urls import resolved, unescaped
from tallyloom.operators.shaping import col, require

ANCHOR = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""

_REST = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""
#: What a page is made of, besides text: comments, elements whose content is no markup, tags. A
#: comment or such an element that never ends takes the rest of the page. Quantifiers are possessive
#: or of one character, so that the length of a page costs no stack.
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(?:(?:script|style|textarea|title|template|noscript|xmp|iframe)(?=[\s/>])" + _REST + r")"
    r".*?(?:</(?:script|style|textarea|title|template|noscript|xmp|iframe)(?=[\s/>])|\z)"
    r"|</?[a-z][^\s/>]*+" + _REST
)
_WITH_HREF = r"(?is)^<(?:a|base)[\s/]"
_ATTRIBUTE = r"""(?is)[\s/"'](href(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?)(?=[\s/>])|"[^"]*+"|'[^']*+'"""
_VALUE = r"""(?is)^href\s*=\s*["']?(.*?)["']?$"""


def extract_links(pages: DataFrame, id: str, html: str, part: str | None = None) -> DataFrame:
    """Targets of the page's anchors, in no order, repeats kept: (id, href).

    `part` keeps targets containing it, for example `.pdf`.
    """
    require(pages, [id, html])
    found = F.regexp_extract_all(col(html), F.lit(ANCHOR), F.lit(1))
    if part is not None:
        found = F.filter(found, lambda href: href.contains(part))
    return pages.select(col(id), F.explode(found).alias("href"))


def _href(tag: Column) -> Column:
    """Value of a tag's first href, its entities read and its edges trimmed; null without one."""
    values = F.filter(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), lambda x: x != "")
    value = F.regexp_extract(F.get(values, F.lit(0)), _VALUE, 1)
    return unescaped(F.regexp_replace(F.regexp_replace(value, r"^\s+|\s+$", ""), r"[\t\r\n]", ""))


def resolved_links(
    pages: DataFrame, id: str, html: str, url: str, part: str | None = None
) -> DataFrame:
    """Absolute targets of the page's anchors in page order: (id, place, href, link).

    The page is cut into comments, scripts and the like, and tags, so anchors inside the first two do
    not count; attributes are read by name, quoted or not. `link` is href resolved against the page's
    first base element and its URL. A page that is null has no links; one without a URL keeps hrefs
    that are absolute and has null for the others. `part` keeps links containing it.
    """
    require(pages, [id, html, url])
    tags = F.filter(F.regexp_extract_all(col(html), F.lit(MARKUP), F.lit(0)), lambda x: x.rlike(_WITH_HREF))
    hrefs = F.transform(tags, lambda x: F.struct(x.rlike(r"(?i)^<base").alias("base"), _href(x).alias("href")))
    hrefs = F.filter(hrefs, lambda x: x["href"].isNotNull())
    found = pages.select(col(id), col(url).alias("_url"), hrefs.alias("_hrefs"))
    base = F.get(F.filter("_hrefs", lambda x: x["base"]), F.lit(0))["href"]
    found = found.withColumn("_base", F.when(base.isNull(), F.col("_url")).otherwise(resolved(F.col("_url"), base)))
    anchors = F.filter("_hrefs", lambda x: ~x["base"])
    links = found.select(col(id), "_base", F.posexplode(anchors).alias("place", "_link")).select(
        col(id),
        "place",
        F.col("_link.href").alias("href"),
        resolved(F.col("_base"), F.col("_link.href")).alias("link"),
    )
    return links if part is None else links.where(F.col("link").contains(part))
