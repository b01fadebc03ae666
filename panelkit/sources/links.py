"""Spreadsheet-link harvesting from HTML pages."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHOR = r'(?is)<a\s[^>]*>.*?</a>'
# An attribute value stands in double quotes, single quotes or none; the one
# group holds it with its quotes.
VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
TAG = r"""(?is)^<a(?:\s+[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?\s+"""
HREF = TAG + "href" + VALUE
TITLE = TAG + "title" + VALUE
INNER = r'(?is)^<a\s[^>]*>(.*)</a>$'
# A character reference, a stretch without any, or a lone ampersand.
REFERENCE = r"&[#0-9A-Za-z]+;|[^&]+|&"


def unescape(c):
    """Character references decoded once, from left to right: the named ones
    of HTML 4 (a no-break space becomes a space), decimal and hexadecimal
    ones.  Unknown names and numbers that are no character stay as they are."""
    named = F.create_map(*[F.lit(x) for name, code in name2codepoint.items()
                           for x in (f"&{name};", " " if name == "nbsp" else chr(code))])

    def decoded(part):
        number = (F.when(part.rlike("^&#[xX][0-9A-Fa-f]{1,6};$"), F.conv(F.regexp_extract(part, "([0-9A-Fa-f]+);$", 1), 16, 10))
                   .when(part.rlike("^&#[0-9]{1,7};$"), F.regexp_extract(part, "([0-9]+);$", 1))).cast("int")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.format_string("%08X", number)), "UTF-32")
        return F.coalesce(F.when(valid, F.when(number == 0xA0, " ").otherwise(char)), F.try_element_at(named, part), part)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0)), decoded), "")


def unquote(c):
    return F.regexp_replace(c, r"""^["']|["']$""", "")


def strip_ws(c):
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def harvest_links(pages: DataFrame, pattern: str = ".xls", url_col: str = "url", html_col: str = "html",
                  id_col: str = "page_id", base: str | None = None) -> DataFrame:
    """Every ``<a href>`` whose href contains ``pattern`` (case-insensitive):
    name = link text, else its title, else the href's last path segment;
    URL resolved against ``base`` (default: the page's own origin) for
    '../x', '/x' and relative forms; absolute 'http…' links kept.
    One row per (page, link position); pages are independent rows."""
    a = pages.select(id_col, url_col, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), 0)).alias("pos", "_a"))
    has_href = F.col("_a").rlike(HREF)
    href = unescape(unquote(F.regexp_extract("_a", HREF, 1)))
    title = F.when(F.col("_a").rlike(TITLE), unescape(unquote(F.regexp_extract("_a", TITLE, 1))))
    text = strip_ws(unescape(F.regexp_replace(F.regexp_extract("_a", INNER, 1), r"<[^>]*>", "")))
    a = a.where(has_href).select(id_col, url_col, "pos", href.alias("href"), title.alias("title"), text.alias("text"))
    a = a.where(F.lower("href").contains(pattern.lower()))
    root = F.lit(base) if base is not None else F.regexp_extract(F.col(url_col), r"^(https?://[^/]+)", 1)
    h = F.col("href")
    full = (F.when(h.startswith("../"), F.concat(root, F.lit("/"), F.replace(h, F.lit("../"), F.lit(""))))
             .when(h.startswith("/"), F.concat(root, h))
             .when(~h.startswith("http"), F.concat(root, F.lit("/"), h))
             .otherwise(h))
    name = F.when(F.col("text") != "", F.col("text")).when(F.coalesce(F.col("title"), F.lit("")) != "", F.col("title")) \
            .otherwise(F.element_at(F.split(h, "/"), -1))
    return a.select(id_col, "pos", name.alias("nombre"), full.alias("url_completa"))
