"""Text from stored web pages, and pages from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalize_text

#: Margins and line spacings of the paper sizes; fixed values.
PRESETS = {"A1": ("10mm", 1.7), "A2": ("10mm", 1.5), "A3": ("10mm", 1.3)}


def list_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, item, href, label): links that are list entries, numbered in page order from 1."""
    return extract(pages, '<li><a href="([^"]*)">([^<]*)</a></li>', ("href", "label"), key, html)


def keyed_verses(pages: DataFrame, key: str = "page_id", html: str = "html", selectors: tuple[str, ...] = ("translation", "verse")) -> DataFrame:
    """(key, verse, text) of elements with data-verse-key: what stands in the first of ``selectors`` (class names) that
    the page has, markup removed; a verse that is there twice keeps its last text."""
    page = F.col(html)
    pattern = lambda name: rf'(?s)data-verse-key="[0-9]+:([0-9]+)"[^>]*>(?:(?!data-verse-key).)*?class="[^"]*\b{name}\b[^"]*"[^>]*>(.*?)</'
    found = F.lit(None).cast("array<struct<verse:string,text:string>>")
    for name in reversed(selectors):
        zipped = F.arrays_zip(F.regexp_extract_all(page, F.lit(pattern(name)), F.lit(1)).alias("verse"), F.regexp_extract_all(page, F.lit(pattern(name)), F.lit(2)).alias("text"))
        found = F.when(F.size(zipped) > 0, zipped).otherwise(found)
    rows = pages.select(key, F.posexplode(found).alias("place", "v")).select(key, "place", F.col("v.verse").cast("int").alias("verse"), normalize_text(F.regexp_replace("v.text", "<[^>]*>", " ")).alias("text"))
    return rows.groupBy(key, "verse").agg(F.max_by("text", "place").alias("text"))


def extract(pages: DataFrame, pattern: str, names: tuple[str, ...], key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, item, names...): the groups of all places of a pattern, numbered from 1; nothing leaves the JVM."""
    both = F.arrays_zip(*(F.regexp_extract_all(html, F.lit(pattern), F.lit(i)).alias(n) for i, n in enumerate(names, 1)))
    rows = pages.select(key, F.posexplode(both).alias("__i", "v"))
    return rows.select(key, (F.col("__i") + 1).alias("item"), *(F.col(f"v.{n}").alias(n) for n in names))


def full_paragraphs(paragraphs: DataFrame, text: str = "text") -> DataFrame:
    """Paragraphs that are not blank, trimmed: what is typeset."""
    return paragraphs.withColumn(text, F.regexp_replace(text, r"^\s+|\s+$", "")).where(F.col(text) != "")


def page_html(body: Column, font: str, points: float, size: str = "A1", font_url: str = "") -> Column:
    """A page for paged media around ``body``, which is HTML already: right to left, justified, in one font."""
    margin, spacing = PRESETS[size]
    face = f"@font-face {{ font-family: '{font}'; src: url('{font_url}'); }}\n" if font_url else ""
    style = (
        f"{face}@page {{ size: {size}; margin: {margin}; }}\n"
        f"body {{ direction: rtl; margin: 0; font-family: '{font}'; font-size: {points:.2f}pt; line-height: {spacing}; text-align: justify; text-align-last: justify; }}\n"
        "p { margin: 0; }\n"
    )
    return F.concat(F.lit(f'<!DOCTYPE html>\n<html dir="rtl" lang="ar"><head><meta charset="utf-8"><style>\n{style}</style></head><body>\n'), body, F.lit("\n</body></html>"))


def typeset(paragraphs: DataFrame, key: str, order: str, font: str, points: float, size: str = "A1", font_url: str = "") -> DataFrame:
    """(key, html, n_paragraphs): one page for each key, its paragraphs that are not blank in order; texts are escaped."""
    escaped = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    listed = full_paragraphs(paragraphs).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, escaped.alias("t")))).alias("ps"))
    body = F.array_join(F.transform("ps", lambda p: F.concat(F.lit("<p>"), p["t"], F.lit("</p>"))), "")
    return listed.select(key, page_html(body, font, points, size, font_url).alias("html"), F.size("ps").alias("n_paragraphs"))


def largest_size(fits, low: float = 2.0, high: float = 7.0, steps: int = 11) -> float:
    """The largest size, to a hundredth, at which ``fits`` holds, by so many halvings; ``low`` if it holds at none."""
    best = low
    for _ in range(steps):
        middle = round((low + high) / 2, 2)
        if fits(middle):
            best = low = middle
        else:
            high = middle
    return best
