"""Predicates and joined text of layout lines, rows of segments and spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import geometry as G

#: Page numbers, running headers, leaders, number and letter tokens, upper-case section lines.
PAGE_NUMBER = r"(?i)^(?:[ivxlcdm]+|\d+)$"
PUBLICATION_HEADER = r"(?i)^\S+\s+(?:SPECIFICATION|REPORT|CHARACTERISTIC)\b.*\bPAGE\s+\S+\s*$"
SECTION_HEADER = r"^\s*\d+(?:\.\d+)*\s+[A-Z][A-Z0-9 /&(),.:'\-–—]+\s*$"
LEADER = r"(?:\.{2,}|…)\s*\d*\s*$"
SECTION_TOKEN = r"^(\d+(?:\.\d+)+)\.?$"
LETTER_TOKEN = r"^([A-Za-z])\.$"


def location(table: Column, row: Column) -> Column:
    """Where a record came from, for messages."""
    return F.concat(F.lit("table "), table.cast("string"), F.lit(", row "), row.cast("string"))


def span_text(spans: Column) -> Column:
    """The text of spans (text, x0, x1, size) in order; a gap over 1.5 and .18 of the last size becomes a space where neither side has one."""
    full = F.filter(spans, lambda s: F.length(s["text"]) > 0)

    def piece(s: Column, i: Column) -> Column:
        last = F.get(full, i - 1)
        apart = (s["x0"] - last["x1"] > F.greatest(F.lit(1.5), last["size"] * 0.18)) & ~last["text"].endswith(" ") & ~s["text"].startswith(" ")
        return F.concat(F.when((i > 0) & apart, " ").otherwise(""), s["text"])

    return F.trim(F.array_join(F.transform(full, piece), ""))


def toc_entry(text: Column, segments: Column, page_width: Column) -> Column:
    """A printed contents row: a leader at its end, or three segments of which the last is a number far to the right."""
    last = F.get(segments, F.size(segments) - 1)
    return text.rlike(LEADER) | F.coalesce((F.size(segments) >= 3) & F.trim(last["text"]).rlike(r"^\d+$") & (G.ratio(last["x0"], page_width) >= 0.65), F.lit(False))


def _token(segments: Column, gap: Column, least: float, pattern: str) -> Column:
    first = F.regexp_extract(F.trim(F.get(segments, F.lit(0))["text"]), pattern, 1)
    return F.when((F.size(segments) >= 2) & (gap >= least), F.nullif(first, F.lit("")))


def section_token(text: Column, segments: Column, page_width: Column, gap: Column, least: float) -> Column:
    """The section number that is a row's first segment, with a wide enough gap behind it; null in contents rows."""
    return F.when(~toc_entry(text, segments, page_width), _token(segments, gap, least, SECTION_TOKEN))


def letter_token(segments: Column, gap: Column, least: float) -> Column:
    """The item letter that is a row's first segment, with a wide enough gap behind it."""
    return F.lower(_token(segments, gap, least, LETTER_TOKEN))


def page_footer(text: Column, x0: Column, x1: Column, page_width: Column, y_ratio: Column) -> Column:
    """A centered plain or Roman page number at the page's foot."""
    center = G.ratio((x0 + x1) / 2, page_width)
    return (y_ratio >= 0.92) & (F.abs(center - 0.5) <= 0.12) & F.trim(text).rlike(PAGE_NUMBER)


def running_header(text: Column, x_ratio: Column, y_ratio: Column, font_size: Column, body_font: Column) -> Column:
    """A publication's header with a page, or a small indented upper-case section title, at the page's top."""
    return (y_ratio <= 0.105) & (text.rlike(PUBLICATION_HEADER) | ((font_size <= body_font - 0.75) & (x_ratio >= 0.30) & text.rlike(SECTION_HEADER)))


def readable_image(x0: Column, y0: Column, x1: Column, y1: Column, page_width: Column, page_height: Column) -> Column:
    """Neither under half a percent of the page nor under 20 points on a side; false for a box that cannot be read."""
    page = F.greatest(page_width * page_height, F.lit(1.0))
    return F.coalesce((G.area(x0, y0, x1, y1) / page >= 0.005) & (x1 - x0 >= 20) & (y1 - y0 >= 20), F.lit(False))


def upper_case(text: Column) -> Column:
    """Some letter, and none of them small."""
    return text.rlike(r"\p{Lu}") & ~text.rlike(r"\p{Ll}")


def appendix_strength(text: Column, x_ratio: Column, font_size: Column, body_font: Column, bold: Column) -> Column:
    """An appendix title at the left, in the body's font size or more, bold or in capitals."""
    return (x_ratio <= 0.22) & (font_size >= body_font - 0.25) & (bold | upper_case(text))
