"""Text expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Trim all Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_cell(c: Column) -> Column:
    """One line end, plain spaces, squeezed and stripped lines, no empty lines."""
    plain = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), " ", " ")
    lines = F.transform(F.split(plain, "\n"), lambda x: strip(F.regexp_replace(x, "[ \t]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def clean_text(c: Column) -> Column:
    """Drop NUL, non-characters and soft hyphens; plain, squeezed spaces; stripped."""
    return strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[\\x00￾￿­]", ""), " ", " "), "[ \t]+", " "))


def normal(c: Column) -> Column:
    """Lower-case ASCII words joined by single spaces, for matching."""
    return F.trim(F.regexp_replace(F.lower(clean_text(c)), "[^a-z0-9]+", " "))


def words(c: Column) -> Column:
    return F.filter(F.array_distinct(F.split(normal(c), " ")), lambda x: x != "")


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two distinct word arrays; 0 where either is empty."""
    either = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def edge_fingerprint(c: Column) -> Column:
    """Case folded, digit runs as #, squeezed: equal for running headers that differ in numbers only."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(clean_text(c)), r"(?U)\d+", "#"), r"(?U)\s+", " "))


def yes_no(c: Column) -> Column:
    """Canonical Yes or No, null for empty, anything else trimmed."""
    t = strip(c)
    return F.when(F.lower(t) == "yes", "Yes").when(F.lower(t) == "no", "No").when(t == "", None).otherwise(t)


def header_name(c: Column) -> Column:
    return strip(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def sentences(c: Column) -> Column:
    """Pieces after . ! or ? and white space."""
    return F.split(c, r"(?<=[.!?])\s+")


def render_table(cells: Column) -> Column:
    """Cell matrix as lines: line ends to spaces, cleaned, | escaped, empty rows dropped."""
    rows = F.transform(cells, lambda r: F.transform(r, lambda x: F.replace(clean_text(F.regexp_replace(F.coalesce(x, F.lit("")), "\n", " ")), F.lit("|"), F.lit("\\|"))))
    return F.array_join(F.transform(F.filter(rows, lambda r: F.exists(r, lambda x: x != "")), lambda r: F.array_join(r, " | ")), "\n")


def toc_title(c: Column) -> Column:
    """A contents line's title: cut at the dot leader, without a trailing page number."""
    return strip(F.regexp_replace(F.split(c, r"\.{3,}", 2)[0], r"\s+\d+\s*$", ""))


def id_component(c: Column) -> Column:
    cleaned = F.regexp_replace(F.regexp_replace(F.trim(c), "[^A-Za-z0-9._-]+", "_"), "^[_.-]+|[_.-]+$", "")
    return F.when(cleaned == "", "DOCUMENT").otherwise(cleaned)


def chunk_id(document: Column, section: Column, kind: Column, number: Column) -> Column:
    return F.format_string("%s-%s-%s-%03d", id_component(document), F.coalesce(section, F.lit("UNSECTIONED")), kind, number)
