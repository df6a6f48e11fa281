"""Section numbers, markers and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def section_number(c: Column) -> Column:
    """The dotted number that starts a header, or null. One integer before any text counts."""
    return F.nullif(F.regexp_extract(c, r"^\s*(\d+(?:\.\d+)*)\s+\S", 1), F.lit(""))


def parts(c: Column) -> Column:
    """A dotted number as an array that sorts in reading order."""
    return F.transform(F.split(c, r"\."), lambda x: x.try_cast("bigint"))


def dotted(c: Column) -> Column:
    return F.array_join(c.cast("array<string>"), ".")


def record_type(c: Column) -> Column:
    return F.when(section_number(c).isNotNull(), "section_header").otherwise("requirement")


def malformed_prefix(c: Column) -> Column:
    """A first token that looks like a broken section number, or null."""
    t = F.regexp_replace(c, r"(?U)^\s+", "")
    token, rest = F.regexp_extract(t, r"(?U)^(\S+)", 1), F.regexp_extract(t, r"(?sU)^\S+\s+(\S.*)$", 1)
    valid = token.rlike(r"^\d+(?:\.\d+)*$")
    return F.when(~t.rlike(r"^\d"), None).when(valid & (rest == ""), token).when(valid, None).when(token.contains("."), token)


def missing_siblings(parent: Column, first: Column, last: Column) -> Column:
    """Up to five missing numbers listed, more as "first through last"."""
    name = lambda n: F.concat_ws(".", F.nullif(parent, F.lit("")), n.cast("string"))
    few = F.array_join(F.transform(F.sequence(first, last), name), ", ")
    return F.when(last - first < 5, few).otherwise(F.concat(name(first), F.lit(" through "), name(last)))


def item_id_ok(c: Column) -> Column:
    return F.trim(c).rlike(r"(?i)^NIO-\d+$")


def list_number_ok(c: Column, prefix: str) -> Column:
    return F.upper(F.trim(c)).rlike(rf"^{prefix}-\d+(?:\.\d+)?$")


def lettered_item(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"^\s*([A-Za-z])\.", 1), F.lit(""))


def numbered_item(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"^\s*\(?(\d+)[.)]", 1), F.lit(""))


def repaired_number(number: Column, title: Column) -> Column:
    """4.7.2 with title "2 Title" as 4.7.2.2, else null."""
    digit = F.nullif(F.regexp_extract(title, r"^(\d+)\s+\S", 1), F.lit(""))
    return F.when(digit.isNotNull(), F.concat(number, F.lit("."), digit))
