"""Citation cells: recognised clause references and what is left over."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three families of citations and the words that join them.
ARP = r"\bARP\s*4754[A-Z]?\s+\d+(?:\.\d+)+(?:\s+[a-z](?:(?:\s*\(\d+\)(?:\s*,?\s*\(\d+\))*)?)(?![a-z0-9(]))?"
STD = r"\bENG[\s-]*STD[\s-]*011\s+RS[\s-]*\d+"
DO = r"\bDO[\s-]*297\s+\d+(?:\.\d+)+(?:\s+[a-z](?![a-z0-9(]))?"
ANY = f"(?i)(?:{ARP}|{STD}|{DO})"
FILLER = r"(?i)^(?:\s++|[,;:/&+\-–—]++|\b(?:and/or|and|or|see|also|refer(?:ring)?\s+to)\b)*$"
_EDGE = r"[ \t\r\n,;:/&+\-–—]+"


def _targets(match: Column) -> Column:
    """The (document, target) pairs of one recognised citation; sub-items fan out only behind an item letter."""
    section = F.regexp_extract(match, r"\s(\d+(?:\.\d+)+)", 1)
    item = F.lower(F.regexp_extract(match, r"(?i)\s\d+(?:\.\d+)+\s+([a-z])", 1))
    subs = F.regexp_extract_all(match, F.lit(r"\((\d+)\)"), F.lit(1))
    one = lambda doc, target: F.struct(F.lit(doc).alias("document"), target.alias("target"))
    base = F.when(item == "", section).otherwise(F.concat_ws(" ", section, item))
    number = F.regexp_extract(match, r"(?i)RS[\s-]*0*(\d+)$", 1)
    return (
        F.when(match.rlike(r"(?i)^ARP") & (item != "") & (F.size(subs) > 0), F.transform(subs, lambda s: one("ARP4754", F.concat(base, F.lit("("), s, F.lit(")")))))
        .when(match.rlike(r"(?i)^ARP"), F.array(one("ARP4754", base)))
        .when(match.rlike(r"(?i)^ENG"), F.array(one("ENG-STD-011", F.concat(F.lit("RS"), number))))
        .otherwise(F.array(one("DO-297", base)))
    )


def references(c: Column) -> Column:
    """Distinct references in order of first sight: array of (document, target, canonical)."""
    found = F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(ANY), F.lit(0)), _targets)))
    return F.transform(found, lambda r: F.struct(r["document"].alias("document"), r["target"].alias("target"), F.concat_ws(" ", r["document"], r["target"]).alias("canonical")))


def residuals(c: Column) -> Column:
    """What lies between references and is more than filler, stripped of separators."""
    gaps = F.filter(F.split(F.coalesce(c, F.lit("")), ANY, -1), lambda g: (g != "") & ~g.rlike(FILLER))
    return F.filter(F.transform(gaps, lambda g: F.regexp_replace(g, f"^{_EDGE}|{_EDGE}$", "")), lambda g: g != "")


def document_key(c: Column) -> Column:
    """Letters and digits only, upper case."""
    return F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
