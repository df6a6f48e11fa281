"""Clause lookup in a relation of layout lines.

lines: doc_id, page_index, ord, text, x0, y0, x1, y1, page_width, page_height, font_size, bold.
targets: doc_id and the address parts. All lookups are equi joins on the document with an order condition; the
first match is a minimum of ``ord``, so no row order is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import numbering as N
from quire.operators import boundaries, margins

INDENT, COLUMN = 0.03, 0.025
#: A chapter's title; a section number at a line's start has two parts or more, a bare integer is none.
CHAPTER = r"(?i)^\s*CHAPTER\s+(\d+)\b"
SECTION = r"^\s*(\d+(?:\.\d+)+)(?:\s|$|[-–—:])"


def parse_address(c: Column) -> Column:
    """(section, item, subitem) of an address such as "5.4.3 a(8)"; null where it is none."""
    pattern = r"^\s*(?:[A-Za-z]+[\s-]*\d*[A-Z]?\s+)?(\d+(?:\.\d+)+)(?:\s+([A-Za-z])(?:\((\d+)\))?)?\s*$"
    part = lambda i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))
    return F.when(c.rlike(pattern), F.struct(part(1).alias("section"), F.lower(part(2)).alias("item"), part(3).alias("subitem")))


def body_lines(lines: DataFrame, top: float = 0.05, bottom: float = 0.03) -> DataFrame:
    """Lines with text whose center is outside the margins, with x_ratio, y_ratio, section number and item letter."""
    y = G.ratio((F.col("y0") + F.col("y1")) / 2, F.col("page_height"))
    placed = lines.where(F.trim("text") != "").withColumn("y_ratio", y).where(G.in_band(F.col("y_ratio"), top, bottom))
    return placed.withColumn("x_ratio", G.ratio(F.col("x0"), F.col("page_width"))).withColumn("number", F.nullif(F.regexp_extract("text", SECTION, 1), F.lit(""))).withColumn("letter", F.lower(N.lettered_item(F.col("text")))).withColumn("sub", N.numbered_item(F.col("text")))


def section_bounds(lines: DataFrame, targets: DataFrame, *, chapters: bool = False) -> DataFrame:
    """``targets`` (doc_id, section) with start and end: from the first line with the number to the first later heading of another number that is no deeper, no smaller by over half a point, and bold if the first is. With ``chapters``, a later line of another chapter ends it, too."""
    heads = lines.where("number is not null").select("doc_id", "ord", "number", "font_size", "bold", F.size(N.parts(F.col("number"))).alias("depth"))
    first = heads.join(targets.select("doc_id", F.col("section").alias("number")).distinct(), ["doc_id", "number"], "left_semi").groupBy("doc_id", "number").agg(F.min_by(F.struct("ord", "font_size", "bold", "depth"), "ord").alias("h"))
    starts = first.select("doc_id", F.col("number").alias("section"), F.col("h.ord").alias("start"), F.col("h.font_size").alias("f"), F.col("h.bold").alias("b"), F.col("h.depth").alias("d"))
    met = starts.join(heads, "doc_id").where("ord > start and number <> section and depth <= d and font_size >= f - 0.5 and (bold or not b)")
    ends = met.select("doc_id", "section", "ord")
    if chapters:
        other = lines.withColumn("_c", F.nullif(F.regexp_extract("text", CHAPTER, 1), F.lit("")).cast("bigint")).where("_c is not null").select("doc_id", "ord", "_c")
        ends = ends.unionByName(starts.join(other, "doc_id").where((F.col("ord") > F.col("start")) & (F.col("_c") != N.parts(F.col("section"))[0])).select("doc_id", "section", "ord"))
    ends = ends.groupBy("doc_id", "section").agg(F.min("ord").alias("end"))
    return targets.join(starts.select("doc_id", "section", "start").join(ends, ["doc_id", "section"], "left"), ["doc_id", "section"], "left")


def marker_bounds(lines: DataFrame, spans: DataFrame, label: str, wanted: str, tolerance: float = INDENT) -> DataFrame:
    """Narrow ``spans`` (doc_id, start, end, ...) to a marker: from the first equal marker behind the start to the next marker of about its indent, else the old end. Spans without a wanted marker stay; one not found gets a null start."""
    keyed = spans.withColumn("_id", F.struct("doc_id", "start", "end", *[c for c in spans.columns if c not in ("doc_id", "start", "end")]))
    marks = lines.where(F.col(label).isNotNull()).select("doc_id", F.col("ord").alias("_o"), F.col(label).alias("_m"), F.col("x_ratio").alias("_x"))
    inside = keyed.where(F.col(wanted).isNotNull()).join(marks, "doc_id").where("_o > start and (end is null or _o < end)")
    begin = inside.where(F.col("_m") == F.col(wanted)).groupBy("_id").agg(F.min_by(F.struct("_o", "_x"), "_o").alias("s"))
    after = inside.join(begin, "_id").where((F.col("_o") > F.col("s._o")) & (F.abs(F.col("_x") - F.col("s._x")) <= tolerance)).groupBy("_id").agg(F.min("_o").alias("_next"))
    out = keyed.join(begin, "_id", "left").join(after, "_id", "left")
    found = F.col(wanted).isNull()
    return out.select(*[c for c in spans.columns if c not in ("start", "end")], F.when(found, F.col("start")).otherwise(F.col("s._o")).alias("start"), F.when(found, F.col("end")).otherwise(F.coalesce("_next", "end")).alias("end"))


def column_markers(lines: DataFrame, pattern: str, *, bold: bool = True, tolerance: float = COLUMN) -> DataFrame:
    """Numbered markers at line starts with the end of their text: of equal numbers that whose column holds most distinct numbers, up to the next marker of that column, or a bold section heading before it at or left of the column (then next_reference is null)."""
    number = F.nullif(F.regexp_extract("text", pattern, 1), F.lit(""))
    marks = lines.withColumn("mark", number.cast("bigint")).where("mark is not null").where(F.lit(not bold) | F.col("bold"))
    support = boundaries.column_support(marks, ["doc_id"], "ord", "mark", "x_ratio", tolerance)
    best = marks.join(support, ["doc_id", "ord"]).groupBy("doc_id", "mark").agg(F.min_by(F.struct("ord", "x_ratio"), F.struct(-F.col("support"), "ord")).alias("m"))
    chosen = best.select("doc_id", "mark", F.col("m.ord").alias("start"), F.col("m.x_ratio").alias("x"))
    peers = marks.select("doc_id", "ord", F.col("mark").alias("peer"), "x_ratio")
    met = chosen.join(peers, "doc_id").where((F.col("ord") > F.col("start")) & (F.abs(F.col("x_ratio") - F.col("x")) <= tolerance))
    following = met.groupBy("doc_id", "mark").agg(F.min("ord").alias("end"), F.min_by("peer", "ord").alias("next_reference"))
    bounds = chosen.join(following, ["doc_id", "mark"], "left")
    heads = lines.where("bold and number is not null").select("doc_id", "ord", "x_ratio")
    cut = bounds.join(heads, "doc_id").where((F.col("ord") > F.col("start")) & (F.col("end").isNull() | (F.col("ord") < F.col("end"))) & (F.col("x_ratio") <= F.col("x") + tolerance)).groupBy("doc_id", "mark").agg(F.min("ord").alias("_cut"))
    return bounds.join(cut, ["doc_id", "mark"], "left").select("doc_id", "mark", "start", F.coalesce("_cut", "end").alias("end"), F.when(F.col("_cut").isNull(), F.col("next_reference")).alias("next_reference"))


def render(lines: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """(doc_id, key, text, pages): the lines of each span as paragraphs.

    A child marker starts a paragraph, and so does an indent of over .018 or a gap of over .9 median line heights
    on the same page. Within one, a hyphen before a small letter is dropped and the words join; else a space.
    """
    inside = spans.where("start is not null").select("doc_id", key, "start", "end").join(lines, "doc_id").where("ord >= start and (end is null or ord < end)")
    w = Window.partitionBy("doc_id", key).orderBy("ord")
    height = F.median(F.col("y1") - F.col("y0")).over(Window.partitionBy("doc_id", key))
    same = F.lag("page_index").over(w) == F.col("page_index")
    gap = F.when(same, F.col("y0") - F.lag("y1").over(w)).otherwise(0.0)
    new = F.col("letter").isNotNull() | F.col("sub").isNotNull() | (F.col("x_ratio") - F.lag("x_ratio").over(w) > 0.018) | (gap > 0.9 * height)
    wrap = F.lag("text").over(w).endswith("-") & F.col("text").rlike(r"(?U)^\p{Ll}")
    marked = inside.withColumn("_joint", F.when(F.lag("ord").over(w).isNull(), "").when(F.coalesce(new, F.lit(False)), "\n").when(wrap, "").otherwise(" ")).withColumn("_wrap", wrap)
    cut = F.when(F.lead("_joint").over(w).eqNullSafe("") & F.coalesce(F.lead("_wrap").over(w), F.lit(False)), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    rows = marked.withColumn("_piece", F.concat("_joint", cut)).groupBy("doc_id", key).agg(F.array_sort(F.collect_list(F.struct("ord", "_piece", "page_index"))).alias("l"))
    return rows.select("doc_id", key, F.array_join(F.transform("l", lambda x: x["_piece"]), "").alias("text"), F.array_distinct(F.transform("l", lambda x: x["page_index"] + 1)).alias("pages"))


def clauses(lines: DataFrame, addresses: DataFrame, *, chapters: bool = False) -> DataFrame:
    """``addresses`` (doc_id, reference) with the clause's text and pages, or why there is none: every address stays."""
    body = body_lines(lines)
    parsed = addresses.select("doc_id", "reference").distinct().withColumn("a", parse_address(F.col("reference"))).select("doc_id", "reference", "a.*")
    spans = section_bounds(body, parsed.where("section is not null"), chapters=chapters)
    narrowed = marker_bounds(body, marker_bounds(body, spans.where("start is not null"), "letter", "item"), "sub", "subitem")
    texts = render(body, narrowed, "reference")
    code = F.when(F.col("section").isNull(), "bad_address").when(F.col("text").isNull(), "not_found")
    return parsed.join(texts, ["doc_id", "reference"], "left").select("doc_id", "reference", "text", "pages", code.alias("error_type"))


def standard_clauses(lines: DataFrame, pattern: str = r"^\s*RS[\s-]*0*(\d+)") -> DataFrame:
    """(doc_id, mark, next_reference, text, pages) of every RS clause."""
    body = body_lines(lines, 0.07, 0.09)
    spans = column_markers(body, pattern)
    return spans.join(render(body, spans, "mark"), ["doc_id", "mark"]).select("doc_id", "mark", "next_reference", "text", "pages")


def content_flags(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """Whether a span's pages (first_page to last_page) hold tables or images; pages: doc_id, page_index, has_table (null where unknown), has_image."""
    met = spans.join(pages, "doc_id").where("page_index between first_page and last_page")
    return met.groupBy("doc_id", "reference").agg(margins.kleene_or(F.col("has_table")).alias("contains_table"), F.bool_or("has_image").alias("contains_image"))
