"""Whole-document chunking of layout lines: headings, sections, paragraphs, chunks.

lines: doc_id, page_index, ord, text, x0, y0, x1, y1, page_width, page_height, font_size, bold.
toc: doc_id, title, source ("toc" or "bookmark"), page_number (null where unknown).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import layout as L
from quire.functions import text as T
from quire.operators import chunking, margins, sequence

_NUMBERED = r"^\s*(\d+(?:\.\d+)*)\.?\s+(\S.*)$"
_LONE = r"^\s*(\d+(?:\.\d+)+)\s*$"
#: Page titles of navigation pages.
NAVIGATION = ("contents", "table of contents", "index", "list of figures", "list of tables")
#: Titles of front matter.
FRONT = r"^(?:disclaimer|foreword|preface|introduction to \w+ standards)$"
#: Weak and strong title similarity; the heading column; the score from which a candidate is accepted.
WEAK, STRONG, COLUMN, ACCEPT = 0.35, 0.60, 0.20, 4.0


def placed(lines: DataFrame) -> DataFrame:
    """Cleaned lines with text, their ratios, an edge distance bucket and the document's body font (median of body lines)."""
    y = G.ratio((F.col("y0") + F.col("y1")) / 2, F.col("page_height"))
    rows = lines.withColumn("text", T.clean_text(F.col("text"))).where("text <> ''").withColumn("x_ratio", G.ratio(F.col("x0"), F.col("page_width"))).withColumn("y_ratio", y)
    font = rows.groupBy("doc_id").agg(F.coalesce(F.median(F.when(F.col("y_ratio").between(0.1, 0.9), F.col("font_size"))), F.median("font_size"), F.lit(10.0)).alias("body_font"))
    return rows.join(font, "doc_id")


def running_text(rows: DataFrame, band: float = 0.105) -> DataFrame:
    """(doc_id, ord) of lines in an edge band that recur, but for numbers, at the same distance on three pages (on two where there are under five)."""
    near = rows.where((F.col("y_ratio") <= band) | (F.col("y_ratio") >= 1 - band))
    keyed = near.withColumn("edge", F.when(F.col("y_ratio") <= band, "top").otherwise("bottom")).withColumn("fp", T.edge_fingerprint(F.col("text"))).withColumn("bucket", F.rint(F.least("y_ratio", 1 - F.col("y_ratio")) / 0.01).cast("int"))
    pages = rows.groupBy("doc_id").agg(F.countDistinct("page_index").alias("n_pages"))
    often = keyed.groupBy("doc_id", "edge", "fp", "bucket").agg(F.countDistinct("page_index").alias("n")).join(pages, "doc_id").where(F.col("n") >= F.when(F.col("n_pages") < 5, 2).otherwise(3))
    return keyed.join(often, ["doc_id", "edge", "fp", "bucket"], "left_semi").select("doc_id", "ord")


def furniture() -> Column:
    """Page numbers and running headers, by their own form."""
    header = L.running_header(F.col("text"), F.col("x_ratio"), F.col("y_ratio"), F.col("font_size"), F.col("body_font"))
    return header | L.page_footer(F.col("text"), F.col("x0"), F.col("x1"), F.col("page_width"), F.col("y_ratio"))


def suspicious_margins(rows: DataFrame, top: float, bottom: float) -> DataFrame:
    """(doc_id, page_index, preview): pages whose margins drop text of 24 characters or more that does not recur, with the first two such lines."""
    dropped = rows.where(~G.in_band(F.col("y_ratio"), top, bottom) & ~furniture() & (F.length("text") >= 24))
    own = dropped.join(running_text(rows), ["doc_id", "ord"], "left_anti").join(navigation_pages(rows), ["doc_id", "page_index"], "left_anti")
    first = F.slice(F.array_sort(F.collect_list(F.struct("y0", "x0", "ord", "text"))), 1, 2)
    return own.groupBy("doc_id", "page_index").agg(F.array_join(F.transform(first, lambda x: x["text"]), " / ").alias("preview"))


def front_matter_titles(rows: DataFrame) -> DataFrame:
    """(doc_id, page_index, title): the first line of a page that is a title of front matter."""
    return rows.where(T.normal(F.col("text")).rlike(FRONT)).groupBy("doc_id", "page_index").agg(F.min_by("text", F.struct("y0", "x0", "ord")).alias("title"))


def caption_lines(lines: DataFrame, captions: DataFrame) -> DataFrame:
    """``lines`` (with block) of each caption (doc_id, page_index, block, caption: the ord of its first line): on from the first until a gap of over .8 of its height, or a section number."""
    first = captions.join(lines.select("doc_id", F.col("ord").alias("caption"), F.greatest(F.col("y1") - F.col("y0"), F.lit(1.0)).alias("_height")), ["doc_id", "caption"])
    by = ["doc_id", "page_index", "block", "caption"]
    inside = lines.join(first, ["doc_id", "page_index", "block"]).where("ord >= caption")
    gap = F.col("y0") - F.lag("y1").over(Window.partitionBy(*by).orderBy("ord"))
    marked = inside.withColumn("_end", (F.col("ord") > F.col("caption")) & ((gap > 0.8 * F.col("_height")) | F.col("text").rlike(_NUMBERED) | F.col("text").rlike(_LONE)))
    return sequence.take_while(marked, by, ["ord"], F.col("_end")).drop("_height", "_end")


def navigation_pages(rows: DataFrame) -> DataFrame:
    """(doc_id, page_index) with a contents title, or four leader and six numbered lines."""
    leader = F.col("text").rlike(r"\.{3,}|(?:\. ){3,}")
    pages = rows.groupBy("doc_id", "page_index").agg(F.bool_or(T.normal(F.col("text")).isin(*NAVIGATION)).alias("titled"), F.count_if(leader).alias("leaders"), F.count_if(F.col("text").rlike(r"^\s*\d+(?:\.\d+)*\s")).alias("numbered"))
    return pages.where("titled or (leaders >= 4 and numbered >= 6)").select("doc_id", "page_index")


def evidence(toc: DataFrame) -> DataFrame:
    """(doc_id, number, ev_words, source, page_number) of numbered contents and bookmark entries."""
    numbered = toc.where(F.col("title").rlike(_NUMBERED))
    return numbered.select("doc_id", F.regexp_extract("title", _NUMBERED, 1).alias("number"), T.words(T.toc_title(F.regexp_extract("title", _NUMBERED, 2))).alias("ev_words"), "source", "page_number")


def candidates(rows: DataFrame, toc: DataFrame) -> DataFrame:
    """Heading candidates with score: numbered rows, and lone numbers that take the next bold row as title; a missing dot is repaired where the repaired number has evidence."""
    w = Window.partitionBy("doc_id", "page_index").orderBy("y0", "x0", "ord")
    nxt = lambda c: F.lead(c).over(w)
    height = F.col("y1") - F.col("y0")
    takes = F.col("text").rlike(_LONE) & (nxt("y0") - F.col("y1") <= F.greatest(F.lit(4.0), 0.65 * height)) & nxt("bold") & (nxt("x_ratio") <= COLUMN) & ~nxt("text").rlike(_NUMBERED)
    named = rows.withColumn("title", F.when(takes, nxt("text")).otherwise(F.nullif(F.regexp_extract("text", _NUMBERED, 2), F.lit("")))).withColumn("title_ord", F.when(takes, nxt("ord")))
    named = named.withColumn("number", F.when(takes, F.regexp_extract("text", _LONE, 1)).otherwise(F.regexp_extract("text", _NUMBERED, 1))).where("title is not null and number <> ''").where(~F.col("text").rlike(r"\.{3,}"))
    known = evidence(toc)
    digit = F.nullif(F.regexp_extract("title", r"^(\d+)\s+\S", 1), F.lit(""))
    forms = F.array_compact(F.array(F.struct(F.lit(0).alias("fix"), F.col("number").alias("n"), F.col("title").alias("t")), F.when(digit.isNotNull(), F.struct(F.lit(1).alias("fix"), F.concat_ws(".", "number", digit).alias("n"), F.regexp_replace("title", r"^\d+\s+", "").alias("t")))))
    each = named.select("doc_id", "ord", F.explode(forms).alias("f")).select("doc_id", "ord", "f.fix", F.col("f.n").alias("number"), F.col("f.t").alias("t"))
    met = each.join(known, ["doc_id", "number"]).withColumn("sim", T.similarity(T.words(F.col("t")), F.col("ev_words")))
    best = met.where(F.col("sim") >= WEAK).groupBy("doc_id", "ord").agg(F.max_by(F.struct("fix", "number", "t", "sim"), F.struct("fix", "sim")).alias("e"), F.array_sort(F.collect_set("source")).alias("sources"))
    joined = named.join(best, ["doc_id", "ord"], "left")
    number, title, sim = F.coalesce("e.number", "number"), F.coalesce("e.t", "title"), F.coalesce("e.sim", F.lit(0.0))
    sources = F.coalesce("sources", F.array().cast("array<string>"))
    points = (
        (F.col("bold"), 2.0), (F.col("font_size") >= F.col("body_font") - 0.25, 1.0), (F.col("x_ratio") <= COLUMN, 1.0), (F.array_contains(sources, "toc"), 3.0), (F.array_contains(sources, "bookmark"), 3.0), (sim >= STRONG, 0.5),
        (L.upper_case(title) & (F.length(title) <= 120), 0.25), ((F.col("y_ratio") < 0.095) & (F.col("font_size") < F.col("body_font") - 0.5), -2.0), (F.length(title) > 220, -1.5),
    )
    score = sum((F.when(c, p).otherwise(0.0) for c, p in points), F.lit(0.0))
    return joined.select("doc_id", "page_index", "ord", "title_ord", "y0", "x0", "x_ratio", number.alias("section_number"), title.alias("section_title"), score.alias("score"), (F.size(sources) > 0).alias("has_evidence"), (F.coalesce("e.fix", F.lit(0)) == 1).alias("source_typo")).where((F.col("x_ratio") <= COLUMN) & (F.col("has_evidence") | F.contains("section_number", F.lit("."))))


def headings(rows: DataFrame, toc: DataFrame, top: float = 0.0, bottom: float = 0.0) -> DataFrame:
    """Accepted headings: score of four, and evidence or a place in the learned column; the first of each number counts. Margins, running text, page numbers and running headers hold none."""
    inside = rows.where(G.in_band(F.col("y_ratio"), top, bottom) & ~furniture()).join(running_text(rows), ["doc_id", "ord"], "left_anti")
    body = inside.join(navigation_pages(rows).groupBy("doc_id").agg(F.max("page_index").alias("nav")), "doc_id", "left").where("nav is null or page_index > nav").drop("nav")
    found = candidates(body, toc)
    learned = margins.median_mad(found.where("has_evidence"), ["doc_id"], "x_ratio").join(found.where("has_evidence").groupBy("doc_id").agg(F.count("*").alias("n")), "doc_id")
    cut = F.when(F.col("n") >= 3, F.greatest(F.lit(0.12), F.col("median") + F.least(F.greatest(0.020 + 3 * F.col("mad"), F.lit(0.025)), F.lit(0.050)))).otherwise(COLUMN)
    accepted = found.join(learned.select("doc_id", cut.alias("cutoff")), "doc_id", "left").where((F.col("score") >= ACCEPT) & (F.col("has_evidence") | (F.col("x_ratio") <= F.coalesce("cutoff", F.lit(COLUMN)))))
    first = Window.partitionBy("doc_id", "section_number").orderBy("page_index", "y0", "x0")
    return accepted.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "cutoff")


def paragraphs(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, par_no, page, text): rows of a page joined as the gap, indent and list markers say; a hyphen at a line's end is kept."""
    w = Window.partitionBy(*by, "page_index").orderBy("y0", "x0", "ord")
    height = F.median(F.col("y1") - F.col("y0")).over(Window.partitionBy(*by, "page_index"))
    listed = F.col("text").rlike(r"^\s*(?:[•▪\-–]|\(?[A-Za-z0-9]{1,3}[.)])\s")
    new = (F.col("y0") - F.lag("y1").over(w) > 0.38 * height) | (F.abs(F.col("x_ratio") - F.lag("x_ratio").over(w)) > 0.045) | listed
    wrap = F.lag("text").over(w).endswith("-") & F.col("text").rlike(r"(?U)^\p{Ll}")
    flagged = rows.withColumn("_new", F.coalesce(new, F.lit(True))).withColumn("_piece", F.concat(F.when(F.coalesce(new, F.lit(True)), "").when(wrap, "").otherwise(" "), F.col("text")))
    runs = sequence.islands(flagged, [*by], ["page_index", "y0", "x0", "ord"], F.col("_new"), "par_no")
    return runs.groupBy(*by, "par_no").agg(F.min("page_index").alias("page"), F.array_sort(F.collect_list(F.struct("page_index", "y0", "x0", "ord", "_piece"))).alias("l")).select(*by, "par_no", "page", F.array_join(F.transform("l", lambda x: x["_piece"]), "").alias("text"))


def chunks(lines: DataFrame, toc: DataFrame, *, max_chars: int = chunking.MAX_CHARS, top: float = 0.09, bottom: float = 0.03) -> DataFrame:
    """(chunk_id, document, content_type, section_number, section_title, page_start, page_end, text), pages from 1.

    Running text, margins and navigation pages are left out. A heading ends a run of text and is carried forward to
    what follows it; within a run paragraphs are packed up to the limit.
    """
    if max_chars < 500:
        raise ValueError("chunks hold 500 characters or more")
    rows = placed(lines)
    heads = headings(rows, toc, top, bottom)
    used = heads.select("doc_id", F.explode(F.array_compact(F.array("ord", "title_ord"))).alias("ord"))
    nav = navigation_pages(rows)
    body = rows.join(running_text(rows), ["doc_id", "ord"], "left_anti").join(nav, ["doc_id", "page_index"], "left_anti").where(G.in_band(F.col("y_ratio"), top, bottom) & ~furniture())
    text = body.join(used, ["doc_id", "ord"], "left_anti").withColumn("head", F.lit(None).cast("struct<number:string,title:string>"))
    marks = heads.join(rows.select("doc_id", "ord", *[c for c in rows.columns if c not in heads.columns]), ["doc_id", "ord"]).withColumn("head", F.struct(F.col("section_number").alias("number"), F.col("section_title").alias("title")))
    events = text.select(*rows.columns, "head").unionByName(marks.select(*rows.columns, "head"))
    order = ["page_index", "y0", "x0", "ord"]
    carried = sequence.islands(sequence.carry_forward(events, ["doc_id"], order, F.col("head"), "section"), ["doc_id"], order, F.col("head").isNotNull(), "run_id").where("head is null")
    parts = paragraphs(carried, ["doc_id", "run_id", "section"])
    runs = parts.groupBy("doc_id", "run_id", "section").agg(F.array_sort(F.collect_list(F.struct("par_no", "page", "text"))).alias("p"))
    pieces = chunking.split_parts(runs.select("doc_id", "run_id", "section", F.posexplode("p").alias("i", "x")).select("doc_id", "run_id", "section", "i", F.col("x.page").alias("page"), F.col("x.text").alias("text")), "text", max_chars)
    flat = pieces.select("doc_id", "run_id", "section", "i", "page", F.posexplode("parts").alias("j", "part"))
    each = chunking.packed(flat.groupBy("doc_id", "run_id", "section").agg(F.array_sort(F.collect_list(F.struct("i", "j", "page", "part"))).alias("p")), "p", F.transform("p", lambda x: F.length(x["part"])), max_chars).withColumnRenamed("chunk_no", "at")
    done = each.select("doc_id", "run_id", "at", F.col("section.number").alias("section_number"), F.col("section.title").alias("section_title"), (F.array_min(F.transform("p", lambda x: x["page"])) + 1).alias("page_start"), (F.array_max(F.transform("p", lambda x: x["page"])) + 1).alias("page_end"), F.array_join(F.transform("p", lambda x: x["part"]), chunking.JOINT).alias("text"))
    counted = sequence.counter(done, ["doc_id", "section_number"], ["run_id", "at"], "n")
    return counted.select(T.chunk_id(F.col("doc_id"), F.col("section_number"), F.lit("TEXT"), F.col("n")).alias("chunk_id"), F.col("doc_id").alias("document"), F.lit("text").alias("content_type"), "section_number", "section_title", "page_start", "page_end", "text")


def bookmark_warnings(found: DataFrame, toc: DataFrame) -> DataFrame:
    """(doc_id, number, code): bookmarks without a heading, with another title, or more than two pages away."""
    known = evidence(toc).where("source = 'bookmark'")
    met = known.join(found.select("doc_id", F.col("section_number").alias("number"), "section_title", "page_index"), ["doc_id", "number"], "left")
    per = met.groupBy("doc_id", "number").agg(F.max(F.col("page_index").isNotNull()).alias("found"), F.max(T.similarity(F.col("ev_words"), T.words(F.coalesce("section_title", F.lit(""))))).alias("sim"), F.min(F.abs(F.col("page_number") - 1 - F.col("page_index"))).alias("away"))
    code: Column = F.when(~F.col("found"), "missing").when(F.col("sim") < WEAK, "different_title").when(F.col("away") > 2, "far_page")
    return per.select("doc_id", "number", code.alias("code")).where("code is not null")
