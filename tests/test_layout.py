"""Layout predicates and the plans' bounds on small pages."""

import pytest
from pyspark.sql import functions as F

from quire.functions import layout as L
from quire.operators import sequence, spatial
from quire.plans import chunker, clauses

SPANS = "array<struct<text:string,x0:double,x1:double,size:double>>"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(value, kind):
    return F.lit(value).cast(kind)


def spans(*items):
    return F.array(*[F.struct(F.lit(t).alias("text"), F.lit(float(a)).alias("x0"), F.lit(float(b)).alias("x1"), F.lit(float(z)).alias("size")) for t, a, b, z in items])


@pytest.mark.parametrize(
    "items, text",
    [
        ([("RS1", 0, 20, 10), ("Body", 40, 60, 10)], "RS1 Body"),
        ([("a", 0, 5, 10), ("b", 6.5, 9, 10)], "ab"),
        ([("a", 0, 5, 10), ("b", 7, 9, 10)], "a b"),
        ([("a ", 0, 5, 10), ("b", 50, 59, 10)], "a b"),
        ([("a", 0, 5, 10), ("", 6, 7, 99), ("b", 8, 9, 10)], "a b"),
    ],
)
def test_span_text(spark, items, text):
    assert one(spark, L.span_text(spans(*items))) == text


def test_no_spans_are_empty_text(spark):
    assert one(spark, L.span_text(F.array().cast(SPANS))) == ""
    assert one(spark, L.letter_token(F.array().cast(SPANS), F.lit(1.0), 0.01)) is None


@pytest.mark.parametrize(
    "items, text, gap, number",
    [
        ([("5.4.", 0, 9, 10), ("Title", 30, 60, 10)], "5.4. Title", 0.03, "5.4"),
        ([("5.4.", 0, 9, 10), ("Title", 30, 60, 10)], "5.4. Title", 0.001, None),
        ([("5.4", 0, 9, 10)], "5.4", 0.03, None),
        ([("5.4", 0, 9, 10), ("Title", 30, 60, 10)], "5.4 Title .... 7", 0.03, None),
        ([("5.4", 0, 9, 10), ("Title", 30, 60, 10), ("7", 70, 72, 10)], "5.4 Title 7", 0.03, None),
        ([("5.4", 0, 9, 10), ("Title", 30, 60, 10), ("7", 64, 66, 10)], "5.4 Title 7", 0.03, "5.4"),
    ],
)
def test_section_token(spark, items, text, gap, number):
    assert one(spark, L.section_token(F.lit(text), spans(*items), F.lit(100.0), F.lit(gap), 0.01)) == number


def test_letter_token(spark):
    assert one(spark, L.letter_token(spans(("B.", 0, 5, 10), ("x", 20, 30, 10)), F.lit(0.03), 0.01)) == "b"


@pytest.mark.parametrize("text, x0, y, found", [("xii", 48, 0.92, True), ("12", 48, 0.95, True), ("12", 48, 0.91, False), ("12", 20, 0.95, False), ("Page 12", 48, 0.95, False)])
def test_page_footer(spark, text, x0, y, found):
    assert one(spark, L.page_footer(F.lit(text), F.lit(x0), F.lit(x0 + 4), F.lit(100), F.lit(y))) is found


@pytest.mark.parametrize("text, x, y, font, found", [("ACME REPORT 7 - PAGE 3", 0.1, 0.05, 10.0, True), ("ACME REPORT 7 - PAGE 3", 0.1, 0.2, 10.0, False), ("2.0 SYSTEM", 0.4, 0.1, 9.0, True), ("2.0 SYSTEM", 0.4, 0.1, 10.0, False), ("2.0 System", 0.4, 0.1, 9.0, False)])
def test_running_header(spark, text, x, y, font, found):
    assert one(spark, L.running_header(F.lit(text), F.lit(x), F.lit(y), F.lit(font), F.lit(10.0))) is found


def test_images_appendices_and_locations(spark):
    image = lambda *box: one(spark, L.readable_image(*[lit(v, "double") for v in box], F.lit(600.0), F.lit(800.0)))
    assert image(0, 0, 60, 60) and not image(0, 0, 19, 400) and not image(0, 0, 40, 40) and image(None, 0, 60, 60) is False
    strong = lambda text, x, bold: one(spark, L.appendix_strength(F.lit(text), F.lit(x), F.lit(10.0), F.lit(10.0), F.lit(bold)))
    assert strong("APPENDIX É", 0.2, False) and strong("Appendix A", 0.2, True) and not strong("Appendix A", 0.2, False) and not strong("APPENDIX A", 0.3, True)
    assert one(spark, L.location(F.lit(2), F.lit(7))) == "table 2, row 7"


def test_take_while(spark):
    df = spark.createDataFrame([(1, 1, False), (1, 2, None), (1, 3, True), (1, 4, False), (2, 1, True)], "g int, o int, s boolean")
    assert [tuple(r)[:2] for r in sequence.take_while(df, ["g"], ["o"], F.col("s")).orderBy("o").collect()] == [(1, 1), (1, 2)]
    assert sequence.take_while(df.limit(0), ["g"], ["o"], F.col("s")).collect() == []


def test_merge_rows(spark):
    items = [(1, 0, 2, "right", 50.0, 11.0, 90.0, 20.0, 9.0, True, False), (1, 0, 1, "left", 5.0, 10.0, 40.0, 21.0, 11.0, False, False), (1, 1, 3, "next", 5.0, 30.0, 40.0, 41.0, 11.0, False, True)]
    made = spatial.merge_rows(spark.createDataFrame(items, "page int, row_no int, ord int, text string, x0 double, y0 double, x1 double, y1 double, font_size double, bold boolean, italic boolean"), ["page"])
    rows = [tuple(r) for r in made.orderBy("row_no").collect()]
    assert rows == [(1, 0, "left right", 5.0, 10.0, 90.0, 21.0, 11.0, True, False), (1, 1, "next", 5.0, 30.0, 40.0, 41.0, 11.0, False, True)]


LINE = "doc_id string, page_index int, block int, ord int, text string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, font_size double, bold boolean"


def page(spark, *items):
    return spark.createDataFrame([("d", p, 1, i, t, float(x), float(y), float(x + 100), float(y + 10), 600.0, 800.0, 10.0, b) for i, (p, t, x, y, b) in enumerate(items)], LINE)


def test_margin_text_that_does_not_recur_is_reported(spark):
    lines = page(spark, (0, "A whole sentence that stands in the margin", 60, 20, False), (0, "short", 60, 5, False), (0, "Body text in the middle of the page", 60, 400, False))
    assert [tuple(r) for r in chunker.suspicious_margins(chunker.placed(lines), 0.09, 0.03).collect()] == [("d", 0, "A whole sentence that stands in the margin")]


def test_front_matter_and_captions(spark):
    lines = page(spark, (0, "Foreword", 60, 100, True), (0, "Table 1 Values", 60, 200, False), (0, "of all sensors", 60, 212, False), (0, "not a part", 60, 260, False))
    assert [tuple(r) for r in chunker.front_matter_titles(chunker.placed(lines)).collect()] == [("d", 0, "Foreword")]
    captions = spark.createDataFrame([("d", 0, 1, 1)], "doc_id string, page_index int, block int, caption int")
    assert sorted(r.ord for r in chunker.caption_lines(lines, captions).collect()) == [1, 2]


def test_a_numbered_running_header_is_no_heading(spark):
    lines = page(spark, *[(p, f"{p + 1}.0 ACME", 60, 40, True) for p in range(3)], (0, "1.1 Scope", 60, 300, True), (0, "Text of the scope section follows here", 60, 330, False))
    toc = spark.createDataFrame([("d", t, "toc", None) for t in ("1.0 Acme", "1.1 Scope")], "doc_id string, title string, source string, page_number int")
    assert [r.section_number for r in chunker.headings(chunker.placed(lines), toc, 0.09, 0.03).collect()] == ["1.1"]


def test_a_bold_section_ends_a_marker_and_a_chapter_ends_a_section(spark):
    lines = page(spark, (0, "RS1 first", 60, 100, True), (0, "body", 60, 112, False), (0, "4.2 Section", 60, 140, True), (0, "RS2 second", 60, 160, True))
    found = {r.mark: (r.text, r.next_reference) for r in clauses.standard_clauses(lines).collect()}
    assert found == {1: ("RS1 first body", None), 2: ("RS2 second", None)}
    lines = page(spark, (0, "4.2 Section", 60, 100, True), (0, "body", 60, 120, False), (0, "CHAPTER 5", 60, 140, False), (0, "other", 60, 160, False))
    asked = spark.createDataFrame([("d", "4.2")], "doc_id string, reference string")
    text = lambda chapters: clauses.clauses(lines, asked, chapters=chapters).first().text
    assert "other" in text(False) and "other" not in text(True) and "body" in text(True)
