import io
import random
import zipfile

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import citation, numbering, text
from quire.operators import chunking, spatial
from quire.plans import chunker, clauses, registry, standards
from quire.sources import files

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, small, duck, name):
    found = registry.QUERIES[name](spark, small)
    rows = sorted(map(tuple, found.select(sorted(found.columns)).collect()), key=repr)
    assert rows
    if name in registry.SQL:
        result = duck.execute(registry.SQL[name])
        columns = [c[0] for c in result.description]
        order = [columns.index(c) for c in sorted(columns)]
        assert sorted(columns) == sorted(found.columns)
        assert rows == sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def test_chunks_have_ids_and_a_bound(spark, small):
    rows = registry.QUERIES["doc_chunks"](spark, small).collect()
    assert len({r["chunk_id"] for r in rows}) == len(rows) and all(len(r["text"]) <= 3000 for r in rows)


@given(st.text(alphabet="ab. !?", max_size=200), st.integers(5, 40))
@settings(max_examples=300, deadline=None)
def test_split_keeps_tokens_and_bound(s, limit):
    parts = chunking.split_oversize(s, limit)
    assert "".join("".join(parts).split()) == "".join(s.split())
    assert len(s) <= limit or all(len(p) <= limit for p in parts)


def test_exact_multiple_is_not_repeated():
    assert chunking.split_oversize("ab " + "x" * 20 + ".", 10)[:2] == ["ab", "x" * 10]
    assert chunking.split_oversize("ab " + "x" * 20, 10) == ["ab", "x" * 10, "x" * 10]
    assert chunking.pack_parts(["a" * 1500, "b" * 1498, "c"]) == ["a" * 1500 + "\n\n" + "b" * 1498, "c"]


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first()["x"]


def test_citations(spark):
    names = lambda s: [r["canonical"] for r in one(spark, s, citation.references)]
    assert names("ARP4754A 5.4.3 a(8), (9)") == ["ARP4754 5.4.3 a(8)", "ARP4754 5.4.3 a(9)"]
    assert names("ENG-STD-011 RS036 and DO-297 5.3 e") == ["ENG-STD-011 RS36", "DO-297 5.3 e"]
    assert one(spark, "ENG-STD-011 RS036 and DO-297 5.3 e", citation.residuals) == []
    assert names("see Annex Q") == [] and one(spark, "see Annex Q", citation.residuals) == ["see Annex Q"]
    assert names(None) == []


def test_text_and_numbers(spark):
    assert one(spark, "a\r\n  b\t\tc \r\r d", text.clean_cell) == "a\nb c\nd"
    assert one(spark, "Rev 12 of 30 ", text.edge_fingerprint) == "rev # of #"
    assert one(spark, "100 Mbps link", numbering.section_number) == "100"
    assert one(spark, "4.3. x", numbering.malformed_prefix) == "4.3."
    assert one(spark, "yes ", text.yes_no) == "Yes"


def test_nested_boxes(spark):
    rows = [("d", 0, 0.0, 0.0, 10.0, 10.0, "a"), ("d", 1, 0.1, 0.1, 9.9, 9.9, "longer"), ("d", 2, 20.0, 0.0, 30.0, 5.0, "c")]
    df = spark.createDataFrame(rows, "doc string, ord int, x0 double, y0 double, x1 double, y1 double, text string")
    assert sorted(r["text"] for r in spatial.drop_nested(df, ["doc"], ["ord"]).collect()) == ["c", "longer"]


def docx(rows):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda c: "<w:tc>" + "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in c.split("\n")) + "</w:tc>"
    body = "".join("<w:tr>" + "".join(map(cell, r)) + "</w:tr>" for r in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:tbl>{body}</w:tbl></w:body></w:document>")
    return out.getvalue()


def test_requirements(spark, tmp_path):
    rows = [("ID", "Specification", "Rationale", "Req"), ("NIO-1", "4 A", "", ""), ("NIO-2", "4.1 B", "", ""), ("NIO-3", "4.3 C", "", ""), ("NIO-3", "x", "why", "yes"), ("X", "4.3.1.1 D", "", "maybe"), ("a", "b")]
    (tmp_path / "r.docx").write_bytes(docx(rows))
    cells = files.read_docx(spark, str(tmp_path / "r.docx"))
    records = standards.requirements(cells).orderBy("ord").collect()
    assert [r["section_number"] for r in records] == ["4", "4.1", "4.3", "4.3", "4.3.1.1"] and records[3]["req"] == "Yes"
    warned = {(r["code"], r["detail"]) for r in standards.requirement_warnings(cells).collect()}
    assert warned == {("missing_sibling", "4.2"), ("missing_parent", "4.3.1"), ("duplicate_id", "NIO-3"), ("bad_id", "X"), ("unknown_req", "maybe"), ("cell_count", "2")}


def test_checklist_and_enrichment(spark):
    head = list(standards.COLUMNS)
    rows = [(4, head), (5, ["COR-1", "Plans", None, None, None]), (6, ["cor-1.1", "x", "d", "ARP4754A 5.1 a, DO-297 9.9 and Annex Q", "all"]), (7, ["COR-1.2", "y", None, "ARP 4754 5.1 a", None]), (8, ["COR-2.1", "z", None, "DO-297 9.9", None]), (9, [])]
    sheet = spark.createDataFrame([("f", "Correctness Checklist", n, c) for n, c in rows], "file string, sheet string, excel_row int, cells array<string>")
    records = standards.checklist(sheet)
    got = {r["number"]: r for r in records.collect()}
    assert got["COR-1.1"]["parent_title"] == "Plans" and got["COR-1.1"]["reference_unparsed"] == ["and Annex Q"]
    assert {(r["excel_row"], r["code"]) for r in standards.checklist_warnings(sheet).collect()} == {(8, "orphan_item")}
    known = spark.createDataFrame([("5.1 a", "clause text")], "target string, content string")
    out = {r["number"]: r for r in standards.enrich(records, "number", {"ARP4754": lambda t: t.join(known, "target", "left"), "DO297": lambda t: t.join(known, "target", "left")}).collect()}
    assert [(e["retrieval_status"], e["content"], e["error_type"]) for e in out["COR-1.1"]["enriched"]] == [("ok", "clause text", None), ("error", None, "not_found")]
    assert out["COR-1.2"]["has_issue"] is False and out["COR-2.1"]["has_issue"] and len(out) == 4


def layout(spark, rows):
    full = [("d", p, i, t, float(x), float(y), x + 200.0, y + 10.0, 1000.0, 1000.0, float(f), b) for i, (p, t, x, y, f, b) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id string, page_index int, ord long, text string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double, font_size double, bold boolean")


def test_clauses(spark):
    lines = layout(spark, [(0, "header", 100, 10, 8, False), (0, "5.1 Scope", 100, 100, 12, True), (0, "a. first off-the-", 100, 112, 10, False), (0, "shelf part", 100, 124, 10, False), (0, "b. other column", 200, 136, 10, False), (0, "c. last", 110, 148, 10, False), (1, "5.2 Next", 100, 100, 12, True)])
    got = {r["reference"]: r for r in clauses.clauses(lines, spark.createDataFrame([("d", "5.1 a"), ("d", "5.1"), ("d", "9.9 b"), ("d", "Annex Q")], "doc_id string, reference string")).collect()}
    assert got["5.1 a"]["text"] == "a. first off-theshelf part\nb. other column"
    assert got["5.1"]["text"].startswith("5.1 Scope") and got["5.1"]["pages"] == [1]
    assert (got["9.9 b"]["error_type"], got["Annex Q"]["error_type"]) == ("not_found", "bad_address")


def test_a_bare_integer_ends_no_section(spark):
    lines = layout(spark, [(0, "5.1 Scope", 100, 100, 12, True), (0, "a. first", 100, 112, 10, False), (0, "5 items follow", 100, 124, 12, True), (0, "5.2 Next", 100, 136, 12, True)])
    got = clauses.clauses(lines, spark.createDataFrame([("d", "5.1")], "doc_id string, reference string")).first()
    assert got["text"].endswith("5 items follow")


def test_ids_are_upper_case(spark, tmp_path):
    (tmp_path / "r.docx").write_bytes(docx([("nio-3", "4 A", "", ""), ("NIO-3", "4.1 B", "", "")]))
    cells = files.read_docx(spark, str(tmp_path / "r.docx"))
    assert [r["id"] for r in standards.requirements(cells).collect()] == ["NIO-3", "NIO-3"]
    assert ("duplicate_id", "NIO-3") in {(r["code"], r["detail"]) for r in standards.requirement_warnings(cells).collect()}


def test_standard_clauses(spark):
    lines = layout(spark, [(0, "RS001 one", 100, 100, 10, True), (0, "text", 100, 112, 10, False), (0, "RS002 two", 102, 124, 10, True), (0, "RS009 elsewhere", 500, 136, 10, True)])
    got = {r["mark"]: r for r in clauses.standard_clauses(lines).collect()}
    assert got[1]["text"] == "RS001 one text" and got[1]["next_reference"] == 2


def test_jsonl(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), path)
    assert files.read_jsonl(spark, path, "a int, b string").collect() == [(1, None)]
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_jsonl(spark.createDataFrame([(1,)], "a int"), path)
    (tmp_path / "bad.jsonl").write_text("[1]\n")
    with pytest.raises(Exception, match="not a JSON object"):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a int").collect()


def test_whole_document_chunks(spark):
    body = lambda p, y, t: (p, t, 100, y, 10, False)
    rows = [(p, f"Running head {p}", 100, 20, 8, False) for p in range(4)]
    rows += [(0, "CONTENTS", 100, 120, 12, True), (1, "4 Safety", 100, 150, 12, True), body(1, 200, "First para-"), body(1, 211, "graph goes on."), body(1, 300, "Second one."), (2, "4.1.1 2 Repaired title", 100, 150, 12, True), body(2, 200, "Text below."), (3, "4.2", 100, 150, 12, True), (3, "Split title", 100, 161, 12, True), body(3, 250, "x " * 400)]
    toc = spark.createDataFrame([("d", "4 Safety", "toc", None), ("d", "4.1.1.2 Repaired title", "bookmark", 3), ("d", "9 Gone", "bookmark", 3)], "doc_id string, title string, source string, page_number int")
    lines = layout(spark, rows)
    got = chunker.chunks(lines, toc, max_chars=500).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["section_title"]) for r in got] == [("d-4-TEXT-001", "Safety"), ("d-4.1.1.2-TEXT-001", "Repaired title"), ("d-4.2-TEXT-001", "Split title"), ("d-4.2-TEXT-002", "Split title")]
    assert got[0]["text"] == "First para-graph goes on.\n\nSecond one." and got[0]["page_start"] == 2
    assert {(r["number"], r["code"]) for r in chunker.bookmark_warnings(chunker.headings(chunker.placed(lines), toc), toc).collect()} == {("9", "missing")}


def test_missing_parents_is_its_sql_where_rows_share_a_place(spark, tmp_path):
    """Part keys a million apart put a parent and its child in one place; keys may be null."""
    rnd = random.Random(4)
    odd = lambda v: None if rnd.random() < 0.05 else v
    lines = [(odd(o), odd(rnd.randrange(4) + 1_000_000 * rnd.randrange(3)), odd(rnd.randrange(1, 8))) for o in range(150) for _ in range(5)]
    lines += [(1000, 1_000_003, 1), (1000, 3, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = con.execute(f"SELECT l_orderkey, ord, parent, has_relative FROM ({registry.SQL['missing_parents']})").fetchall()
    got = registry.QUERIES["missing_parents"](spark, str(tmp_path)).select("l_orderkey", "ord", "parent", "has_relative").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and 1000 not in {r["l_orderkey"] for r in got}
