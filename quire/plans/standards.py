"""Requirement tables, review checklists and their enrichment with clause text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import citation as C
from quire.functions import numbering as N
from quire.functions import text as T
from quire.operators import boundaries

#: The columns of a checklist sheet, and its sheets with the prefix of their numbers.
COLUMNS = ("Number", "List Value", "Description", "References", "Applicability", "Pass/Fail", "Comments", "Checker")
SHEETS = {"Correctness Checklist": "COR", "Completeness Checklist": "CPL"}
HEADER_ROW = 4
#: The spellings of each known document, letters and digits only.
ALIASES = {"ARP4754": "ARP4754", "ARP4754A": "ARP4754", "ARP4754B": "ARP4754", "DO297": "DO297", "ENGSTD011": "ENGSTD011"}


def requirement_rows(cells: DataFrame) -> DataFrame:
    """Rows of four cells that are neither blank nor headers, with an order column; cells are cleaned."""
    cleaned = cells.withColumn("cells", F.transform("cells", lambda c: T.clean_cell(F.coalesce(c, F.lit("")))))
    kept = cleaned.where(F.exists("cells", lambda c: c != "") & ~F.lower(F.trim(F.coalesce(F.get("cells", F.lit(0)), F.lit("")))).isin("id", "identifier", "nio id", "nio-id"))
    return kept.withColumn("ord", F.col("table_no").cast("long") * 1_000_000_000 + F.col("row_no"))


def requirements(cells: DataFrame) -> DataFrame:
    """Records of a requirement table: type, the section in force, canonical Req; the table's order is kept in ``ord``."""
    rows = requirement_rows(cells).where(F.size("cells") == 4)
    own = N.section_number(F.get("cells", F.lit(1)))
    w = Window.partitionBy("file").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        "file", "ord", F.upper(F.get("cells", F.lit(0))).alias("id"), N.record_type(F.get("cells", F.lit(1))).alias("type"), F.last(own, ignorenulls=True).over(w).alias("section_number"),
        F.get("cells", F.lit(1)).alias("specification"), F.nullif(F.get("cells", F.lit(2)), F.lit("")).alias("rationale"), T.yes_no(F.get("cells", F.lit(3))).alias("req"),
        F.struct("file", F.col("table_no").alias("table"), F.col("row_no").alias("word_row")).alias("source"),
    )


def requirement_warnings(cells: DataFrame) -> DataFrame:
    """(file, ord, code, detail): row and numbering checks as a relation."""
    rows, records = requirement_rows(cells), requirements(cells)
    seen = Window.partitionBy("file", "id").orderBy("ord")
    headers = records.where("type = 'section_header'").select("file", "ord", "section_number", N.parts(F.col("section_number")).alias("number"))
    order, twin = Window.partitionBy("file").orderBy("ord"), Window.partitionBy("file", "section_number").orderBy("ord")
    parent = F.slice("number", 1, F.size("number") - 1)
    last = F.element_at("number", -1)
    siblings = headers.withColumn("parent", parent).withColumn("last", last).withColumn("before", F.lag("last").over(Window.partitionBy("file", "parent").orderBy("ord")))
    warn = lambda df, code, detail: df.select("file", "ord", F.lit(code).alias("code"), detail.cast("string").alias("detail"))
    found = [
        warn(rows.where(F.size("cells") != 4), "cell_count", F.size("cells")),
        warn(records.where(~N.item_id_ok(F.col("id"))), "bad_id", F.col("id")),
        warn(records.where("specification = ''"), "empty_specification", F.col("id")),
        warn(records.where("req is not null and req not in ('Yes', 'No')"), "unknown_req", F.col("req")),
        warn(records.where("id <> ''").withColumn("n", F.row_number().over(seen)).where("n > 1"), "duplicate_id", F.col("id")),
        warn(records.withColumn("m", N.malformed_prefix(F.col("specification"))).where("m is not null and type = 'requirement'"), "malformed_number", F.col("m")),
        warn(headers.withColumn("n", F.row_number().over(twin)).where("n > 1"), "duplicate_section", F.col("section_number")),
        warn(headers.withColumn("b", F.lag("number").over(order)).where("number < b"), "descending_section", F.col("section_number")),
        warn(siblings.where("last - before > 1"), "missing_sibling", N.missing_siblings(N.dotted(F.col("parent")), F.col("before") + 1, F.col("last") - 1)),
        warn(boundaries.missing_parents(headers, ["file"], "ord", "number"), "missing_parent", N.dotted(F.col("parent"))),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def checklist(rows: DataFrame) -> DataFrame:
    """Records of the two checklist sheets: titles and items with parent titles and parsed citations."""
    sheet = F.create_map(*[F.lit(x) for pair in SHEETS.items() for x in pair])
    cell = lambda i: F.nullif(T.strip(F.regexp_replace(F.get("cells", F.lit(i)), "\r\n?", "\n")), F.lit(""))
    body = rows.where(F.col("sheet").isin(*SHEETS) & (F.col("excel_row") > HEADER_ROW)).select("file", "sheet", "excel_row", *[cell(i).alias(n) for i, n in enumerate(("number", "list_value", "description", "reference_raw", "applicability"))]).where("coalesce(number, list_value, description, reference_raw, applicability) is not null")
    upper = F.upper("number")
    records = body.withColumn("checklist_type", sheet[F.col("sheet")]).withColumn("number", upper).withColumn("row_type", F.when(~F.contains("number", F.lit(".")), "title").otherwise("item")).withColumn("parent_number", F.when(F.col("row_type") == "item", F.split_part("number", F.lit("."), F.lit(1))))
    titles = records.where("row_type = 'title'").groupBy("file", "sheet", F.col("number").alias("parent_number")).agg(F.min_by("list_value", "excel_row").alias("parent_title"))
    return records.join(titles, ["file", "sheet", "parent_number"], "left").select("file", "sheet", "checklist_type", "excel_row", "number", "row_type", "parent_number", "parent_title", "list_value", "description", "reference_raw", C.references(F.col("reference_raw")).alias("references"), C.residuals(F.col("reference_raw")).alias("reference_unparsed"), "applicability")


def checklist_warnings(rows: DataFrame) -> DataFrame:
    """(file, sheet, excel_row, code): header, number, duplicate and orphan checks."""
    header = rows.where(F.col("sheet").isin(*SHEETS) & (F.col("excel_row") == HEADER_ROW))
    want = F.array(*[F.lit(" ".join(c.lower().split())) for c in COLUMNS])
    got = F.transform(F.slice("cells", 1, len(COLUMNS)), lambda c: T.header_name(F.coalesce(c, F.lit(""))))
    records = checklist(rows)
    twin = Window.partitionBy("file", "sheet", "number").orderBy("excel_row")
    ok = F.lit(False)
    for s, prefix in SHEETS.items():
        ok = ok | ((F.col("sheet") == s) & N.list_number_ok(F.coalesce("number", F.lit("")), prefix))
    warn = lambda df, code: df.select("file", "sheet", "excel_row", F.lit(code).alias("code"))
    return (
        warn(header.where(got != want), "header_mismatch")
        .unionByName(warn(records.where(~ok), "bad_number"))
        .unionByName(warn(records.withColumn("n", F.row_number().over(twin)).where("n > 1"), "duplicate_number"))
        .unionByName(warn(records.where("row_type = 'item' and parent_title is null"), "orphan_item"))
    )


def enrich(records: DataFrame, key: str, resolvers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``records`` with ``enriched``: an outcome for each of its references, in order; every record stays.

    A resolver is a table function by document family: given distinct (target), it returns (target, content), the
    content null where there is none. Each distinct pair is resolved once, however many records cite it.
    """
    alias = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    refs = records.select(F.col(key).alias("_key"), F.posexplode("references").alias("pos", "ref"))
    refs = refs.withColumn("family", alias[C.document_key(F.col("ref.document"))]).withColumn("target", T.strip(F.col("ref.target")))
    wanted = refs.where("family is not null and target <> ''").select("family", "target").distinct()
    found = None
    for family, resolve in resolvers.items():
        part = resolve(wanted.where(F.col("family") == family).select("target")).select(F.lit(family).alias("family"), "target", "content")
        found = part if found is None else found.unionByName(part)
    joined = refs.join(found, ["family", "target"], "left") if found is not None else refs.withColumn("content", F.lit(None).cast("string"))
    code = F.when(F.col("family").isNull(), "unknown_document").when(F.coalesce("target", F.lit("")) == "", "blank_target").when(F.trim(F.coalesce("content", F.lit(""))) == "", "not_found")
    outcome = F.struct("pos", F.col("ref.document").alias("document"), F.col("ref.target").alias("target"), F.col("ref.canonical").alias("canonical"), F.when(code.isNull(), "ok").otherwise("error").alias("retrieval_status"), F.when(code.isNull(), F.col("content")).alias("content"), code.alias("error_type"))
    lists = joined.groupBy("_key").agg(F.array_sort(F.collect_list(outcome)).alias("enriched"))
    return records.join(lists, records[key] == lists["_key"], "left").drop("_key").withColumn("has_issue", F.exists(F.coalesce("enriched", F.expr("array()").cast(lists.schema["enriched"].dataType)), lambda r: r["retrieval_status"] == "error") | (F.size(F.coalesce("reference_unparsed", F.array().cast("array<string>"))) > 0))
