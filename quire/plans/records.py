"""Queries over events and the order tables, on natural or derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import citation as C
from quire.functions import numbering as N
from quire.functions import text as T
from quire.operators import boundaries, margins, sequence, spatial


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def section_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last sign-up event of a user at or before each event."""
    signup = F.when(F.col("event_type") == "signup", F.col("event_id"))
    return sequence.carry_forward(_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], signup, "section").select("event_id", "user_id", "section")


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return _table(spark, sf_dir, "events").select("event_id", "user_id", F.concat_ws(".", (k % 4 + 1).cast("string"), F.floor("value").cast("string")).alias("number"))


def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sequence.order_violations(_numbers(spark, sf_dir), ["user_id"], ["event_id"], N.parts(F.col("number")))
    return found.select("event_id", "user_id", "number", N.dotted(F.col("_before")).alias("previous"))


def sibling_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("n"))
    return sequence.sibling_gaps(lines, ["l_orderkey"], "n").withColumn("missing", N.missing_siblings(F.col("l_orderkey").cast("string"), F.col("first_missing"), F.col("last_missing")))


def _dotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber").cast("long") * 1_000_000 + F.col("l_partkey")).alias("ord"), (F.col("l_partkey") % 5).alias("a"), F.col("l_linenumber").cast("long").alias("b")).distinct()
    return lines.select("l_orderkey", "ord", F.when(F.col("b") % 2 == 1, F.array("a")).otherwise(F.array("a", "b")).alias("number"))


def missing_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = boundaries.missing_parents(_dotted(spark, sf_dir), ["l_orderkey"], "ord", "number")
    return found.select("l_orderkey", "ord", N.dotted(F.col("parent")).alias("parent"), "has_relative")


def dotted_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading order of dotted numbers within an order: by parts, not as text."""
    rows = _dotted(spark, sf_dir).select("l_orderkey", "ord", N.dotted(F.col("number")).alias("number")).withColumn("_k", N.parts(F.col("number")))
    return sequence.counter(rows, ["l_orderkey"], ["_k", "ord"], "place").select("l_orderkey", "ord", "number", F.col("place").cast("long").alias("place"))


def citation_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    s = lambda c: c.cast("string")
    cell = (
        F.when(p % 4 == 0, F.concat(F.lit("ARP4754A 5."), s(p % 9), F.lit("."), s(p % 7), F.lit(" a(8), (9)")))
        .when(p % 4 == 1, F.concat(F.lit("ENG-STD-011 RS0"), s(p % 50 + 1), F.lit(" and DO-297 5."), s(p % 8), F.lit(" e")))
        .when(p % 4 == 2, F.concat(F.lit("see Annex Q; DO-297 4."), s(p % 6), F.lit(" b, DO-297 4."), s(p % 6), F.lit(" b")))
        .otherwise(F.concat(F.lit("ARP 4754 6."), s(p % 5), F.lit(" / part "), s(p)))
    )
    cells = _table(spark, sf_dir, "part").select("p_partkey", cell.alias("cell"))
    return cells.select("p_partkey", F.array_join(F.transform(C.references(F.col("cell")), lambda r: r["canonical"]), "; ").alias("canonical"), F.array_join(C.residuals(F.col("cell")), "; ").alias("residual"))


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("o_orderkey") % 17 == 0
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, "unknown").otherwise("CUST-1").alias("document"), F.when(bad, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("target"))


def enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reference with its content or the reason why there is none; every input row stays."""
    content = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("target"), F.col("c_name").alias("content"))
    joined = _references(spark, sf_dir).withColumn("known", C.document_key(F.col("document")) == "CUST1").join(content, "target", "left")
    ok = F.col("known") & F.col("content").isNotNull()
    return joined.select("o_orderkey", F.when(ok, "ok").otherwise("error").alias("status"), F.when(ok, F.col("content")).alias("content"), F.when(~F.col("known"), "unknown_document").when(F.col("content").isNull(), "not_found").alias("error_type"))


def enrich_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = enrich_left_join(spark, sf_dir)
    # One row per target of a known document, and one for all references to others.
    refs = outcome.join(_references(spark, sf_dir).select("o_orderkey", F.when(F.col("document") == "CUST-1", F.col("target")).alias("target")), "o_orderkey")
    per = refs.groupBy("target").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "ok").alias("ok"))
    known, total = F.col("target").isNotNull(), lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(total("n").alias("records"), total("n").alias("occurrences"), total("ok").alias("ok"), total(F.col("n") - F.col("ok")).alias("errors"), total(F.when(known, 0).otherwise(F.col("n"))).alias("unparsed"), total(F.col("n") - F.col("ok")).alias("records_with_issues"), F.count("target").alias("unique_retrievals"), total(F.when(known, F.col("n") - 1)).alias("cache_hits"))


def parent_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region as parent title; a slice has a region that does not exist."""
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 7 == 0, 99).otherwise(F.col("n_regionkey")).alias("r_regionkey"))
    return nations.join(_table(spark, sf_dir, "region"), "r_regionkey", "left").select("n_nationkey", F.col("r_name").alias("parent_title"), F.col("r_name").isNull().alias("orphan"))


def longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part the longest outline number that starts its own, and the last outline row of that number; all parts make the outline."""
    parts = _table(spark, sf_dir, "part").select("p_partkey", F.array(F.col("p_size") % 5, F.col("p_size") % 3, (F.col("p_partkey") % 7).cast("int")).alias("number"))
    outline = parts.select(F.explode(F.array(F.slice("number", 1, 1), F.when(F.col("p_partkey") % 3 == 0, F.slice("number", 1, 2)))).alias("number"), F.col("p_partkey").alias("ord")).where("number is not null")
    last = outline.groupBy("number").agg(F.max("ord").alias("ord"))
    return boundaries.longest_prefix(parts, last, "p_partkey", "number").select("p_partkey", N.dotted(F.col("prefix")).alias("prefix"), "entry")


def next_peer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next event of the user whose value differs by at most ten."""
    return boundaries.next_peer(_table(spark, sf_dir, "events"), ["user_id"], "event_id", "value", 10.0).select("event_id", "user_id", "next_row")


def column_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    support = boundaries.column_support(_table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type", "value", 5.0)
    return boundaries.best_supported(support, ["user_id"], "event_id")


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").alias("x0"), F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("y0"), (F.col("l_quantity") + 12).alias("x1"), (F.floor(F.col("l_discount") * 100 + 0.5) + F.floor(F.col("l_tax") * 100 + 0.5) + 2).cast("double").alias("y1"))


def region_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(spark, sf_dir)
    return spatial.overlapping(boxes.where("l_linenumber > 2"), boxes.where("l_linenumber <= 2"), ["l_orderkey"], 0.45).select("l_orderkey", "l_partkey", "l_linenumber")


def nearest_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each customer the supplier of its nation whose balance is nearest."""
    left = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    right = _table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    return spatial.nearest(left, right, ["nation"], "c_custkey", "c_acctbal", "s_suppkey", "s_acctbal", width=10.0).select("c_custkey", "s_suppkey", F.round("distance", 6).alias("distance"))


def nested_box_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.drop_nested(_boxes(spark, sf_dir).withColumn("text", F.col("l_partkey").cast("string")), ["l_orderkey"], ["y0", "x0", "l_partkey", "l_linenumber"])


def visual_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.visual_rows(_boxes(spark, sf_dir).withColumn("ord", F.col("l_partkey") * 100 + F.col("l_linenumber")), ["l_orderkey"])


def center_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.center_rows(_boxes(spark, sf_dir).withColumn("ord", F.col("l_partkey") * 100 + F.col("l_linenumber")), ["l_orderkey"])


def median_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = margins.median_mad(_table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice")
    return found.select("o_orderpriority", F.round("median", 4).alias("median"), F.round("mad", 4).alias("mad"))


def run_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = sequence.islands(_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", "run_id")
    return runs.groupBy("user_id", "run_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers with a running counter per supplier and flag."""
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    counted = sequence.counter(lines, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"], "n")
    return counted.select("l_orderkey", "l_linenumber", "l_partkey", T.chunk_id(F.concat(F.lit("SUPP/"), F.col("l_suppkey").cast("string")), F.lit(None).cast("string"), F.col("l_returnflag"), F.col("n")).alias("chunk_id"))


def table_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's nations as a table; a cell holds a separator and a line end."""
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    nations = _table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(rows.alias("r"))
    cells = F.transform("r", lambda x: F.array(x["n_nationkey"].cast("string"), F.concat(x["n_name"], F.lit("|x\n y")), F.lit(None).cast("string")))
    return nations.select("n_regionkey", T.render_table(cells).alias("table_text"))


def event_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and orders of the same day of the month in one stream, orders first."""
    events = _table(spark, sf_dir, "events").select(F.dayofmonth("ts").alias("day"), F.lit(1).alias("priority"), F.col("event_id").alias("id"))
    orders = _table(spark, sf_dir, "orders").select(F.dayofmonth("o_orderdate").alias("day"), F.lit(0).alias("priority"), F.col("o_orderkey").alias("id"))
    chunk = F.struct("priority", F.floor(F.col("id") / 10_000).alias("block"))
    return sequence.chunked_counter(events.unionByName(orders), ["day"], chunk, ["priority", "id"], "place").select("day", "priority", "id", "place")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint, missing string")
    return _table(spark, sf_dir, "events").select("event_id", F.to_json(parsed, {"ignoreNullFields": "false"}).alias("json"))


QUERIES = {
    f.__name__: f
    for f in (section_carry_forward, order_violations, sibling_gaps, missing_parents, dotted_sort, citation_parse, enrich_left_join, enrich_counters, parent_title, longest_prefix, next_peer, column_support, region_overlap, nearest_region, nested_box_dedupe, visual_rows, center_rows, median_mad, run_islands, chunk_ids, table_render, event_merge, json_roundtrip)
}

_DOTTED = """d AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey AS ord, l_partkey % 5 AS a, CAST(l_linenumber AS BIGINT) AS b FROM lineitem),
k AS (SELECT l_orderkey, ord, CASE WHEN b % 2 = 1 THEN [a] ELSE [a, b] END AS number FROM d)"""
_BOXES = """bx AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS x0, floor(l_discount * 100 + 0.5::DOUBLE) AS y0, l_quantity + 12 AS x1, floor(l_discount * 100 + 0.5::DOUBLE) + floor(l_tax * 100 + 0.5::DOUBLE) + 2 AS y1 FROM lineitem)"""
_REFS = """r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE 'CUST-1' END AS document, CASE WHEN o_orderkey % 17 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS target FROM orders),
j AS (SELECT o_orderkey, document, target, c_name, document = 'CUST-1' AS known FROM r LEFT JOIN customer ON c_custkey = target)"""
_CITE = r"""c AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ARP4754A 5.' || (p_partkey % 9) || '.' || (p_partkey % 7) || ' a(8), (9)' WHEN 1 THEN 'ENG-STD-011 RS0' || (p_partkey % 50 + 1) || ' and DO-297 5.' || (p_partkey % 8) || ' e'
  WHEN 2 THEN 'see Annex Q; DO-297 4.' || (p_partkey % 6) || ' b, DO-297 4.' || (p_partkey % 6) || ' b' ELSE 'ARP 4754 6.' || (p_partkey % 5) || ' / part ' || p_partkey END AS cell FROM part),
m AS (SELECT p_partkey, cell, unnest(regexp_extract_all(cell, '(?i)(?:\bARP\s*4754[A-Z]?\s+\d+(?:\.\d+)+(?:\s+[a-z]\b(?:\s*\(\d+\)(?:\s*,?\s*\(\d+\))*)?)?|\bENG[\s-]*STD[\s-]*011\s+RS[\s-]*\d+|\bDO[\s-]*297\s+\d+(?:\.\d+)+(?:\s+[a-z]\b)?)')) AS hit, generate_subscripts(regexp_extract_all(cell, '(?i)(?:\bARP\s*4754[A-Z]?\s+\d+(?:\.\d+)+(?:\s+[a-z]\b(?:\s*\(\d+\)(?:\s*,?\s*\(\d+\))*)?)?|\bENG[\s-]*STD[\s-]*011\s+RS[\s-]*\d+|\bDO[\s-]*297\s+\d+(?:\.\d+)+(?:\s+[a-z]\b)?)'), 1) AS i FROM c)"""

_OVER = "least(b{0}, y1) - greatest(t{0}, y0) >= 0.35::DOUBLE * least(greatest(y1 - y0, 1), b{0} - t{0})"
_ITEMS = "SELECT *, l_partkey * 100 + l_linenumber AS ord FROM bx"

SQL = {
    "nested_box_dedupe": rf"""WITH RECURSIVE {_BOXES}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY y0, x0, l_partkey, l_linenumber) AS i, {{'l_partkey': l_partkey, 'l_linenumber': l_linenumber, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'text': CAST(l_partkey AS VARCHAR)}} AS b FROM bx),
f AS (SELECT l_orderkey, i, [b] AS kept FROM n WHERE i = 1 UNION ALL
  SELECT l_orderkey, i, CASE WHEN hit IS NULL THEN list_append(kept, b) ELSE list_transform(kept, lambda k, j: CASE WHEN j = hit AND length(b.text) > length(k.text) THEN {{'l_partkey': k.l_partkey, 'l_linenumber': k.l_linenumber, 'x0': k.x0, 'y0': k.y0, 'x1': k.x1, 'y1': k.y1, 'text': b.text}} ELSE k END) END
  FROM (SELECT n.l_orderkey, n.i, n.b, f.kept, list_position(list_transform(f.kept, lambda k: least(k.x1, n.x1) > greatest(k.x0, n.x0) AND least(k.y1, n.y1) > greatest(k.y0, n.y0) AND least((k.x1 - k.x0) * (k.y1 - k.y0), (n.x1 - n.x0) * (n.y1 - n.y0)) > 0
    AND (least(k.x1, n.x1) - greatest(k.x0, n.x0)) * (least(k.y1, n.y1) - greatest(k.y0, n.y0)) / least((k.x1 - k.x0) * (k.y1 - k.y0), (n.x1 - n.x0) * (n.y1 - n.y0)) >= 0.95::DOUBLE), true) AS hit FROM f JOIN n ON n.l_orderkey = f.l_orderkey AND n.i = f.i + 1)),
e AS (SELECT l_orderkey, unnest(kept) AS k FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY i DESC) = 1) SELECT l_orderkey, k.l_partkey AS l_partkey, k.l_linenumber AS l_linenumber, k.x0 AS x0, k.y0 AS y0, k.x1 AS x1, k.y1 AS y1, k.text AS text FROM e""",
    "visual_rows": rf"""WITH RECURSIVE {_BOXES}, n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (y0 + y1) / 2, x0, ord) AS i FROM ({_ITEMS})),
f AS (SELECT l_orderkey, i, 1 AS n_rows, 0 AS row_no, y0 AS t1, y1 AS b1, CAST(NULL AS DOUBLE) AS t2, CAST(NULL AS DOUBLE) AS b2, CAST(NULL AS DOUBLE) AS t3, CAST(NULL AS DOUBLE) AS b3 FROM n WHERE i = 1 UNION ALL
  SELECT l_orderkey, i, CASE WHEN j = 0 THEN n_rows + 1 ELSE n_rows END, CASE WHEN j = 0 THEN n_rows ELSE n_rows - j END,
    CASE j WHEN 0 THEN y0 WHEN 1 THEN least(t1, y0) ELSE t1 END, CASE j WHEN 0 THEN y1 WHEN 1 THEN greatest(b1, y1) ELSE b1 END,
    CASE j WHEN 0 THEN t1 WHEN 2 THEN least(t2, y0) ELSE t2 END, CASE j WHEN 0 THEN b1 WHEN 2 THEN greatest(b2, y1) ELSE b2 END,
    CASE j WHEN 0 THEN t2 WHEN 3 THEN least(t3, y0) ELSE t3 END, CASE j WHEN 0 THEN b2 WHEN 3 THEN greatest(b3, y1) ELSE b3 END
  FROM (SELECT f.l_orderkey, n.i, n_rows, y0, y1, t1, b1, t2, b2, t3, b3, CASE WHEN {_OVER.format(1)} THEN 1 WHEN n_rows > 1 AND {_OVER.format(2)} THEN 2 WHEN n_rows > 2 AND {_OVER.format(3)} THEN 3 ELSE 0 END AS j FROM f JOIN n ON n.l_orderkey = f.l_orderkey AND n.i = f.i + 1))
SELECT n.l_orderkey, l_partkey, l_linenumber, x0, y0, x1, y1, ord, row_no FROM n JOIN f ON f.l_orderkey = n.l_orderkey AND f.i = n.i""",
    "center_rows": rf"""WITH RECURSIVE {_BOXES}, n AS (SELECT *, (y0 + y1) / 2 AS c, greatest(1.5::DOUBLE, 0.3::DOUBLE * median(y1 - y0) OVER (PARTITION BY l_orderkey)) AS tol, row_number() OVER (PARTITION BY l_orderkey ORDER BY y0, x0, ord) AS i FROM ({_ITEMS})),
f AS (SELECT l_orderkey, i, 0 AS row_no, c AS total, 1 AS k FROM n WHERE i = 1 UNION ALL
  SELECT n.l_orderkey, n.i, CASE WHEN abs(c - total / k) <= tol THEN row_no ELSE row_no + 1 END, CASE WHEN abs(c - total / k) <= tol THEN total + c ELSE c END, CASE WHEN abs(c - total / k) <= tol THEN k + 1 ELSE 1 END FROM f JOIN n ON n.l_orderkey = f.l_orderkey AND n.i = f.i + 1)
SELECT n.l_orderkey, l_partkey, l_linenumber, x0, y0, x1, y1, ord, row_no FROM n JOIN f ON f.l_orderkey = n.l_orderkey AND f.i = n.i""",
    "section_carry_forward": "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM events",
    "order_violations": """WITH n AS (SELECT event_id, user_id, [CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 + 1, CAST(floor(value) AS BIGINT)] AS k FROM events), b AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM n)
SELECT event_id, user_id, array_to_string(k, '.') AS number, array_to_string(before, '.') AS previous FROM b WHERE k < before""",
    "sibling_gaps": """WITH n AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS n FROM lineitem), g AS (SELECT l_orderkey, lag(n) OVER (PARTITION BY l_orderkey ORDER BY n) + 1 AS first_missing, n - 1 AS last_missing FROM n)
SELECT l_orderkey, first_missing, last_missing, CASE WHEN last_missing - first_missing < 5 THEN array_to_string(list_transform(range(first_missing, last_missing + 1), lambda x: l_orderkey || '.' || x), ', ') ELSE l_orderkey || '.' || first_missing || ' through ' || l_orderkey || '.' || last_missing END AS missing FROM g WHERE first_missing <= last_missing""",
    "missing_parents": f"""WITH {_DOTTED}, f AS (SELECT l_orderkey, number[1] AS a, min(ord) AS seen, min(CASE WHEN len(number) = 1 THEN ord END) AS parent_at FROM k GROUP BY l_orderkey, number[1])
SELECT k.l_orderkey, ord, CAST(number[1] AS VARCHAR) AS parent, seen < ord AS has_relative FROM k JOIN f ON k.l_orderkey = f.l_orderkey AND k.number[1] = f.a WHERE len(number) = 2 AND (parent_at IS NULL OR parent_at > ord)""",
    "dotted_sort": f"WITH {_DOTTED} SELECT l_orderkey, ord, array_to_string(number, '.') AS number, row_number() OVER (PARTITION BY l_orderkey ORDER BY number, ord) AS place FROM k",
    "citation_parse": rf"""WITH {_CITE}, s AS (SELECT p_partkey, i, hit, regexp_extract(hit, '\s(\d+(?:\.\d+)+)', 1) AS section, lower(regexp_extract(hit, '(?i)\s\d+(?:\.\d+)+\s+([a-z])', 1)) AS item, regexp_extract_all(hit, '\((\d+)\)', 1) AS subs FROM m),
t AS (SELECT p_partkey, i, CASE WHEN hit ILIKE 'ARP%' AND len(subs) > 0 THEN list_transform(subs, lambda x: 'ARP4754 ' || section || ' ' || item || '(' || x || ')') WHEN hit ILIKE 'ARP%' THEN ['ARP4754 ' || section || CASE WHEN item = '' THEN '' ELSE ' ' || item END]
  WHEN hit ILIKE 'ENG%' THEN ['ENG-STD-011 RS' || CAST(regexp_extract(hit, 'RS[\s-]*(\d+)', 1) AS BIGINT)] ELSE ['DO-297 ' || section || CASE WHEN item = '' THEN '' ELSE ' ' || item END] END AS names FROM s),
u AS (SELECT p_partkey, i, unnest(names) AS name, generate_subscripts(names, 1) AS j FROM t), f AS (SELECT p_partkey, name, min(i * 100 + j) AS spot FROM u GROUP BY p_partkey, name),
a AS (SELECT p_partkey, string_agg(name, '; ' ORDER BY spot) AS canonical FROM f GROUP BY p_partkey)
SELECT p_partkey, canonical, CASE p_partkey % 4 WHEN 2 THEN 'see Annex Q' WHEN 3 THEN 'part ' || p_partkey ELSE '' END AS residual FROM a""",
    "enrich_left_join": f"WITH {_REFS} SELECT o_orderkey, CASE WHEN known AND c_name IS NOT NULL THEN 'ok' ELSE 'error' END AS status, CASE WHEN known THEN c_name END AS content, CASE WHEN NOT known THEN 'unknown_document' WHEN c_name IS NULL THEN 'not_found' END AS error_type FROM j",
    "enrich_counters": f"WITH {_REFS} SELECT count(*) AS records, count(*) AS occurrences, count(*) FILTER (known AND c_name IS NOT NULL) AS ok, count(*) FILTER (NOT (known AND c_name IS NOT NULL)) AS errors, count(*) FILTER (NOT known) AS unparsed, count(*) FILTER (NOT (known AND c_name IS NOT NULL)) AS records_with_issues, count(DISTINCT target) FILTER (known) AS unique_retrievals, count(*) FILTER (known) - count(DISTINCT target) FILTER (known) AS cache_hits FROM j",
    "parent_title": "SELECT n_nationkey, r_name AS parent_title, r_name IS NULL AS orphan FROM nation LEFT JOIN region ON r_regionkey = CASE WHEN n_nationkey % 7 = 0 THEN 99 ELSE n_regionkey END",
    "longest_prefix": """WITH t AS (SELECT p_partkey, [CAST(p_size % 5 AS BIGINT), CAST(p_size % 3 AS BIGINT), p_partkey % 7] AS number FROM part), o AS (SELECT number, max(ord) AS ord FROM (SELECT number[1:1] AS number, p_partkey AS ord FROM t UNION ALL SELECT number[1:2], p_partkey FROM t WHERE p_partkey % 3 = 0) GROUP BY number),
m AS (SELECT t.p_partkey, o.number, o.ord, row_number() OVER (PARTITION BY t.p_partkey ORDER BY len(o.number) DESC, o.ord DESC) AS rn FROM t JOIN o ON t.number[1:len(o.number)] = o.number)
SELECT t.p_partkey, array_to_string(m.number, '.') AS prefix, m.ord AS entry FROM t LEFT JOIN m ON t.p_partkey = m.p_partkey AND rn = 1""",
    "next_peer": "SELECT a.event_id, a.user_id, min(b.event_id) AS next_row FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.event_id > a.event_id AND abs(b.value - a.value) <= 10 GROUP BY a.event_id, a.user_id",
    "column_support": """WITH s AS (SELECT a.user_id, a.event_id, count(DISTINCT b.event_type) AS support FROM events a JOIN events b ON a.user_id = b.user_id AND abs(b.value - a.value) <= 5 GROUP BY a.user_id, a.event_id)
SELECT user_id, event_id, support FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY support DESC, event_id) = 1""",
    "region_overlap": f"""WITH {_BOXES} SELECT l_orderkey, l_partkey, l_linenumber FROM bx l WHERE l_linenumber > 2 AND EXISTS (SELECT 1 FROM bx r WHERE r.l_orderkey = l.l_orderkey AND r.l_linenumber <= 2
  AND greatest(least(l.x1, r.x1) - greatest(l.x0, r.x0), 0) * greatest(least(l.y1, r.y1) - greatest(l.y0, r.y0), 0) / ((l.x1 - l.x0) * (l.y1 - l.y0)) >= 0.45::DOUBLE)""",
    "nearest_region": "SELECT c_custkey, s_suppkey, round(abs(s_acctbal - c_acctbal), 6) AS distance FROM customer JOIN supplier ON s_nationkey = c_nationkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY abs(s_acctbal - c_acctbal), s_acctbal, s_suppkey) = 1",
    "median_mad": """WITH m AS (SELECT o_orderpriority, median(o_totalprice) AS med FROM orders GROUP BY o_orderpriority) SELECT o_orderpriority, round(any_value(med), 4) AS median, round(median(abs(o_totalprice - med)), 4) AS mad FROM orders JOIN m USING (o_orderpriority) GROUP BY o_orderpriority""",
    "run_islands": """WITH r AS (SELECT user_id, event_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM events) SELECT user_id, run_id, count(*) AS n, min(event_id) AS first_event FROM r GROUP BY user_id, run_id""",
    "chunk_ids": "SELECT l_orderkey, l_linenumber, l_partkey, printf('SUPP_%d-UNSECTIONED-%s-%03d', l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey)) AS chunk_id FROM lineitem",
    "table_render": r"SELECT n_regionkey, string_agg(n_nationkey || ' | ' || n_name || '\|x y | ', chr(10) ORDER BY n_nationkey) AS table_text FROM nation GROUP BY n_regionkey",
    "event_merge": """WITH u AS (SELECT CAST(day(ts) AS INTEGER) AS day, 1 AS priority, event_id AS id FROM events UNION ALL SELECT CAST(day(o_orderdate) AS INTEGER), 0, o_orderkey FROM orders) SELECT day, priority, id, row_number() OVER (PARTITION BY day ORDER BY priority, id) AS place FROM u""",
    "json_roundtrip": """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"missing":null}' AS json FROM events""",
}
