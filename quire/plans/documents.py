"""Queries over documents, pages, benchmark items and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import chunking, margins, sequence

#: A line in so many documents is a repeated one.
REPEATED = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line, fingerprint): cleaned lines that are not empty."""
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    cleaned = lines.select("doc_id", "pos", T.clean_text(F.col("raw")).alias("line")).where("line <> ''")
    return cleaned.withColumn("fingerprint", T.edge_fingerprint(F.col("line")))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return margins.repeated_lines(doc_lines(spark, sf_dir), "fingerprint", "doc_id", REPEATED)


def strip_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = doc_lines(spark, sf_dir)
    return lines.join(repeated_lines(spark, sf_dir), "fingerprint", "left_anti").select("doc_id", "pos", "line")


def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, as chunks of at most 3000 characters with stable ids."""
    lines = strip_repeated_lines(spark, sf_dir)
    parts = lines.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("parts"))
    chunks = chunking.chunk_parts(parts, "parts").select("doc_id", F.posexplode("chunks").alias("n", "text"))
    document = F.concat(F.lit("DOC"), F.col("doc_id").cast("string"))
    return chunks.select(
        T.chunk_id(document, F.lit(None).cast("string"), F.lit("TEXT"), F.col("n") + 1).alias("chunk_id"), document.alias("document"), F.lit("text").alias("content_type"),
        F.lit(None).cast("string").alias("section_number"), F.lit(None).cast("string").alias("section_title"), F.lit(1).alias("page_start"), F.lit(1).alias("page_end"), "text",
    )


def chunk_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy packing alone: a part beyond the limit is a chunk of its own."""
    lines = doc_lines(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"))
    chunks = chunking.packed(lines, "lines", F.transform("lines", lambda x: F.length(x["line"])))
    return chunks.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), T.chunk_id(F.concat(F.lit("DOC"), F.col("doc_id").cast("string")), F.lit(None).cast("string"), F.lit("TEXT"), F.col("chunk_no")).alias("chunk_id"), F.size("lines").cast("long").alias("n_parts"), F.array_join(F.transform("lines", lambda x: x["line"]), chunking.JOINT).alias("text"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", T.clean_cell(F.col("text")).alias("cell"), T.clean_text(F.col("text")).alias("clean"))


def oversize_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _table(spark, sf_dir, "documents").select("doc_id", "text").where(F.length("text") > chunking.MAX_CHARS)
    return chunking.split_parts(long, "text").select("doc_id", F.posexplode("parts").alias("part_no", "part"))


def paragraph_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines joined to paragraphs that end behind . ! or ?"""
    w = Window.partitionBy("doc_id").orderBy("pos")
    flagged = doc_lines(spark, sf_dir).withColumn("break", F.coalesce(F.lag("line").over(w).rlike("[.!?]$"), F.lit(False)))
    runs = sequence.islands(flagged, ["doc_id"], ["pos"], F.col("break"), "par_no")
    return runs.groupBy("doc_id", "par_no").agg(F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l")).select("doc_id", "par_no", "n_lines", F.array_join(F.transform("l", lambda x: x["line"]), " ").alias("text"))


def hyphen_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line with a hyphen put behind it and the next one: clause tools drop the hyphen, the chunker keeps it."""
    w = Window.partitionBy("doc_id").orderBy("pos")
    pairs = doc_lines(spark, sf_dir).select("doc_id", "pos", F.concat("line", F.lit("-")).alias("a"), F.lead("line").over(w).alias("b")).where("b is not null")
    wrapped = F.col("b").rlike(r"^[a-zà-öø-ÿ]")
    head = F.expr("substring(a, 1, length(a) - 1)")
    return pairs.select("doc_id", "pos", F.when(wrapped, F.concat(head, "b")).otherwise(F.concat_ws(" ", "a", "b")).alias("clause_text"), F.when(wrapped, F.concat("a", "b")).otherwise(F.concat_ws(" ", "a", "b")).alias("chunk_text"))


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda tag: F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1)
    return _table(spark, sf_dir, "pages").select("page_id", part("title").alias("title"), part("h1").alias("h1"))


def title_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _titles(spark, sf_dir).select("page_id", F.round(T.similarity(T.words(F.col("title")), T.words(F.col("h1"))), 9).alias("similarity"))


def best_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark item most similar to a page's title, ties to the smaller id; no item and 0 where none shares a word."""
    pages = _titles(spark, sf_dir).select("page_id", T.words(F.col("title")).alias("w"))
    items = _table(spark, sf_dir, "benchmark").select("item_id", T.words(F.col("text")).alias("w"))
    words = lambda df, key, size: df.select(key, F.size("w").alias(size), F.explode("w").alias("word"))
    met = words(pages, "page_id", "n").join(words(items, "item_id", "m"), "word").groupBy("page_id", "item_id").agg(F.count("*").alias("both"), F.first("n").alias("n"), F.first("m").alias("m"))
    met = met.select("page_id", "item_id", F.round(F.col("both") / (F.col("n") + F.col("m") - F.col("both")), 9).alias("similarity"))
    best = met.groupBy("page_id").agg(F.max_by(F.struct("item_id", "similarity"), F.struct("similarity", -F.col("item_id"))).alias("best"))
    return pages.select("page_id").join(best, "page_id", "left").select("page_id", "best.item_id", F.coalesce("best.similarity", F.lit(0.0)).alias("similarity"))


def bookmark_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as body headings against benchmark items as bookmarks of the same number: missing, or of little similarity."""
    items = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("key"), T.words(F.col("text")).alias("iw"))
    pages = _titles(spark, sf_dir).select(F.col("page_id").alias("key"), T.words(F.col("title")).alias("tw"))
    met = items.join(pages, "key", "left").withColumn("similarity", F.round(T.similarity(F.col("iw"), F.coalesce("tw", F.array().cast("array<string>"))), 9))
    return met.select("key", F.when(F.col("tw").isNull(), "missing").when(F.col("similarity") < 0.35, "different title").otherwise("same").alias("warning"), "similarity")


def keep_first_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sequence.keep_first(_table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest")), ["digest"], ["doc_id"])
    return found.select("doc_id", "digest", F.col("occurrence").cast("long").alias("occurrence"), "first_of")


def margin_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as a page's, at y = position / number of lines; repeated ones are its running text."""
    lines = doc_lines(spark, sf_dir)
    w = Window.partitionBy("doc_id")
    placed = lines.withColumn("y", F.row_number().over(w.orderBy("pos")) / F.count("*").over(w))
    flagged = placed.join(repeated_lines(spark, sf_dir), "fingerprint", "left").withColumn("repeated", F.col("pages").isNotNull())
    return margins.margin_suggestion(flagged, ["doc_id"], "repeated", "y")


def navigation_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leader-like and numbered lines by document."""
    lines = doc_lines(spark, sf_dir)
    found = lines.groupBy("doc_id").agg(F.count_if(F.col("line").rlike(r"\|")).alias("leaders"), F.count_if(F.col("line").rlike("[0-9]")).alias("numbered"), F.bool_or(F.lower("line").isin("contents", "table of contents", "index")).alias("titled"))
    return found.withColumn("navigation", F.col("titled") | ((F.col("leaders") >= 4) & (F.col("numbered") >= 1)))


def kleene_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether any document of a source is of low quality: unknown where none is and some are unlabelled."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).alias("flag"))
    joined = _table(spark, sf_dir, "documents").select("doc_id", "source", (F.col("doc_id") % 40).alias("bin")).join(labels, "doc_id", "left")
    return joined.groupBy("source", "bin").agg(margins.kleene_or(F.col("flag")).alias("contains_low"))


def heading_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as heading candidates: weights for capitals, a short line, no full stop, a first line, a digit start, a very long line."""
    line = F.col("line")
    weights = ((line.rlike("^[^a-z]+$"), 2.0), (F.length("line") <= 120, 1.0), (~line.rlike("[.!?]$"), 1.0), (F.col("pos") == 0, 3.0), (line.rlike("^[0-9]"), 0.5), (F.length("line") > 220, -1.5))
    score = sum((F.when(c, w).otherwise(0.0) for c, w in weights), F.lit(0.0))
    return doc_lines(spark, sf_dir).select("doc_id", "pos", score.alias("score"), (score >= 4.0).alias("accepted"))


def count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"))


def dialog_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return turns.select("conv_id", F.size("t").cast("long").alias("turns"), F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n").alias("dialog"))


QUERIES = {
    f.__name__: f
    for f in (doc_chunks, chunk_pack, clean_text, repeated_lines, strip_repeated_lines, oversize_split, paragraph_rebuild, hyphen_join, title_similarity, best_evidence, bookmark_disagreement, keep_first_dup, margin_suggest, navigation_flag, kleene_flags, heading_score, count_by_type, dialog_render)
}


def _clean(c: str) -> str:
    return rf"regexp_replace(regexp_replace(replace(regexp_replace({c}, '[\x{{0000}}\x{{FFFE}}\x{{FFFF}}\x{{00AD}}]', '', 'g'), chr(160), ' '), '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')"


def _words(c: str) -> str:
    return rf"list_distinct(list_filter(string_split(trim(regexp_replace(lower({_clean(c)}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> ''))"


def _similarity(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE ELSE round(CAST(len(list_intersect({a}, {b})) AS DOUBLE) / CAST(len(list_distinct(list_concat({a}, {b}))) AS DOUBLE), 9) END"


_LINES = rf"""l0 AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS raw FROM documents),
l1 AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, {_clean('raw')} AS line FROM l0),
l AS (SELECT doc_id, pos, line, regexp_replace(regexp_replace(regexp_replace(lower(line), '\d+', '#', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS fingerprint FROM l1 WHERE line <> ''),
rep AS (SELECT fingerprint, count(DISTINCT doc_id) AS pages FROM l GROUP BY fingerprint HAVING count(DISTINCT doc_id) >= {REPEATED})"""
_TITLES = r"t AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h1 FROM pages)"

def _split(source: str, limit: int = chunking.MAX_CHARS) -> str:
    """CTEs that end in parts(doc_id, pos, part_no, part): the texts of ``source`` (doc_id, pos, txt), all beyond the limit, cut at sentences, words and lengths.

    Units are sentences, or the words of sentences beyond the limit, of which the first opens a new part (cut).
    """
    return rf"""s0 AS (SELECT doc_id, pos, string_split(regexp_replace(txt, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM {source}),
s1 AS (SELECT doc_id, pos, unnest(range(len(ss))) AS si, unnest(ss) AS sentence FROM s0),
s2 AS (SELECT doc_id, pos, si, CASE WHEN length(sentence) <= {limit} THEN [sentence] ELSE list_filter(string_split_regex(sentence, '\s+'), lambda x: x <> '') END AS us, length(sentence) > {limit} AS long FROM s1),
s3 AS (SELECT doc_id, pos, si, long, unnest(range(len(us))) AS ui, unnest(us) AS unit FROM s2),
units AS (SELECT doc_id, pos, unit, length(unit) AS len, long AND ui = 0 AS cut, row_number() OVER (PARTITION BY doc_id, pos ORDER BY si, ui) AS i FROM s3),
walk AS (SELECT doc_id, pos, i, len // {limit} AS whole, len % {limit} AS size, CAST(0 AS BIGINT) AS base, false AS joins FROM units WHERE i = 1 UNION ALL
  SELECT u.doc_id, u.pos, u.i, CASE WHEN j THEN 0 ELSE u.len // {limit} END, CASE WHEN j THEN w.size + 1 + u.len ELSE u.len % {limit} END,
    CASE WHEN j THEN w.base + w.whole ELSE w.base + w.whole + CASE WHEN w.size > 0 THEN 1 ELSE 0 END END, j
  FROM (SELECT w.*, u.len AS ulen, NOT u.cut AND w.size > 0 AND w.size + 1 + u.len <= {limit} AS j FROM walk w JOIN units u ON u.doc_id = w.doc_id AND u.pos = w.pos AND u.i = w.i + 1) w
  JOIN units u ON u.doc_id = w.doc_id AND u.pos = w.pos AND u.i = w.i + 1),
pieces AS (SELECT doc_id, pos, i, base + k AS part_no, substr(unit, CAST(k * {limit} + 1 AS BIGINT), {limit}) AS piece FROM (SELECT w.doc_id, w.pos, w.i, base, unit, unnest(range(whole)) AS k FROM walk w JOIN units u ON u.doc_id = w.doc_id AND u.pos = w.pos AND u.i = w.i WHERE NOT joins)
  UNION ALL SELECT w.doc_id, w.pos, w.i, base + whole, CASE WHEN joins THEN unit ELSE substr(unit, CAST(whole * {limit} + 1 AS BIGINT)) END FROM walk w JOIN units u ON u.doc_id = w.doc_id AND u.pos = w.pos AND u.i = w.i WHERE joins OR size > 0),
parts AS (SELECT doc_id, pos, CAST(part_no AS INTEGER) AS part_no, string_agg(piece, ' ' ORDER BY i) AS part FROM pieces GROUP BY doc_id, pos, part_no)"""


SQL = {
    "doc_chunks": rf"""WITH RECURSIVE {_LINES}, kept AS (SELECT doc_id, pos, line AS txt FROM l WHERE fingerprint NOT IN (SELECT fingerprint FROM rep)), big AS (SELECT * FROM kept WHERE length(txt) > 3000), {_split('big')},
a AS (SELECT doc_id, pos, 0 AS part_no, txt AS part FROM kept WHERE length(txt) <= 3000 UNION ALL SELECT doc_id, pos, part_no, part FROM parts),
n AS (SELECT doc_id, part, length(part) AS size, row_number() OVER (PARTITION BY doc_id ORDER BY pos, part_no) AS i FROM a),
r AS (SELECT doc_id, i, 1 AS chunk_no, size FROM n WHERE i = 1 UNION ALL
  SELECT n.doc_id, n.i, CASE WHEN r.size + 2 + n.size <= 3000 THEN r.chunk_no ELSE r.chunk_no + 1 END, CASE WHEN r.size + 2 + n.size <= 3000 THEN r.size + 2 + n.size ELSE n.size END FROM r JOIN n ON n.doc_id = r.doc_id AND n.i = r.i + 1)
SELECT printf('DOC%d-UNSECTIONED-TEXT-%03d', n.doc_id, chunk_no) AS chunk_id, 'DOC' || n.doc_id AS document, 'text' AS content_type, CAST(NULL AS VARCHAR) AS section_number, CAST(NULL AS VARCHAR) AS section_title, 1 AS page_start, 1 AS page_end,
  string_agg(part, chr(10) || chr(10) ORDER BY n.i) AS text FROM n JOIN r ON n.doc_id = r.doc_id AND n.i = r.i GROUP BY n.doc_id, chunk_no""",
    "oversize_split": rf"""WITH RECURSIVE big AS (SELECT doc_id, 0 AS pos, text AS txt FROM documents WHERE length(text) > 3000), {_split('big')} SELECT doc_id, part_no, part FROM parts""",
    "chunk_pack": rf"""WITH RECURSIVE {_LINES}, n AS (SELECT doc_id, pos, line, length(line) AS size, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM l),
r AS (SELECT doc_id, i, 1 AS chunk_no, size FROM n WHERE i = 1 UNION ALL
  SELECT n.doc_id, n.i, CASE WHEN r.size + 2 + n.size <= 3000 THEN r.chunk_no ELSE r.chunk_no + 1 END, CASE WHEN r.size + 2 + n.size <= 3000 THEN r.size + 2 + n.size ELSE n.size END FROM r JOIN n ON n.doc_id = r.doc_id AND n.i = r.i + 1)
SELECT n.doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, printf('DOC%d-UNSECTIONED-TEXT-%03d', n.doc_id, chunk_no) AS chunk_id, count(*) AS n_parts, string_agg(line, chr(10) || chr(10) ORDER BY n.i) AS text FROM n JOIN r ON n.doc_id = r.doc_id AND n.i = r.i GROUP BY n.doc_id, chunk_no""",
    "clean_text": rf"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(replace(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(160), ' '), chr(10)), lambda x: regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')), lambda x: x <> ''), chr(10)) AS cell, {_clean('text')} AS clean FROM documents""",
    "repeated_lines": f"WITH {_LINES} SELECT fingerprint, pages FROM rep",
    "strip_repeated_lines": f"WITH {_LINES} SELECT doc_id, pos, line FROM l WHERE fingerprint NOT IN (SELECT fingerprint FROM rep)",
    "paragraph_rebuild": rf"""WITH {_LINES}, b AS (SELECT *, CASE WHEN regexp_matches(lag(line) OVER (PARTITION BY doc_id ORDER BY pos), '[.!?]$') THEN 1 ELSE 0 END AS brk FROM l),
p AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS par_no FROM b) SELECT doc_id, par_no, count(*) AS n_lines, string_agg(line, ' ' ORDER BY pos) AS text FROM p GROUP BY doc_id, par_no""",
    "hyphen_join": rf"""WITH {_LINES}, p AS (SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM l)
SELECT doc_id, pos, CASE WHEN regexp_matches(b, '^[a-zà-öø-ÿ]') THEN line || b ELSE line || '- ' || b END AS clause_text, CASE WHEN regexp_matches(b, '^[a-zà-öø-ÿ]') THEN line || '-' || b ELSE line || '- ' || b END AS chunk_text FROM p WHERE b IS NOT NULL""",
    "title_similarity": f"WITH {_TITLES}, w AS (SELECT page_id, {_words('title')} AS a, {_words('h1')} AS b FROM t) SELECT page_id, {_similarity('a', 'b')} AS similarity FROM w",
    "best_evidence": f"""WITH {_TITLES}, p AS (SELECT page_id, {_words('title')} AS tw FROM t), i AS (SELECT item_id, {_words('text')} AS iw FROM benchmark),
m AS (SELECT page_id, item_id, {_similarity('tw', 'iw')} AS similarity FROM p JOIN i ON len(list_intersect(tw, iw)) > 0 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY similarity DESC, item_id) = 1)
SELECT p.page_id, m.item_id, coalesce(m.similarity, 0.0::DOUBLE) AS similarity FROM p LEFT JOIN m ON m.page_id = p.page_id""",
    "bookmark_disagreement": f"""WITH {_TITLES}, p AS (SELECT page_id AS key, {_words('title')} AS tw FROM t), i AS (SELECT item_id AS key, {_words('text')} AS iw FROM benchmark),
m AS (SELECT i.key, tw, CASE WHEN tw IS NULL THEN 0.0::DOUBLE ELSE {_similarity('iw', 'tw')} END AS similarity FROM i LEFT JOIN p ON i.key = p.key)
SELECT key, CASE WHEN tw IS NULL THEN 'missing' WHEN similarity < 0.35 THEN 'different title' ELSE 'same' END AS warning, similarity FROM m""",
    "keep_first_dup": "SELECT doc_id, md5(text) AS digest, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS occurrence, first(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS first_of FROM documents",
    "margin_suggest": f"""WITH {_LINES}, y AS (SELECT l.doc_id, CAST(row_number() OVER (PARTITION BY l.doc_id ORDER BY pos) AS DOUBLE) / CAST(count(*) OVER (PARTITION BY l.doc_id) AS DOUBLE) AS y, rep.fingerprint IS NOT NULL AS repeated FROM l LEFT JOIN rep ON l.fingerprint = rep.fingerprint),
e AS (SELECT doc_id, max(CASE WHEN repeated AND y <= 0.2 THEN y END) AS head, min(CASE WHEN repeated AND y >= 0.8::DOUBLE THEN y END) AS foot FROM y GROUP BY doc_id),
b AS (SELECT doc_id, any_value(head) AS head, any_value(foot) AS foot, min(CASE WHEN NOT repeated AND y > head AND y <= 0.2 THEN y END) AS first, max(CASE WHEN NOT repeated AND y < foot AND y >= 0.8::DOUBLE THEN y END) AS last FROM y JOIN e USING (doc_id) GROUP BY doc_id)
SELECT doc_id, round_even(CASE WHEN head IS NOT NULL THEN coalesce((head + first) / 2, least(head + 0.03::DOUBLE, 0.2::DOUBLE)) END, 3) AS top_margin, round_even(CASE WHEN foot IS NOT NULL THEN coalesce(1 - (foot + last) / 2, least(1 - foot + 0.03::DOUBLE, 0.2::DOUBLE)) END, 3) AS bottom_margin FROM b""",
    "navigation_flag": rf"""WITH {_LINES}, c AS (SELECT doc_id, count(*) FILTER (line LIKE '%|%') AS leaders, count(*) FILTER (regexp_matches(line, '[0-9]')) AS numbered, bool_or(lower(line) IN ('contents', 'table of contents', 'index')) AS titled FROM l GROUP BY doc_id)
SELECT doc_id, leaders, numbered, titled, titled OR (leaders >= 4 AND numbered >= 1) AS navigation FROM c""",
    "kleene_flags": "SELECT source, doc_id % 40 AS bin, CASE WHEN coalesce(bool_or(quality = 0), false) THEN true WHEN count(*) FILTER (quality IS NULL) > 0 THEN NULL ELSE false END AS contains_low FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source, doc_id % 40",
    "heading_score": rf"""WITH {_LINES}, s AS (SELECT doc_id, pos, CAST(CASE WHEN regexp_matches(line, '^[^a-z]+$') THEN 2.0 ELSE 0 END + CASE WHEN length(line) <= 120 THEN 1.0 ELSE 0 END + CASE WHEN NOT regexp_matches(line, '[.!?]$') THEN 1.0 ELSE 0 END + CASE WHEN pos = 0 THEN 3.0 ELSE 0 END + CASE WHEN regexp_matches(line, '^[0-9]') THEN 0.5 ELSE 0 END + CASE WHEN length(line) > 220 THEN -1.5 ELSE 0 END AS DOUBLE) AS score FROM l)
SELECT doc_id, pos, score, score >= 4 AS accepted FROM s""",
    "count_by_type": "SELECT role, count(*) AS n FROM conversations GROUP BY role",
    "dialog_render": "SELECT conv_id, count(*) AS turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn, role, text) AS dialog FROM conversations GROUP BY conv_id",
}
