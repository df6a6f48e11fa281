"""Secret scan with corpus-wide ownership frequency."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fresh, materialize, trimmed

#: Base kinds in their listed order; the method's own kinds follow.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("private_key", "bearer", "vendor", "opaque")
#: A value seen with so many distinct owners is a widely copied example.
WIDE_OWNERS = 3
#: Shannon entropy per character from which an opaque value looks live.
LIVE_BITS = 3.0

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{32,}")
_PRIVATE = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*")
_BEARER = re.compile(r"(?<![A-Za-z0-9])[Bb]earer\x20+([A-Za-z0-9._~+/-]{20,}=*)")
_VENDOR = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_|glpat-|sk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}")
_OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base rules, by start and then kind; code points, end exclusive."""
    found: list[tuple[str, int, int, str]] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) if value else 0.0


def _live(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= LIVE_BITS


def candidate_spans(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Live-looking values that the base rules did not cover; whether they count depends on who else has them."""
    found: list[tuple[str, int, int, str]] = []
    if "PRIVATE KEY-----" in text:
        found += [("private_key", m.start(), m.end(), m[0]) for m in _PRIVATE.finditer(text)]
    if "earer " in text:
        found += [("bearer", m.start(1), m.end(1), m[1]) for m in _BEARER.finditer(text) if _live(m[1])]
    found += [("vendor", m.start(), m.end(), m[0]) for m in _VENDOR.finditer(text) if _live(m[0])]
    found += [("opaque", m.start(), m.end(), m[0]) for m in _OPAQUE.finditer(text) if _live(m[0])]
    starts, ends = _merged([(s, e) for _, s, e, _ in base])
    out: list[tuple[str, int, int, str]] = []
    for span in sorted(found, key=lambda s: (ADDED_KINDS.index(s[0]), s[1])):
        at = bisect_left(ends, span[1] + 1)
        if at == len(starts) or starts[at] >= span[2]:
            starts.insert(at, span[1])
            ends.insert(at, span[2])
            out.append(span)
    return out


def _merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of disjoint spans that cover the same positions, both rising."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted(spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


_SPAN = "struct<kind:string,start:bigint,end:bigint,hash:string>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string())]))


def _scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One row per document: its base spans and candidate spans, with hashes of their values; the text stays behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        digest = lambda v: hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            every = []
            for t in b.column(3):
                text = t.as_py() or ""
                base = base_spans(text)
                every.append([[dict(zip(("kind", "start", "end", "hash"), (k, s, e, digest(v)), strict=True)) for k, s, e, v in spans] for spans in (base, candidate_spans(text, base))])
            uids = pa.array(range(uid, uid + b.num_rows), pa.int64())
            uid += b.num_rows
            yield pa.RecordBatch.from_arrays([uids, b.column(0), b.column(1), b.column(2), b.column(4), pa.array([x[0] for x in every], _SPANS), pa.array([x[1] for x in every], _SPANS)], names=["uid", "id", "owner", "repo", "text_key", "base", "more"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    return source.mapInArrow(trimmed(run), f"uid long, id long, owner string, repo string, text_key long, base array<{_SPAN}>, more array<{_SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repos): distinct owners and repositories of each value. Counted from (hash, owner, repo) upwards, so a value that a third of all rows hold is combined before each shuffle."""
    each = found.select("hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo")).distinct()
    return each.groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repos"))


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id", wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """(id, text_key, base, added, n_example): one row per row of ``docs``.

    base: spans of the three base rules, whatever their frequency. added: further live-looking values (private
    keys, bearer and vendor tokens, opaque strings of high entropy) whose hash fewer than ``wide_owners`` distinct
    owners hold. n_example counts the row's spans, of either sort, whose value is widely copied.
    The frequency covers all rows. Null texts are empty, null owners and repositories count as one of their own,
    null ids stay; repeated rows each get a row and count once. An empty table gives no rows.
    """
    scanned = materialize(_scan(docs, id_col, text_col, owner_col, repo_col), "secrets-scan")
    found = scanned.where("size(base) + size(more) > 0").select("uid", "owner", "repo", F.explode(F.concat(F.transform("base", lambda s: F.struct(s.alias("span"), F.lit(True).alias("is_base"))), F.transform("more", lambda s: F.struct(s.alias("span"), F.lit(False).alias("is_base"))))).alias("x"))
    found = found.select("uid", "owner", "repo", "x.span", "x.is_base", F.col("x.span.hash").alias("hash"))
    counts = materialize(ownership(found), "secrets-owners")
    judged = found.join(counts, "hash").withColumn("example", F.col("owners") >= wide_owners)
    rows = judged.groupBy("uid").agg(F.collect_list(F.when(~F.col("is_base") & ~F.col("example"), F.struct(F.col("span.start").alias("start"), F.col("span.end").alias("end"), F.col("span.kind").alias("kind")))).alias("added"), F.count_if("example").alias("n_example"))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    more = F.transform(F.array_sort(F.coalesce("added", F.expr("array()").cast("array<struct<start:bigint,end:bigint,kind:string>>"))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.join(materialize(rows, "secrets-rows"), "uid", "left").select("id", "text_key", plain.alias("base"), more.alias("added"), F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op2: counts and digests of the spans of every document."""
    found = secret_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    order = F.create_map(*[F.lit(x) for i, k in enumerate(BASE_KINDS + ADDED_KINDS) for x in (k, i)])
    keyed = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("at"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select(F.col("id").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(keyed).alias("spans"), F.size("added").cast("long").alias("n_added"), "n_example")


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", **options: object) -> DataFrame:
    """``docs`` with every base and added span of ``text_col`` replaced by ``mark``; all rows and columns stay.

    Spans come back by id and text hash. The table of rows with spans is joined as its size on disk allows: Spark
    broadcasts it below its own threshold and else shuffles both sides.
    """
    found = secret_scan(docs, id_col=id_col, text_col=text_col, **options)
    columns, by, key, at = docs.columns, fresh(docs, "secret_id"), fresh(docs, "secret_key"), fresh(docs, "secret_spans")
    spans = materialize(found.where("size(base) + size(added) > 0").select(F.col("id").alias(by), F.col("text_key").alias(key), F.concat("base", "added").alias(at)).dropDuplicates([by, key]), "secrets-spans")
    joined = docs.join(spans, F.col(id_col).cast("long").eqNullSafe(F.col(by)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(key)), "left")
    # Spans overlap only within a row; merged from the left, the text between them is kept.
    ordered = F.array_sort(F.transform(at, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"))))
    empty = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    step = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(F.concat(acc["text"], F.substring(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("text"), s["end"].alias("at"))).otherwise(F.struct(acc["text"].alias("text"), F.greatest(acc["at"], s["end"]).alias("at")))
    clean = F.aggregate(ordered, empty, step, lambda acc: F.concat(acc["text"], F.substring(F.col(text_col), acc["at"] + 1, F.length(text_col))))
    return joined.withColumn(text_col, F.when(F.col(at).isNull(), F.col(text_col)).otherwise(clean)).select(*columns)
