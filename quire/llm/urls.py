"""URL verdicts: listed rules, and association rules mined by FP-growth and matched by an inverted index."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fold, materialize

#: Listed rules (verdict, host, path).
LISTED = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A token set is a rule if it occurs with label 0 on this share of the labelled pages, and LEAST pages at least; if this
#: share of the labelled pages that have it are labelled 0, and LIFT times as many as of all labelled pages.
SUPPORT, LEAST, CONFIDENCE, LIFT = 0.002, 5, 0.7, 2.0
#: A rule has this many items at most. Baskets of more than WIDE items are mined in overlapping parts of WIDE items.
LENGTH, WIDE = 3, 12
#: Words in host names that mark a page as one to block, where no labels are given.
SEEDS = ("casino", "poker", "slots", "bet", "bets", "betting", "pills", "viagra", "pharmacy", "porn", "xxx", "escort", "loans", "warez")
_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): what is between the first :// and the next of /?#, A-Z in lower case, and from there up to ? or #; both empty without ://."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(_LOWER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def tokens(url: str | None) -> list[str]:
    """Distinct tokens: host labels, path segments (digits as 0), file ending, query keys, whether there is a fragment."""
    host, path = split_url(url)
    rest = (url or "").partition("://")[2][len(host) + len(path) :]
    labels = host.split(":")[0].split(".")
    out = {f"host:{x}" for x in labels[:-1] if x} | {f"top:{labels[-1]}"}
    segments = [re.sub("[0-9]+", "0", s.translate(_LOWER)) for s in path.split("/") if s]
    out |= {f"path:{s}" for s in segments}
    if segments and "." in segments[-1]:
        out.add("ending:" + segments[-1].rpartition(".")[2])
    before, _, fragment = rest.partition("#")
    out |= {"query:" + q.partition("=")[0] for q in before.removeprefix("?").split("&") if q}
    return sorted(out | ({"fragment"} if fragment else set()))


@dataclass
class Rules:
    """Listed rules by host and path, and mined token sets by one of their tokens each."""

    listed: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    index: dict[str, list[frozenset[str]]] = field(default_factory=dict)

    def verdict(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = split_url(url)
        best: tuple[int, int, str, str] | None = None
        labels = host.split(".")
        for i in range(len(labels) if host else 0):
            suffix = ".".join(labels[i:])
            for start, says in self.listed.get(suffix, ()):
                if path.startswith(start) and (best is None or (len(suffix + start), len(suffix)) > best[:2]):
                    best = (len(suffix + start), len(suffix), suffix + start, says)
        if best:
            return host, path, best[2], best[3]
        have = set(tokens(url)) if self.index else set()
        blocked = any(rule <= have for t in have for rule in self.index.get(t, ()))
        return host, path, None, "block" if blocked else "allow"


def weak_label(url: str | None) -> int | None:
    """0 where a word of the host is a seed, else 1; None without a host."""
    host = split_url(url)[0]
    return None if not host else 0 if any(w in SEEDS for w in re.split("[^a-z]+", host)) else 1


def _parts(items: list[int]) -> Iterator[list[int]]:
    """Parts of at most WIDE items such that any LENGTH items are in one."""
    if len(items) <= WIDE:
        yield items
        return
    size = WIDE // LENGTH
    groups = [items[i : i + size] for i in range(0, len(items), size)]
    for some in combinations(groups, LENGTH):
        yield sum(some, [])


def mine(pages: DataFrame, labels: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", label_col: str = "quality", support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE, lift: float = LIFT) -> list[frozenset[str]]:
    """Token sets of at most LENGTH items that go with label 0 often and surely enough, without those that a subset makes needless.

    ``labels`` are joined by id (those of fold 0 are not used); without them ``weak_label`` labels each page.
    Tokens on fewer pages of label 0 than the support asks for are dropped first, since they are in no such set, and
    tokens that always occur together count as one item (of the first by name): so neither unique tokens nor copies of
    one long url make subsets without end. FP-growth then mines pages of label 0, wide baskets in overlapping parts; the
    sets it finds are counted anew on all labelled pages by an index on their rarest item, so counts are exact.
    What reaches the driver are the rules. Each has its support's share of pages, so their number is at most that of
    the sets of an average page over the support.
    """
    spark, weak = pages.sparkSession, labels is None
    urls = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url")).where("url is not null")
    if not weak:
        known = labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").where(fold("id") != 0).groupBy("id").agg(F.min("y").alias("y"))
        urls = urls.join(known, "id").select("url", "y")
    else:
        urls = urls.select("url", F.lit(None).cast("int").alias("y"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(u, weak_label(u) if weak else y) for u, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            rows = [(tokens(u), y) for u, y in rows if y is not None]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.list_(pa.string())), pa.array([y for _, y in rows], pa.int32())], names=["tokens", "y"])

    labelled = materialize(urls.mapInArrow(cut, "tokens array<string>, y int").withColumn("row", F.monotonically_increasing_id()), "url-labelled")
    n, blocked = labelled.agg(F.count("*"), F.count_if(F.col("y") == 0)).first()
    floor = max(least, int(-(-support * n // 1)))
    if blocked < floor:
        return []
    share = max(confidence, min(1.0, lift * blocked / n))
    each = labelled.select("row", "y", F.explode("tokens").alias("token"))
    # Tokens of the same labelled pages: as many, with the same sums of two hashes of the pages.
    spots = [F.sum(F.xxhash64("row", F.lit(i)) % (1 << 40)).alias(f"h{i}") for i in range(2)]
    often = each.groupBy("token").agg(F.count_if(F.col("y") == 0).alias("bad"), F.count("*").alias("n"), *spots).where(F.col("bad") >= floor)
    names = materialize(often.groupBy("n", "h0", "h1").agg(F.min("token").alias("item"), F.min("n").alias("pages")).select("item", "pages"), "url-items")
    # The names are broadcast: each is on the support's share of pages.
    chosen = {r["item"]: i for i, r in enumerate(names.orderBy("pages", "item").collect())}
    shared = spark.sparkContext.broadcast(chosen)

    def baskets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sorted(shared.value[t] for t in ts if t in shared.value) for ts in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), b.column(1)], names=["items", "y"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for items in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(list(_parts(items)), pa.list_(pa.int32()))], names=["items"])

    rows = materialize(labelled.select("tokens", "y").mapInArrow(baskets, "items array<int>, y int").where("size(items) > 0").groupBy("items").agg(F.count("*").alias("n"), F.count_if(F.col("y") == 0).alias("bad")), "url-baskets")
    bad = materialize(rows.where("bad > 0").select("items", F.explode(F.sequence(F.lit(1), F.col("bad")))).select("items").mapInArrow(parts, "items array<int>"), "url-parts")
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, floor / max(1, bad.count())), minConfidence=1.0).fit(bad).freqItemsets
    sets = materialize(found.where(F.size("items") <= LENGTH).select(F.array_sort("items").alias("rule")).distinct(), "url-itemsets")
    # Items are numbered by how many pages they are on, so a set's first is its rarest.
    met = sets.withColumn("item", F.col("rule")[0]).join(rows.select("items", "n", "bad", F.explode("items").alias("item")), "item").where(F.size(F.array_except("rule", "items")) == 0)
    sure = materialize(met.groupBy("rule").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where((F.col("bad") >= floor) & (F.col("bad") >= share * F.col("n"))).select("rule"), "url-sure")
    smaller = F.filter(F.transform(F.sequence(F.lit(1), F.lit((1 << LENGTH) - 1)), lambda m: F.filter("rule", lambda x, i: F.call_function("shiftright", m, i).bitwiseAND(F.lit(1)) == 1)), lambda r: (F.size(r) > 0) & (F.size(r) < F.size("rule")))
    needless = sure.select("rule", F.explode(smaller).alias("part")).join(sure.select(F.col("rule").alias("part")), "part").select("rule").distinct()
    token = {i: t for t, i in chosen.items()}
    return [frozenset(token[i] for i in r["rule"]) for r in sure.join(needless, "rule", "left_anti").orderBy("rule").collect()]


def judge(pages: DataFrame, mined: list[frozenset[str]], *, listed: tuple = LISTED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict): one row per row of ``pages``, in one pass without a shuffle.

    A listed rule fits its host and all subdomains where the path starts with the rule's; the longest wins (of equal
    ones that with the longer host). Elsewhere a page is blocked if it has all tokens of a mined set; sets are looked
    up by their rarest token. Null urls and urls without :// have an empty host and path and fit no listed rule.
    """
    by_host: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for says, host, path in listed:
        by_host[host].append((path, says))
    often: dict[str, int] = defaultdict(int)
    for s in mined:
        for t in s:
            often[t] += 1
    index: dict[str, list[frozenset[str]]] = defaultdict(list)
    for s in mined:
        index[min(s, key=lambda t: (often[t], t))].append(s)
    shared = pages.sparkSession.sparkContext.broadcast(Rules(dict(by_host), dict(index)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [shared.value.verdict(u) for u in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], pa.string()) for i in range(4))], names=["id", "host", "path", "rule", "verdict"])

    source = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"))
    return source.mapInArrow(run, "id long, host string, path string, rule string, verdict string")


def query(spark, sf_dir: str) -> DataFrame:  # noqa: ANN001
    """op3: host, path, rule and verdict of every page's url. The labels table is of documents, so pages get weak labels."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages, mine(pages)).withColumnRenamed("id", "page_id")
