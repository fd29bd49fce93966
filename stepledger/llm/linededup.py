"""Boilerplate lines by their frequency on a site, in DataFrame functions only.

For each host the pages that contain a line are divided by all its pages; a
line above the boilerplate ratio goes from every page of that host. Lines are
compared without surrounding spaces; blank lines are neither counted nor
dropped. Pages of a host with equal lines (blank ones and surrounding spaces
aside) count as one page, in the line's count and in the host's total: copies
of a text are no boilerplate, and a line has to stand on two different pages
at least. There is no other floor: small hosts are held to the same ratio.

Counting moves a digest for each page and distinct line, added up before the
shuffle. The lines that go are few: a host whose pages have l lines on average
has fewer than l / ratio of them, and a page is looked up in them by hash.

Defined results: a null text stays null and counts as a page without lines, as
does an empty one; a null host is a host of its own; rows that repeat count as
one page; an empty table gives an empty result; other columns stay as they
are; texts of any length are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import materialise, unused

RATIO, MIN_PAGES = 0.05, 2


def marks(lines: Column) -> Column:
    """A digest of each line without surrounding spaces; null for blank ones."""
    return F.transform(lines, lambda x: F.when(F.trim(x) != "", F.md5(F.trim(x))))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO) -> DataFrame:
    """host and bad, the digests of its boilerplate lines."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    each = docs.select(F.col(host).cast("string").alias("host"), F.filter(marks(lines), lambda x: x.isNotNull()).alias("marks"))
    page = F.unhex(F.md5(F.array_join("marks", "")))
    pages = materialise(each.select("host", page.alias("page"), F.transform(F.array_distinct("marks"), F.unhex).alias("marks")).dropDuplicates(["host", "page"]), "pages")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("marks").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    counts = counts.withColumnRenamed("host", "of")
    found = counts.join(totals, counts["of"].eqNullSafe(totals["host"])).where(F.col("n") > ratio * F.col("pages"))
    return found.groupBy("host").agg(F.collect_list(F.lower(F.hex("line"))).alias("bad"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, counted: bool = False) -> DataFrame:
    """The rows with the other lines only; with n_lines and n_dropped if wanted.

    The written list of bad lines has a known size: the join broadcasts it
    where the session's threshold allows and shuffles by host otherwise.
    """
    of, bad, lines, keys, hits, left = unused(docs, "of", "bad", "lines", "keys", "hits", "left")
    listed = materialise(boilerplate(docs, host, ratio), "boilerplate").select(F.col("host").alias(of), F.col("bad").alias(bad))
    rows = docs.join(listed, docs[host].cast("string").eqNullSafe(F.col(of)), "left").drop(of)
    text = F.col("text").cast("string")
    rows = rows.withColumn(lines, F.split(text, "\n", -1)).withColumn(keys, F.when(F.col(bad).isNotNull(), marks(F.col(lines))))
    # of a page's lines the bad ones, by hash, so that each line is held against few
    rows = rows.withColumn(hits, F.array_intersect(keys, bad))
    some = F.coalesce(F.size(hits) > 0, F.lit(False))
    kept = F.filter(lines, lambda x, i: ~F.coalesce(F.array_contains(F.col(hits), F.get(F.col(keys), i)), F.lit(False)))
    rows = rows.withColumn(left, F.when(some, kept).otherwise(F.col(lines)))
    clean = F.when(some, F.array_join(left, "\n")).otherwise(text)
    out = [clean.alias("text") if c == "text" else docs[c] for c in docs.columns]
    if counted:
        n = F.coalesce(F.size(lines), F.lit(0))
        out += [n.alias("n_lines"), (n - F.coalesce(F.size(left), F.lit(0))).alias("n_dropped")]
    return rows.select(*out)


def by_site(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines and n_dropped of every document, its source being its host."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    out = drop_boilerplate(rows, counted=True)
    return out.select("doc_id", "text", F.greatest("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.greatest("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))


ORACLE_SQL = f"""
WITH pages AS (
  SELECT row_number() OVER () AS rid, doc_id, source, string_split(text, chr(10)) AS lines FROM documents
), keyed AS (
  SELECT rid, source, coalesce(array_to_string(list_filter(list_transform(lines, lambda x: trim(x, ' ')), lambda x: x <> ''), chr(10)), '') AS page FROM pages
), firsts AS (
  SELECT min(rid) AS rid FROM keyed GROUP BY source, page
), totals AS (
  SELECT source, count(*) AS pages FROM pages JOIN firsts USING (rid) GROUP BY source
), cells AS (
  SELECT rid, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM pages
), counts AS (
  SELECT source, trim(line, ' ') AS line, count(DISTINCT rid) AS n FROM cells JOIN firsts USING (rid) WHERE trim(line, ' ') <> '' GROUP BY ALL
), bad AS (
  SELECT c.source, c.line
  FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= {MIN_PAGES} AND c.n > {RATIO} * t.pages
), marked AS (
  SELECT c.rid, c.line, c.pos, b.line IS NOT NULL AS hit
  FROM cells c LEFT JOIN bad b ON c.source IS NOT DISTINCT FROM b.source AND trim(c.line, ' ') = b.line
), rebuilt AS (
  SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS text,
         count(*) AS n_lines, count(*) FILTER (hit) AS n_dropped
  FROM marked GROUP BY rid
)
SELECT p.doc_id, r.text, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_dropped, 0) AS n_dropped
FROM pages p LEFT JOIN rebuilt r ON p.rid = r.rid
"""
