"""Line dedup by site-relative frequency.

For each host, the number of its pages that hold a line is divided by the number of its pages; a line beyond the ratio is boilerplate of that host
and goes from each of its pages. Lines are parts of the text between \\n, compared exactly. A line on one page only is never boilerplate, however small
the host.

Defined cases: a null text stays null and counts as a page without lines; an empty text has no line; lines of white space only are never counted
or dropped; null is a host of its own; repeated rows are pages of their own; texts may be of any length; an empty table gives an empty table; other columns
pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stash

RATIO = 0.1
#: A line's digests are sent to each executor only up to this number (16 bytes each); beyond it they are joined by host.
BROADCAST_LINES = 1_000_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO) -> DataFrame:
    """(host, key): the 64-bit keys of each host's boilerplate lines. Counts are added up before the shuffle, so a hot host or line costs one row a task."""
    p = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").cast("string").alias("text"))
    totals = p.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("pages"))
    keys = F.transform(F.filter(_lines(F.col("text")), lambda x: F.length(F.translate(x, " \t\r\x0b\x0c", "")) > 0), lambda x: F.xxhash64(x))
    counts = p.select("host", F.explode(F.array_distinct(keys)).alias("key")).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.join(totals, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("n") > F.col("pages") * F.lit(ratio)).select("host", "key")


def drop_lines(pages: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """(row, text, n_lines, n_dropped): each row's other columns as one struct, its text without boilerplate lines, and how many lines it had and lost.

    A host has at most lines-per-page / ratio boilerplate lines, so its list is small.
    """
    bad = stash(boilerplate(pages, text, host, ratio), "lines")
    lists = bad.groupBy(F.col("host").alias("of")).agg(F.sort_array(F.collect_list("key")).alias("bad"))
    if bad.count() <= broadcast_lines:
        lists = F.broadcast(lists)
    rest = [F.col(f"`{c}`") for c in pages.columns if c != text]
    whole = pages.select(F.struct(*rest).alias("row"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{host}`").alias("host"))
    # one-element arrays bind the split lines, so that they are computed once a row
    cut = F.when(
        F.col("bad").isNotNull() & F.col("text").isNotNull(),
        F.transform(
            F.array(_lines(F.col("text"))),
            lambda all_: F.struct(
                F.size(all_).alias("n"),
                F.filter(all_, lambda x: ~F.array_contains(F.col("bad"), F.xxhash64(x))).alias("kept"),
            ),
        )[0],
    )
    joined = whole.join(lists, F.col("host").eqNullSafe(F.col("of")), "left").withColumn("cut", cut)
    n_dropped = F.coalesce(F.col("cut.n") - F.size("cut.kept"), F.lit(0)).cast("long")
    n_lines = F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.length("text") - F.length(F.translate("text", "\n", "")) + 1).cast("long")
    return joined.select("row", F.when(n_dropped > 0, F.array_join("cut.kept", "\n")).otherwise(F.col("text")).alias("text"), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return drop_lines(docs).select("row.doc_id", "row.source", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP5_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d WHERE text IS NOT NULL),
totals AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
bad AS (SELECT c.source, c.line FROM (SELECT source, line, count(DISTINCT r) AS n FROM l WHERE length(translate(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13), '')) > 0 GROUP BY source, line) c
  JOIN totals t ON c.source IS NOT DISTINCT FROM t.source WHERE c.n > 1 AND c.n > t.pages * {RATIO}::DOUBLE),
cut AS (SELECT l.r, count(*) AS n, count(bad.line) AS gone, string_agg(l.line, chr(10) ORDER BY l.k) FILTER (WHERE bad.line IS NULL) AS kept
  FROM l LEFT JOIN bad ON l.line = bad.line AND l.source IS NOT DISTINCT FROM bad.source GROUP BY l.r)
SELECT d.doc_id, d.source, (CASE WHEN d.text IS NULL OR d.text = '' THEN 0 ELSE cut.n END)::BIGINT AS n_lines, coalesce(cut.gone, 0)::BIGINT AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL WHEN cut.gone > 0 THEN sha256(coalesce(cut.kept, '')) ELSE sha256(d.text) END AS kept_sha256
FROM d LEFT JOIN cut ON cut.r = d.r
"""
