"""Routing of pages by their signals, verdicts, guards, fallbacks and the replay of verdicts against labels. Signals are derived from document lengths."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.plans.registry import query, table

_SIGNALS = "signals AS (SELECT doc_id, doc_id // 4 AS doc, doc_id % 4 + 1 AS page, n_chars AS chars, doc_id * 7 % 100 AS image_share, doc_id * 13 % 60 AS curves, doc_id % 11 = 0 AS failed FROM documents)"


def signals(spark, sf_dir):
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", F.floor(i / 4).alias("doc"), (i % 4 + 1).alias("page"), F.col("n_chars").alias("chars"), (i * 7 % 100).alias("image_share"), (i * 13 % 60).alias("curves"), (i % 11 == 0).alias("failed"))


def bucket():
    return F.when((F.col("chars") < 20) & (F.col("image_share") < 2), "skip").when(F.col("curves") >= 50, "diagram").when(F.col("chars") >= 500, F.when(F.col("image_share") >= 90, "vision").otherwise("text")).when(F.col("image_share") >= 50, "ocr").otherwise("vision")


_BUCKET = "CASE WHEN chars < 20 AND image_share < 2 THEN 'skip' WHEN curves >= 50 THEN 'diagram' WHEN chars >= 500 THEN CASE WHEN image_share >= 90 THEN 'vision' ELSE 'text' END WHEN image_share >= 50 THEN 'ocr' ELSE 'vision' END"


@query("l1_l3_lanes", f"WITH {_SIGNALS} SELECT doc, page, b, CASE b WHEN 'text' THEN 'native' WHEN 'ocr' THEN 'gateway' WHEN 'skip' THEN 'none' ELSE 'vision' END AS lane FROM (SELECT *, {_BUCKET} AS b FROM signals)")
def lanes(spark, sf_dir):
    s = signals(spark, sf_dir).select("doc", "page", bucket().alias("b"))
    return s.withColumn("lane", F.when(F.col("b") == "text", "native").when(F.col("b") == "ocr", "gateway").when(F.col("b") == "skip", "none").otherwise("vision"))


@query("l4_document_route", f"WITH {_SIGNALS} SELECT doc, CASE WHEN bool_and(b = 'text') THEN 'fast' WHEN count(*) FILTER (WHERE b IN ('ocr', 'vision', 'diagram')) * 2 > count(*) THEN 'scan' ELSE 'mixed' END AS route FROM (SELECT *, {_BUCKET} AS b FROM signals) GROUP BY doc")
def document_route(spark, sf_dir):
    s = signals(spark, sf_dir).select("doc", bucket().alias("b"))
    return s.groupBy("doc").agg(F.when(F.bool_and(F.col("b") == "text"), "fast").when(F.count_if(F.col("b").isin("ocr", "vision", "diagram")) * 2 > F.count(F.lit(1)), "scan").otherwise("mixed").alias("route"))


@query("l5_l6_verdicts", f"WITH {_SIGNALS}, v AS (SELECT *, CASE WHEN failed THEN 'engine_error' WHEN curves < 4 THEN 'collapse' WHEN chars % 5 = 0 THEN 'cjk' WHEN chars < 100 THEN 'empty' ELSE 'ok' END AS state FROM signals), g AS (SELECT *, count(*) OVER (PARTITION BY doc) AS pages, count(*) FILTER (WHERE state = 'cjk') OVER (PARTITION BY doc) AS hits FROM v) SELECT doc, page, CASE WHEN state = 'cjk' AND pages >= 3 AND hits >= 0.3 * pages THEN 'ok' ELSE state END AS state FROM g")
def verdicts(spark, sf_dir, least_pages=3, share=0.3):
    """Precedence of findings on a page; where a whole document is of that script, the finding is withdrawn."""
    state = F.when(F.col("failed"), "engine_error").when(F.col("curves") < 4, "collapse").when(F.col("chars") % 5 == 0, "cjk").when(F.col("chars") < 100, "empty").otherwise("ok")
    v = signals(spark, sf_dir).select("doc", "page", state.alias("s"))
    w = W.partitionBy("doc")
    is_cjk = F.col("s") == "cjk"
    g = v.select("doc", "page", "s", F.count(F.lit(1)).over(w).alias("pages"), F.sum(is_cjk.cast("int")).over(w).alias("hits"))
    return g.select("doc", "page", F.when(is_cjk & (F.col("pages") >= least_pages) & (F.col("hits") >= share * F.col("pages")), "ok").otherwise(F.col("s")).alias("state"))


@query("l9_l11_fallback", f"WITH {_SIGNALS} SELECT doc, page, coalesce(vision, gateway, native, '') AS text, CASE WHEN vision IS NOT NULL THEN 'vision' WHEN gateway IS NOT NULL THEN 'gateway' WHEN native IS NOT NULL THEN 'native' ELSE 'empty' END AS source FROM (SELECT s.doc, s.page, CASE WHEN image_share > 70 THEN text END AS vision, CASE WHEN image_share > 40 AND NOT failed THEN 'g:' || text END AS gateway, CASE WHEN chars > 300 THEN 'n:' || text END AS native FROM signals s JOIN documents USING (doc_id))")
def fallback(spark, sf_dir):
    """The first lane that gave something, and which it was."""
    s = signals(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    lanes_ = {"vision": F.when(F.col("image_share") > 70, F.col("text")), "gateway": F.when((F.col("image_share") > 40) & ~F.col("failed"), F.concat(F.lit("g:"), "text")), "native": F.when(F.col("chars") > 300, F.concat(F.lit("n:"), "text"))}
    source = F.lit("empty")
    for name, c in reversed(lanes_.items()):
        source = F.when(c.isNotNull(), name).otherwise(source)
    return s.select("doc", "page", F.coalesce(*lanes_.values(), F.lit("")).alias("text"), source.alias("source"))


@query("l12_failed_documents", f"WITH {_SIGNALS} SELECT doc, bool_or(chars < 200) AND NOT bool_or(NOT failed AND image_share > 50) AS failed FROM signals GROUP BY doc")
def failed_documents(spark, sf_dir):
    return signals(spark, sf_dir).groupBy("doc").agg((F.bool_or(F.col("chars") < 200) & ~F.bool_or(~F.col("failed") & (F.col("image_share") > 50))).alias("failed"))


@query("l17_retry", "SELECT user_id, max(k)::BIGINT AS attempts, arg_max(ok, k) AS ok FROM (SELECT user_id, event_id % 3 = 0 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, CASE WHEN user_id % 5 = 0 THEN 3 ELSE 2 END AS most FROM events) WHERE k <= most GROUP BY user_id")
def retry(spark, sf_dir):
    """Two attempts, three for the class that was cut off; the last one counts."""
    k = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    e = table(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 3 == 0).alias("ok"), k.alias("k")).filter(F.col("k") <= F.when(F.col("user_id") % 5 == 0, 3).otherwise(2))
    return e.groupBy("user_id").agg(F.max("k").cast("long").alias("attempts"), F.max_by("ok", "k").alias("ok"))


@query("l19_d17_replay", "SELECT count(*) FILTER (WHERE bad AND quality = 0) AS hits, count(*) FILTER (WHERE bad AND quality = 1) AS false_alarms, count(*) FILTER (WHERE quality = 0) AS relevant, count(*) AS n FROM (SELECT l.quality, regexp_matches(d.text, '[#$%&|]') AS bad FROM documents d JOIN labels l USING (doc_id))")
def replay(spark, sf_dir):
    """Recall and false alarms of a rule against the labels."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike("[#$%&|]").alias("bad")).join(table(spark, sf_dir, "labels"), "doc_id")
    return d.agg(F.count_if(F.col("bad") & (F.col("quality") == 0)).alias("hits"), F.count_if(F.col("bad") & (F.col("quality") == 1)).alias("false_alarms"), F.count_if(F.col("quality") == 0).alias("relevant"), F.count(F.lit(1)).alias("n"))
