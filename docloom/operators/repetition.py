"""Degenerate text: rules that tell repetition from writing, and their severity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from docloom.plans.registry import query, table


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, r"[\x20\x09-\x0D]+"), "")


def top_ngram(w: str, n: int) -> Column:
    """How often the most frequent n-gram of the array column w occurs. Within the row: hashes of the grams are sorted, and the longest run counted. The array is
    bound by a one-element array, so that a text is split once and not for each gram."""
    gram = ", ".join(f"x[i + {k}]" for k in range(n))
    return F.expr(f"""CASE WHEN size({w}) < {n} THEN 0 ELSE aggregate(
      sort_array(transform(array({w}), x -> transform(sequence(0, size(x) - {n}), i -> xxhash64({gram})))[0]),
      named_struct('last', CAST(NULL AS BIGINT), 'run', 0, 'most', 0),
      (a, g) -> named_struct('last', g, 'run', if(g <=> a.last, a.run + 1, 1), 'most', greatest(a.most, if(g <=> a.last, a.run + 1, 1))), a -> a.most) END""")


_GRAMS = """w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, len(w) AS n_words, len(list_distinct(w)) AS n_distinct, w, unnest(range(1, greatest(len(w) - {n} + 2, 1))) AS i FROM w)"""


@query("k2_dominant_ngram", "WITH " + _GRAMS.replace("{n}", "5") + ", t AS (SELECT doc_id, n_words, g, count(*) AS n FROM (SELECT doc_id, n_words, array_to_string(w[i:i + 4], ' ') AS g FROM g WHERE n_words >= 30) GROUP BY ALL) SELECT doc_id, max(n)::BIGINT AS top, round(max(n) * 5 / any_value(n_words), 6) AS cover FROM t GROUP BY doc_id HAVING max(n) >= 8 AND max(n) * 5 / any_value(n_words) >= 0.35")
def dominant_ngram(spark, sf_dir, n=5, least=8, cover=0.35, least_words=30):
    """Texts in which one run of five words makes up much of the text."""
    d = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("w")).filter(F.size("w") >= least_words)
    t = d.select("doc_id", F.size("w").alias("k"), top_ngram("w", n).alias("top"))
    return t.withColumn("c", F.col("top") * n / F.col("k")).filter((F.col("top") >= least) & (F.col("c") >= cover)).select("doc_id", F.col("top").cast("long").alias("top"), F.round("c", 6).alias("cover"))


@query("k3_short_text", "WITH " + _GRAMS.replace("{n}", "3") + ", s AS (SELECT doc_id FROM documents WHERE length(text) BETWEEN 60 AND 199), t AS (SELECT doc_id, n_words, n_distinct, g, count(*) AS n FROM (SELECT doc_id, n_words, n_distinct, array_to_string(w[i:i + 2], ' ') AS g FROM g JOIN s USING (doc_id) WHERE n_words >= 9) GROUP BY ALL) SELECT doc_id, max(n)::BIGINT AS top, any_value(n_distinct)::BIGINT AS types FROM t GROUP BY doc_id HAVING max(n) * 3 / any_value(n_words) >= 0.5 OR any_value(n_distinct) / any_value(n_words) <= 0.45")
def short_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter(F.length("text").between(60, 199)).select("doc_id", words(F.col("text")).alias("w")).filter(F.size("w") >= 9)
    t = d.select("doc_id", F.size("w").alias("k"), F.size(F.array_distinct("w")).cast("long").alias("types"), top_ngram("w", 3).cast("long").alias("top"))
    return t.filter((F.col("top") * 3 / F.col("k") >= 0.5) | (F.col("types") / F.col("k") <= 0.45)).select("doc_id", "top", "types")


@F.pandas_udf(DoubleType())
def compression_ratio(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compressed by uncompressed bytes; null and empty texts are 1."""
    for s in parts:
        yield s.map(lambda t: len(zlib.compress(t.encode(), 6)) / len(t.encode()) if t else 1.0)


@query("k1_compression")
def compression(spark, sf_dir, most=0.16, least_chars=200):
    d = table(spark, sf_dir, "documents").filter(F.length("text") >= least_chars)
    return d.select("doc_id", compression_ratio("text").alias("ratio")).filter(F.col("ratio") < most)


SOFT = ("dominant_cell", "low_variety")


@query("k5_dominant_cell", "SELECT o_custkey, max(n)::BIGINT AS top, sum(n)::BIGINT AS cells FROM (SELECT o_custkey, o_orderstatus || o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1 HAVING sum(n) >= 12 AND max(n) >= 0.2 * sum(n)")
def dominant_cell(spark, sf_dir, least=12, share=0.2):
    v = table(spark, sf_dir, "orders").groupBy("o_custkey", F.concat("o_orderstatus", "o_orderpriority").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return v.groupBy("o_custkey").agg(F.max("n").alias("top"), F.sum("n").alias("cells")).filter((F.col("cells") >= least) & (F.col("top") >= share * F.col("cells")))


def severity(rules: Column, soft: tuple[str, ...] = SOFT) -> Column:
    """None without rules; soft if all that fired are soft; else hard."""
    return F.when(F.size(rules) == 0, "none").when(F.size(F.array_except(rules, F.array(*map(F.lit, soft)))) == 0, "soft").otherwise("hard")


@query("k7_k9_severity", "WITH r AS (SELECT doc_id, list_filter([CASE WHEN n_chars < 300 THEN 'dominant_cell' END, CASE WHEN lang = 'fr' THEN 'low_variety' END, CASE WHEN n_chars > 8000 THEN 'loop' END], lambda x: x IS NOT NULL) AS rules FROM documents) SELECT doc_id, len(rules)::BIGINT AS fired, CASE WHEN len(rules) = 0 THEN 'none' WHEN len(list_filter(rules, lambda x: x NOT IN ('dominant_cell', 'low_variety'))) = 0 THEN 'soft' ELSE 'hard' END AS severity FROM r")
def severities(spark, sf_dir):
    rules = F.filter(F.array(F.when(F.col("n_chars") < 300, "dominant_cell"), F.when(F.col("lang") == "fr", "low_variety"), F.when(F.col("n_chars") > 8000, "loop")), lambda x: x.isNotNull())
    return table(spark, sf_dir, "documents").select("doc_id", F.size(rules).cast("long").alias("fired"), severity(rules).alias("severity"))


def drop_hard(assessed: DataFrame) -> DataFrame:
    return assessed.filter("severity <> 'hard'")


def table_cells(body: Column) -> Column:
    """Cells of an HTML table as text without tags, trimmed."""
    return F.transform(F.regexp_extract_all(body, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", "")))


def table_rules(df: DataFrame, body: str) -> DataFrame:
    """Adds rules, an array: R1 compresses below 0.16; R2 one cell makes up 0.6 of those with two characters or more; R3 it makes up 0.35, and the table compresses
    below 0.36; R4 at most 0.45 of 30 words or more are distinct. R1 needs 200 characters, and what is shorter counts as not compressible; the others need 20 cells.
    A null or empty body has no rules."""
    d = df.withColumn("_cells", table_cells(F.col(body)))
    d = d.withColumn("_joined", F.array_join(F.filter("_cells", lambda c: c != ""), " ")).withColumn("_many", F.filter("_cells", lambda c: F.length(c) >= 2))
    d = d.withColumn("_comp", F.when(F.length("_joined") >= 200, compression_ratio("_joined")).otherwise(1.0)).withColumn("_w", words(F.col("_joined")))
    enough, share = F.size("_many") >= 20, top_ngram("_many", 1) / F.size("_many")
    few = (F.size("_w") >= 30) & (F.size(F.array_distinct("_w")) <= 0.45 * F.size("_w"))
    rules = F.array(F.when(F.col("_comp") < 0.16, "R1"), F.when(enough & (share >= 0.6), "R2"), F.when(enough & (share >= 0.35) & (F.col("_comp") < 0.36), "R3"), F.when(enough & few, "R4"))
    return d.withColumn("rules", F.filter(rules, lambda r: r.isNotNull())).drop("_cells", "_joined", "_many", "_comp", "_w")


def order_tables(spark, sf_dir) -> DataFrame:
    """An HTML table for each order: a row of four cells for each of its lines, of which there are few."""
    cell = lambda *c: F.concat(F.lit("<td>"), *c, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell(F.lit("flag "), "l_returnflag"), cell(F.lit("status "), "l_linestatus"), cell(F.lit("y "), F.year("l_shipdate").cast("string")), cell(F.lit("state "), "l_linestatus"), F.lit("</tr>"))
    t = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", row.alias("r")))), lambda x: x["r"]), "").alias("body"))
    return t.select("l_orderkey", F.concat(F.lit("<table>"), "body", F.lit("</table>")).alias("body"))


@query("k4_k6_table_rules")
def order_table_rules(spark, sf_dir):
    return table_rules(order_tables(spark, sf_dir), "body").select("l_orderkey", F.array_join("rules", ",").alias("rules"))


@query("k8_k10_pages")
def assessed_pages(spark, sf_dir):
    """Orders as blocks of a page, their customer: visible characters in all, in hard and in soft blocks, and whether any block is degenerate. Nothing is changed."""
    from docloom.functions.text import visible_chars

    b = table_rules(order_tables(spark, sf_dir), "body")
    b = b.select("l_orderkey", visible_chars(F.col("body")).cast("long").alias("n"), severity(F.col("rules"), ("R3", "R4")).alias("s"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    part = lambda s: F.coalesce(F.sum(F.when(F.col("s") == s, F.col("n"))), F.lit(0)).alias(f"chars_{s}")
    return b.join(o, "l_orderkey").groupBy("o_custkey").agg(F.sum("n").alias("chars"), part("hard"), part("soft"), F.bool_or(F.col("s") != "none").alias("degenerate"))
