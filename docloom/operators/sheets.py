"""Spreadsheets as long tables of cells (sheet, row, col, value): density, features, headers, facts, hierarchies."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.plans.registry import query, table


def cells(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    row = F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey"))
    values = F.array("c_name", "c_mktsegment", F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_custkey").cast("string")))
    return c.select(F.col("c_nationkey").alias("sheet"), row.alias("row"), values.alias("vs")).select("sheet", "row", F.posexplode("vs").alias("p", "value")).select("sheet", "row", (F.col("p") + 1).alias("col"), "value")


_ROWS = "cells AS (SELECT n.sheet, n.row, x.col, x.value FROM (SELECT c_nationkey AS sheet, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS row, c_name, c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS k FROM customer) n, LATERAL (VALUES (1, n.c_name), (2, n.c_mktsegment), (3, n.k)) x(col, value))"


@query("m3_density", f"WITH {_ROWS} SELECT sheet, row::BIGINT AS row, count(*) FILTER (WHERE value <> '') AS filled, round(count(*) FILTER (WHERE value <> '') / max(col), 6) AS density FROM cells GROUP BY sheet, row")
def density(spark, sf_dir):
    return cells(spark, sf_dir).groupBy("sheet", F.col("row").cast("long").alias("row")).agg(F.count_if(F.col("value") != "").alias("filled"), F.round(F.count_if(F.col("value") != "") / F.max("col"), 6).alias("density"))


@query("m7_region_features", f"WITH {_ROWS} SELECT sheet, col::BIGINT AS col, count(*) AS n, count(DISTINCT value) AS kinds, round(avg(CASE WHEN regexp_matches(value, '^[0-9.]+$') THEN 1.0 ELSE 0.0 END), 6) AS numeric_share, max(length(value))::BIGINT AS longest FROM cells WHERE value <> '' GROUP BY 1, 2")
def region_features(spark, sf_dir):
    return cells(spark, sf_dir).filter("value <> ''").groupBy("sheet", F.col("col").cast("long").alias("col")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("kinds"), F.round(F.avg(F.col("value").rlike("^[0-9.]+$").cast("double")), 6).alias("numeric_share"), F.max(F.length("value")).cast("long").alias("longest"))


@query("m14_flat_rows", f"WITH {_ROWS} SELECT sheet, row::BIGINT AS row, string_agg('c' || CAST(col AS VARCHAR) || ': ' || value, ', ' ORDER BY col) AS sentence FROM cells WHERE value <> '' GROUP BY 1, 2")
def flat_rows(spark, sf_dir):
    part = F.struct("col", F.concat(F.lit("c"), F.col("col").cast("string"), F.lit(": "), "value").alias("t"))
    return cells(spark, sf_dir).filter("value <> ''").groupBy("sheet", F.col("row").cast("long").alias("row")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["t"]), ", ").alias("sentence"))


@query("m17_matrix_facts", "SELECT r_name, part, value FROM (SELECT r_name, count(DISTINCT n_nationkey) AS nations, count(s_suppkey) AS suppliers FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY r_name) UNPIVOT (value FOR part IN (nations, suppliers)) WHERE value > 0")
def matrix_facts(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey")
    n = table(spark, sf_dir, "nation").join(s, "n_nationkey", "left").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    wide = n.groupBy("r_name").agg(F.countDistinct("n_nationkey").alias("nations"), F.count("s_suppkey").alias("suppliers"))
    return wide.unpivot("r_name", ["nations", "suppliers"], "part", "value").filter("value > 0")


@query("m20_code_pairs", f"WITH {_ROWS} SELECT a.sheet, count(*) AS pairs FROM cells a JOIN cells b ON a.sheet = b.sheet AND a.row = b.row AND b.col = a.col + 1 WHERE a.value <> '' AND b.value <> '' GROUP BY 1 HAVING count(*) >= 2")
def code_pairs(spark, sf_dir):
    c = cells(spark, sf_dir).filter("value <> ''")
    nxt = F.lead(F.struct("col", "value")).over(W.partitionBy("sheet", "row").orderBy("col"))
    return c.withColumn("next", nxt).filter(F.col("next.col") == F.col("col") + 1).groupBy("sheet").agg(F.count(F.lit(1)).alias("pairs")).filter("pairs >= 2")


@query("m24_m25_nearest_parent", "WITH n AS (SELECT DISTINCT k FROM (SELECT CAST(l_orderkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS k FROM lineitem UNION ALL SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')) SELECT a.k, b.k AS parent FROM n a LEFT JOIN n b ON b.k = regexp_replace(a.k, '[.][^.]*$', '') AND a.k <> b.k")
def nearest_parent(spark, sf_dir):
    """The longest proper prefix of a dotted number that occurs itself: prefixes are spread out and joined, not compared with all."""
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("k"))
    heads = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("string").alias("k"))
    n = lines.union(heads).distinct()
    parts = F.split("k", "[.]")
    prefixes = n.select("k", F.explode_outer(F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), ".")))).alias("prefix"))
    known = n.select(F.col("k").alias("prefix"))
    best = prefixes.join(known, "prefix", "left_semi").groupBy("k").agg(F.max_by("prefix", F.length("prefix")).alias("parent"))
    return n.join(best, "k", "left").select("k", "parent")


@query("m29_quality_score", "SELECT doc_id, round(greatest(0.05, least(0.99, 0.3 * least(1, n_chars / 2000) + 0.2 * (CASE WHEN lang = 'en' THEN 1 ELSE 0.5 END) + 0.2 * (doc_id % 10) / 10 + 0.2 * (doc_id % 7) / 7 + 0.1 - (CASE WHEN n_chars < 100 THEN 0.3 ELSE 0 END))), 6) AS score FROM documents")
def quality_score(spark, sf_dir):
    n, i = F.col("n_chars"), F.col("doc_id")
    s = 0.3 * F.least(F.lit(1.0), n / 2000) + 0.2 * F.when(F.col("lang") == "en", 1.0).otherwise(0.5) + 0.2 * (i % 10) / 10 + 0.2 * (i % 7) / 7 + 0.1 - F.when(n < 100, 0.3).otherwise(0.0)
    return table(spark, sf_dir, "documents").select("doc_id", F.round(F.greatest(F.lit(0.05), F.least(F.lit(0.99), s)), 6).alias("score"))


_MERGES = "merges AS (SELECT sheet, row AS r1, least(row + 2, (SELECT max(row) FROM cells c WHERE c.sheet = cells.sheet)) AS r2, 2 AS c1, 3 AS c2 FROM cells WHERE row % 5 = 1 AND col = 2)"


@query(
    "m1_merged_cells",
    f"WITH {_ROWS}, {_MERGES} SELECT c.sheet, c.row::BIGINT AS row, c.col::BIGINT AS col, m.sheet IS NOT NULL AS is_merged, CASE WHEN m.sheet IS NULL THEN c.value ELSE a.value END AS logical_value FROM cells c LEFT JOIN merges m ON m.sheet = c.sheet AND c.row BETWEEN r1 AND r2 AND c.col BETWEEN c1 AND c2 LEFT JOIN cells a ON a.sheet = m.sheet AND a.row = m.r1 AND a.col = m.c1",
)
def merged_cells(spark, sf_dir):
    """Every cell of a merged range has the value of its first cell. The ranges name the cells that they cover, so this is a join of equals, not of ranges."""
    c = cells(spark, sf_dir)
    last = F.max("row").over(W.partitionBy("sheet"))
    m = c.filter("col = 2").withColumn("last", last).filter("row % 5 = 1").select("sheet", F.col("row").alias("r1"), F.least(F.col("row") + 2, F.col("last")).alias("r2"), F.col("value").alias("anchor"))
    cover = m.select("sheet", "anchor", F.explode(F.sequence("r1", "r2")).alias("row")).select("sheet", "row", "anchor", F.explode(F.sequence(F.lit(2), F.lit(3))).alias("col"), F.lit(True).alias("m"))
    out = c.join(cover, ["sheet", "row", "col"], "left")
    return out.select("sheet", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("m").isNotNull().alias("is_merged"), F.when(F.col("m").isNotNull(), F.col("anchor")).otherwise(F.col("value")).alias("logical_value"))


@query("c10_code_map", "WITH m AS (SELECT p_type AS code, arg_min(p_brand, p_partkey) AS meaning FROM part GROUP BY 1) SELECT p_partkey, meaning FROM part JOIN m ON code = p_type")
def code_map(spark, sf_dir):
    """Codes by their first definition. How the map is joined is left to its size."""
    p = table(spark, sf_dir, "part")
    m = p.groupBy(F.col("p_type").alias("code")).agg(F.min_by("p_brand", "p_partkey").alias("meaning"))
    return p.join(m, F.col("p_type") == F.col("code")).select("p_partkey", "meaning")


@query(
    "e17_label_spans",
    f"WITH {_ROWS}, f AS (SELECT sheet, row, value, CASE WHEN lag(value) OVER w = value AND lag(row) OVER w = row - 1 THEN 0 ELSE 1 END AS c FROM cells WHERE col = 2 AND value <> '' WINDOW w AS (PARTITION BY sheet ORDER BY row)), g AS (SELECT *, sum(c) OVER (PARTITION BY sheet ORDER BY row) AS run FROM f) SELECT sheet, min(row)::BIGINT AS lo, max(row)::BIGINT AS hi, min(value) AS label FROM g WHERE length(value) >= 2 AND regexp_matches(value, '[A-Za-z]') GROUP BY sheet, run HAVING count(*) >= 2",
)
def label_spans(spark, sf_dir):
    """Neighbouring cells with one label of two characters or more, a letter among them, are one span."""
    w = W.partitionBy("sheet").orderBy("row")
    c = cells(spark, sf_dir).filter("col = 2 AND value <> ''")
    new = F.when((F.lag("value").over(w) == F.col("value")) & (F.lag("row").over(w) == F.col("row") - 1), 0).otherwise(1)
    g = c.withColumn("c", new).withColumn("run", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, 0))).filter((F.length("value") >= 2) & F.col("value").rlike("[A-Za-z]"))
    g = g.groupBy("sheet", "run").agg(F.min("row").cast("long").alias("lo"), F.max("row").cast("long").alias("hi"), F.min("value").alias("label"), F.count(F.lit(1)).alias("n"))
    return g.filter("n >= 2").select("sheet", "lo", "hi", "label")


_FLAT = "flat AS (SELECT c_nationkey AS region, c_custkey AS k, c_name AS leaf, c_mktsegment AS parent, length(c_name || ': ' || CAST(c_acctbal::BIGINT AS VARCHAR)) AS n FROM customer)"


@query(
    "e7_flat_siblings",
    f"WITH {_FLAT}, ok AS (SELECT region FROM flat GROUP BY 1 HAVING count(DISTINCT leaf) >= 0.9 * count(*) AND avg(n) <= 550), f AS (SELECT flat.*, CASE WHEN lag(parent) OVER (PARTITION BY region ORDER BY k) = parent THEN 0 ELSE 1 END AS c FROM flat JOIN ok USING (region)), g AS (SELECT *, sum(c) OVER (PARTITION BY region ORDER BY k) AS run FROM f) SELECT region, min(k) AS first_row, count(*) AS n, min(parent) AS parent FROM g GROUP BY region, run HAVING count(*) >= 2",
)
def flat_siblings(spark, sf_dir, max_chars=1100):
    """Consecutive rows below one parent, in regions whose leaves are nearly all distinct and whose rows are short on average; single rows are left as they are."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("region"), F.col("c_custkey").alias("k"), F.col("c_name").alias("leaf"), F.col("c_mktsegment").alias("parent"), F.length(F.concat("c_name", F.lit(": "), F.round("c_acctbal").cast("long").cast("string"))).alias("n"))
    ok = c.groupBy("region").agg(F.countDistinct("leaf").alias("d"), F.count(F.lit(1)).alias("rows"), F.avg("n").alias("mean")).filter((F.col("d") >= 0.9 * F.col("rows")) & (F.col("mean") <= max_chars // 2))
    w = W.partitionBy("region").orderBy("k")
    g = c.join(ok.select("region"), "region", "left_semi").withColumn("c", F.when(F.lag("parent").over(w) == F.col("parent"), 0).otherwise(1)).withColumn("run", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return g.groupBy("region", "run").agg(F.min("k").alias("first_row"), F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent")).filter("n >= 2").select("region", "first_row", "n", "parent")


@query("d22_hierarchy_share", f"WITH {_ROWS}, r AS (SELECT sheet, col, count(*) AS rows, count(*) FILTER (WHERE value = '') > 0 AS blanks FROM cells GROUP BY 1, 2) SELECT sheet, round(coalesce(sum(rows) FILTER (WHERE blanks), 0) / sum(rows), 6) AS share FROM r GROUP BY 1")
def hierarchy_share(spark, sf_dir):
    """Share of rows in regions (here columns) with a hierarchy, which is told by blanks below a value."""
    r = cells(spark, sf_dir).groupBy("sheet", "col").agg(F.count(F.lit(1)).alias("rows"), (F.count_if(F.col("value") == "") > 0).alias("blanks"))
    return r.groupBy("sheet").agg(F.round(F.coalesce(F.sum(F.when(F.col("blanks"), F.col("rows"))), F.lit(0)) / F.sum("rows"), 6).alias("share"))


@query(
    "d15_section_summary",
    "WITH a AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS k FROM a) SELECT c_nationkey, sum(n)::BIGINT AS n_rows, count(*) AS n_axes, string_agg(c_mktsegment, ',' ORDER BY k) FILTER (WHERE k <= 3) AS top FROM k GROUP BY 1",
)
def section_summary(spark, sf_dir, most=3):
    a = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    k = a.withColumn("k", F.row_number().over(W.partitionBy("c_nationkey").orderBy(F.desc("n"), "c_mktsegment")))
    top = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("k") <= most, F.struct("k", "c_mktsegment")))), lambda x: x["c_mktsegment"]), ",")
    return k.groupBy("c_nationkey").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_axes"), top.alias("top"))


@query("g3_all_numbers", "WITH n AS (SELECT CAST(l_orderkey AS VARCHAR) AS a, CAST(l_linenumber AS VARCHAR) AS b, CAST(l_suppkey AS VARCHAR) AS c FROM lineitem) SELECT k, bool_or(seen) AS seen FROM (SELECT a || '.' || b || '.' || c AS k, true AS seen FROM n UNION ALL SELECT a || '.' || b, false FROM n UNION ALL SELECT a, false FROM n) GROUP BY 1")
def all_numbers(spark, sf_dir):
    """Dotted numbers that occur, and those that only their descendants imply."""
    parts = F.array(*[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey")])
    n = table(spark, sf_dir, "lineitem").select(parts.alias("p")).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("p")), lambda i: F.struct(F.array_join(F.slice("p", F.lit(1), i), ".").alias("k"), (i == F.size("p")).alias("seen")))).alias("x"))
    return n.groupBy("x.k").agg(F.bool_or("x.seen").alias("seen"))
