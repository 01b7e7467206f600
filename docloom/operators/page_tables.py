"""Tables in the HTML of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions.table_html import segments, sanitized
from docloom.plans.registry import query, table


def lists_as_tables(spark, sf_dir):
    """(page_id, html): pages whose lists are written as tables, as older sites do."""
    h = F.regexp_replace(F.regexp_replace("html", "<(/?)ul>", "<$1TABLE>"), "<(/?)li>", "<$1tr>")
    return table(spark, sf_dir, "pages").select("page_id", h.alias("html"))


_PAGES = "p AS (SELECT page_id, regexp_replace(regexp_replace(html, '<(/?)ul>', '<\\1TABLE>', 'g'), '<(/?)li>', '<\\1tr>', 'g') AS html FROM pages)"


@query(
    "i38_table_html",
    f"""WITH {_PAGES}, a AS (SELECT page_id, regexp_replace(html, '(?is)<\\s*script\\b.*?<\\s*/\\s*script\\s*>|<\\s*style\\b.*?<\\s*/\\s*style\\s*>', '', 'g') AS h FROM p),
b AS (SELECT page_id, regexp_replace(regexp_replace(replace(replace(h, '<TABLE', '<table'), '</TABLE', '</table'), '<br\\b[^>]*>', chr(57344) || 'br/' || chr(57345), 'g'), '<(/?)(table|thead|tbody|tr|th|td|strong|em|b|i)\\b[^>]*>', chr(57344) || '\\1\\2' || chr(57345), 'g') AS h FROM a),
c AS (SELECT page_id, replace(replace(replace(regexp_replace(h, '</?\\s*[a-zA-Z][a-zA-Z0-9]*\\b[^>]*>', '', 'g'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS h FROM b)
SELECT page_id, replace(replace(h, chr(57344), '<'), chr(57345), '>') AS html FROM c""",
)
def table_html(spark, sf_dir):
    return lists_as_tables(spark, sf_dir).select("page_id", sanitized(F.col("html")).alias("html"))


@query(
    "i38_table_segments",
    f"""WITH {_PAGES}, t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<\\s*table\\b.*?<\\s*/\\s*table\\s*>')) AS x FROM p)
SELECT p.page_id, count(x) AS n_tables, coalesce(sum(length(x)), 0)::BIGINT AS table_chars, any_value(length(html) - coalesce(n, 0))::BIGINT AS text_chars FROM p LEFT JOIN t USING (page_id) LEFT JOIN (SELECT page_id, sum(length(x)) AS n FROM t GROUP BY 1) s USING (page_id) GROUP BY p.page_id""",
)
def table_segments(spark, sf_dir):
    s = lists_as_tables(spark, sf_dir).select("page_id", F.explode_outer(segments(F.col("html"))).alias("x")).select("page_id", "x.*")
    chars = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.length("text"))), F.lit(0)).cast("long")
    return s.groupBy("page_id").agg(F.count_if(F.col("kind") == "table").alias("n_tables"), chars("table").alias("table_chars"), chars("text").alias("text_chars"))
