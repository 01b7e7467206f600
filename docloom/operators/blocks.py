"""Documents as typed blocks: routing by extension, decoding, HTML cleaning, blocks from lines, spans and slices."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docloom.plans.registry import query, table

DOMAINS = {"excel": "xls|xlsx|xlsm|csv", "office": "hwp|hwpx|doc|docx|ppt|pptx", "ocr": "png|jpg|jpeg|tif|tiff|bmp", "html": "html|htm", "text": "txt|md"}


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[.]([^./]+)$", 1))


def domain(name: Column) -> Column:
    out = F.lit("pdf")
    for d, exts in DOMAINS.items():
        out = F.when(extension(name).isin(*exts.split("|")), d).otherwise(out)
    return out


@query("a1_a2_domains", "SELECT page_id, e AS ext, CASE WHEN e IN ('xls', 'xlsx', 'xlsm', 'csv') THEN 'excel' WHEN e IN ('hwp', 'hwpx', 'doc', 'docx', 'ppt', 'pptx') THEN 'office' WHEN e IN ('png', 'jpg', 'jpeg', 'tif', 'tiff', 'bmp') THEN 'ocr' WHEN e IN ('html', 'htm') THEN 'html' WHEN e IN ('txt', 'md') THEN 'text' ELSE 'pdf' END AS domain FROM (SELECT page_id, lower(regexp_extract(url || ['.html', '.XLSX', '.png', '', '.txt'][page_id % 5 + 1], '[.]([^./]+)$', 1)) AS e FROM pages)")
def domains(spark, sf_dir):
    name = F.concat("url", F.element_at(F.array(*map(F.lit, (".html", ".XLSX", ".png", "", ".txt"))), (F.col("page_id") % 5 + 1).cast("int")))
    return table(spark, sf_dir, "pages").select("page_id", extension(name).alias("ext"), domain(name).alias("domain"))


@F.pandas_udf(StringType())
def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Text of bytes: by byte-order mark, else UTF-8, else the Korean code page; null where none fits. Nothing is replaced."""

    def one(b: bytes | None) -> str | None:
        if b is None:
            return None
        for mark, name in ((b"\xff\xfe\x00\x00", "utf-32"), (b"\x00\x00\xfe\xff", "utf-32"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
            if b.startswith(mark):
                names = [name]
                break
        else:
            names = ["utf-8-sig", "cp949"]
        for name in names:
            try:
                return b.decode(name)
            except UnicodeDecodeError:
                pass
        return None

    for s in parts:
        yield s.map(one)


@query("a4_decode", "SELECT doc_id, length(text)::BIGINT AS n FROM documents")
def decoded(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 2 == 0, F.encode("text", "utf-8")).otherwise(F.encode("text", "utf-16"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(decode(raw)).cast("long").alias("n"))


DROPPED = ("script", "style", "title", "noscript", "template", "iframe")


@query("a6_drop_tags", "SELECT page_id, " + "regexp_replace(" * (len(DROPPED) + 1) + "html" + "".join(f", '(?is)<{t}\\b.*?</{t}>', '', 'g')" for t in DROPPED) + ", '(?s)<!--.*?-->', '', 'g') AS html FROM pages")
def drop_tags(spark, sf_dir):
    c = F.col("html")
    for t in DROPPED:
        c = F.regexp_replace(c, rf"(?is)<{t}\b.*?</{t}>", "")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(c, "(?s)<!--.*?-->", "").alias("html"))


@query("a34_join_chunks", "SELECT conv_id, string_agg(regexp_replace(text, '\\x{1E}', '', 'g'), chr(30) ORDER BY turn) AS body FROM conversations GROUP BY conv_id")
def join_chunks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_replace("text", "\x1e", "").alias("text"))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\x1e").alias("body"))


@query("j3_line_blocks", "SELECT doc_id, k - 1 AS ord, CASE WHEN regexp_matches(l, '^#+ ') THEN 'heading' WHEN contains(l, ' | ') THEN 'table' WHEN regexp_matches(l, '^[-*] ') THEN 'list' ELSE 'text' END AS type, length(l)::BIGINT AS n FROM (SELECT doc_id, unnest(s) AS l, generate_subscripts(s, 1) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)) WHERE trim(l) <> ''")
def line_blocks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("ord", "l")).filter(F.trim("l") != "")
    kind = F.when(F.col("l").rlike("^#+ "), "heading").when(F.contains("l", F.lit(" | ")), "table").when(F.col("l").rlike("^[-*] "), "list").otherwise("text")
    return d.select("doc_id", F.col("ord").cast("long").alias("ord"), kind.alias("type"), F.length("l").cast("long").alias("n"))


@query("j11_j12_page_spans", "WITH s AS (SELECT conv_id, turn, text, turn // 2 + 1 AS page, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM conversations) SELECT conv_id, page::BIGINT AS page, min(a)::BIGINT AS char_start, max(a + length(text))::BIGINT AS char_end FROM s GROUP BY 1, 2")
def page_spans(spark, sf_dir):
    """Half-open code-point spans of each page in the joined text."""
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    s = table(spark, sf_dir, "conversations").select("conv_id", (F.floor(F.col("turn") / 2) + 1).alias("page"), F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).alias("a"), F.length("text").alias("n"))
    return s.groupBy("conv_id", "page").agg(F.min("a").cast("long").alias("char_start"), F.max(F.col("a") + F.col("n")).cast("long").alias("char_end"))


@query("b10_span_slices", "WITH s AS (SELECT conv_id, turn, text, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM conversations) SELECT conv_id, turn, text AS slice FROM s")
def span_slices(spark, sf_dir):
    """Slices of the joined text by their spans give the parts back."""
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    c = table(spark, sf_dir, "conversations")
    spans = c.select("conv_id", "turn", F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).cast("int").alias("a"), F.length("text").alias("n"))
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n\n").alias("body"))
    return spans.join(whole, "conv_id").select("conv_id", "turn", F.substring("body", F.col("a") + 1, F.col("n")).alias("slice"))
