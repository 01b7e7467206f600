"""HTML to markdown, markdown to typed blocks, pipe tables, top-level tables, and chunks that keep atomic parts whole."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from docloom.functions.text import replaced, replaced_sql
from docloom.plans.registry import query, table

# fixed values: tags that hold no content
DROPPED = ("script", "style", "title", "meta", "link", "base", "noscript", "template", "iframe")

CLEAN = [(rf"(?is)<{t}\b.*?</{t}>", "") for t in DROPPED if t not in ("meta", "link", "base")]
CLEAN += [(r"(?s)<!--.*?-->", ""), (r"(?s)<!\[CDATA\[.*?\]\]>", ""), (r"(?s)<[!?][^>]*>", ""), (r"(?i)<(?:meta|link|base)\b[^>]*>", "")]
DATA_IMAGES = [
    (r"""(?is)<img\b[^>]*\balt\s*=\s*"([^"]*)"[^>]*\bsrc\s*=\s*"\s*data:[^"]*"[^>]*>""", "$1"),
    (r"""(?is)<img\b[^>]*\bsrc\s*=\s*"\s*data:[^"]*"[^>]*\balt\s*=\s*"([^"]*)"[^>]*>""", "$1"),
    (r"""(?is)<img\b[^>]*\bsrc\s*=\s*"\s*data:[^"]*"[^>]*>""", ""),
]
MARKDOWN = CLEAN + DATA_IMAGES + [(r"\s+", " ")]
MARKDOWN += [(rf"(?i)<h{k}\b[^>]*>", "\n\n" + "#" * k + " ") for k in range(1, 7)]
MARKDOWN += [(r"(?i)<li\b[^>]*>", "\n- "), (r"(?i)</?(?:h[1-6]|p|div|ul|ol|article|section|main|header|footer|nav|aside|form|br)\b[^>]*>", "\n\n"), (r"(?i)</li>", "\n"), (r"<[^>]*>", "")]
MARKDOWN += [(r" *\n *", "\n"), (r"\n\n\n+", "\n\n"), (r"^\n+|\n+$", "")]

#: Marks the borders of blocks by U+001E: pipe tables (a line, a line of dashes, further lines), headings, list items, blank lines.
BLOCKS = [
    ("\x1e", ""),
    (r"(^|\n)([^\n|]*\|[^\n]*\n[ \t]*\|?[ \t:]*-[ \t:|-]*(?:\n[^\n]*\|[^\n]*)*)(\n|$)", "$1\x1e$2\x1e$3"),
    (r"(^|\n)(#+ [^\n]*)", "$1\x1e$2\x1e"),
    (r"(^|\n)([ \t]*(?:[-*+]|[0-9]+[.)]) [^\n]*)", "$1\x1e$2\x1e"),
    (r"\n[ \t]*\n", "\x1e"),
]
_TRIM = [(r"^\s+|\s+$", "")]
KINDS = [("table", r"\|[^\n]*\n[ \t]*\|?[ \t:]*-"), ("image", r"^!\[[^\]]*\]\([^)]*\)$"), ("equation", r"(?s)^\$\$.*\$\$$")]


def blocks(docs: DataFrame, key: str, md: str) -> DataFrame:
    """(key, ord, type, level, body, img_path): each row's text by itself, so no shuffle. Headings lose their marks and carry their level; null texts have no blocks."""
    parts = F.filter(F.transform(F.split(replaced(F.col(md), BLOCKS), "\x1e", -1), lambda x: replaced(x, _TRIM)), lambda x: x != "")
    b = docs.select(key, F.posexplode(parts).alias("ord", "raw"))
    kind = F.lit("text")
    for name, pattern in reversed(KINDS):
        kind = F.when(F.col("raw").rlike(pattern), name).otherwise(kind)
    level = F.length(F.regexp_extract("raw", "^(#+) ", 1))
    b = b.select(key, F.col("ord").cast("long").alias("ord"), kind.alias("type"), F.when(level.between(1, 6), level.cast("long")).alias("level"), "raw")
    body = F.when(F.col("type") == "equation", replaced(F.col("raw"), [(r"^\$\$\s*|\s*\$\$$", "")])).otherwise(F.when(F.col("level").isNotNull(), F.regexp_replace("raw", "^#+ +", "")).otherwise(F.col("raw")))
    return b.select(key, "ord", "type", "level", body.alias("body"), F.when(F.col("type") == "image", F.regexp_extract("raw", r"\]\(([^)\s]*)", 1)).alias("img_path"))


def _blocks_sql(source: str, key: str, md: str) -> str:
    kinds = " ".join(f"WHEN regexp_matches(raw, '{p}') THEN '{n}'" for n, p in KINDS)
    return f"""parts AS (SELECT {key}, list_filter(list_transform(string_split({replaced_sql(md, BLOCKS)}, chr(30)), lambda x: {replaced_sql('x', _TRIM)}), lambda x: x <> '') AS ps FROM {source}),
raws AS (SELECT {key}, unnest(ps) AS raw, unnest(range(len(ps))) AS ord FROM parts),
kinds AS (SELECT {key}, ord, CASE {kinds} ELSE 'text' END AS type, length(regexp_extract(raw, '^(#+) ', 1)) AS lv, raw FROM raws),
blocks AS (SELECT {key}, ord, type, CASE WHEN lv BETWEEN 1 AND 6 THEN lv END::BIGINT AS level, CASE WHEN type = 'equation' THEN regexp_replace(raw, '^\\$\\$\\s*|\\s*\\$\\$$', '', 'g') WHEN lv BETWEEN 1 AND 6 THEN regexp_replace(raw, '^#+ +', '') ELSE raw END AS body,
  CASE WHEN type = 'image' THEN regexp_extract(raw, '\\]\\(([^)\\s]*)', 1) END AS img_path FROM kinds)"""


@query("a5_html_markdown", f"SELECT page_id, {replaced_sql('html', MARKDOWN)} AS md FROM pages")
def html_markdown(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", replaced(F.col("html"), MARKDOWN).alias("md"))


@query("a7_data_images", "SELECT page_id, " + replaced_sql("""'<img alt="a' || page_id || '" src="data:image/png;base64,AA=="><img src="data:x" alt="b"><img src="/p.png"><img src="data:y">' || html""", DATA_IMAGES) + " AS html FROM pages")
def data_images(spark, sf_dir):
    """Images that hold their own bytes become their alternative text; linked images stay."""
    html = F.concat(F.lit('<img alt="a'), "page_id", F.lit('" src="data:image/png;base64,AA=="><img src="data:x" alt="b"><img src="/p.png"><img src="data:y">'), "html")
    return table(spark, sf_dir, "pages").select("page_id", replaced(html, DATA_IMAGES).alias("html"))


_EXTRA = "\n\n![a](img/1.png)\n\n$$ x + y $$\n\n| k | v |\n|---|---|\n| a | 1 |\nend"


@query("j1_blocks", f"WITH md AS (SELECT page_id, {replaced_sql('html', MARKDOWN)} || '{_EXTRA}' AS md FROM pages), {_blocks_sql('md', 'page_id', 'md')} SELECT * FROM blocks")
def page_blocks(spark, sf_dir):
    md = table(spark, sf_dir, "pages").select("page_id", F.concat(replaced(F.col("html"), MARKDOWN), F.lit(_EXTRA)).alias("md"))
    return blocks(md, "page_id", "md")


@query("b9_table_blocks", f"WITH {_blocks_sql('documents', 'doc_id', 'text')} SELECT doc_id, count(*) FILTER (WHERE type = 'table' AND trim(body) <> '') AS n_tables, count(*) AS n_blocks, count(level) AS n_headings FROM blocks GROUP BY 1")
def table_blocks(spark, sf_dir):
    b = blocks(table(spark, sf_dir, "documents"), "doc_id", "text")
    return b.groupBy("doc_id").agg(F.count_if((F.col("type") == "table") & (F.trim("body") != "")).alias("n_tables"), F.count(F.lit(1)).alias("n_blocks"), F.count("level").alias("n_headings"))


def pipe_html(body: Column) -> Column:
    """A pipe table as an HTML table: the line above the dashes is its head, cells are trimmed and escaped, and an escaped bar stays within its cell."""
    line = lambda x: replaced(x, [(r"^\s*\|?", ""), (r"\|?\s*$", ""), (r"\\\|", "\x1f"), ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")])
    lines = F.filter(F.split(body, "\n"), lambda x: F.trim(x) != "")
    row = lambda x, tag: F.concat(F.lit("<tr>"), F.array_join(F.transform(F.split(line(x), "[|]", -1), lambda c: F.concat(F.lit(f"<{tag}>"), F.trim(F.replace(c, F.lit("\x1f"), F.lit("|"))), F.lit(f"</{tag}>"))), ""), F.lit("</tr>"))
    rest = F.slice(lines, F.lit(3), F.greatest(F.lit(0), F.size(lines) - 2))
    return F.concat(F.lit("<table><thead>"), row(lines[0], "th"), F.lit("</thead><tbody>"), F.array_join(F.transform(rest, lambda x: row(x, "td")), ""), F.lit("</tbody></table>"))


@query(
    "j2_pipe_tables",
    "SELECT r_name, '<table><thead><tr><th>name</th><th>a|b</th></tr></thead><tbody>' || string_agg('<tr><td>' || n_name || '</td><td>' || n_nationkey || ' &lt; 99</td></tr>', '' ORDER BY n_nationkey) || '</tbody></table>' AS html FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1",
)
def pipe_tables(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    line = F.struct("n_nationkey", F.concat(F.lit("| "), "n_name", F.lit(" | "), "n_nationkey", F.lit(" < 99 |")).alias("l"))
    md = n.groupBy("r_name").agg(F.concat(F.lit("| name | a\\|b |\n|:--|--:|\n"), F.array_join(F.sort_array(F.collect_list(line))["l"], "\n")).alias("md"))
    return md.select("r_name", pipe_html(F.col("md")).alias("html"))


def top_tables(html: Column) -> Column:
    """The outermost tables of a page as an array, each with the tables inside it. A table that is never closed is left out."""
    tokens = F.split(replaced(html, [("\x1e", ""), (r"(?i)(<table\b)", "\x1e$1"), (r"(?i)(</table\s*>)", "$1\x1e")]), "\x1e", -1)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("now"), F.array().cast("array<string>").alias("out"))

    def step(a, t):
        inside = a["depth"] + F.when(t.rlike(r"(?i)^<table\b"), 1).otherwise(0)
        after = F.greatest(F.lit(0), inside - F.when(t.rlike(r"(?i)</table\s*>$"), 1).otherwise(0))
        now = F.when(inside > 0, F.concat(a["now"], t)).otherwise("")
        done = (inside > 0) & (after == 0)
        return F.struct(after.alias("depth"), F.when(done, "").otherwise(now).alias("now"), F.when(done, F.concat(a["out"], F.array(now))).otherwise(a["out"]).alias("out"))

    return F.aggregate(tokens, start, step, lambda a: a["out"])


@query("a8_top_tables", "SELECT page_id, 2::BIGINT AS n, '<table><tr><td><TABLE><tr><td>' || page_id || '</td></tr></TABLE></td></tr></table>' AS first FROM pages")
def page_tables(spark, sf_dir):
    inner = F.concat(F.lit("<table><tr><td><TABLE><tr><td>"), "page_id", F.lit("</td></tr></TABLE></td></tr></table>"))
    t = table(spark, sf_dir, "pages").select("page_id", top_tables(F.concat("html", inner, F.lit("x<table></table ></table>"))).alias("t"))
    return t.select("page_id", F.size("t").cast("long").alias("n"), F.col("t")[0].alias("first"))


@F.pandas_udf(ArrayType(ArrayType(IntegerType())))
def pack_ranges(lengths: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """[first item, counted from 1, and number of items] of each pack, in one pass over the lengths: an item joins while it fits, and an oversize one stands alone."""

    def packs(ns, cap):
        out, used = [], 0
        for k, n in enumerate(ns):
            if out and used + n <= cap:
                out[-1][1] += 1
                used += n
            else:
                out.append([k + 1, 1])
                used = n
        return out

    for ns, caps in lengths:
        yield pd.Series([None if a is None else packs(a, c) for a, c in zip(ns, caps)], index=ns.index, dtype=object)


OPEN, CLOSE = "〈MODAL", "〈/MODAL〉"


def pieces(text: Column, cap: int) -> Column:
    """Parts of a text, whose concatenation is the text. A marked part stays whole, whatever its length; the rest is cut at blank lines, and where a part exceeds
    the cap, at lines, then sentences, then at the cap itself."""
    atomic = lambda p: p.startswith(OPEN) & p.endswith(CLOSE)
    cut = lambda ps, keep, parts: F.flatten(F.transform(ps, lambda p: F.when(keep(p), F.array(p)).otherwise(parts(p))))
    whole = lambda p: atomic(p) | (F.length(p) <= cap)
    ps = F.split(text, f"(?={OPEN})|(?<={CLOSE})", -1)
    ps = cut(ps, atomic, lambda p: F.split(p, r"(?<=\n\n)(?=[^\n])", -1))
    ps = cut(ps, whole, lambda p: F.split(p, r"(?<=\n)(?=[^\n])", -1))
    ps = cut(ps, whole, lambda p: F.split(p, r"(?<=[.!?][ \t])|(?<=[.!?][)\"'][ \t])", -1))
    ps = cut(ps, whole, lambda p: F.transform(F.sequence(F.lit(1), F.length(p), F.lit(cap)), lambda i: F.substring(p, i, F.lit(cap))))
    return F.filter(ps, lambda p: p != "")


def chunks(docs: DataFrame, key: str, text: str, cap: int) -> DataFrame:
    """(key, chunk, body): pieces packed greedily up to the cap, trimmed; blank chunks go, null texts have none. A document is one row throughout, so nothing is shuffled."""
    p = docs.select(key, pieces(F.col(text), cap).alias("ps")).withColumn("ranges", pack_ranges(F.transform("ps", F.length), F.lit(cap)))
    bodies = F.transform("ranges", lambda r: replaced(F.array_join(F.slice("ps", r[0], r[1]), ""), _TRIM))
    return p.select(key, F.posexplode(F.filter(bodies, lambda b: b != "")).alias("chunk", "body"))


@query("j15_recursive_1100")
def recursive_1100(spark, sf_dir):
    return chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 1100)


@query("j15_recursive_600")
def recursive_600(spark, sf_dir):
    return chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 600)


@query(
    "j15_page_chunks",
    "WITH s AS (SELECT conv_id, turn, text, turn // 2 + 1 AS page FROM conversations) SELECT conv_id, page::BIGINT AS page, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS body FROM s GROUP BY 1, 2",
)
def page_chunks(spark, sf_dir):
    """The page method: a chunk is a page."""
    s = table(spark, sf_dir, "conversations").select("conv_id", (F.floor(F.col("turn") / 2) + 1).alias("page"), F.struct("turn", "text").alias("t"))
    return s.groupBy("conv_id", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda x: x["text"]), "\n\n").alias("body"))


@query(
    "j15_chunk_pages",
    "WITH c AS (SELECT conv_id, turn, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, length(text) AS n, turn // 2 + 1 AS page FROM conversations), p AS (SELECT conv_id, page, min(a) AS a, max(a + n) AS b FROM c GROUP BY 1, 2), k AS (SELECT conv_id, unnest(range(0, (max(b)::BIGINT + 1099) // 1100)) AS chunk FROM p GROUP BY 1) SELECT conv_id, chunk, string_agg(CAST(page AS BIGINT), ',' ORDER BY page) AS pages FROM k JOIN p USING (conv_id) WHERE a < (chunk + 1) * 1100 AND b > chunk * 1100 GROUP BY 1, 2",
)
def chunk_pages(spark, sf_dir, size=1100):
    """Pages of each chunk by the overlap of their spans: a page names the chunks that it reaches, so spans aren't compared with each other."""
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    c = table(spark, sf_dir, "conversations").select("conv_id", (F.floor(F.col("turn") / 2) + 1).alias("page"), F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).alias("a"), F.length("text").alias("n"))
    p = c.groupBy("conv_id", "page").agg(F.min("a").alias("a"), F.max(F.col("a") + F.col("n")).alias("b")).filter("b > a")
    k = p.select("conv_id", "page", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor((F.col("b") - 1) / size))).alias("chunk"))
    return k.groupBy("conv_id", "chunk").agg(F.array_join(F.sort_array(F.collect_set("page")), ",").alias("pages"))
