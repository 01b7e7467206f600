"""Queries over the column functions on text."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.plans.registry import query, table

_WS = "[\\x20\\x09-\\x0D]+"


@query("i1_clean", f"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g')) AS text FROM documents")
def clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.trim(F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), r"[ \t]+", " ")).alias("text"))


@query("i7_numbering_level", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN regexp_matches(t, '^[0-9]+[.][0-9]+[.][0-9]+( |$)') THEN 3 WHEN regexp_matches(t, '^[0-9]+[.][0-9]+( |$)') THEN 2 WHEN regexp_matches(t, '^[0-9]+[.]( |$)') THEN 1 WHEN regexp_matches(t, '^[(][0-9]+[)]') THEN 4 WHEN regexp_matches(t, '^[a-z][)]') THEN 5 ELSE 0 END::BIGINT AS level FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN l_orderkey || '. x' WHEN 2 THEN l_orderkey || '.2 x' WHEN 3 THEN l_orderkey || '.3.1 x' WHEN 4 THEN '(4) x' WHEN 5 THEN 'a) x' ELSE 'x' END AS t FROM lineitem)")
def numbering(spark, sf_dir):
    k, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    t = F.when(n == 1, F.concat(k, F.lit(". x"))).when(n == 2, F.concat(k, F.lit(".2 x"))).when(n == 3, F.concat(k, F.lit(".3.1 x"))).when(n == 4, "(4) x").when(n == 5, "a) x").otherwise("x")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", n.cast("long").alias("l_linenumber"), T.numbering_level(t).cast("long").alias("level"))


@query("i12_keywords", "SELECT doc_id, array_to_string(list_slice(list_filter(list_distinct_ordered, lambda w: true), 1, 12), ' ') AS keywords FROM (SELECT doc_id, list_transform(list_sort(list_transform(map_entries(m), lambda e: {'k': e.value, 'w': e.key})), lambda x: x.w) AS list_distinct_ordered FROM (SELECT doc_id, map_from_entries(list({'key': w, 'value': k})) AS m FROM (SELECT doc_id, w, min(k) AS k FROM (SELECT doc_id, regexp_replace(unnest(s), '^[.()!?\"'']+|[.()!?\"'']+$', '', 'g') AS w, generate_subscripts(s, 1) AS k FROM (SELECT doc_id, regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D,;:/|]+') AS s FROM documents)) WHERE length(w) >= 2 AND w NOT IN ('the', 'de', 'of', 'and') GROUP BY 1, 2) GROUP BY doc_id))")
def keywords(spark, sf_dir):
    words = T.keywords(F.col("text"), ("the", "de", "of", "and"), 12)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(words, " ").alias("keywords")).filter("keywords <> ''")


@query("i13_i32_ids", "SELECT doc_id, regexp_replace(source || ' ' || lang, '[^A-Za-z0-9_-]', '_', 'g') || '::' || left(md5(text), 12) AS id, left(sha256(text), 16) AS digest FROM documents")
def ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.stable_id(F.concat_ws(" ", "source", "lang"), F.col("text")).alias("id"), F.substring(F.sha2("text", 256), 1, 16).alias("digest"))


@query("i16_addresses", "SELECT p_partkey, CASE WHEN c > 26 THEN chr(64 + ((c - 1) // 26)::INT) ELSE '' END || chr(65 + ((c - 1) % 26)::INT) || CAST(p_size AS VARCHAR) AS address FROM (SELECT p_partkey, p_size, p_partkey % 700 + 1 AS c FROM part)")
def addresses(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.a1(F.col("p_size"), (F.col("p_partkey") % 700 + 1).cast("int")).alias("address"))


@query("i18_d8_visible_chars", "SELECT page_id, length(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\\s\\x{0B}\\x{85}\\p{Z}]+', '', 'g'))::BIGINT AS n FROM pages")
def visible(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.visible_chars(F.col("html")).cast("long").alias("n"))


@query("i19_leader_dots", "SELECT doc_id, length(regexp_replace(regexp_replace(text, '[.]{4,}', '...', 'g'), '(?:· ?){3,}', '...', 'g'))::BIGINT AS n FROM documents")
def leader_dots(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length(F.regexp_replace(F.regexp_replace("text", "[.]{4,}", "..."), "(?:· ?){3,}", "...")).cast("long").alias("n"))


@query("i21_cjk_ratio", "SELECT doc_id, round(len(regexp_extract_all(text, '[\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{AC00}-\\x{D7A3}]')) / greatest(1, length(text)), 6) AS ratio FROM documents")
def cjk_ratio(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.round(T.cjk_count(F.col("text")) / F.greatest(F.lit(1), F.length("text")), 6).alias("ratio"))


@query("i29_csv_fields", "SELECT conv_id, turn, CASE WHEN regexp_matches(text, '[,\"\\n\\r]') THEN '\"' || replace(text, '\"', '\"\"') || '\"' ELSE text END AS field FROM conversations")
def csv_fields(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.csv_field(F.col("text")).alias("field"))


@query("i36_durations", "SELECT o_orderkey, CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm' WHEN s >= 60 THEN CAST(s // 60 AS VARCHAR) || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE CAST(s AS VARCHAR) || 's' END AS took FROM (SELECT o_orderkey, floor(o_totalprice / 50)::BIGINT AS s FROM orders)")
def durations(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", T.duration(F.col("o_totalprice") / 50).alias("took"))


@query("i39_error_class", "SELECT event_id, CASE WHEN c >= 500 OR c = 429 THEN 'retry' WHEN c >= 400 THEN 'fatal' ELSE 'ok' END AS class FROM (SELECT event_id, 200 + event_id * 37 % 400 AS c FROM events)")
def error_class(spark, sf_dir):
    c = 200 + F.col("event_id") * 37 % 400
    return table(spark, sf_dir, "events").select("event_id", F.when((c >= 500) | (c == 429), "retry").when(c >= 400, "fatal").otherwise("ok").alias("class"))


@query("i42_clip_numeric", "SELECT doc_id, CASE WHEN length(text) > 80 THEN left(text, 79) || '…' ELSE text END AS clipped, len(regexp_extract_all(text, '[0-9]')) * 2 > length(text) AS numeric_heavy FROM documents")
def clip_numeric(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.clip(F.col("text"), 80).alias("clipped"), (F.regexp_count("text", F.lit("[0-9]")) * 2 > F.length("text")).alias("numeric_heavy"))


@query("i43_char_ngrams", "SELECT g, count(*) AS n FROM (SELECT lower(substr(t, unnest(range(1, length(t) - 1)), 3)) AS g FROM (SELECT text AS t FROM conversations WHERE length(text) >= 3)) GROUP BY 1 HAVING count(*) >= 20")
def char_ngrams(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").filter(F.length("text") >= 3).select(F.col("text").alias("t"))
    grams = c.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("t") - 2), lambda i: F.lower(F.substring("t", i, 3)))).alias("g"))
    return grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n >= 20")


def _pick(values, key: str, step: int = 1):
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(F.col(key) / step) % len(values) + 1).cast("int"))


def _pick_sql(values, key: str, step: int = 1) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][CAST({key} // {step} % {len(values)} + 1 AS INTEGER)]"


@query(
    "i2_path_frame",
    "WITH p AS (SELECT n_nationkey, unnest([r_name, ' ' || r_name || ' ', '', n_name, replace(n_name, '_', ' _'), lower(n_name)]) AS s, unnest(range(6)) AS i FROM nation JOIN region ON r_regionkey = n_regionkey), k AS (SELECT *, row_number() OVER (PARTITION BY n_nationkey, replace(s, ' ', '') ORDER BY i) AS k FROM p WHERE trim(s) <> '') SELECT n_nationkey, string_agg(trim(s), ' > ' ORDER BY i) AS path FROM k WHERE k = 1 GROUP BY 1",
)
def path_frames(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_nationkey", T.path_frame(F.array("r_name", F.concat(F.lit(" "), "r_name", F.lit(" ")), F.lit(""), "n_name", F.replace("n_name", F.lit("_"), F.lit(" _")), F.lower("n_name"))).alias("path"))


@query("i3_row_sentence", "SELECT c_custkey, 'book > ' || n_name || CASE WHEN c_mktsegment <> n_name THEN ' > ' || c_mktsegment ELSE '' END || ' 항목: name: ' || c_name || ', balance: ' || floor(c_acctbal)::BIGINT AS sentence FROM customer JOIN nation ON n_nationkey = c_nationkey")
def row_sentences(spark, sf_dir):
    """Document, sheet and path, neighbours that are equal once, then the pairs of the row."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    parts = F.array(F.lit("book"), F.lit("book"), "n_name", F.lit(""), "c_mktsegment")
    parts = F.filter(parts, lambda x: x != "")
    path = F.array_join(F.filter(parts, lambda x, i: (i == 0) | (x != F.get(parts, F.greatest(i - 1, F.lit(0))))), " > ")
    return c.select("c_custkey", F.concat(path, F.lit(" 항목: name: "), "c_name", F.lit(", balance: "), F.floor("c_acctbal").cast("string")).alias("sentence"))


_MARKS = ("○", "X ", "○○", "●●", "△▲", "o", "아니", "✔", "필 수", "Y", "")


@query(
    "i4_marks",
    f"WITH v AS (SELECT doc_id, replace({_pick_sql(_MARKS, 'doc_id')}, ' ', '') AS t FROM documents), m AS (SELECT *, MAP {T.MARKS}[t] AS known FROM v) SELECT doc_id, t <> '' AND (known IS NOT NULL OR t IN ('O', 'o', '0') OR regexp_full_match(t, '[○●◎◯△▲×X✕✓✔]+')) AS is_mark, coalesce(known, CASE WHEN t IN ('O', 'o', '0') OR regexp_full_match(t, '[○◯]+') THEN 'applicable' WHEN regexp_full_match(t, '●+') THEN 'applicable_primary' END) AS meaning FROM m",
)
def marks(spark, sf_dir):
    v = table(spark, sf_dir, "documents").select("doc_id", _pick(_MARKS, "doc_id").alias("v"))
    return v.select("doc_id", T.is_mark(F.col("v")).alias("is_mark"), T.mark_meaning(F.col("v")).alias("meaning"))


_CELLS = ("※ see", "Total", "소 계", "* a", "단, b", "A01", "HR", "totals", "CPO(officer)", "abcdefg", "1a", "")


@query(
    "i6_i11_cell_kinds",
    f"WITH v AS (SELECT doc_id, {_pick_sql(_CELLS, 'doc_id')} AS v FROM documents) SELECT doc_id, regexp_matches(v, '^(※|주\\)|주:|주\\.|비고|참고|단,|단서|\\* |\\(단,|\\(※)') AS note, lower(replace(v, ' ', '')) IN {T.TOTALS} AS total, length(v) <= 12 AND regexp_full_match(v, '[A-Z]{{1,5}}[0-9]{{0,4}}|[가-힣]{{1,4}}|[A-Za-z가-힣]{{1,6}}') AS code, v = 'CPO(officer)' OR (length(v) <= 12 AND regexp_full_match(v, '[A-Z]{{1,5}}[0-9]{{0,4}}|[가-힣]{{1,4}}|[A-Za-z가-힣]{{1,6}}')) AS code_or_note FROM v",
)
def cell_kinds(spark, sf_dir):
    v = table(spark, sf_dir, "documents").select("doc_id", _pick(_CELLS, "doc_id").alias("v"))
    return v.select("doc_id", T.is_note(F.col("v")).alias("note"), T.is_total(F.col("v")).alias("total"), T.is_code(F.col("v")).alias("code"), T.is_code_with_note(F.col("v")).alias("code_or_note"))


_FORMATS = ("0.0%", "0.00%", "0%", '0.0"%"', "0\\%", "#,##0")


@query("i14_percent_formats", f"WITH v AS (SELECT doc_id, {_pick_sql(_FORMATS, 'doc_id')} AS v FROM documents) SELECT doc_id, regexp_matches(v, '^0(\\.0+)?%$') AS percent, length(regexp_extract(v, '0\\.(0+)%', 1))::BIGINT AS decimals FROM v")
def percent_formats(spark, sf_dir):
    v = table(spark, sf_dir, "documents").select("doc_id", _pick(_FORMATS, "doc_id").alias("v"))
    return v.select("doc_id", T.is_percent_format(F.col("v")).alias("percent"), T.percent_decimals(F.col("v")).cast("long").alias("decimals"))


@query("i17_struck", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || ' (취소선)' ELSE o_orderpriority END AS shown FROM orders")
def struck_values(spark, sf_dir):
    is_struck = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select("o_orderkey", T.struck(T.struck(F.col("o_orderpriority"), is_struck), is_struck).alias("shown"))


@query("i20_digital_length", "SELECT doc_id, length(regexp_replace(text, '\\s+', '', 'g'))::BIGINT AS n FROM (SELECT doc_id, regexp_replace(text, '<[^>]+>', '', 'g') AS text FROM documents)")
def digital_lengths(spark, sf_dir):
    md = F.concat(F.lit("![a](b c).png)\n"), "text", F.lit("\n  ![x](y)\n<table><td> </td></table>"))
    return table(spark, sf_dir, "documents").select("doc_id", T.digital_length(md).cast("long").alias("n"))


@query("b11_markers_off", "SELECT conv_id, turn, text FROM conversations")
def markers_off(spark, sf_dir):
    marked = F.concat(F.lit('〈MODAL id="T1" type="table"〉'), "text", F.lit("〈/MODAL〉"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.without_markers(marked).alias("text"))


@query("i30_sentence_cuts")
def sentence_cuts(spark, sf_dir, before=100, after=200):
    """Context around a part: the end of what precedes it and the start of what follows, in whole sentences."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.tail_from_sentence(F.col("text"), before).alias("tail"), T.head_to_sentence(F.col("text"), after).alias("head"))


@query("i33_slugs", "SELECT conv_id, 'kb-' || replace(CAST(conv_id AS VARCHAR) || '-a-b', '-', '') AS slug FROM conversations GROUP BY conv_id")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id").distinct().select("conv_id", F.concat(F.lit("kb-"), F.replace(F.concat(F.col("conv_id").cast("string"), F.lit("-a-b")), F.lit("-"), F.lit(""))).alias("slug"))


@query("i37_attempt_trails", "SELECT user_id, string_agg(event_type || ':' || event_id % 3 || CASE WHEN event_id % 4 = 0 THEN '(' || event_id % 5 || ')' ELSE '' END, ' → ' ORDER BY event_id) AS trail FROM events GROUP BY 1")
def attempt_trails(spark, sf_dir):
    """Steps as stage:outcome(detail), in order."""
    i = F.col("event_id")
    step = F.concat("event_type", F.lit(":"), (i % 3).cast("string"), F.when(i % 4 == 0, F.concat(F.lit("("), (i % 5).cast("string"), F.lit(")"))).otherwise(""))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", step.alias("s")))), lambda x: x["s"]), " → ").alias("trail"))


@query("i26_json_objects", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_objects(spark, sf_dir):
    """Properties of events as answers give them, between prose or in a fence, with a note that has braces of its own."""
    from docloom.functions.json_text import json_object

    note = F.when(F.col("event_type") == "error", F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nNo {more}."))).otherwise(F.concat(F.lit("It is "), "props", F.lit(", see {there}.")))
    found = table(spark, sf_dir, "events").select("event_id", json_object()(note).alias("found"))
    return found.select("event_id", F.get_json_object("found", "$.k").cast("bigint").alias("k"))
