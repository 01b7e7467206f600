"""Context of tables, images and equations: copied from the texts around them, moved or absorbed, with each part's place in the joined text kept.

Blocks are rows (doc, ord, type, level, body, page, list_item). A run of texts lies between two other blocks and concerns these two alone: the left one takes its notes
first, the right one copies what is left or absorbs it if it is short. So a document is not folded from its start: each run is settled by itself, in windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.plans.registry import query, table

# fixed values: what has context, windows in blocks, budgets in code points, and how notes begin
MODALS = {"table": "T", "image": "I", "equation": "E"}
BEFORE, AFTER = 3, 6
COPIED, ABSORBED, LARGEST = 200, 50, 13800
NOTE = r"^(?:※|\*|†|‡|주\)|주\s*\d+\)|\(\d+\)|\[\d+\]|\d+\)\s)"
LIST_MARKS = r"^(?:(?:[-+]|\d+[.)])\s+)*+"

_PIECE = "array<struct<ord:bigint,s:string,moves:boolean>>"


def is_note(s: Column, list_item: Column) -> Column:
    """Does a text begin like a footnote? The marks of a list item don't count."""
    return F.when(list_item, F.regexp_replace(s, LIST_MARKS, "")).otherwise(s).rlike(NOTE)


def _fold(parts: Column, budget: int, take) -> Column:
    """Pieces taken while the budget lasts. take(part, left) gives a piece or null, and whether it is the last."""
    start = F.struct(F.lit(budget).alias("left"), F.lit(False).alias("done"), F.array().cast(_PIECE).alias("out"))

    def step(a, p):
        piece, last = take(p, a["left"])
        got = F.struct((a["left"] - F.coalesce(F.length(piece["s"]) + 1, F.lit(0))).alias("left"), last.alias("done"), F.when(piece.isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(piece))).alias("out"))
        return F.when(a["done"], a).otherwise(got)

    return F.aggregate(parts, start, step, lambda a: a["out"])


def _piece(p: Column, s: Column, moves: Column) -> Column:
    return F.struct(p["ord"].alias("ord"), s.alias("s"), moves.alias("moves"))


def _before(parts: Column) -> Column:
    """Nearest first: whole sentences up to the budget; a heading is taken and, with the headings right above it, ends the context."""
    marked = F.transform(parts, lambda p, i: p.withField("ends", p["heading"] & ~F.coalesce(F.get(parts, i + 1)["heading"], F.lit(False))))
    return _fold(marked, COPIED, lambda p, left: (F.when(left > 0, _piece(p, T.tail_from_sentence(p["s"], left), F.lit(False))), (left <= 0) | p["ends"]))


def _after(parts: Column, before_modal: Column) -> Column:
    """In order: up to a heading, or to a label of the next modal. Notes that fit move; of a note that doesn't fit whole sentences are copied."""

    def take(p, left):
        stops = p["heading"] | (before_modal & (p["to_end"] == 1) & ~p["note"])
        head = F.when(p["note"], F.regexp_replace(T.head_to_sentence(p["s"], left), r"(?U)\s+$", "")).otherwise("")
        fits = F.length(p["s"]) <= left
        return F.when(~stops & fits, _piece(p, p["s"], p["note"])).when(~stops & (head != ""), _piece(p, head, F.lit(False))), stops | ~fits

    return _fold(parts, COPIED, take)


def _joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["s"]), "\n")


def runs(blocks: DataFrame) -> DataFrame:
    """(doc, run, modal, before, after, gone): for each block that is no text, the context it gets, and the texts of the run behind it that leave their places."""
    by_doc, in_run = W.partitionBy("doc").orderBy("run"), W.partitionBy("doc", "run")
    b = blocks.withColumn("s", F.regexp_replace(F.coalesce("body", F.lit("")), r"(?U)^\s+|\s+$", ""))
    up, down = in_run.orderBy("is_text", "ord"), in_run.orderBy(F.col("is_text").desc(), F.col("ord").desc())
    full = F.when(F.col("is_text") & (F.col("s") != ""), 1).otherwise(0)
    b = b.withColumn("up", F.sum(F.col("is_text").cast("int")).over(up)).withColumn("down", F.row_number().over(down)).withColumn("to_end", F.sum(full).over(down))
    text = F.struct("ord", "s", F.col("level").isNotNull().alias("heading"), is_note(F.col("s"), F.coalesce("list_item", F.lit(False))).alias("note"), "to_end")
    some = F.col("is_text") & (F.col("s") != "")
    # absorption sees the last texts whole or not at all: each has a code point at least, and longer ones are never absorbed
    short = F.struct("ord", F.when(F.length("s") <= ABSORBED, F.col("s")).alias("s"), F.length("s").alias("n"), "page")
    g = b.groupBy("doc", "run").agg(
        F.max(F.when(~F.col("is_text"), F.struct("ord", "type", "page", F.length(F.coalesce("body", F.lit(""))).alias("n")))).alias("modal"),
        F.sort_array(F.collect_list(F.when(some & (F.col("up") <= AFTER), text))).alias("head"),
        F.sort_array(F.collect_list(F.when(some & (F.col("down") <= BEFORE), text)), asc=False).alias("tail"),
        F.sort_array(F.collect_list(F.when(some & (F.col("to_end") <= ABSORBED + 1), short)), asc=False).alias("short"),
    )
    modal = lambda c: F.coalesce(c["type"].isin(*MODALS), F.lit(False))
    g = g.withColumn("right", F.lead("modal").over(by_doc))
    g = g.withColumn("copied", F.when(modal(F.col("right")), _before(F.col("tail"))).otherwise(F.array().cast(_PIECE)))
    g = g.withColumn("after", F.when(modal(F.col("modal")), _after(F.col("head"), modal(F.col("right")))).otherwise(F.array().cast(_PIECE)))
    around = F.coalesce(F.length(_joined(F.lag("copied").over(by_doc))), F.lit(0)) + F.length(_joined(F.col("after")))
    g = g.withColumn("dropped", modal(F.col("modal")) & (F.col("modal.n") + around > LARGEST))
    g = g.withColumn("after", F.when(F.col("dropped"), F.array().cast(_PIECE)).otherwise(F.col("after"))).withColumn("right_dropped", F.coalesce(F.lead("dropped").over(by_doc), F.lit(False)))
    moved = F.transform(F.filter("after", lambda p: p["moves"]), lambda p: p["ord"])
    g = g.withColumn("moved", moved).withColumn("from", F.array_max("moved"))
    left_over = lambda c: F.filter(c, lambda p: F.col("from").isNull() | (p["ord"] > F.col("from")))
    g = g.withColumn("rest", left_over("short"))
    total = F.aggregate("rest", F.lit(0).cast("long"), lambda a, p: a + p["n"])
    absorbs = modal(F.col("modal")) & modal(F.col("right")) & ~F.col("right_dropped") & (F.size("rest") > 0) & (total <= ABSORBED) & F.forall("rest", lambda p: p["page"].eqNullSafe(F.col("right.page")))
    g = g.withColumn("absorbs", absorbs)
    ahead = F.when(F.col("absorbs"), F.transform("rest", lambda p: p["s"])).when(F.col("right_dropped"), F.array().cast("array<string>")).otherwise(F.transform(left_over("copied"), lambda p: p["s"]))
    g = g.withColumn("ahead", F.array_join(F.reverse(ahead), "\n"))
    gone = F.concat("moved", F.when(F.col("absorbs"), F.transform("rest", lambda p: p["ord"])).otherwise(F.array().cast("array<bigint>")))
    before = F.coalesce(F.lag("ahead").over(by_doc), F.lit(""))
    return g.select("doc", "run", "modal", before.alias("before"), _joined(F.col("after")).alias("after"), gone.alias("gone"))


def segments(blocks: DataFrame) -> DataFrame:
    """(doc, ord, type, modal_id, page, text, char_start, char_end): the parts of the enriched text, which are joined by blank lines.

    Tables, images and equations become marked parts that hold their context; texts that moved into one are left out, headings get their marks back. A modal that is too
    large loses its context, or its marks too if its body alone is too large. Other blocks, empty texts and rows without a place are left out; a null body is an
    empty one, a null document one of its own, and of two blocks at one place the order is that of their types and bodies.
    """
    b = blocks.filter("ord IS NOT NULL").select("doc", F.col("ord").cast("long").alias("place"), "type", "level", F.coalesce("body", F.lit("")).alias("body"), "page", "list_item")
    w = W.partitionBy("doc").orderBy("place", "type", "body")
    b = b.withColumn("ord", F.row_number().over(w).cast("long")).withColumn("is_text", F.coalesce(F.col("type") == "text", F.lit(False)))
    b = b.withColumn("run", F.sum((~F.col("is_text")).cast("long")).over(W.partitionBy("doc").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)))
    r = runs(b).select(F.col("doc").alias("of"), F.col("run").alias("nth"), "before", "after", "gone")
    j = b.join(r, F.col("doc").eqNullSafe(F.col("of")) & (F.col("run") == F.col("nth"))).filter(F.col("type").isin(*MODALS) | (F.col("is_text") & (F.col("body") != "") & ~F.array_contains("gone", F.col("ord"))))
    nth = F.row_number().over(W.partitionBy("doc", "type").orderBy("ord"))
    j = j.withColumn("modal_id", F.when(~F.col("is_text"), F.concat(T.lookup(F.col("type"), MODALS), nth.cast("string"))))
    inside = F.concat_ws("\n", F.when(F.col("before") != "", F.col("before")), F.lit(""), "body", F.when(F.col("after") != "", F.col("after")))
    marked = F.concat(F.lit('〈MODAL id="'), "modal_id", F.lit('" type="'), "type", F.lit('"〉'), inside, F.lit("〈/MODAL〉"))
    heading = F.concat(F.repeat(F.lit("#"), F.least(F.col("level"), F.lit(6)).cast("int")), F.lit(" "), "body")
    text = F.when(F.col("is_text"), F.when(F.col("level") > 0, heading).otherwise(F.col("body"))).when(F.length("body") > LARGEST, F.col("body")).otherwise(marked)
    j = j.select("doc", F.col("place").alias("ord"), F.col("ord").alias("nth"), "type", "modal_id", "page", text.alias("text"))
    start = F.coalesce(F.sum(F.length("text") + 2).over(W.partitionBy("doc").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long")
    j = j.withColumn("char_start", start)
    return j.select("doc", "ord", "type", "modal_id", "page", "text", "char_start", (F.col("char_start") + F.length("text")).alias("char_end"))


def page_bounds(parts: DataFrame) -> DataFrame:
    """(doc, page, char_start, char_end): the half-open span of each page. A document without any page number is all page 1; else parts without one are page 0."""
    p = parts.groupBy("doc", F.coalesce("page", F.lit(0)).cast("long").alias("page")).agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"))
    none = F.max("page").over(W.partitionBy("doc")) == 0
    return p.select("doc", F.when(none, 1).otherwise(F.col("page")).cast("long").alias("page"), "char_start", "char_end")


def conversation_blocks(spark, sf_dir) -> DataFrame:
    """Conversations as documents of two turns a page: a heading for each turn of a user, a text for each line, a table of line lengths, and a note below it."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.split("text", "\n", -1)
    block = lambda kind, level, body: F.struct(F.lit(kind).alias("type"), F.lit(level).cast("long").alias("level"), body.alias("body"))
    rows = F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit("| "), i.cast("string"), F.lit(" | "), F.length(x).cast("string"), F.lit(" |"))), "\n")
    heading = F.when(F.col("role") == "user", F.array(block("text", 2, F.concat(F.lit("Turn "), F.col("turn").cast("string")))))
    note = F.when(F.col("turn") % 3 == 0, F.array(block("text", None, F.concat(F.lit("* "), F.length("text").cast("string"), F.lit(" in all")))))
    none = F.array().cast("array<struct<type:string,level:bigint,body:string>>")
    parts = F.concat(F.coalesce(heading, none), F.transform(lines, lambda x: block("text", None, x)), F.array(block("table", None, rows)), F.coalesce(note, none), F.array(block("text", None, F.substring_index("text", " ", 2))))
    e = c.select("conv_id", "turn", F.posexplode(parts).alias("at", "x"))
    # a turn has at most as many blocks as its text has code points, and four
    return e.select(F.col("conv_id").alias("doc"), ((F.col("turn").cast("long") * F.lit(1 << 32)) + F.col("at")).alias("ord"), "x.*", (F.floor(F.col("turn") / 2) + 1).alias("page"), F.lit(False).alias("list_item"))


@query("j6_j10_modal_segments")
def modal_segments(spark, sf_dir):
    return segments(conversation_blocks(spark, sf_dir)).withColumnRenamed("doc", "conv_id")


@query("j12_j13_modal_spans")
def modal_spans(spark, sf_dir):
    """Where each page lies in the enriched text, and the modals that lie in it."""
    s = segments(conversation_blocks(spark, sf_dir))
    m = s.filter("modal_id IS NOT NULL").groupBy(F.col("doc").alias("of"), F.col("page").alias("on")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("char_start", "char_end", "modal_id"))), lambda x: F.concat_ws(":", x["modal_id"], x["char_start"].cast("string"), x["char_end"].cast("string"))), ",").alias("modals"))
    return page_bounds(s).join(m, F.col("doc").eqNullSafe(F.col("of")) & (F.col("page") == F.col("on")), "left").select(F.col("doc").alias("conv_id"), "page", "char_start", "char_end", F.coalesce("modals", F.lit("")).alias("modals"))
