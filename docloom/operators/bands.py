"""Header bands, column names and roles, and footers of a sheet's regions.

Cells are rows (sheet, row, col, text, number, dated, bold, center, shaded, bordered, wide): `number` is null unless the cell is a number, `wide` says that a merge
across columns covers it, and every cell of a merged range has the range's text. Regions are rows (sheet, region, r0, r1, c0, c1) and, where there is one, the rows of
a title inside (title_r0, title_r1) and the first row of a filter (filter_row). Merges are rows (sheet, r0, r1, c0, c1).

Cells are counted by row, and a band is told from the first row that can begin one and the first that forbids it, which are two minima. So a region never comes
together in one task; only the few rows of a band, or the last rows of a region, are looked at in order. A null sheet is a sheet of its own, null and blank texts are
no cells, of cells in one place the one with the smallest text counts, and a region without cells has neither band nor footer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.plans.checkpoints import kept
from docloom.plans.registry import query, table

#: What a header row scores at least, the style it has at least, the share of values that ends a band, and what the filter's row gains.
SCORE, STYLE, VALUES, FILTERED = 1.8, 0.5, 0.5, 0.8
#: Rows before a band, rows of a band, characters of a short label, footer rows.
BEFORE, DEPTH, SHORT, FOOT = 8, 5, 14, 15
#: Weights of the shares of cells in a row's score.
WEIGHTS = {"bold": 1.2, "center": 0.8, "shaded": 0.6, "bordered": 0.4, "words": 0.8, "short": 0.5, "wide": 0.4, "marks": -1.5, "numbered": -1.5, "values": -0.8}
FILL = 0.6
#: Names of columns with remarks, parts of names of columns with items; columns searched for numbered items, their least number and share.
REMARKS = ("합의", "수신", "비고", "참고", "참조", "근거", "관련근거", "관련규정")
ITEMS = ("사항", "항목", "구분", "내용", "업무", "분류", "제목", "품목", "품명")
ITEM_COLS, ITEM_CELLS, ITEM_SHARE = 5, 3, 0.3
#: Numbers and dates as text, labels of key and value.
NUMBER, DATE, LABEL = r"^-?[0-9,]+(\.[0-9]+)?%?$", r"^[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}\.?$", r".[:：]\s*$"
#: Rows by which cells find their region.
STRIPE = 64

KEY = ["sheet", "region"]


def _same(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names])


def _with(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """a and b's other columns, joined on names, where nulls are equal. Neither side is broadcast: the tables have a row for each sheet or more, and Parquet makes
    them look far smaller than they are in the driver's memory."""
    kept_of_b = [] if how in ("left_semi", "left_anti") else [F.col(f"b.{c}") for c in b.columns if c not in names]
    return a.alias("a").join(b.hint("merge").alias("b"), _same("a", "b", names), how).select("a.*", *kept_of_b)


def whole(regions: DataFrame) -> DataFrame:
    """Regions with all their columns, no region twice."""
    for c in ("title_r0", "title_r1", "filter_row"):
        if c not in regions.columns:
            regions = regions.withColumn(c, F.lit(None).cast("long"))
    return regions.select(*KEY, "r0", "r1", "c0", "c1", "title_r0", "title_r1", "filter_row").dropDuplicates(KEY)


def placed(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """The cells with a text, in one line, and the region that they lie in."""
    c = cells.withColumn("text", T.one_line(F.coalesce(F.col("text"), F.lit("")))).filter("text <> '' AND row IS NOT NULL AND col IS NOT NULL")
    rest = [x for x in c.columns if x not in ("sheet", "row", "col")]
    c = c.groupBy("sheet", "row", "col").agg(F.min(F.struct("text", *[x for x in rest if x != "text"])).alias("x")).select("sheet", "row", "col", "x.*")
    stripes = regions.select(*KEY, "r0", "r1", "c0", "c1", F.explode(F.sequence(F.floor(F.col("r0") / STRIPE), F.floor(F.col("r1") / STRIPE))).alias("stripe"))
    met = _with(c.withColumn("stripe", F.floor(F.col("row") / STRIPE)), stripes, ["sheet", "stripe"])
    return met.filter("row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1").drop("stripe", "r0", "r1", "c0", "c1")


def measured(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """(sheet, region, row, filled, share by kind, fill, style, pair, kinds of the row): one row for each row of a region that has cells (placed)."""
    t, flag = T.compact(F.col("text")), lambda c: F.coalesce(F.col(c), F.lit(False))
    value = F.col("number").isNotNull() | flag("dated") | t.rlike(NUMBER) | t.rlike(DATE)
    kinds = {"bold": flag("bold"), "center": flag("center"), "shaded": flag("shaded"), "bordered": flag("bordered"), "wide": flag("wide"), "words": ~value, "values": value}
    kinds |= {"short": F.length("text") <= SHORT, "marks": T.is_mark(F.col("text")), "numbered": T.numbering_level(F.col("text")) > 0}
    rows = cells.groupBy(*KEY, "row").agg(F.count(F.lit(1)).alias("filled"), *[F.count_if(x).alias(k) for k, x in kinds.items()], F.count_if(F.col("text").rlike(LABEL)).alias("labels"))
    rows = _with(rows, regions, KEY)
    share = {k: F.col(k) / F.col("filled") for k in kinds}
    fill = F.col("filled") / (F.col("c1") - F.col("c0") + 1)
    pair = (F.col("labels") > 0) & (fill < 0.5)
    filtered = F.coalesce((F.col("row") == F.col("filter_row")) & (share["values"] < VALUES) & ~pair, F.lit(False))
    # sums in a fixed order, so that a score is the same on every run
    score = reduce(lambda x, y: x + y, [F.lit(w) * share[k] for k, w in WEIGHTS.items()]) + F.lit(FILL) * fill
    style = share["bold"] + share["shaded"] + F.when(share["center"] >= 0.5, 0.5).otherwise(0.0)
    extra = lambda by: F.when(filtered, by).otherwise(0.0)
    return rows.select(
        *KEY, "row", "filled", pair.alias("pair"),
        ((F.col("marks") > 0) | (F.col("numbered") > 0)).alias("item"),
        (share["values"] >= VALUES).alias("data"),
        F.round(score + extra(FILTERED), 9).alias("score"), F.round(style + extra(STYLE), 9).alias("style"),
        F.coalesce(F.col("row").between(F.col("title_r0"), F.col("title_r1")), F.lit(False)).alias("title"),
    ).withColumn("strong", (F.col("score") >= SCORE) & (F.col("style") >= STYLE) & (F.col("filled") >= 2))


def axes(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the rows (sheet, region, row) whose numbers rise by one: three or more, and more than half of the row's cells."""
    w = W.partitionBy(*KEY, "row").orderBy("col")
    n = _with(cells, rows.select(*KEY, "row"), [*KEY, "row"], "left_semi")
    n = n.withColumn("step", F.round(F.col("number") - F.last("number", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)), 6))
    n = n.groupBy(*KEY, "row").agg(F.count(F.lit(1)).alias("filled"), F.count("number").alias("n"), F.count_if(F.col("step") == 1).alias("ones"))
    return n.filter("n >= 3 AND 2 * n > filled AND ones = n - 1").select(*KEY, "row")


def _bands(rows: DataFrame, cells: DataFrame, regions: DataFrame, merges: DataFrame, depth: int) -> DataFrame:
    """(sheet, region, row, score): the header rows of regions, from measured rows."""
    inside = _with(rows, regions.select(*KEY, "r0"), KEY).filter("row >= r0")
    free = ~F.col("title") & ~F.col("pair")
    begins, weak = free & ~F.col("item") & F.col("strong"), ~F.col("item") & ~F.col("strong")
    blocks = free & (F.col("item") | (weak & (F.col("row") - F.col("r0") + 1 >= BEFORE)))
    first = inside.groupBy(*KEY).agg(F.min(F.when(begins, F.col("row"))).alias("first"), F.min(F.when(blocks, F.col("row"))).alias("block"))
    first = first.filter("first IS NOT NULL AND (block IS NULL OR first < block)").drop("block")
    near = kept(_with(rows, first, KEY).filter(F.col("row").between(F.col("first"), F.col("first") + depth - 1)))
    reach = merges.groupBy("sheet", F.col("r0").alias("row")).agg(F.max("r1").alias("reach"))
    near = _with(near, reach, ["sheet", "row"], "left")
    near = _with(near, axes(cells, near.filter("data AND row > first")).withColumn("axis", F.lit(True)), [*KEY, "row"], "left")
    before = W.partitionBy(*KEY).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    covered = (F.max("reach").over(before) >= F.col("row")) & (F.col("filled") >= 2) & (F.col("score") >= SCORE)
    kind = F.when(F.col("row") == F.col("first"), "go").when(F.col("title") | F.col("item"), "stop").when(F.col("data"), F.when(F.col("axis"), "axis").otherwise("stop"))
    kind = kind.when(F.col("strong"), "go").when(covered, "last").otherwise("stop")
    near = near.withColumn("kind", kind)
    # a row belongs to the band if all rows down to it are there and let the band go on
    near = near.withColumn("went", F.count_if(F.col("kind") == "go").over(before))
    near = near.filter((F.col("went") == F.col("row") - F.col("first")) & (F.col("kind") != "stop"))
    return near.select(*KEY, "row", F.when(F.col("kind") != "axis", F.col("score")).alias("score"))


def bands(cells: DataFrame, regions: DataFrame, merges: DataFrame, depth: int = DEPTH, rows: DataFrame | None = None) -> DataFrame:
    """(sheet, region, row, score): the header rows of each region; the score of a row that only continues a row of years or days is null.

    A band begins at the first row that is marked out by style and reads like labels. Titles, empty rows and lone pairs of label and value come before it, and rows that
    are too weak in the first seven rows; a later weak row, or an item with a mark or number, ends the search. Then rows follow as long as they are strong, the row under a merge of the band last, and
    the first row of values ends it, unless the values count up by one. A filter below the band found says where to search again. Takes placed cells."""
    regions = whole(regions)
    rows = kept(measured(cells, regions)) if rows is None else rows
    found = kept(_bands(rows, cells, regions, merges, depth))
    ends = found.groupBy(*KEY).agg(F.max("row").alias("end"))
    again = _with(regions, ends, KEY, "left").filter("filter_row BETWEEN r0 AND r1 AND (end IS NULL OR filter_row > end)").withColumn("r0", F.col("filter_row"))
    second = kept(_bands(rows, cells, again, merges, depth))
    return _with(found, second.select(*KEY).distinct(), KEY, "left_anti").unionByName(second)


def names(cells: DataFrame, regions: DataFrame, header: DataFrame) -> DataFrame:
    """(sheet, region, col, label, name): for each column of a region with a band the first of its labels and its name: labels from top to bottom, those that repeat the one above left out.
    A column without labels has the name of its left neighbour, and of equal names the later ones are numbered. Null without labels to its left."""
    h = _with(cells.select(*KEY, "row", "col", "text"), header.select(*KEY, "row"), [*KEY, "row"], "left_semi")
    above = F.lag("text").over(W.partitionBy(*KEY, "col").orderBy("row"))
    h = h.withColumn("new", ~above.eqNullSafe(F.col("text"))).filter("new").groupBy(*KEY, "col").agg(F.sort_array(F.collect_list(F.struct("row", "text"))).alias("labels"))
    h = h.select(*KEY, "col", F.col("labels")[0]["text"].alias("label"), F.array_join(F.transform("labels", lambda x: x["text"]), "_").alias("own"))
    cols = _with(whole(regions), header.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, F.explode(F.sequence("c0", "c1")).alias("col"))
    h = _with(cols, h, [*KEY, "col"], "left")
    h = h.withColumn("base", F.last("own", ignorenulls=True).over(W.partitionBy(*KEY).orderBy("col")))
    k = F.row_number().over(W.partitionBy(*KEY, "base").orderBy("col"))
    return h.withColumn("k", k).select(*KEY, "col", "label", F.when(F.col("k") > 1, F.concat("base", F.lit("_"), F.col("k").cast("string"))).otherwise(F.col("base")).alias("name"))


def roles(cells: DataFrame, named: DataFrame, header: DataFrame, merges: DataFrame) -> DataFrame:
    """named with `role`: "items", "remarks", "values" or null for columns without a name.

    Items are the columns under the merge of the first label, else the first labelled column if it is called so, else those of the first five whose texts below the
    band are numbered often enough."""
    first = named.filter("label IS NOT NULL").groupBy(*KEY).agg(F.min(F.struct("col", "label")).alias("x")).select(*KEY, F.col("x.col").alias("at"), F.col("x.label").alias("called"))
    edges = header.groupBy(*KEY).agg(F.min("row").alias("top"), F.max("row").alias("end"))
    first = _with(first, edges, KEY)
    m = merges.filter("c1 > c0").select("sheet", "r0", "r1", "c0", "c1", F.explode(F.sequence(F.floor(F.col("r0") / STRIPE), F.floor(F.col("r1") / STRIPE))).alias("stripe"))
    m = _with(first.select(*KEY, "top", "at", F.floor(F.col("top") / STRIPE).alias("stripe")), m, ["sheet", "stripe"]).filter("top BETWEEN r0 AND r1 AND at BETWEEN c0 AND c1")
    first = _with(first, m.groupBy(*KEY).agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")), KEY, "left")
    called = reduce(lambda x, y: x | y, [F.contains(T.compact(F.col("called")), F.lit(t)) for t in ITEMS])
    told = F.col("c0").isNotNull() | called
    first = first.select(*KEY, "end", told.alias("told"), F.coalesce("c0", F.when(called, F.col("at"))).alias("lo"), F.coalesce("c1", F.when(called, F.col("at"))).alias("hi"))
    left = named.groupBy(*KEY).agg((F.min("col") + ITEM_COLS).alias("beyond"))
    search = _with(first.filter("NOT told"), left, KEY).select(*KEY, "end", "beyond")
    texts = _with(cells.select(*KEY, "row", "col", "text"), search, KEY).filter("row > end AND col < beyond").filter(~T.is_mark(F.col("text")))
    numbered = texts.groupBy(*KEY, "col").agg(F.count(F.lit(1)).alias("n"), F.count_if(T.numbering_level(F.col("text")) > 0).alias("hits"))
    numbered = numbered.filter((F.col("n") >= ITEM_CELLS) & (F.col("hits") >= ITEM_SHARE * F.col("n"))).select(*KEY, "col", F.lit(True).alias("numbered"))
    out = _with(_with(named, first.select(*KEY, "lo", "hi"), KEY, "left"), numbered, [*KEY, "col"], "left")
    role = F.when(F.col("col").between(F.col("lo"), F.col("hi")) | F.col("numbered"), "items").when(T.compact(F.col("name")).isin(*REMARKS), "remarks").when(F.col("name").isNotNull(), "values")
    return out.withColumn("role", role).drop("lo", "hi", "numbered")


def footers(cells: DataFrame, regions: DataFrame, header: DataFrame, foot: int = FOOT) -> DataFrame:
    """(sheet, region, row, kind): the rows that end a region without belonging to its body: "note" or "total".

    The last rows in a row that are totals or notes, up to `foot`, if all are totals or an empty row lies above them; else the notes at their end. A region has a body
    left, or no footer. The body is what lies below the band, or all rows but the title. Takes placed cells."""
    regions = whole(regions)
    first = F.min_by("text", F.when(~T.is_mark(F.col("text")), F.col("col")))
    rows = cells.groupBy(*KEY, "row").agg(F.bool_or(T.is_mark(F.col("text"))).alias("marked"), F.bool_or(T.is_total(F.col("text")) & ~T.is_mark(F.col("text"))).alias("total"), first.alias("first"))
    rows = rows.select(*KEY, "row", F.when(F.col("total"), "total").when(~F.col("marked") & T.is_note(F.col("first")), "note").otherwise("body").alias("kind"))
    ends = header.groupBy(*KEY).agg(F.max("row").alias("end"))
    rows = kept(_with(_with(rows, regions.select(*KEY, "r0", "title_r0", "title_r1"), KEY), ends, KEY, "left"))
    body = rows.filter("NOT coalesce(row BETWEEN title_r0 AND title_r1, false) AND (end IS NULL OR row > end)")
    last = body.groupBy(*KEY).agg(F.max(F.when(F.col("kind") == "body", F.col("row"))).alias("last"), F.count(F.lit(1)).alias("n"))
    tail = _with(body.select(*KEY, "row", "kind", "r0"), last, KEY).filter("last IS NULL OR row > last")
    # the limit by region is taken before rows are shuffled
    tail = tail.withColumn("up", F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("row")))).filter(F.col("up") <= foot)
    block = tail.groupBy(*KEY).agg(F.min("row").alias("top"), F.max(F.when(F.col("kind") == "total", F.col("row"))).alias("last_total"), F.count_if(F.col("kind") == "note").alias("notes"), F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.max("r0").alias("r0"))
    block = block.filter("rows < n").withColumn("row", F.col("top") - 1)
    above = _with(block, rows.select(*KEY, "row", F.lit(True).alias("full")), [*KEY, "row"], "left").drop("row")
    above = above.withColumn("all", (F.col("notes") == 0) | (F.col("full").isNull() & (F.col("top") - 1 >= F.col("r0"))))
    out = _with(tail.select(*KEY, "row", "kind"), above.select(*KEY, "all", "last_total"), KEY)
    return out.filter("all OR last_total IS NULL OR row > last_total").select(*KEY, "row", "kind")


def _sheets(spark, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A sheet for each customer: who it is, labels in one row or in two of which the upper one is merged, the orders, their sum and a note, as the orders have them."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sheet"), "c_name", "c_mktsegment", "c_acctbal")
    two, apart = F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_acctbal") < 3000
    k = F.row_number().over(W.partitionBy("sheet").orderBy("o_orderkey")).cast("long")
    cell = lambda row, col, text, number=None, bold=None, dated=None, wide=None: F.struct(
        F.lit(row).cast("long").alias("row") if not isinstance(row, Column) else row.cast("long").alias("row"),
        F.lit(col).cast("long").alias("col"),
        (text if isinstance(text, Column) else F.lit(text)).cast("string").alias("text"),
        (F.lit(None) if number is None else number).cast("double").alias("number"),
        F.lit(dated or False).alias("dated"),
        (F.lit(False) if bold is None else bold).alias("bold"),
        F.lit(wide or False).alias("wide"),
    )
    top = F.when(two, 4).otherwise(3).cast("long")
    labels = ["구분", "상태", "금액", "일자", "비고"]
    body = [cell(F.col("k") + F.col("top"), 1, F.concat(F.col("k").cast("string"), F.lit(". "), F.col("o_orderkey").cast("string"))), cell(F.col("k") + F.col("top"), 2, F.when(F.col("o_orderstatus") == "F", "○").otherwise(F.col("o_orderstatus")))]
    body += [cell(F.col("k") + F.col("top"), 3, F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_totalprice")), cell(F.col("k") + F.col("top"), 4, F.date_format("o_orderdate", "yyyy-MM-dd"), dated=True), cell(F.col("k") + F.col("top"), 5, F.col("o_orderpriority"))]
    of = _with(o.withColumn("k", k), c.withColumn("top", top), ["sheet"])
    n = of.groupBy("sheet").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("sum"), F.max("o_orderdate").alias("day"))
    heads = _with(c.withColumn("top", top).withColumn("two", two), n, ["sheet"])
    end = F.col("top") + F.col("n") + F.when(apart, 2).otherwise(1)
    fixed = [cell(1, 1, "계정:"), cell(1, 2, F.col("c_name"))]
    fixed += [cell(3, j + 1, F.when(~F.col("two") | (j == 0), t).otherwise("주문" if j < 4 else t), bold=F.lit(True), wide=0 < j < 4) for j, t in enumerate(labels)]
    fixed += [cell(4, j + 1, F.when(F.col("two"), t)) for j, t in enumerate(labels)]
    fixed += [cell(end, 1, "합계"), cell(end, 3, F.col("sum"), F.col("sum")), cell(end + 1, 1, F.concat(F.lit("※ "), F.date_format("day", "yyyy-MM-dd")))]
    cells = of.select("sheet", F.explode(F.array(*body)).alias("x")).union(heads.select("sheet", F.explode(F.array(*fixed)).alias("x"))).select("sheet", "x.*").filter("text IS NOT NULL")
    cells = cells.withColumns({"center": F.col("bold"), "shaded": F.lit(False), "bordered": F.lit(False)})
    regions = heads.select("sheet", F.lit(0).cast("long").alias("region"), F.lit(1).cast("long").alias("r0"), (end + 1).cast("long").alias("r1"), F.lit(1).cast("long").alias("c0"), F.lit(5).cast("long").alias("c1"))
    box = lambda r0, r1, c0, c1: F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip(("r0", "r1", "c0", "c1"), (r0, r1, c0, c1), strict=True)])
    merges = heads.filter("two").select("sheet", F.explode(F.array(box(3, 3, 2, 4), box(3, 4, 1, 1), box(3, 4, 5, 5))).alias("x")).select("sheet", "x.*")
    # asked for in many joins: written once
    return cells, kept(regions), kept(merges)


_SHEETS = """s AS (SELECT c_custkey AS sheet, c_mktsegment IN ('BUILDING', 'MACHINERY') AS two, c_acctbal < 3000 AS apart, count(*) AS n,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 4 ELSE 3 END + count(*) + CASE WHEN c_acctbal < 3000 THEN 2 ELSE 1 END AS last FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment, c_acctbal)"""


@query("m10_header_bands", f"WITH {_SHEETS} SELECT sheet, 0::BIGINT AS region, 3::BIGINT AS row, round((1.2 + 0.8 + 0.8 + 0.5 + 0.6)::DOUBLE + 0.4 * 3 / 5, 9) AS score FROM s UNION ALL SELECT sheet, 0, 4, (0.8 + 0.5 + 0.6)::DOUBLE FROM s WHERE two")
def header_bands(spark, sf_dir):
    cells, regions, merges = _sheets(spark, sf_dir)
    return bands(kept(placed(cells, regions)), regions, merges)


@query("m11_column_roles", f"WITH {_SHEETS} SELECT sheet, 0::BIGINT AS region, col::BIGINT AS col, CASE WHEN two AND col BETWEEN 2 AND 4 THEN '주문' ELSE t END AS label, CASE WHEN two AND col BETWEEN 2 AND 4 THEN '주문_' ELSE '' END || t AS name, role FROM s, (VALUES (1, '구분', 'items'), (2, '상태', 'values'), (3, '금액', 'values'), (4, '일자', 'values'), (5, '비고', 'remarks')) x(col, t, role)")
def column_roles(spark, sf_dir):
    cells, regions, merges = _sheets(spark, sf_dir)
    c = kept(placed(cells, regions))
    h = kept(bands(c, regions, merges))
    return roles(c, names(c, regions, h), h, merges)


@query("m12_footers", f"WITH {_SHEETS} SELECT sheet, 0::BIGINT AS region, last AS row, 'total' AS kind FROM s WHERE apart UNION ALL SELECT sheet, 0, last + 1, 'note' FROM s")
def footer_rows(spark, sf_dir):
    cells, regions, merges = _sheets(spark, sf_dir)
    c = kept(placed(cells, regions))
    return footers(c, regions, kept(bands(c, regions, merges)))
