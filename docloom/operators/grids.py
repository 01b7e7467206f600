"""Grids of tables whose cells span rows and columns, and headers of two rows.

Cells are rows (sheet, row, k, text, cs, rs): the k-th cell that is written in a row, and how many columns and rows it covers; a span that is null or below 1 is 1.
A cell goes to the first column, right of the ones before it, that no cell from above covers. Rows and columns are counted from 0 and 1. A row that no span from above
reaches depends on no row before it, so a sheet is filled in pieces that begin at such rows, and spans are kept as ranges, however wide they are.

Cells without row or place in the row are left out, repeated cells count once (that of the smallest text), a null text is empty, and a null sheet is a sheet of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.plans.checkpoints import kept
from docloom.plans.registry import query, table

#: Pieces of a sheet that are filled together.
PIECES = 512
#: Columns of a row that are dealt together.
STRIP = 1024
#: Fixed value: the share of a second header row's cells that are one column wide.
SINGLE = 0.7


class Places:
    """Columns for cells of a sheet, given in the order in which they are written. Only the spans that still reach down are held."""

    def __init__(self):
        self.above: list[tuple[int, int, int]] = []  # (first column, last column, last row)
        self.here: list[tuple[int, int, int]] = []
        self.now, self.at, self.col = None, 0, 1

    def column(self, row: int, cs: int, rs: int) -> int:
        if row != self.now:
            if self.above or self.here:
                self.above, self.here = sorted(x for x in self.above + self.here if x[2] >= row), []
            self.now, self.at, self.col = row, 0, 1
        col, above = self.col, self.above
        while self.at < len(above) and above[self.at][0] <= col:
            col = max(col, above[self.at][1] + 1)
            self.at += 1
        if rs > 1:
            self.here.append((col, col + cs - 1, row + rs - 1))
        self.col = col + cs
        return col


def free_columns(cells: list[tuple[int, int, int]]) -> list[int]:
    """The column of each cell (row, cs, rs), given in the order in which they are written."""
    places = Places()
    return [places.column(*x) for x in cells]


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells in order of sheet, row, k; of those in one place the first counts. A sheet may come in several batches, and a batch may hold many sheets."""
    before, places = None, Places()
    for batch in batches:
        sheet, row, k, cs, rs = (batch.column(c).to_pylist() for c in ("sheet", "row", "k", "cs", "rs"))
        first, cols = [], []
        for n, at in enumerate(zip(sheet, row, k, strict=True)):
            if at == before:
                continue
            if before is None or at[0] != before[0]:
                places = Places()
            before = at
            first.append(n)
            cols.append(places.column(at[1], cs[n], rs[n]))
        if len(first) < len(row):
            batch = batch.take(pa.array(first, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("sheet", "row", "k")), pa.array(cols, pa.int64()), *(batch.column(c) for c in ("text", "cs", "rs"))], names=["sheet", "row", "k", "col", "text", "cs", "rs"])


def anchors(cells: DataFrame) -> DataFrame:
    """(sheet, row, k, col, text, cs, rs): where each cell begins. Row spans end with the sheet's last row that has a cell."""
    span = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1)).cast("long")
    c = cells.filter("row IS NOT NULL AND k IS NOT NULL").select("sheet", F.col("row").cast("long").alias("row"), F.col("k").cast("long").alias("k"), F.coalesce("text", F.lit("")).alias("text"), span("cs").alias("cs"), span("rs").alias("rs"))
    # of repeated cells the deepest counts here: a piece may be longer than it need be, never shorter
    rows = c.groupBy("sheet", "row").agg(F.max("rs").alias("deep"))
    w = W.partitionBy("sheet").orderBy("row")
    rows = rows.withColumn("last", F.max("row").over(W.partitionBy("sheet")))
    reach = F.max(F.col("row") + F.col("deep") - 1).over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("begins", F.when(reach >= F.col("row"), 0).otherwise(1))
    rows = rows.select(F.col("sheet").alias("of"), F.col("row").alias("at"), "last", F.sum("begins").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("piece"))
    # repeated cells are told apart by what they are before their spans are cut
    c = c.join(rows.hint("merge"), F.col("sheet").eqNullSafe(F.col("of")) & (F.col("row") == F.col("at"))).select("sheet", "row", "k", "text", "cs", F.col("rs").alias("deep"), F.least("rs", F.col("last") - F.col("row") + 1).alias("rs"), F.floor(F.col("piece") / PIECES).alias("part"))
    c = c.repartition("sheet", "part").sortWithinPartitions("sheet", "row", "k", "text", "cs", "deep").select("sheet", "row", "k", "text", "cs", "rs")
    schema = f"sheet {c.schema['sheet'].dataType.simpleString()}, row long, k long, col long, text string, cs long, rs long"
    return c.mapInArrow(_fill, schema)


def expanded(anchors: DataFrame) -> DataFrame:
    """(sheet, row, col, text, top, left): every place of the grid that a cell covers, with the cell's text and where it begins; where cells overlap, the one written last."""
    strip = F.sequence(F.floor(F.col("col") / STRIP), F.floor((F.col("col") + F.col("cs") - 1) / STRIP))
    c = anchors.select("sheet", "row", "k", "col", "text", F.explode(F.sequence(F.col("row"), F.col("row") + F.col("rs") - 1)).alias("y"), "cs", strip.alias("strips"))
    c = c.select("sheet", "row", "k", "col", "text", "y", "cs", F.explode("strips").alias("strip")).repartition("sheet", "y", "strip")
    inside = F.sequence(F.greatest(F.col("col"), F.col("strip") * STRIP), F.least(F.col("col") + F.col("cs"), (F.col("strip") + 1) * STRIP) - 1)
    c = c.select("sheet", "y", "strip", F.explode(inside).alias("x"), F.struct("row", "k", "col", "text").alias("cell"))
    c = c.groupBy("sheet", "y", "strip", "x").agg(F.max("cell").alias("cell"))
    return c.select("sheet", F.col("y").alias("row"), F.col("x").alias("col"), "cell.text", F.col("cell.row").alias("top"), F.col("cell.col").alias("left"))


def _groups(label: Column) -> Column:
    """A label that, repeated side by side, stands for one group."""
    return (F.length(label) >= 2) & ~T.is_mark(label) & label.rlike(r"\p{L}")


def two_row_headers(anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """(sheet, row, col, leaf, over): for each of the rows (sheet, row) that is the upper row of a header of two, each column's own label and the group's above it.

    The upper row has a group: a cell over two columns or more, or equal labels side by side. The next row with a text splits groups up: it has more cells than there
    are groups, most of them one column wide, no marks, and one below a group at least. A column without a label of its own has its group's, and no group then."""
    # sheets are many and their rows small on disk, so none of the sides is broadcast
    same = lambda a, b: F.col(f"{a}.sheet").eqNullSafe(F.col(f"{b}.sheet")) & (F.col(f"{a}.row") == F.col(f"{b}.row"))
    a = anchors.withColumn("label", F.trim(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).filter("label <> ''")
    full = a.select("sheet", "row").distinct().withColumn("next", F.lead("row").over(W.partitionBy("sheet").orderBy("row")))
    pairs = full.alias("a").join(rows.select("sheet", "row").distinct().hint("merge").alias("b"), same("a", "b"), "left_semi").filter("next IS NOT NULL")
    w = W.partitionBy("sheet", "row").orderBy("col", "k")
    upper = a.alias("a").join(pairs.hint("merge").alias("b"), same("a", "b")).select("a.*", "b.next")
    upper = upper.withColumn("hi", F.col("col") + F.col("cs") - 1)
    goes_on = (F.lag("label").over(w) == F.col("label")) & (F.lag("hi").over(w) + 1 == F.col("col")) & _groups(F.col("label"))
    upper = upper.withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    spans = upper.groupBy("sheet", "row", "next", "run").agg(F.min("col").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n"), F.max("cs").alias("cs")).filter("hi > lo AND (n > 1 OR cs > 1)")
    spans = spans.groupBy("sheet", "row", F.col("next")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    low = a.select("sheet", F.col("row").alias("at"), "col", "k", "cs", "label")
    lower = spans.join(low.withColumnRenamed("sheet", "of").hint("merge"), F.col("sheet").eqNullSafe(F.col("of")) & (F.col("next") == F.col("at")))
    under = F.exists("spans", lambda x: F.col("col").between(x["lo"], x["hi"]))
    ok = lower.groupBy("sheet", "row").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("spans")).alias("groups"), F.count_if(F.col("cs") == 1).alias("single"), F.bool_or(T.is_mark(F.col("label"))).alias("marked"), F.bool_or(under).alias("under"))
    ok = ok.filter((F.col("n") > F.col("groups")) & (F.col("single") >= SINGLE * F.col("n")) & ~F.col("marked") & F.col("under")).select("sheet", "row")
    over = upper.select("sheet", "row", "k", "label", F.explode(F.sequence("col", "hi")).alias("col")).groupBy("sheet", "row", "col").agg(F.max_by("label", "k").alias("label"))
    both = over.withColumn("up", F.lit(True)).unionByName(lower.select("sheet", "row", "col", "label", F.lit(False).alias("up")))
    both = both.alias("a").join(ok.hint("merge").alias("b"), same("a", "b"), "left_semi").groupBy("sheet", "row", "col").agg(F.max(F.when(~F.col("up"), F.col("label"))).alias("own"), F.max(F.when(F.col("up"), F.col("label"))).alias("group"))
    leaf = F.coalesce("own", "group")
    return both.select("sheet", "row", "col", leaf.alias("leaf"), F.when(F.col("group") != leaf, F.col("group")).alias("over"))


@query(
    "m33_grid_expansion",
    "WITH l AS (SELECT l_orderkey AS sheet, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) - 1 AS row, l_returnflag AS a, l_linestatus AS b, CAST(l_quantity::BIGINT AS VARCHAR) AS c, CAST(l_suppkey AS VARCHAR) AS d FROM lineitem) SELECT sheet, row::BIGINT AS row, x.col::BIGINT AS col, x.text FROM l, LATERAL (VALUES (1, a), (2, b), (3, c), (4, CASE WHEN b = 'F' THEN c ELSE d END)) x(col, text)",
)
def grid_expansion(spark, sf_dir):
    """A sheet for each order: states and flags that stay the same are one cell over several rows, closed lines' quantities one over two columns."""
    key = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").withColumn("row", (F.row_number().over(key) - 1).cast("long"))
    w = W.partitionBy("l_orderkey").orderBy("row")
    for c, col in (("a", "l_returnflag"), ("b", "l_linestatus")):
        new = F.when(F.lag(col).over(w).eqNullSafe(F.col(col)), 0).otherwise(1)
        lines = lines.withColumn(f"{c}_new", new).withColumn(f"{c}_run", F.sum(f"{c}_new").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn(f"{c}_n", F.count(F.lit(1)).over(W.partitionBy("l_orderkey", f"{c}_run")))
    cell = lambda text, cs, rs, there: F.when(there, F.struct(text.cast("string").alias("text"), cs.alias("cs"), rs.alias("rs")))
    one, closed = F.lit(1).cast("long"), F.col("l_linestatus") == "F"
    made = [cell(F.col("l_returnflag"), one, F.col("a_n"), F.col("a_new") == 1), cell(F.col("l_linestatus"), one, F.col("b_n"), F.col("b_new") == 1)]
    made += [cell(F.col("l_quantity").cast("long"), F.when(closed, 2).otherwise(1).cast("long"), one, F.lit(True)), cell(F.col("l_suppkey"), one, one, ~closed)]
    cells = lines.select(F.col("l_orderkey").alias("sheet"), "row", F.posexplode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("k", "x")).select("sheet", "row", "k", "x.*")
    return expanded(anchors(cells)).select("sheet", "row", "col", "text")


@query(
    "m35_two_row_headers",
    "WITH l AS (SELECT o_custkey AS sheet, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + 1 AS col, year(o_orderdate)::VARCHAR || ' orders' AS y, '#' || CAST(o_orderkey AS VARCHAR) AS leaf FROM orders), g AS (SELECT sheet, count(*) AS spans FROM (SELECT sheet, y FROM l GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1) SELECT sheet, 0::BIGINT AS row, col::BIGINT AS col, leaf, y AS over FROM l JOIN g USING (sheet) UNION ALL SELECT sheet, 0, 1, 'Customer', NULL FROM g",
)
def two_row_header_labels(spark, sf_dir):
    """A sheet for each customer, whose orders are columns below their years; years of even customers are merged cells, those of odd ones are repeated."""
    o = table(spark, sf_dir, "orders").withColumn("y", F.concat(F.year("o_orderdate").cast("string"), F.lit(" orders")))
    o = o.withColumn("k", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("o_custkey", "y")))
    merged = F.col("o_custkey") % 2 == 0
    first = F.col("k") == F.min("k").over(W.partitionBy("o_custkey", "y"))
    cell = lambda row, k, text, cs, rs: [F.lit(row).cast("long").alias("row"), k.cast("long").alias("k"), text.alias("text"), cs.cast("long").alias("cs"), F.lit(rs).cast("long").alias("rs")]
    one, sheet = F.lit(1), F.col("o_custkey").alias("sheet")
    years = o.withColumn("first", first).filter(F.col("first") | ~merged).select(sheet, *cell(0, F.col("k"), F.col("y"), F.when(merged, F.col("n")).otherwise(1), 1))
    numbers = o.select(sheet, *cell(1, F.col("k"), F.concat(F.lit("#"), F.col("o_orderkey").cast("string")), one, 1))
    corner = o.select("o_custkey").distinct().select(sheet, *cell(0, F.lit(0), F.lit("Customer"), one, 2))
    amounts = o.select(sheet, *cell(2, F.col("k"), F.col("o_totalprice").cast("string"), one, 1)).union(o.select("o_custkey").distinct().select(sheet, *cell(2, F.lit(0), F.lit("Sum"), one, 1)))
    a = kept(anchors(years.union(numbers).union(corner).union(amounts)))
    return two_row_headers(a, a.select("sheet", F.lit(0).cast("long").alias("row")).distinct())
