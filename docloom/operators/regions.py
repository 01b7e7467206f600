"""Regions of spreadsheets: occupied cells that lie near one another, as boxes.

Cells never come together by sheet: they are joined to runs within a row, runs are linked between near rows, and components are found over the links. What is merged
after that are boxes: those of a sheet that has few in one go, those of larger sheets dealt by clusters that cannot touch each other, and each cluster in order.

Cells are rows (sheet, row, col, bordered); repeated cells count once, and cells without row or column are left out. A null sheet is a sheet of its own.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.operators import graph
from docloom.plans.checkpoints import kept
from docloom.plans.registry import query, table

#: Empty rows and columns that do not part a region.
GAP_ROWS, GAP_COLS = 1, 1
#: A title or note has so many rows at most, lies so many empty rows away at most, and shares so much of the narrower width.
TITLE_ROWS, TITLE_GAP, TITLE_SHARE = 2, 2, 0.6
#: When a sheet's main region lets remnants be told (borders, cells), how far away they lie, and what is kept all the same (cells, density, columns).
MAIN_BORDERS, MAIN_CELLS, AWAY_ROWS, AWAY_COLS, KEEP_CELLS, KEEP_DENSITY, KEEP_COLS = 0.3, 20, 2, 2, 12, 0.35, 2
#: Boxes of about so many go to one call of Python, whole clusters.
TOGETHER = 4096
#: Rows of a sheet whose links are followed together first.
TOGETHER_ROWS = 4096
#: Boxes of a sheet that one task merges at most.
LOCAL = 4096
#: Bands in which boxes look for each other.
BAND_ROWS, BAND_COLS = 64, 16


def box() -> list[Column]:
    """The box around boxes, and what they hold."""
    return [F.min("r0").alias("r0"), F.max("r1").alias("r1"), F.min("c0").alias("c0"), F.max("c1").alias("c1"), F.sum("cells").alias("cells"), F.sum("bordered").alias("bordered")]


def runs(cells: DataFrame, gap_cols: int = GAP_COLS) -> DataFrame:
    """(id, sheet, row, c0, c1, cells, bordered): neighbouring cells of a row, over gaps that do not part them."""
    once = cells.filter("row IS NOT NULL AND col IS NOT NULL").groupBy("sheet", "row", "col").agg(F.max(F.coalesce(F.col("bordered").cast("int"), F.lit(0))).alias("bordered"))
    w = W.partitionBy("sheet", "row").orderBy("col")
    new = F.when(F.col("col") - F.lag("col").over(w) <= gap_cols + 1, 0).otherwise(1)
    run = once.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    out = run.groupBy("sheet", "row", "run").agg(F.min("col").alias("c0"), F.max("col").alias("c1"), F.count(F.lit(1)).alias("cells"), F.sum("bordered").alias("bordered"))
    return kept(out.drop("run").withColumn("id", F.monotonically_increasing_id()))


def run_links(runs: DataFrame, gap_rows: int = GAP_ROWS, gap_cols: int = GAP_COLS) -> DataFrame:
    """(a, b, sheet, rows): runs of near rows that are near. For each pair of rows a run is linked to the last one of the other row that begins before it: since runs of a row
    are apart, no earlier one can be near without that one belonging to it. So links are no more than runs, however full the rows are."""
    sides = [F.struct((F.col("row") - (d if low else 0)).alias("top"), F.lit(d).alias("d"), F.lit(low).alias("low")) for d in range(1, gap_rows + 2) for low in (False, True)]
    met = runs.select("id", "sheet", "c0", "c1", F.explode(F.array(*sides)).alias("x")).select("id", "sheet", "c0", "c1", "x.*")
    w = W.partitionBy("sheet", "top", "d").orderBy("c0", "low").rowsBetween(W.unboundedPreceding, -1)
    before = lambda low: F.last(F.when(F.col("low") == low, F.struct("id", "c1")), ignorenulls=True).over(w)
    met = met.withColumn("upper", before(False)).withColumn("lower", before(True)).withColumn("other", F.when(F.col("low"), F.col("upper")).otherwise(F.col("lower")))
    return met.filter(F.col("c0") - F.col("other.c1") <= gap_cols + 1).select(F.col("id").alias("a"), F.col("other.id").alias("b"), "sheet", F.floor(F.col("top") / TOGETHER_ROWS).alias("rows"))


def components(cells: DataFrame, gap_rows: int = GAP_ROWS, gap_cols: int = GAP_COLS) -> DataFrame:
    """(id, sheet, r0, r1, c0, c1, cells, bordered): the box of each group of cells that reach one another over small gaps."""
    r = runs(cells, gap_cols)
    c = graph.connected(run_links(r, gap_rows, gap_cols), ("sheet", "rows"))
    r = r.join(c.hint("merge"), F.col("id") == F.col("v"), "left").select("sheet", F.coalesce("c", "id").alias("id"), F.col("row").alias("r0"), F.col("row").alias("r1"), "c0", "c1", "cells", "bordered")
    return r.groupBy("sheet", "id").agg(*box())


def clusters(boxes: DataFrame, slack: int = 0) -> DataFrame:
    """boxes with `cluster`: boxes that meet, where `slack` rows further down count as met, and then the boxes around them that meet, until none do."""
    boxes = kept(boxes)
    out, around = boxes.withColumn("cluster", F.col("id")), boxes
    while True:
        band = lambda lo, hi, n: F.explode(F.sequence(F.floor(F.col(lo) / n), F.floor(hi / n)))
        spread = around.select("sheet", "id", "r0", "r1", "c0", "c1", band("r0", F.col("r1") + slack, BAND_ROWS).alias("y")).withColumn("x", band("c0", F.col("c1"), BAND_COLS))
        a, b = (spread.select("sheet", "y", "x", F.struct("id", "r0", "r1", "c0", "c1").alias(k)) for k in "ab")
        b = b.withColumnRenamed("sheet", "of")
        # the sheet is a key of the join: bands alone would pair the boxes of all sheets
        met = a.join(b.hint("merge"), a["sheet"].eqNullSafe(b["of"]) & (a["y"] == b["y"]) & (a["x"] == b["x"])).filter(F.col("a.id") < F.col("b.id"))
        met = met.filter(f"a.r0 <= b.r1 + {slack} AND b.r0 <= a.r1 + {slack} AND a.c0 <= b.c1 AND b.c0 <= a.c1")
        links = kept(met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), "sheet").distinct())
        if not links.limit(1).count():
            return out
        c = graph.connected(links, ("sheet",))
        out = kept(out.join(c, F.col("cluster") == F.col("v"), "left").withColumn("cluster", F.coalesce("c", "cluster")).drop("v", "c"))
        around = kept(out.groupBy("sheet", F.col("cluster").alias("id")).agg(*box()))


def united(a: list, b: list) -> list:
    return [min(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3]), a[4] + b[4], a[5] + b[5]]


def adjacent(a: list, b: list) -> bool:
    """a title or note and what it stands above or below; a is not below b."""
    shared, width = min(a[3], b[3]) - max(a[2], b[2]) + 1, min(a[3] - a[2], b[3] - b[2]) + 1
    return 0 <= b[0] - a[1] - 1 <= TITLE_GAP and shared > 0 and shared / width >= TITLE_SHARE and min(a[1] - a[0], b[1] - b[0]) < TITLE_ROWS


def met(a: list, b: list) -> bool:
    return a[0] <= b[1] and b[0] <= a[1] and a[2] <= b[3] and b[2] <= a[3]


def _fold_pairs(boxes: list[list], near, reach: int) -> None:
    """The first pair that is near, by place on the sheet, is merged, until there is none. After a merge no other pair is new but those of the box it made, so
    that the boxes before it are held against this one only."""
    place = lambda b: (b[0], b[2])
    boxes.sort(key=place)
    i, made = 0, None
    while i < len(boxes):
        own = boxes[i]
        if made is not None and own is not made:  # before the new box: only the two of them
            j = k if own[1] + reach >= made[0] and near(own, made) else len(boxes)
        else:
            j, end = i + 1, own[1] + reach
            while j < len(boxes) and boxes[j][0] <= end and not near(own, boxes[j]):
                j += 1
            j = j if j < len(boxes) and boxes[j][0] <= end else len(boxes)
            made = None
        if j < len(boxes):
            made = united(own, boxes.pop(j))
            del boxes[i]
            k = bisect.bisect_right(boxes, place(made), key=place)
            boxes.insert(k, made)
            i = 0
        else:
            i += 1


def merged_in_order(boxes: list[list]) -> list[list]:
    """The first pair of adjacent boxes is merged and looked for anew, until there is none; last, boxes that have come to overlap are one."""
    _fold_pairs(boxes, adjacent, TITLE_GAP + 1)
    _fold_pairs(boxes, met, 0)
    return boxes


_COLUMNS = ["r0", "r1", "c0", "c1", "cells", "bordered"]


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    sheets, out = [], []
    for _, own in group.groupby("cluster", sort=False):
        made = merged_in_order(own[_COLUMNS].to_numpy().tolist())
        sheets += [own["sheet"].iloc[0]] * len(made)
        out += made
    return pd.DataFrame(out, columns=_COLUMNS).assign(sheet=sheets)[["sheet", *_COLUMNS]]


def _whole_sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Boxes in order of sheets, each of LOCAL boxes at most."""

    def done(made: list[tuple], last) -> pa.RecordBatch:
        rows = [x for sheet, boxes in made for x in zip([sheet] * len(boxes), *zip(*boxes, strict=True), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), last, strict=True)], names=["sheet", *_COLUMNS])

    def settled(boxes: list[list]) -> list[list]:
        _fold_pairs(boxes, met, 0)
        return merged_in_order(boxes)

    now, own, types = None, [], None
    for batch in batches:
        types, made = [f.type for f in batch.schema], []
        for sheet, *box_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own and sheet != now:
                made.append((now, settled(own)))
                own = []
            now = sheet
            own.append(box_)
        if made:
            yield done(made, types)
    if own:
        yield done([(now, settled(own))], types)


def merged(boxes: DataFrame) -> DataFrame:
    """Boxes that overlap are one, then titles and notes join what they belong to. Sheets of up to LOCAL boxes are merged one by one as they stand; boxes of larger
    ones are dealt by clusters, in which alone the order matters."""
    boxes = kept(boxes)
    large = kept(boxes.groupBy(F.col("sheet").alias("of")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LOCAL).select("of"))
    schema = ", ".join(f"{c} {boxes.schema[c].dataType.simpleString()}" for c in ("sheet", *_COLUMNS))
    if not large.limit(1).count():
        return _settled(boxes, schema)
    same = F.col("sheet").eqNullSafe(F.col("of"))
    small = boxes.join(large.hint("merge"), same, "left_anti")
    return _settled(small, schema).union(_merged(boxes.join(large.hint("merge"), same, "left_semi")))


def _settled(boxes: DataFrame, schema: str) -> DataFrame:
    return boxes.select("sheet", *_COLUMNS).repartition("sheet").sortWithinPartitions("sheet").mapInArrow(_whole_sheets, schema)


def _merged(boxes: DataFrame) -> DataFrame:
    """The boxes of large sheets. The order matters only within clusters of boxes that a title's reach connects."""
    one = clusters(boxes).groupBy("sheet", F.col("cluster").alias("id")).agg(*box())
    near = kept(clusters(one, TITLE_GAP + 1))
    alone = near.groupBy("cluster").agg(F.count(F.lit(1)).alias("k")).filter("k = 1").select("cluster")
    schema = ", ".join(f"{c} {near.schema[c].dataType.simpleString()}" for c in ("sheet", *_COLUMNS))
    more = kept(near.join(alone, "cluster", "left_anti"))
    folded = more.groupBy(F.pmod(F.xxhash64("cluster"), F.lit(more.count() // TOGETHER + 1))).applyInPandas(_merge, schema)
    return near.join(alone, "cluster", "left_semi").select("sheet", *_COLUMNS).union(folded)


def without_remnants(boxes: DataFrame) -> DataFrame:
    """Where a sheet's largest region is a bordered table, small pieces below it or beside it go, unless they are dense enough to be tables themselves."""
    boxes = kept(boxes.withColumn("density", F.col("cells") / ((F.col("r1") - F.col("r0") + 1) * (F.col("c1") - F.col("c0") + 1))).withColumn("borders", F.col("bordered") / F.col("cells")))
    main = boxes.groupBy(F.col("sheet").alias("of")).agg(F.max(F.struct("cells", (-F.col("r0")).alias("up"), (-F.col("c0")).alias("left"), "r0", "r1", "c0", "c1", "borders")).alias("main"))
    b = boxes.join(main.hint("merge"), F.col("sheet").eqNullSafe(F.col("of")))
    tells = (F.col("main.borders") >= MAIN_BORDERS) & (F.col("main.cells") >= MAIN_CELLS)
    below = F.col("r0") > F.col("main.r1") + AWAY_ROWS
    beside = F.expr("r0 <= main.r1 AND r1 >= main.r0") & ((F.col("c0") > F.col("main.c1") + AWAY_COLS) | (F.col("c1") < F.col("main.c0") - AWAY_COLS))
    dense = (F.col("cells") >= KEEP_CELLS) & (F.col("density") >= KEEP_DENSITY) & (F.col("c1") - F.col("c0") + 1 >= KEEP_COLS)
    is_main = F.expr("r0 = main.r0 AND c0 = main.c0 AND r1 = main.r1 AND c1 = main.c1")
    return b.filter(is_main | ~tells | ~(below | beside) | dense).select("sheet", *_COLUMNS, "density", "borders")


def regions(cells: DataFrame, gap_rows: int = GAP_ROWS, gap_cols: int = GAP_COLS) -> DataFrame:
    """(sheet, region, r0, r1, c0, c1, cells, bordered, density, borders), numbered from the top of each sheet."""
    out = without_remnants(merged(components(cells, gap_rows, gap_cols)))
    return out.withColumn("region", F.row_number().over(W.partitionBy("sheet").orderBy("r0", "c0")))


def calendar_cells(spark, sf_dir) -> DataFrame:
    """A sheet for each supplier: its lines by the week of shipping and the quantity; those that came back have a border."""
    week = F.floor(F.datediff("l_shipdate", F.lit("1992-01-01")) / 7).cast("long")
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), week.alias("row"), F.col("l_quantity").cast("long").alias("col"), (F.col("l_returnflag") == "R").alias("bordered"))


@query(
    "m4_region_components",
    "WITH RECURSIVE cell AS MATERIALIZED (SELECT DISTINCT l_suppkey AS sheet, CAST(floor(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) / 7) AS BIGINT) AS r, CAST(l_quantity AS BIGINT) AS c FROM lineitem), "
    "id AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY sheet, r, c) AS i FROM cell), off AS (SELECT * FROM range(-2, 3) y(dr), range(-2, 3) x(dc)), "
    "near AS MATERIALIZED (SELECT p.i AS a, q.i AS b FROM (SELECT * FROM id, off) p JOIN id q ON q.sheet = p.sheet AND q.r = p.r + dr AND q.c = p.c + dc WHERE p.i <> q.i), "
    "way(a, b) AS (SELECT i, i FROM id UNION SELECT way.a, near.b FROM way JOIN near ON near.a = way.b), root AS (SELECT a, min(b) AS k FROM way GROUP BY a) "
    "SELECT sheet, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) AS cells FROM id JOIN root ON a = i GROUP BY sheet, k",
)
def region_components(spark, sf_dir):
    return components(calendar_cells(spark, sf_dir)).select("sheet", "r0", "r1", "c0", "c1", "cells")


@query("m5_m6_regions")
def sheet_regions(spark, sf_dir):
    return regions(calendar_cells(spark, sf_dir))
