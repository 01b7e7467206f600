"""Trees of dotted numbers: ancestors that no row has, roll-ups from the leaves to the roots, and the way down to each node.

Trees are dealt by sheet and root, once, and walked in order with only the way to a node at hand. Where many rows share a root, a row counts for each prefix of its
number instead, and these counts are added up before the shuffle; so a root over a third of all rows costs one row a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docloom.plans.registry import query, table

#: Buckets in which rows are counted by sheet and root, rows of a bucket that are walked in one task at most, and nodes written at a time.
BUCKETS, TOGETHER, ROWS = 1 << 16, 1_000_000, 16384

def _prefixes(no: Column, least: int = 0) -> Column:
    """Of a number 1.2.3: 1, 1.2, 1.2.3; without the last ones if least is 1."""
    parts = F.split(no, r"\.")
    last = F.size(parts) - least
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda k: F.array_join(F.slice(parts, 1, k), ".")))


def _walk(types: dict[str, pa.DataType]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order of sheet and number, part by part -> nodes: a node comes after all below it, so that only the way to the row at hand is held."""
    names = ["sheet", "node", "parent", "depth", "phantom", "label", "breadcrumb", "n_children", "n_rows", "total"]

    def close(way: list[list], out: list[tuple], sheet) -> None:
        node, label, phantom, crumb, kids, n, total = way.pop()
        parent = way[-1] if way else None
        out.append((sheet, node, parent and parent[0], len(way) + 1, phantom, label, crumb, kids, n, total))
        if parent:
            parent[4] += 1
            parent[5] += n
            if total is not None:
                parent[6] = total if parent[6] is None else parent[6] + total

    def table(out: list[tuple]) -> pa.RecordBatch:
        cols = zip(*out, strict=True) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, types[n]) for c, n in zip(cols, names, strict=True)], names=names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, way = None, []
        for batch in batches:
            out: list[tuple] = []
            for sheet, no, label, value in zip(*(batch.column(c).to_pylist() for c in ("sheet", "no", "label", "value")), strict=True):
                if way and (sheet != now or not no.startswith(way[0][0])):
                    while way:
                        close(way, out, now)
                now = sheet
                while way and not (no == way[-1][0] or no.startswith(way[-1][0] + ".")):
                    close(way, out, now)
                while not way or way[-1][0] != no:
                    at = len(way[-1][0]) + 1 if way else 0
                    end = no.find(".", at)
                    crumb = "" if not way else f"{way[-1][3]} > " if way[-1][3] else ""
                    if way:
                        crumb += f"{way[-1][0]}:{'' if way[-1][1] is None else way[-1][1]}"
                    way.append([no if end < 0 else no[:end], None, True, crumb, 0, 0, None])
                    if end < 0:
                        way[-1][1:3] = label, False
                        way[-1][5:7] = 1, value
                if len(out) >= ROWS:
                    yield table(out)
                    out = []
            yield table(out)
        out = []
        while way:
            close(way, out, now)
        yield table(out)

    return walk


def tree(rows: DataFrame) -> DataFrame:
    """(sheet, node, parent, depth, phantom, label, breadcrumb, n_children, n_rows, total) of rows (sheet, no, label, value, at).

    Of rows with one number the last one, by at, counts (ties: the largest label, then value). Other texts than dotted numbers, and nulls, are left out; a null sheet
    is a sheet of its own. A phantom has no label; a node's total is the sum of the values in its subtree, null if none of these has one.
    """
    d = rows.filter(F.col("no").rlike(r"^[0-9]+(\.[0-9]+)*\z")).withColumn("root", F.substring_index("no", ".", 1))
    bucket = F.pmod(F.xxhash64("sheet", "root"), F.lit(BUCKETS))
    # BUCKETS counts a task; those that are full are at most the rows by TOGETHER
    full = [r["b"] for r in d.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TOGETHER).collect()]
    if not full:
        return _walked(d)
    hot = bucket.isin(full) if len(full) < 1000 else F.array_contains(F.lit(full), bucket)
    return _walked(d.filter(~hot)).union(_added_up(d.filter(hot)))


def _walked(d: DataFrame) -> DataFrame:
    """Trees of bounded size, dealt by sheet and root in one shuffle."""
    d = d.repartition("sheet", "root")
    r = d.groupBy("sheet", "root", "no").agg(F.max(F.struct("at", "label", "value")).alias("x")).select("sheet", "root", "no", "x.label", "x.value")
    like = r.select("sheet", "label", F.lit(0).alias("k"), "value").groupBy("k").agg(F.sum("value").alias("total")).schema["total"].dataType
    kinds = {"sheet": r.schema["sheet"].dataType.simpleString(), "label": r.schema["label"].dataType.simpleString(), "total": like.simpleString()}
    schema = f"sheet {kinds['sheet']}, node string, parent string, depth long, phantom boolean, label {kinds['label']}, breadcrumb string, n_children long, n_rows long, total {kinds['total']}"
    types = {f.name: f.type for f in to_arrow_schema(StructType.fromDDL(schema))}
    # parts as an array, so that what lies below a node follows it
    r = r.sortWithinPartitions("sheet", "root", F.split("no", r"\."))
    return r.select("sheet", "no", "label", F.col("value").cast(like).alias("value")).mapInArrow(_walk(types), schema)


def _added_up(rows: DataFrame) -> DataFrame:
    """Trees of any size: each row counts for its prefixes, by joins."""
    r = rows.groupBy("sheet", "no").agg(F.max(F.struct("at", "label", "value")).alias("x")).select("sheet", "no", "x.label", "x.value")
    e = r.select("sheet", "no", "label", "value", F.explode(_prefixes(F.col("no"))).alias("node"))
    own = F.col("node") == F.col("no")
    n = e.groupBy("sheet", "node").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"), (F.count_if(own) == 0).alias("phantom"), F.max(F.when(own, F.col("label"))).alias("label"))
    n = n.withColumn("depth", F.size(F.split("node", r"\.")).cast("long")).withColumn("parent", F.when(F.col("depth") > 1, F.regexp_replace("node", r"\.[0-9]+$", "")))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    children = n.filter("parent IS NOT NULL").groupBy(F.col("sheet").alias("of"), F.col("parent").alias("under")).agg(F.count(F.lit(1)).alias("n_children"))
    step = n.select(F.col("sheet").alias("of"), F.col("node").alias("above"), F.struct("depth", F.concat_ws(":", "node", F.coalesce("label", F.lit(""))).alias("s")).alias("step"))
    ways = n.select("sheet", "node", F.explode(_prefixes(F.col("node"), 1)).alias("up")).join(step, same("sheet", "of") & (F.col("up") == F.col("above")))
    ways = ways.groupBy(F.col("sheet").alias("in"), F.col("node").alias("to")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("step")), lambda x: x["s"]), " > ").alias("way"))
    out = n.join(children, same("sheet", "of") & (F.col("node") == F.col("under")), "left").join(ways, same("sheet", "in") & (F.col("node") == F.col("to")), "left")
    return out.select("sheet", "node", "parent", "depth", "phantom", "label", F.coalesce("way", F.lit("")).alias("breadcrumb"), F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_rows", "total")


_NO = "concat_ws('.', {k} {div} 500, {k} {div} 50 % 10, {k} % 50) || CASE WHEN l_linenumber = 1 THEN '' ELSE '.' || CAST(l_linenumber AS {text}) END"


@query(
    "m26_prefix_tree",
    f"""WITH RECURSIVE src AS (SELECT l_suppkey AS sheet, {_NO.format(k='l_orderkey', div='//', text='VARCHAR')} AS no, l_returnflag AS label, l_quantity::BIGINT AS value, l_orderkey * 8 + l_linenumber AS place FROM lineitem),
r AS (SELECT sheet, no, label, value FROM (SELECT *, row_number() OVER (PARTITION BY sheet, no ORDER BY place DESC, label DESC, value DESC) AS k FROM src) WHERE k = 1),
up AS (SELECT sheet, no, label, value, no AS node FROM r UNION ALL SELECT sheet, no, label, value, regexp_replace(node, '\\.[0-9]+$', '') FROM up WHERE contains(node, '.')),
nodes AS (SELECT sheet, node, CASE WHEN contains(node, '.') THEN regexp_replace(node, '\\.[0-9]+$', '') END AS parent, len(string_split(node, '.'))::BIGINT AS depth, count(*) FILTER (WHERE node = no) = 0 AS phantom,
  max(label) FILTER (WHERE node = no) AS label, count(*) AS n_rows, sum(value)::BIGINT AS total FROM up GROUP BY sheet, node),
down AS (SELECT sheet, node, label, '' AS way FROM nodes WHERE parent IS NULL UNION ALL
  SELECT n.sheet, n.node, n.label, CASE WHEN d.way = '' THEN '' ELSE d.way || ' > ' END || d.node || ':' || coalesce(d.label, '') FROM down d JOIN nodes n ON n.sheet = d.sheet AND n.parent = d.node),
kids AS (SELECT sheet, parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY 1, 2)
SELECT n.sheet, n.node, n.parent, n.depth, n.phantom, n.label, d.way AS breadcrumb, coalesce(k.n, 0) AS n_children, n.n_rows, n.total
FROM nodes n JOIN down d ON d.sheet = n.sheet AND d.node = n.node LEFT JOIN kids k ON k.sheet = n.sheet AND k.parent = n.node""",
)
def prefix_tree(spark, sf_dir):
    """Sheets of suppliers: lines by the digits of their orders; first lines stand for their orders, so that many nodes are phantoms."""
    no = F.expr(_NO.format(k="l_orderkey", div="div", text="STRING"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), no.alias("no"), F.col("l_returnflag").alias("label"), F.col("l_quantity").cast("long").alias("value"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("at"))
    return tree(rows)
