"""Hierarchies of sheets: for each row the chain of headings above it, column by column.

Cells are rows (sheet, row, col, text). A plain text stands for its column and resets it; a text with a marker goes one step deeper if its kind of marker is new in the
column, and back to that kind's step if it isn't. A change of a column empties the columns to its right. Cells are folded as they stream by, in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.plans.registry import query, table

#: The kinds of markers and how they are told, the first that fits.
MARKERS = (
    ("je", r"^제\s*\d+\s*[장조절편관]"),
    ("dec", r"^\d+[-.]\d+[.)\s]"),
    ("pnum", r"^\(\d+\)"),
    ("pkor", r"^\([가-힣]\)"),
    ("platin", r"^\([a-zA-Z]\)"),
    ("num", r"^\d+[.)](?!\d)"),
    ("kor", r"^[가나다라마바사아자차카타파하][.)]"),
    ("uroman", r"^[IVXLCDM]+[.)]"),
    ("lroman", r"^[ivxlcdm]+[.)]"),
    ("ulatin", r"^[A-Z][.)]"),
    ("alpha", r"^[a-z][.)]"),
    ("bullet", r"^[-·•▪]\s"),
)


def marker_kind(text: Column) -> Column:
    """The kind of the marker that a text begins with, or null."""
    t, out = F.trim(text), F.lit(None).cast("string")
    for kind, pattern in reversed(MARKERS):
        out = F.when(t.rlike(pattern), kind).otherwise(out)
    return out


def stepped(chain: list[tuple[str | None, str]], kind: str | None, text: str) -> list[tuple[str | None, str]]:
    """A column's chain after a text."""
    if kind is None:
        return [(None, text)]
    at = next((k for k, (other, _) in enumerate(chain) if other == kind), len(chain))
    return [*chain[:at], (kind, text)]


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells in order of sheet, row, col, text; of those in one place the first counts. Only the chains at hand and the row at hand are held."""
    before, chains, path = None, {}, None
    for batch in batches:
        out: list[tuple] = []
        for sheet, row, col, text, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = (sheet, row, col)
            if at == before:
                continue
            if before is not None and at[:2] != before[:2]:
                out.append((*before[:2], path))
            if before is None or sheet != before[0]:
                chains = {}
            before = at
            if any(c > col for c in chains):
                chains = {c: x for c, x in chains.items() if c <= col}
            chains[col] = stepped(chains.get(col, []), kind, text)
            path = [t for c in sorted(chains) for _, t in chains[c]]
        yield _rows(out, batch.schema)
    if before is not None:
        yield _rows([(*before[:2], path)], batch.schema)


def _rows(out: list[tuple], like: pa.Schema) -> pa.RecordBatch:
    sheets, rows, paths = zip(*out, strict=True) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(sheets, like.field(0).type), pa.array(rows, like.field(1).type), pa.array(paths, pa.list_(pa.string()))], names=["sheet", "row", "path"])


def paths(cells: DataFrame, cols: Iterable[int]) -> DataFrame:
    """(sheet, row, path) for each row with a text in the hierarchy columns. Null and blank texts leave the chains as they are; of repeated cells one counts."""
    cols = sorted(cols)
    c = cells.filter(F.col("col").isin(cols) & F.col("row").isNotNull() & (F.trim("text") != "")).select("sheet", "row", "col", F.trim("text").alias("text"))
    schema = f"sheet {c.schema['sheet'].dataType.simpleString()}, row {c.schema['row'].dataType.simpleString()}, path array<string>"
    # one shuffle and one sort, and no sheet is ever held: the rest streams through
    c = c.repartition("sheet").sortWithinPartitions("sheet", "row", "col", "text")
    return c.withColumn("kind", marker_kind(F.col("text"))).mapInArrow(_fold, schema)


@query("e14_m16_hierarchy_paths")
def hierarchy_paths(spark, sf_dir):
    """Sheets of suppliers: the state of their lines where it changes, line numbers by two kinds of markers, and quantities."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row"), "l_returnflag", "l_linenumber", "l_quantity")
    before = F.lag("l_returnflag").over(W.partitionBy("sheet").orderBy("row"))
    lines = lines.withColumn("state", F.when(~before.eqNullSafe(F.col("l_returnflag")), F.col("l_returnflag")))
    number = F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.col("l_linenumber").cast("string"), F.lit(". line"))).otherwise(F.concat(F.chr(F.lit(96) + F.col("l_linenumber")), F.lit(") line")))
    amount = F.concat(F.lit("("), F.col("l_quantity").cast("long").cast("string"), F.lit(") pieces"))
    cells = lines.select("sheet", "row", F.posexplode(F.array("state", number, amount)).alias("col", "text"))
    return paths(cells, (0, 1, 2))
