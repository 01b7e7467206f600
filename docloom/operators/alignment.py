"""Alignment of two sequences of rows, sheet by sheet: rows that were rendered, and the rows of the source that they come from.

Rows are (sheet, row, text), ordered by row. Of both sides only what tells rows apart comes to a sheet's task: a digest of the text without white space.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.plans.registry import query, table

OPERATIONS = "k int, tag string, i1 long, i2 long, j1 long, j2 long"


def signed(rows: DataFrame) -> DataFrame:
    """(sheet, row, sign); a null text is an empty one, and white space and case don't tell rows apart."""
    text = F.lower(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"\s+", ""))
    return rows.select("sheet", "row", F.md5(text.cast("binary")).alias("sign"))


def operations(rendered: DataFrame, source: DataFrame) -> DataFrame:
    """(sheet, k, tag, i1, i2, j1, j2): what turns the rendered rows [i1, i2) into the source's rows [j1, j2), counted from 0 within a sheet. The longest block of equal
    rows is matched first (of equally long ones the first), then what lies before it and after it. A sheet on one side only is one insertion or deletion."""
    rendered, source = signed(rendered), signed(source)
    kind = rendered.schema["sheet"].dataType.simpleString()

    def of(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        left, right = (x.sort_values(["row", "sign"])["sign"].tolist() for x in (a, b))
        ops = difflib.SequenceMatcher(None, left, right, autojunk=False).get_opcodes()
        return pd.DataFrame([(key[0], k, *op) for k, op in enumerate(ops)], columns=["sheet", "k", "tag", "i1", "i2", "j1", "j2"])

    return rendered.groupBy("sheet").cogroup(source.groupBy("sheet")).applyInPandas(of, f"sheet {kind}, {OPERATIONS}")


def source_rows(ops: DataFrame) -> DataFrame:
    """(sheet, row, source_row), from 0: equal rows, and of replaced ones as many as both sides have, in order."""
    pairs = ops.filter("tag IN ('equal', 'replace')").withColumn("n", F.least(F.col("i2") - F.col("i1"), F.col("j2") - F.col("j1")))
    return pairs.withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select("sheet", (F.col("i1") + F.col("d")).alias("row"), (F.col("j1") + F.col("d")).alias("source_row"))


def replayed(ops: DataFrame, rendered: DataFrame, source: DataFrame) -> DataFrame:
    """(sheet, row, text): the source, made of the rendered rows that are equal and of those that are put in. `row` counts from 0."""
    kept = ops.filter("tag = 'equal'").withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("i2") - F.col("i1") - 1)))
    kept = kept.select("sheet", (F.col("j1") + F.col("d")).alias("to"), (F.col("i1") + F.col("d")).alias("row")).join(rendered, ["sheet", "row"]).select("sheet", F.col("to").alias("row"), "text")
    new = ops.filter("tag IN ('insert', 'replace')").withColumn("row", F.explode(F.sequence("j1", F.col("j2") - 1))).select("sheet", "row").join(source, ["sheet", "row"]).select("sheet", "row", "text")
    return kept.union(new)


@query("c13_row_alignment")
def row_alignment(spark, sf_dir):
    """Each supplier's lines as they were shipped against the lines as they were ordered, and which correspond."""
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sheet"), line.alias("line"), F.datediff("l_shipdate", F.lit("1992-01-01")).alias("day"))
    shipped = lines.select("sheet", (F.col("day").cast("long") * (1 << 40) + F.col("line")).alias("row"), F.col("line").cast("string").alias("text"))
    return source_rows(operations(shipped, lines.select("sheet", F.col("line").alias("row"), F.col("line").cast("string").alias("text"))))
