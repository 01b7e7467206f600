"""Numbers for rows in a global order, without a window that puts all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.plans.checkpoints import ensure_folder


def numbered(df: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """df with its row number (from 1) in the given order, which must be total. Rows are sorted by range; only one count a partition is added up."""
    ensure_folder(df.sparkSession)
    # written down, since a range partitioning that is computed anew may cut elsewhere
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part, own = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()  # one row a partition
    before, offsets = 0, {}
    for p, n in counts:
        offsets[p], before = before, before + n
    start = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), part) if offsets else F.lit(0)
    return rows.withColumn(name, (start + own + 1).cast("long")).drop("_at")
