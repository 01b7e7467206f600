"""The corpus pipeline: each stage reads what its predecessor kept, written as Parquet, and works on all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.decontamination import drop_contaminated
from docloom.llm.jaccard_join import one_of_each
from docloom.llm.line_dedup import drop_lines
from docloom.llm.packing import TOKENIZER, pack
from docloom.llm.quality_rules import keep_good
from docloom.llm.store import new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars follows the text. No document goes."""
    cut = drop_lines(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    return cut.select(*[(F.col("text") if c == "text" else n_chars if c == "n_chars" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, by sequence."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Packing depends on how the rows lie in partitions, and string tiling isn't SQL. tests/llm holds each operator against brute force, and test_pipeline.py the stages against the operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = new_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
