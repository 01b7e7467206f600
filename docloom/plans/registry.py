"""Every query of the library outside the training-data subpackage, by name, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "k2_dominant_ngram"


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame, and the SQL that gives the same rows."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> None:
    from docloom.operators import admission, alignment, bands, blocks, graph, grids, hierarchy, hybrid, jobs, markdown, modal, page_tables, pages, prefix_tree, relational, repetition, regions, retrieval, sheets, state, text, windows  # noqa: F401


load()
