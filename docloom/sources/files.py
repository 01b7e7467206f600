"""Files as tables: documents of any type as bytes, JSON lines with their errors, CSV with a found header, page-separated text; and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.blocks import decode, domain, extension

OFFLOAD_BYTES = 262_144


def documents(spark: SparkSession, path: str) -> DataFrame:
    """path, content, ext, domain, text (null where the bytes are no text), status."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    text = F.when(domain(F.col("path")).isin("text", "html"), decode("content"))
    out = raw.withColumns({"ext": extension(F.col("path")), "domain": domain(F.col("path")), "text": text})
    return out.withColumn("status", F.when(F.col("domain").isin("text", "html") & F.coalesce(F.trim("text") == "", F.lit(True)), "failed").otherwise("ok"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects by schema; a line that is none has its text in _error."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", f"{schema}, _error string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_error"}).alias("x"))
    return parsed.select("x.*")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def csv_cells(spark: SparkSession, path: str) -> DataFrame:
    """CSV as text cells: path, row (from 1, blank lines left out by the header rule of the caller), col, value. Control characters go; nothing is read as a number or formula."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    rows = lines.select("path", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("k", "line"))
    fields = F.filter(F.regexp_extract_all("line", F.lit('(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1)), lambda x: x.isNotNull())
    cells = rows.filter(F.trim("line") != "").select("path", (F.col("k") + 1).alias("row"), F.posexplode(fields).alias("c", "raw"))
    plain = F.when(F.col("raw").startswith('"'), F.replace(F.expr("substring(raw, 2, length(raw) - 2)"), F.lit('""'), F.lit('"'))).otherwise(F.col("raw"))
    return cells.select("path", "row", (F.col("c") + 1).alias("col"), F.regexp_replace(plain, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "").alias("value"))


def write_debug_csv(df: DataFrame, path: str) -> None:
    """Nested columns as JSON text."""
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("struct", "array", "map") else F.col(f.name) for f in df.schema]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def pages(text: Column, separator: str) -> Column:
    """Array of (page from 1, text); a blank first page is left out, numbers stay."""
    parts = F.transform(F.split(text, separator, -1), lambda x, i: F.struct((i + 1).alias("page"), x.alias("text")))
    return F.filter(parts, lambda x: (x["page"] > 1) | (F.trim(x["text"]) != ""))


def page_range(c: Column) -> Column:
    """Sorted page numbers of ranges such as 1-3,5."""
    ends = lambda x: F.split(x, "-")
    spread = F.transform(F.split(F.regexp_replace(c, r"\s", ""), ","), lambda x: F.sequence(F.get(ends(x), 0).cast("int"), F.coalesce(F.get(ends(x), 1), F.get(ends(x), 0)).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(spread)))


def offload(df: DataFrame, payload: str, most: int = OFFLOAD_BYTES) -> DataFrame:
    """inline holds payloads up to most bytes; larger ones have only ref, the digest under which they are to be stored."""
    text = F.to_json(payload) if df.schema[payload].dataType.typeName() in ("struct", "array", "map") else F.col(payload)
    small = F.octet_length(text) <= most
    return df.withColumns({"inline": F.when(small, text), "ref": F.when(~small, F.sha2(text, 256))})
