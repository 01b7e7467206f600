"""Retrieval: hashed vectors, nearest vectors, sparse scores, keyword-overlap ranking, routing of questions. Hybrid search has its own module."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from docloom.operators import hybrid
from docloom.plans.checkpoints import kept
from docloom.plans.registry import query, table


_COS = "(list_inner_product(q.e, v.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(v.e, v.e))))"


@query("n5_f4_nearest", f"WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), s AS (SELECT q.vec_id AS q, v.vec_id AS vec_id, round({_COS}, 6) AS score FROM v q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id) SELECT q, vec_id, score FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) <= 5")
def nearest(spark, sf_dir, k=5, every=100):
    """The k nearest vectors of each query vector, by the cells of an index: those that the bound of their cell rules out are not scored."""
    v = kept(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"), F.lit(None).cast("string").alias("text")))
    found = hybrid.search(hybrid.build(v), v.filter(F.col("id") % every == 0), k, dense=1.0, sparse=0.0, others_only=True)
    return found.select("q", F.col("id").alias("vec_id"), "score")


def hashed_vectors(size: int = 64):
    """Each word's digest names a place and a sign; counts are added up and brought to length one."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        places: dict[str, tuple[int, float]] = {}
        for s in parts:
            out = []
            for t in s:
                v = np.zeros(size)
                for w in (t or "").lower().split():
                    if w not in places:
                        if len(places) > 200_000:
                            places.clear()
                        d = hashlib.md5(w.encode()).digest()
                        places[w] = (int.from_bytes(d, "big") % size, 1.0 if d[0] & 1 else -1.0)
                    i, sign = places[w]
                    v[i] += sign
                n = float(np.sqrt(v @ v))
                out.append((v / n if n else v).tolist())
            yield pd.Series(out)

    return embed


@query("n1_hashed_embedding")
def hashed_embedding(spark, sf_dir, size=64):
    return table(spark, sf_dir, "benchmark").select("item_id", hashed_vectors(size)("text").alias("embedding"))


def terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, weight): 1 + ln(count), per document."""
    t = df.select(key, F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")).alias("term")).filter("length(term) >= 2")
    return t.groupBy(key, "term").agg((1 + F.log(F.count(F.lit(1)))).alias("w"))


_TERMS = "SELECT {k}, term, 1 + ln(count(*)) AS w FROM (SELECT {k}, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM {t}) WHERE length(term) >= 2 GROUP BY ALL"


@query("n6_n7_hybrid", "WITH d AS (" + _TERMS.format(k="conv_id", t="conversations") + "), q AS (" + _TERMS.format(k="item_id", t="benchmark") + "), s AS (SELECT item_id, conv_id, round(sum(d.w * q.w), 6) AS score FROM d JOIN q USING (term) GROUP BY ALL) SELECT item_id, conv_id, score FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, conv_id) <= 10")
def sparse_search(spark, sf_dir, k=10):
    """Sparse dot products over shared terms: a join on terms, not of all pairs."""
    from pyspark.sql import Window as W

    d = terms(table(spark, sf_dir, "conversations"), "conv_id", "text")
    q = terms(table(spark, sf_dir, "benchmark"), "item_id", "text").withColumnRenamed("w", "qw")
    s = d.join(q, "term").groupBy("item_id", "conv_id").agg(F.round(F.sum(F.col("w") * F.col("qw")), 6).alias("score"))
    return s.withColumn("r", F.row_number().over(W.partitionBy("item_id").orderBy(F.desc("score"), "conv_id"))).filter(F.col("r") <= k).drop("r")


@query("f2_c15_rank_reports", "WITH r AS (SELECT doc_id, lower(text) AS hay, n_chars FROM documents), q AS (SELECT DISTINCT term FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term FROM benchmark WHERE item_id = 3) WHERE length(term) >= 4) SELECT doc_id, (SELECT count(*) FROM q WHERE contains(r.hay, q.term)) AS overlap FROM r ORDER BY overlap DESC, n_chars DESC, doc_id LIMIT 20")
def rank_reports(spark, sf_dir, item=3, k=20):
    """Reports by how many of the question's terms they hold, then by rank. The terms of one question are an array, so each report is looked at once."""
    q = table(spark, sf_dir, "benchmark").filter(F.col("item_id") == item).select(F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) >= 4)).alias("terms"))
    r = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("hay"), "n_chars").join(F.broadcast(q))  # one row
    return r.select("doc_id", "n_chars", F.size(F.filter("terms", lambda t: F.contains(F.col("hay"), t))).cast("long").alias("overlap")).orderBy(F.desc("overlap"), F.desc("n_chars"), "doc_id").limit(k).select("doc_id", "overlap")


# fixed values: words that ask for the whole
CUES = ("요약", "전체", "종류", "핵심", "개요", "무엇을 다루", "주제", "전반", "통틀어", "정리해", "한눈에", "summary", "summarize", "overview", "overall", "main topic", "key topics")


@query("o6_route_questions", "SELECT conv_id, turn, CASE WHEN " + " OR ".join(f"contains(lower(text), '{c}')" for c in CUES) + " THEN 'global' ELSE 'local' END AS route FROM conversations WHERE role = 'user'")
def route_questions(spark, sf_dir, cues=CUES):
    low = F.lower("text")
    return table(spark, sf_dir, "conversations").filter("role = 'user'").select("conv_id", "turn", F.when(F.exists(F.array(*map(F.lit, cues)), lambda c: F.contains(low, c)), "global").otherwise("local").alias("route"))


@query("o9_selection_audit", "WITH s AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), m AS (SELECT source, max(n) AS top FROM s GROUP BY 1) SELECT source, count(*) FILTER (WHERE n = top) > 1 AS tied, count(*) AS kinds, max(top)::BIGINT AS top FROM s JOIN m USING (source) GROUP BY source")
def selection_audit(spark, sf_dir):
    n = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    m = n.groupBy("source").agg(F.max("n").alias("top"))
    return n.join(m, "source").groupBy("source").agg((F.count_if(F.col("n") == F.col("top")) > 1).alias("tied"), F.count(F.lit(1)).alias("kinds"), F.max("top").alias("top"))
