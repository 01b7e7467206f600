"""Windows and ordered folds: ranks, running offsets, runs, packs, chains."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.plans.registry import query, table

from .jobs import SQL as JOBS
from .jobs import jobs


@query("e1_top_per_partition", f"WITH {JOBS} SELECT id, kind, workspace, k::BIGINT AS k FROM (SELECT *, row_number() OVER (PARTITION BY kind, workspace ORDER BY created_at, id) AS k FROM jobs WHERE status = 'queued') WHERE k <= 8")
def top_per_partition(spark, sf_dir, most=8):
    k = F.row_number().over(W.partitionBy("kind", "workspace").orderBy("created_at", "id"))
    return jobs(spark, sf_dir).filter("status = 'queued'").withColumn("k", k.cast("long")).filter(F.col("k") <= most).select("id", "kind", "workspace", "k")


@query("e3_rank_ahead", f"WITH {JOBS} SELECT id, row_number() OVER (PARTITION BY kind, workspace ORDER BY created_at, id) - 1 AS ahead, count(*) OVER (PARTITION BY kind, workspace) AS total FROM jobs WHERE status = 'queued'")
def rank_ahead(spark, sf_dir):
    w = W.partitionBy("kind", "workspace")
    return jobs(spark, sf_dir).filter("status = 'queued'").select("id", (F.row_number().over(w.orderBy("created_at", "id")) - 1).cast("long").alias("ahead"), F.count(F.lit(1)).over(w).alias("total"))


@query("e4_running_offset", "SELECT conv_id, turn, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM conversations")
def running_offset(spark, sf_dir):
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).cast("long").alias("char_start"))


@query("e5_e6_runs", "WITH f AS (SELECT user_id, event_id, event_type, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = event_type THEN 0 ELSE 1 END AS c FROM events), g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT f.*, e.ts FROM f JOIN events e USING (event_id))) SELECT user_id, run::BIGINT AS run, min(event_id) AS first_id, count(*) AS n FROM g GROUP BY user_id, run HAVING count(*) BETWEEN 2 AND 30")
def runs(spark, sf_dir):
    """Gaps and islands: consecutive rows with one key, of 2 to 30 members."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("c", F.when(F.lag("event_type").over(w) == F.col("event_type"), 0).otherwise(1))
    g = e.withColumn("run", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return g.groupBy("user_id", "run").agg(F.min("event_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n BETWEEN 2 AND 30").select("user_id", F.col("run").cast("long").alias("run"), "first_id", "n")


def greedy_packs(lengths, cap: int, joiner: int = 2):
    """Pack number of each item of an ordered array of lengths: items join while they fit, and an oversize item stands alone, whole."""
    start = F.struct(F.lit(0).alias("pack"), F.lit(0).alias("used"), F.array().cast("array<int>").alias("out"))

    def step(acc, n):
        fits = (acc["used"] > 0) & (acc["used"] + joiner + n <= cap)
        pack = F.when(acc["used"] == 0, acc["pack"]).when(fits, acc["pack"]).otherwise(acc["pack"] + 1)
        return F.struct(pack.alias("pack"), F.when(fits, acc["used"] + joiner + n).otherwise(n).alias("used"), F.concat(acc["out"], F.array(pack)).alias("out"))

    return F.aggregate(lengths, start, step, lambda acc: acc["out"])


@query(
    "e8_e9_greedy_pack",
    "WITH RECURSIVE o AS (SELECT conv_id, turn, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations), p AS (SELECT conv_id, turn, k, 0 AS pack, n AS used FROM o WHERE k = 1 UNION ALL SELECT o.conv_id, o.turn, o.k, CASE WHEN p.used + 2 + o.n <= 1100 THEN p.pack ELSE p.pack + 1 END, CASE WHEN p.used + 2 + o.n <= 1100 THEN p.used + 2 + o.n ELSE o.n END FROM p JOIN o ON o.conv_id = p.conv_id AND o.k = p.k + 1) SELECT conv_id, turn, pack::BIGINT AS pack, (max(pack) OVER (PARTITION BY conv_id) + 1)::BIGINT AS of_packs FROM p",
)
def greedy_pack(spark, sf_dir, cap=1100):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.length("text").alias("n")))).alias("items"))
    c = c.withColumn("packs", greedy_packs(F.col("items.n"), cap))
    out = c.select("conv_id", F.explode(F.arrays_zip(F.col("items.turn").alias("turn"), "packs")).alias("x"), (F.array_max("packs") + 1).cast("long").alias("of_packs"))
    return out.select("conv_id", F.col("x.turn").alias("turn"), F.col("x.packs").cast("long").alias("pack"), "of_packs")


@query(
    "e11_context_windows",
    "SELECT conv_id, turn, coalesce(string_agg(t, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS before, coalesce(string_agg(t, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING), '') AS after FROM (SELECT conv_id, turn, text AS t FROM conversations)",
)
def context_windows(spark, sf_dir, before=3, after=6):
    w = W.partitionBy("conv_id").orderBy("turn")
    joined = lambda lo, hi: F.array_join(F.collect_list("text").over(w.rowsBetween(lo, hi)), " ")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", joined(-before, -1).alias("before"), joined(1, after).alias("after"))


@query("e12_next_nonblank", "SELECT conv_id, turn, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations WHERE trim(text) <> ''")
def next_nonblank(spark, sf_dir):
    return table(spark, sf_dir, "conversations").filter(F.trim("text") != "").select("conv_id", "turn", F.lead("role").over(W.partitionBy("conv_id").orderBy("turn")).alias("next_role"))


@query("e13_heading_path", "WITH l AS (SELECT conv_id, turn, role, CASE WHEN role = 'system' THEN 1 WHEN role = 'user' THEN 2 ELSE 3 END AS lv, text AS t FROM conversations), h AS (SELECT conv_id, turn, lv, last_value(CASE WHEN lv = 1 THEN t END IGNORE NULLS) OVER w AS h1, last_value(CASE WHEN lv = 2 THEN t END IGNORE NULLS) OVER w AS h2 FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT conv_id, turn, concat_ws(' > ', h1, CASE WHEN lv >= 2 THEN h2 END) AS path FROM h")
def heading_path(spark, sf_dir):
    """The stack of headings above each row: the last of each level so far."""
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(3)
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", level.alias("lv"), F.col("text").alias("t"))
    w = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    last = lambda k: F.last(F.when(F.col("lv") == k, F.col("t")), ignorenulls=True).over(w)
    return c.select("conv_id", "turn", "lv", last(1).alias("h1"), last(2).alias("h2")).select("conv_id", "turn", F.concat_ws(" > ", "h1", F.when(F.col("lv") >= 2, F.col("h2"))).alias("path"))


@query("e16_fill_down", "SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN event_type END AS v FROM events)")
def fill_down(spark, sf_dir):
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("event_id", F.last(F.when(F.col("event_id") % 3 == 0, F.col("event_type")), ignorenulls=True).over(w).alias("filled"))


@query("e18_duplicate_names", "SELECT p_partkey, CASE WHEN k = 1 THEN p_brand ELSE p_brand || '_' || CAST(k AS VARCHAR) END AS name FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)")
def duplicate_names(spark, sf_dir):
    k = F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", k.alias("k")).select("p_partkey", F.when(F.col("k") == 1, F.col("p_brand")).otherwise(F.concat_ws("_", "p_brand", "k")).alias("name"))


@query("e19_step_test", "SELECT l_orderkey, count(d) > 0 AND min(d) = 1 AND max(d) = 1 AS steps FROM (SELECT l_orderkey, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS d FROM lineitem) GROUP BY 1")
def step_test(spark, sf_dir):
    d = F.col("l_linenumber") - F.lag("l_linenumber").over(W.partitionBy("l_orderkey").orderBy("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", d.alias("d")).groupBy("l_orderkey").agg(F.coalesce((F.count("d") > 0) & (F.min("d") == 1) & (F.max("d") == 1), F.lit(False)).alias("steps"))


@query("e20_stop_after_failure", f"WITH {JOBS} SELECT id, CASE WHEN coalesce(max(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY workspace ORDER BY created_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) = 0 THEN 'key/' || CAST(id AS VARCHAR) END AS object_key FROM jobs WHERE workspace IS NOT NULL")
def stop_after_failure(spark, sf_dir):
    """After the first failure of a workspace nothing more is stored: the key is null."""
    w = W.partitionBy("workspace").orderBy("created_at", "id").rowsBetween(W.unboundedPreceding, 0)
    failed = F.max((F.col("status") == "failed").cast("int")).over(w)
    return jobs(spark, sf_dir).filter("workspace IS NOT NULL").select("id", F.when(failed == 0, F.concat(F.lit("key/"), F.col("id").cast("string"))).alias("object_key"))


@query("d21_phase_dwell", "SELECT user_id, event_type, sum(s)::BIGINT AS micros FROM (SELECT user_id, event_type, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS s FROM events) GROUP BY 1, 2")
def phase_dwell(spark, sf_dir):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, sf_dir, "events").select("user_id", "event_type", (F.lead(at).over(W.partitionBy("user_id").orderBy("ts", "event_id")) - at).alias("s"))
    return e.groupBy("user_id", "event_type").agg(F.sum("s").alias("micros"))
