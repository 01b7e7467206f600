"""Filters, joins, aggregates, set operations and ordered limits over job, report, graph and document tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.functions.numbering import numbered
from docloom.plans.registry import query, table

from .jobs import SQL as JOBS
from .jobs import jobs


@query("b2_list_jobs", f"WITH {JOBS} SELECT id, kind, status FROM jobs WHERE workspace = 'ws7' AND status = 'queued' AND kind IS NOT NULL ORDER BY created_at DESC, id DESC LIMIT 500")
def list_jobs(spark, sf_dir, workspace="ws7", status="queued", kind=None, limit=100_000):
    """Only the conditions that are supplied are applied; the limit is clamped to 1..500."""
    j = jobs(spark, sf_dir)
    for name, want in (("workspace", workspace), ("status", status), ("kind", kind)):
        if want is not None:
            j = j.filter(F.col(name) == want)
    return j.orderBy(F.desc("created_at"), F.desc("id")).limit(min(500, max(1, limit))).select("id", "kind", "status")


@query("b3_same_tenant", f"WITH {JOBS} SELECT a.id, count(b.id) AS n FROM jobs a JOIN jobs b ON a.workspace IS NOT DISTINCT FROM b.workspace AND a.kind = b.kind AND b.status = 'running' GROUP BY a.id")
def same_tenant(spark, sf_dir):
    """Running jobs of the same tenant and kind; the absent tenant equals itself."""
    j = jobs(spark, sf_dir)
    running = j.filter("status = 'running'").groupBy(F.col("workspace").alias("w"), F.col("kind").alias("k")).agg(F.count("id").alias("n"))
    return j.join(running, F.col("workspace").eqNullSafe(F.col("w")) & (F.col("kind") == F.col("k"))).select("id", "n")


@query("b4_f1_keyset_page", f"WITH {JOBS}, cur AS (SELECT created_at AS c, id AS i FROM jobs WHERE id = 777) SELECT id, kind FROM jobs, cur WHERE created_at < c OR (created_at = c AND id < i) ORDER BY created_at DESC, id DESC LIMIT 50")
def keyset_page(spark, sf_dir, after=777, size=50):
    """The page after a cursor, newest first, by comparison of (created_at, id)."""
    j = jobs(spark, sf_dir)
    cursor = F.broadcast(j.filter(F.col("id") == after).select(F.struct("created_at", "id").alias("cursor")))
    return j.join(cursor, F.struct("created_at", "id") < F.col("cursor")).orderBy(F.desc("created_at"), F.desc("id")).limit(size).select("id", "kind")


@query("b5_cancel_prefix", f"WITH {JOBS} SELECT id FROM jobs WHERE status = 'queued' AND idem_key LIKE 'k1%' AND idem_key <> 'k100'")
def cancel_prefix(spark, sf_dir, prefix="k1", exclude="k100"):
    j = jobs(spark, sf_dir).filter((F.col("status") == "queued") & F.col("idem_key").startswith(prefix))
    return j.filter(F.lit(exclude).isNull() | (F.col("idem_key") != F.lit(exclude))).select("id")


@query("b6_refs_in_use", f"WITH {JOBS} SELECT DISTINCT idem_key FROM jobs WHERE idem_key IN ('k4', 'k8', 'k12', 'none') AND status <> 'failed'")
def refs_in_use(spark, sf_dir, keys=("k4", "k8", "k12", "none")):
    return jobs(spark, sf_dir).filter(F.col("idem_key").isin(*keys) & (F.col("status") != "failed")).select("idem_key").distinct()


@query("b8_private_use_scrub", "SELECT doc_id, regexp_replace(text, '[\\x{E000}-\\x{F8FF}]', '', 'g') AS text FROM documents")
def private_use_scrub(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "[-]", "").alias("text"))


@query("b15_emission_cap", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents WHERE lang IN ('en', 'fr', 'de') AND n_chars >= 200) WHERE k <= 40")
def emission_cap(spark, sf_dir, kinds=("en", "fr", "de"), cap=40, least=200):
    """Profile whitelist, minimum confidence, and a cap for each type in emission order."""
    d = table(spark, sf_dir, "documents").filter(F.col("lang").isin(*kinds) & (F.col("n_chars") >= least))
    return d.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("doc_id"))).filter(F.col("k") <= cap).select("doc_id", "lang")


@query("b16_schema_violations", "SELECT doc_id, list_filter([CASE WHEN n_chars < 100 THEN 'short' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'lang' END, CASE WHEN source LIKE 'src1%' THEN 'source' END], lambda x: x IS NOT NULL)::VARCHAR AS violations FROM documents")
def schema_violations(spark, sf_dir):
    found = F.array(F.when(F.col("n_chars") < 100, "short"), F.when(~F.col("lang").isin("en", "fr"), "lang"), F.when(F.col("source").startswith("src1"), "source"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("["), F.array_join(F.filter(found, lambda x: x.isNotNull()), ", "), F.lit("]")).alias("violations"))


@query("b19_safe_basename", "SELECT page_id, CASE WHEN n = '' THEN 'file' ELSE n END AS name FROM (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^.*[/\\\\]', ''), '[\\x00-\\x1f]', '', 'g'), '^[.]+', '') AS n FROM pages)")
def safe_basename(spark, sf_dir):
    n = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", r"^.*[/\\]", ""), r"[\x00-\x1f]", ""), "^[.]+", "")
    return table(spark, sf_dir, "pages").select("page_id", F.when(n == "", "file").otherwise(n).alias("name"))


LIMITS = (("click", 3), ("view", 2), ("purchase", 1))
_LIMITS_SQL = "limits AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', {n})" for k, n in LIMITS) + ") t(kind, most))"


@query("c1_limits_join", f"WITH {JOBS}, {_LIMITS_SQL} SELECT kind, workspace, count(*) AS n, max(most)::BIGINT AS most FROM jobs JOIN limits USING (kind) WHERE attempts < most GROUP BY kind, workspace")
def limits_join(spark, sf_dir, limits=LIMITS):
    inline = F.broadcast(spark.createDataFrame(list(limits), "kind string, most int"))  # as many rows as there are kinds
    return jobs(spark, sf_dir).join(inline, "kind").filter("attempts < most").groupBy("kind", "workspace").agg(F.count(F.lit(1)).alias("n"), F.max("most").cast("long").alias("most"))


@query("c2_touched_since_success", "WITH t AS (SELECT c_custkey AS k, max(o_orderdate) AS touched FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1), s AS (SELECT o_custkey AS k, max(o_orderdate) AS success FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT t.k FROM t LEFT JOIN s ON t.k = s.k WHERE touched > coalesce(success, TIMESTAMP '1970-01-01')")
def touched_since_success(spark, sf_dir):
    """Left join with the history; what never succeeded counts from the epoch."""
    o = table(spark, sf_dir, "orders")
    t = o.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderdate").alias("touched"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("success"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return t.join(known, "k", "left_semi").filter(F.col("touched") > F.coalesce("success", F.lit("1970-01-01").cast("timestamp_ntz"))).select("k")


@query("c3_purge_without_live_children", f"WITH {JOBS} SELECT id FROM jobs p WHERE status IN ('succeeded', 'failed') AND NOT EXISTS (SELECT 1 FROM jobs c WHERE c.parent_id = p.id AND c.status IN ('queued', 'running')) ORDER BY created_at, id LIMIT 200")
def purge_without_live_children(spark, sf_dir, batch=200):
    """The anti join comes before the limit, so protected rows don't use up the batch."""
    j = jobs(spark, sf_dir)
    live = j.filter(F.col("status").isin("queued", "running") & F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("p")).distinct()
    done = j.filter(F.col("status").isin("succeeded", "failed"))
    return done.join(live, F.col("id") == F.col("p"), "left_anti").orderBy("created_at", "id").limit(batch).select("id")


@query("c5_lease_join", f"WITH {JOBS}, l AS (SELECT id, attempts + (id % 3 = 0)::INT AS attempts FROM jobs) SELECT j.id FROM jobs j JOIN l ON j.id = l.id AND j.attempts = l.attempts WHERE j.status = 'running'")
def lease_join(spark, sf_dir):
    j = jobs(spark, sf_dir)
    leases = j.select("id", (F.col("attempts") + (F.col("id") % 3 == 0).cast("int")).alias("attempts"))
    return j.filter("status = 'running'").join(leases, ["id", "attempts"], "left_semi").select("id")


@query("c11_orphans", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def orphans(spark, sf_dir):
    """Rows that neither an owner nor a reference knows: two anti joins."""
    known = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    refs = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return table(spark, sf_dir, "lineitem").join(known, "l_orderkey", "left_anti").join(refs, "l_suppkey", "left_anti").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"))


@query("c12_experiment_join", "SELECT d.lang, l.quality::BIGINT AS quality, count(*) AS n, round(avg(d.n_chars), 6) AS chars FROM documents d JOIN labels l USING (doc_id) GROUP BY 1, 2")
def experiment_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").groupBy("lang", F.col("quality").cast("long").alias("quality")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 6).alias("chars"))


@query("d1_running_counts", f"WITH {JOBS} SELECT kind, workspace, count(*) AS n FROM jobs WHERE status = 'running' GROUP BY kind, workspace")
def running_counts(spark, sf_dir):
    return jobs(spark, sf_dir).filter("status = 'running'").groupBy("kind", "workspace").agg(F.count(F.lit(1)).alias("n"))


@query("d2_worker_stats", f"WITH {JOBS} SELECT worker, count(*) FILTER (WHERE status = 'queued') AS queued, count(*) FILTER (WHERE status = 'running') AS running, count(*) FILTER (WHERE status = 'failed') AS failed, round(sum(CASE WHEN status = 'succeeded' THEN value ELSE 0 END), 6) AS done_value, min(CASE WHEN status = 'queued' THEN id END) AS oldest FROM jobs GROUP BY worker")
def worker_stats(spark, sf_dir):
    is_ = lambda s: F.col("status") == s
    return jobs(spark, sf_dir).groupBy("worker").agg(*[F.count_if(is_(s)).alias(s) for s in ("queued", "running", "failed")], F.round(F.sum(F.when(is_("succeeded"), F.col("value")).otherwise(0.0)), 6).alias("done_value"), F.min(F.when(is_("queued"), F.col("id"))).alias("oldest"))


@query("d3_d23_freshness", "SELECT source, count(*) AS n, max(doc_id) AS newest, min(doc_id) AS oldest FROM documents GROUP BY source")
def freshness(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("newest"), F.min("doc_id").alias("oldest"))


BUCKETS = {"click": ["parse"], "view": ["parse", "insert"], "purchase": ["insert"]}


@query("d5_bucket_expansion", f"WITH {JOBS}, b AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{x}')" for k, v in BUCKETS.items() for x in v) + ") t(kind, bucket)) SELECT bucket, workspace, count(*) AS n FROM jobs JOIN b USING (kind) WHERE status = 'running' AND workspace IS NOT NULL GROUP BY 1, 2")
def bucket_expansion(spark, sf_dir, buckets=BUCKETS):
    """A running composite job counts in each of its buckets; jobs without a tenant are exempt."""
    inline = F.create_map(*[x for k, v in buckets.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return jobs(spark, sf_dir).filter("status = 'running' AND workspace IS NOT NULL").select("workspace", F.explode(F.try_element_at(inline, F.col("kind"))).alias("bucket")).groupBy("bucket", "workspace").agg(F.count(F.lit(1)).alias("n"))


@query("d6_c6_edge_weights", "WITH e AS (SELECT l_suppkey AS s, l_partkey % 100 + 1 AS t, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS w FROM lineitem), k AS (SELECT s_suppkey AS v FROM supplier) SELECT least(s, t) AS a, greatest(s, t) AS b, round(sum(coalesce(nullif(w, 0), 1)), 6) AS weight FROM e WHERE s <> t AND s IN (SELECT v FROM k) AND t IN (SELECT v FROM k) GROUP BY 1, 2")
def edge_weights(spark, sf_dir):
    """Undirected weights over known endpoints; a missing or zero weight counts as one."""
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("v"))
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 100 + 1).alias("t"), F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(1.0)).alias("w")).filter("s <> t")
    e = e.groupBy(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).agg(F.sum("w").alias("w"))
    for side in ("a", "b"):
        e = e.join(known.withColumnRenamed("v", side), side, "left_semi")
    return e.select("a", "b", F.round("w", 6).alias("weight"))


@query("d7_chunk_statistics", "SELECT lang, source, count(*) AS n, min(n_chars) AS least, max(n_chars) AS most, round(avg(n_chars), 6) AS mean, grouping(lang, source)::BIGINT AS level FROM documents GROUP BY GROUPING SETS ((lang), (source), (lang, source), ())")
def chunk_statistics(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.groupingSets([[F.col("lang")], [F.col("source")], [F.col("lang"), F.col("source")], []], F.col("lang"), F.col("source")).agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.round(F.avg("n_chars"), 6).alias("mean"), F.grouping_id().cast("long").alias("level"))


@query("d9_lane_list", "SELECT source, array_to_string(list_sort(list_distinct(list(lang))), ',') AS lanes FROM documents GROUP BY source")
def lane_list(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("lanes"))


@query("d14_dominant_share", "SELECT o_custkey, max(n) AS top, sum(n)::BIGINT AS total, round(max(n) / sum(n), 6) AS share FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def dominant_share(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("o_custkey").agg(F.max("n").alias("top"), F.sum("n").alias("total"), F.round(F.max("n") / F.sum("n"), 6).alias("share"))


@query("d16_conflicting_codes", "SELECT p_type AS code, array_to_string(list_sort(list_distinct(list(lower(trim(p_brand))))), ',') AS meanings FROM part GROUP BY p_type HAVING count(DISTINCT lower(trim(p_brand))) > 1")
def conflicting_codes(spark, sf_dir):
    meaning = F.lower(F.trim("p_brand"))
    found = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("code")).agg(F.sort_array(F.collect_set(meaning)).alias("m"))
    return found.filter(F.size("m") > 1).select("code", F.array_join("m", ",").alias("meanings"))


@query("d18_nearest_rank", "SELECT event_type, list_sort(list(value))[CAST(floor(0.95 * (count(*) - 1) + 0.5) AS BIGINT) + 1] AS p95, list_sort(list(value))[CAST(floor(0.5 * (count(*) - 1) + 0.5) AS BIGINT) + 1] AS p50, max(value) AS most FROM events GROUP BY 1")
def nearest_rank(spark, sf_dir):
    """The value at the nearest rank, without interpolation. Ranks come from a window over the rows, so no group is collected."""
    e = table(spark, sf_dir, "events").select("event_type", "value", (F.row_number().over(W.partitionBy("event_type").orderBy("value")) - 1).alias("k"), F.count(F.lit(1)).over(W.partitionBy("event_type")).alias("n"))
    at = lambda p: F.max(F.when(F.col("k") == F.floor(F.lit(p) * (F.col("n") - 1) + 0.5), F.col("value")))
    return e.groupBy("event_type").agg(at(0.95).alias("p95"), at(0.5).alias("p50"), F.max("value").alias("most"))


@query("d19_throughput", "SELECT event_type, round(count(*) / (epoch(max(ts) - min(ts)) / 60), 6) AS per_minute, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS rate FROM events GROUP BY 1")
def throughput(spark, sf_dir):
    seconds = lambda c: F.unix_micros(c.cast("timestamp")) / 1e6
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.count(F.lit(1)) / ((seconds(F.max("ts")) - seconds(F.min("ts"))) / 60), 6).alias("per_minute"), F.round(F.avg(F.when(F.col("value") > 50, 1.0).otherwise(0.0)), 6).alias("rate"))


@query("d24_merge_flags", "SELECT o_custkey, min(o_totalprice) AS confidence, bool_or(o_orderstatus = 'P') AS review, min(o_orderkey) AS first_row, max(o_orderkey) AS last_row FROM orders GROUP BY 1")
def merge_flags(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_totalprice").alias("confidence"), F.bool_or(F.col("o_orderstatus") == "P").alias("review"), F.min("o_orderkey").alias("first_row"), F.max("o_orderkey").alias("last_row"))


@query("f3_nulls_last", "SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS rank FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey ORDER BY rank DESC NULLS LAST, c_custkey LIMIT 100")
def nulls_last(spark, sf_dir):
    r = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("rank"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(r, F.col("o_custkey") == F.col("c_custkey"), "left").orderBy(F.desc_nulls_last("rank"), "c_custkey").limit(100).select("c_custkey")


@query("f7_dotted_order", "SELECT n, row_number() OVER (ORDER BY list_transform(string_split(n, '.'), lambda x: x::INT)) AS place FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS n FROM lineitem)")
def dotted_order(spark, sf_dir):
    """Dotted numbers in the order of their segments as numbers."""
    n = table(spark, sf_dir, "lineitem").select(F.concat_ws(".", "l_orderkey", "l_linenumber").alias("n")).distinct()
    return numbered(n.withColumn("key", F.transform(F.split("n", "[.]"), lambda x: x.cast("int"))), "key").select("n", "place")


@query("g1_g2_page_sets", "SELECT doc_id FROM ((SELECT doc_id FROM documents WHERE n_chars < 300 UNION SELECT doc_id FROM labels WHERE quality = 0) EXCEPT SELECT doc_id FROM labels WHERE toxic = 1)")
def page_sets(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    some = table(spark, sf_dir, "documents").filter("n_chars < 300").select("doc_id").union(labels.filter("quality = 0").select("doc_id"))
    return some.subtract(labels.filter("toxic = 1").select("doc_id"))


@query("g4_intersection", "SELECT count(*) AS n FROM (SELECT doc_id FROM labels WHERE quality = 0 INTERSECT SELECT doc_id FROM documents WHERE n_chars < 2000)")
def intersection(spark, sf_dir):
    return table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id").intersect(table(spark, sf_dir, "documents").filter("n_chars < 2000").select("doc_id")).agg(F.count(F.lit(1)).alias("n"))


@query("g6_replace_members", "WITH g AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'system'), m AS (SELECT conv_id, min(turn) AS turn, string_agg(role, '+' ORDER BY turn) AS role FROM conversations WHERE conv_id IN (FROM g) GROUP BY 1) SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (FROM g) UNION ALL SELECT * FROM m")
def replace_members(spark, sf_dir):
    """Members of a group are replaced by one derived row at the first member's place."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    groups = c.filter("role = 'system'").select("conv_id").distinct()
    whole = c.join(groups, "conv_id", "left_semi").groupBy("conv_id").agg(F.min("turn").alias("turn"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), "+").alias("role"))
    return c.join(groups, "conv_id", "left_anti").unionByName(whole)


@query("b1_json_projection", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_projection(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").filter(k.isNotNull()).select("event_id", k.cast("double").alias("k"))


@query(
    "b7_job_view",
    f"WITH {JOBS} SELECT id, status, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, CASE WHEN kind = 'click' THEN 'f' || id || '.pdf' END AS filename, CASE WHEN status = 'queued' THEN count(*) FILTER (WHERE status = 'queued') OVER (PARTITION BY kind, workspace ORDER BY created_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS ahead FROM jobs",
)
def job_view(spark, sf_dir):
    """What a user may see of a job: a file name for one kind only, times as ISO strings, and the queued jobs ahead in its own partition."""
    w = W.partitionBy("kind", "workspace").orderBy("created_at", "id").rowsBetween(W.unboundedPreceding, -1)
    queued = F.col("status") == "queued"
    ahead = F.coalesce(F.sum(queued.cast("long")).over(w), F.lit(0))
    return jobs(spark, sf_dir).select(
        "id",
        "status",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.when(F.col("kind") == "click", F.concat(F.lit("f"), F.col("id").cast("string"), F.lit(".pdf"))).alias("filename"),
        F.when(queued, ahead).alias("ahead"),
    )


@query("c8_c9_page_lookups", "WITH l AS (SELECT conv_id, turn, role FROM conversations WHERE turn % 2 = 0), v AS (SELECT conv_id, turn, length(text) AS n FROM conversations WHERE length(text) > 200) SELECT c.conv_id, c.turn, coalesce(l.role, 'odl') AS lane, coalesce(v.n, 0)::BIGINT AS n FROM conversations c LEFT JOIN l USING (conv_id, turn) LEFT JOIN v USING (conv_id, turn)")
def page_lookups(spark, sf_dir):
    """Pages with what other relations know of them, and defaults where they know nothing; both joins share one partitioning."""
    c = table(spark, sf_dir, "conversations")
    keys = ["conv_id", "turn"]
    lanes = c.filter("turn % 2 = 0").select(*keys, "role")
    signals = c.filter(F.length("text") > 200).select(*keys, F.length("text").cast("long").alias("n"))
    return c.select(*keys).join(lanes, keys, "left").join(signals, keys, "left").select(*keys, F.coalesce("role", F.lit("odl")).alias("lane"), F.coalesce("n", F.lit(0)).alias("n"))


@query("d10_source_distribution", "SELECT source, count(*) AS n, count(*) FILTER (WHERE n_chars < 300) AS fallbacks FROM documents GROUP BY 1")
def source_distribution(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") < 300).alias("fallbacks"))


@query("d11_verdict_summary", f"WITH {JOBS} SELECT status, split_part(stage || ':' || worker, ':', 1) AS reason, count(*) AS n FROM jobs GROUP BY 1, 2")
def verdict_summary(spark, sf_dir):
    """Counts by state and the part of the reason before its colon."""
    reason = F.split_part(F.concat_ws(":", "stage", "worker"), F.lit(":"), F.lit(1))
    return jobs(spark, sf_dir).groupBy("status", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("d12_processing_time", f"WITH {JOBS} SELECT workspace, round(sum(CASE WHEN status = 'succeeded' THEN value END), 6) AS took FROM jobs GROUP BY 1")
def processing_time(spark, sf_dir):
    """Null, not zero, where nothing was measured."""
    return jobs(spark, sf_dir).groupBy("workspace").agg(F.round(F.sum(F.when(F.col("status") == "succeeded", F.col("value"))), 6).alias("took"))


@query(
    "d20_call_timing",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS ms, array_to_string(list_transform(list_sort(list(value), 'DESC')[1:20], lambda x: printf('%.3f', x)), ',') AS top FROM events GROUP BY 1",
)
def call_timing(spark, sf_dir, most=20):
    """Calls and their time by type, with the slowest: ranks are cut before the shuffle, so that no type's calls meet in one list."""
    e = table(spark, sf_dir, "events").select("event_type", "value", "event_id")
    top = e.withColumn("k", F.row_number().over(W.partitionBy("event_type").orderBy(F.desc_nulls_last("value"), "event_id"))).filter(F.col("k") <= most)
    top = top.groupBy("event_type").agg(F.array_join(F.transform(F.sort_array(F.collect_list("value"), False), lambda x: F.format_string("%.3f", x)), ",").alias("top"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("ms")).join(top, "event_type")


@query("g5_domain_union", "SELECT 1::BIGINT AS domain, page_id AS id, url AS name FROM pages UNION ALL SELECT 2, doc_id, source FROM documents UNION ALL SELECT 3, p_partkey, p_name FROM part")
def domain_union(spark, sf_dir):
    """The outputs of all domains as one relation; the domain's number keeps their order."""
    part = lambda k, t, i, n: table(spark, sf_dir, t).select(F.lit(k).cast("long").alias("domain"), F.col(i).alias("id"), F.col(n).alias("name"))
    return part(1, "pages", "page_id", "url").unionByName(part(2, "documents", "doc_id", "source")).unionByName(part(3, "part", "p_partkey", "p_name"))


@query("g7_distinct_in_order", "SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles FROM (SELECT conv_id, role, min(turn) AS turn FROM conversations GROUP BY 1, 2) GROUP BY 1")
def distinct_in_order(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return c.select("conv_id", F.array_join(F.array_distinct("t.role"), ",").alias("roles"))
