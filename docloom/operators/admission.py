"""Admission of queued jobs: candidates, the ordered fold over limits, claims, backlog and purge."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.plans.registry import query, table

from .jobs import SQL as JOBS
from .jobs import jobs
from .relational import BUCKETS

PER_PARTITION, SCAN = 8, 200
BUCKET_LIMITS = {"parse": 9_000, "insert": 60_000}
PER_WORKSPACE, FREE, MOST_ATTEMPTS = 150, 24, 3

_CANDIDATES = f"""cand AS (SELECT id, kind, workspace, created_at FROM (SELECT *, row_number() OVER (PARTITION BY kind, workspace ORDER BY created_at, id) AS rn
  FROM jobs WHERE status = 'queued' AND NOT cancel_requested AND attempts < {MOST_ATTEMPTS}) WHERE rn <= {PER_PARTITION} ORDER BY created_at, id LIMIT {SCAN})"""


def candidates(j, per_partition: int = PER_PARTITION, scan: int = SCAN):
    """The oldest queued jobs of each (kind, workspace), then the oldest of all: so many rows at most, whatever the backlog."""
    k = F.row_number().over(W.partitionBy("kind", "workspace").orderBy("created_at", "id"))
    open_ = j.filter((F.col("status") == "queued") & ~F.col("cancel_requested") & (F.col("attempts") < MOST_ATTEMPTS))
    return open_.withColumn("k", k).filter(F.col("k") <= per_partition).orderBy("created_at", "id").limit(scan).drop("k")


@query("f9_candidates", f"WITH {JOBS}, {_CANDIDATES} SELECT id, kind, workspace FROM cand")
def scan_candidates(spark, sf_dir):
    return candidates(jobs(spark, sf_dir)).select("id", "kind", "workspace")


def admit(cand, running, buckets: dict, limits: dict, per_workspace: int, free: int):
    """Ids that may start: first come, first served, and a job that is blocked blocks no other. Each admitted job counts at once in its buckets and its workspace;
    a job without a workspace counts in none, and an unknown kind is never admitted. The fold runs over the scan limit's rows, in one expression."""
    of_kind = F.create_map(*[x for k, v in buckets.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    busy = running.select(F.explode(F.try_element_at(of_kind, F.col("kind"))).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    used = busy.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("used"))  # a row, with as many entries as there are buckets
    tenants = running.filter("workspace IS NOT NULL").groupBy("workspace").agg(F.count(F.lit(1)).alias("n"))
    c = cand.join(tenants, "workspace", "left").select("created_at", "id", F.coalesce(F.try_element_at(of_kind, F.col("kind")), F.array().cast("array<string>")).alias("b"), "workspace", F.coalesce("n", F.lit(0)).alias("n"))
    line = c.agg(F.sort_array(F.collect_list(F.struct("created_at", "id", "b", "workspace", "n"))).alias("line"))
    most = ", ".join(f"'{b}', {n}" for b, n in limits.items())
    fold = f"""aggregate(line, CAST(array() AS array<struct<id: bigint, b: array<string>, w: string>>), (done, c) -> if(
      size(done) < {free} AND size(c.b) > 0
      AND forall(c.b, b -> coalesce(try_element_at(used, b), 0) + size(filter(done, d -> array_contains(d.b, b))) < coalesce(try_element_at(map({most}), b), 0))
      AND (c.workspace IS NULL OR c.n + size(filter(done, d -> d.w = c.workspace)) < {per_workspace}),
      concat(done, array(named_struct('id', c.id, 'b', c.b, 'w', c.workspace))), done))"""
    return line.select("line", used.scalar().alias("used")).select(F.explode(F.expr(fold)).alias("x")).select("x.id")


_BUCKET_LISTS = "MAP {" + ", ".join(f"'{k}': {list(v)}" for k, v in BUCKETS.items()) + "}"
_ADMITTED = f"""used AS (SELECT map_from_entries(list((bucket, n))) AS m FROM (SELECT bucket, count(*) AS n FROM (SELECT unnest({_BUCKET_LISTS}[kind]) AS bucket FROM jobs WHERE status = 'running') GROUP BY 1)),
ws AS (SELECT workspace, count(*) AS n FROM jobs WHERE status = 'running' AND workspace IS NOT NULL GROUP BY 1),
line AS (SELECT row_number() OVER (ORDER BY created_at, id) AS k, id, {_BUCKET_LISTS}[kind] AS b, cand.workspace AS w, coalesce(n, 0) AS n FROM cand LEFT JOIN ws ON ws.workspace = cand.workspace),
fold AS (SELECT 0 AS k, CAST([] AS STRUCT(id BIGINT, b VARCHAR[], w VARCHAR)[]) AS done UNION ALL
  SELECT line.k, CASE WHEN len(done) < {FREE} AND (line.w IS NULL OR line.n + len(list_filter(done, lambda d: d.w = line.w)) < {PER_WORKSPACE})
    AND len(list_filter(line.b, lambda x: coalesce(m[x], 0) + len(list_filter(done, lambda d: list_contains(d.b, x))) >= MAP {BUCKET_LIMITS}[x])) = 0
    THEN list_append(done, {{'id': line.id, 'b': line.b, 'w': line.w}}) ELSE done END FROM fold JOIN line ON line.k = fold.k + 1 CROSS JOIN used),
admitted AS (SELECT unnest(done).id AS id FROM (SELECT done FROM fold ORDER BY k DESC LIMIT 1))"""


def _admitted(j):
    return admit(candidates(j), j.filter("status = 'running'"), BUCKETS, BUCKET_LIMITS, PER_WORKSPACE, FREE)


@query("e10_admissions", f"WITH RECURSIVE {JOBS}, {_CANDIDATES}, {_ADMITTED} SELECT id FROM admitted")
def admissions(spark, sf_dir):
    return _admitted(jobs(spark, sf_dir))


@query("h9_claimed", f"WITH RECURSIVE {JOBS}, {_CANDIDATES}, {_ADMITTED} SELECT id, kind, 'running' AS status, attempts + 1 AS attempts, CASE WHEN kind <> 'purchase' THEN idem_key END AS idem_key FROM jobs JOIN admitted USING (id) WHERE status = 'queued' AND NOT cancel_requested AND attempts < {MOST_ATTEMPTS}")
def claimed(spark, sf_dir, releases="purchase"):
    """The rows after the claim: one attempt more, and a kind that rebuilds from a snapshot gives its key free at once. State is tested again, since it may have moved."""
    j = jobs(spark, sf_dir)
    j_open = j.filter((F.col("status") == "queued") & ~F.col("cancel_requested") & (F.col("attempts") < MOST_ATTEMPTS))
    now = j_open.join(_admitted(j), "id")
    return now.select("id", "kind", F.lit("running").alias("status"), (F.col("attempts") + 1).alias("attempts"), F.when(F.col("kind") != releases, F.col("idem_key")).alias("idem_key"))


_BACKLOG = """c AS (SELECT o_custkey AS workspace, max(o_orderdate) AS touched, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS success, max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS attempt FROM orders GROUP BY 1),
b AS (SELECT * FROM c WHERE touched > coalesce(success, TIMESTAMP '1970-01-01'))"""


@query("e2_f6_backlog", f"WITH {_BACKLOG} SELECT workspace, (SELECT count(*) FROM b) AS total FROM b ORDER BY coalesce(attempt, TIMESTAMP '1970-01-01'), touched, workspace LIMIT 50")
def backlog(spark, sf_dir, cap=50):
    """The oldest attempt first, what was never tried before all; the total stands beside the rows that the cap lets through, counted apart so that no window holds all rows."""
    when = lambda s: F.max(F.when(F.col("o_orderstatus") == s, F.col("o_orderdate")))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    c = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("workspace")).agg(F.max("o_orderdate").alias("touched"), when("F").alias("success"), when("O").alias("attempt"))
    b = c.filter(F.col("touched") > F.coalesce("success", epoch))
    return b.orderBy(F.coalesce("attempt", epoch), "touched", "workspace").limit(cap).select("workspace", b.agg(F.count(F.lit(1))).scalar().alias("total"))


@query("d4_live_probe", f"WITH {JOBS} SELECT EXISTS (SELECT 1 FROM jobs WHERE kind = 'click' AND status IN ('queued', 'running') AND workspace = 'ws7') AS live")
def live_probe(spark, sf_dir, kind="click", workspace="ws7"):
    """Stops at the first row that is found."""
    j = jobs(spark, sf_dir).filter((F.col("kind") == kind) & F.col("status").isin("queued", "running") & (F.col("workspace") == workspace))
    return j.limit(1).agg((F.count(F.lit(1)) > 0).alias("live"))


_NOW = "(SELECT max(o_orderdate) FROM orders)"


@query("h15_claim_run", f"SELECT o_orderkey, o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderdate < {_NOW} - INTERVAL 90 DAY) AS claimed, o_orderstatus = 'O' AND o_orderdate < {_NOW} - INTERVAL 90 DAY AS stale FROM orders")
def claim_run(spark, sf_dir, stale_days=90):
    """Nightly runs (O started, F failed, P done) that may be claimed again: failed ones, and started ones that have stood still."""
    o = table(spark, sf_dir, "orders")
    stale = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < o.agg(F.max("o_orderdate")).scalar() - F.make_dt_interval(F.lit(stale_days)))
    return o.select("o_orderkey", ((F.col("o_orderstatus") == "F") | stale).alias("claimed"), stale.alias("stale"))


@query(
    "f10_h11_ttl_purge",
    f"WITH {JOBS} SELECT id FROM jobs p WHERE status IN ('succeeded', 'failed') AND created_at < (SELECT max(created_at) FROM jobs) - INTERVAL 7 DAY AND NOT EXISTS (SELECT 1 FROM jobs c WHERE c.parent_id = p.id AND c.status IN ('queued', 'running')) ORDER BY created_at, id LIMIT 500",
)
def ttl_purge(spark, sf_dir, days=7, batch=500):
    """Ended jobs past their time, oldest first, in batches; a parent of live children stays."""
    j = jobs(spark, sf_dir)
    live = j.filter(F.col("status").isin("queued", "running") & F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("id"))
    old = j.filter(F.col("status").isin("succeeded", "failed") & (F.col("created_at") < j.agg(F.max("created_at")).scalar() - F.make_dt_interval(F.lit(days))))
    return old.join(live, "id", "left_anti").orderBy("created_at", "id").limit(batch).select("id")


@query(
    "c4_update_from",
    f"""WITH {JOBS}, seen AS (SELECT worker, max(created_at) AS beat FROM jobs WHERE status = 'succeeded' GROUP BY 1), late AS (SELECT worker FROM seen WHERE beat < (SELECT max(beat) FROM seen))
    SELECT id, CASE WHEN late.worker IS NULL OR status <> 'running' THEN status WHEN cancel_requested THEN 'canceled' WHEN stage = 'inserting' THEN 'failed' WHEN attempts >= {MOST_ATTEMPTS} THEN 'failed' ELSE 'queued' END AS status,
    CASE WHEN late.worker IS NULL OR status <> 'running' THEN jobs.worker END AS worker FROM jobs LEFT JOIN late ON late.worker = jobs.worker""",
)
def update_from(spark, sf_dir):
    """Update from a join: running jobs of workers whose last sign is older than the newest one are taken back; all other rows stay as they are."""
    j = jobs(spark, sf_dir)
    seen = j.filter("status = 'succeeded'").groupBy("worker").agg(F.max("created_at").alias("beat"))
    late = seen.filter(F.col("beat") < seen.agg(F.max("beat")).scalar()).select("worker", F.lit(True).alias("late"))
    hit = F.col("late").isNotNull() & (F.col("status") == "running")
    after = F.when(F.col("cancel_requested"), "canceled").when((F.col("stage") == "inserting") | (F.col("attempts") >= MOST_ATTEMPTS), "failed").otherwise("queued")
    return j.join(late, "worker", "left").select("id", F.when(hit, after).otherwise(F.col("status")).alias("status"), F.when(~hit, F.col("worker")).alias("worker"))
