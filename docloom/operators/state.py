"""Transitions of job state as relations: a snapshot goes in, the rows after the transition come out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docloom.plans.registry import query, table

from .jobs import SQL as JOBS
from .jobs import jobs

ATTEMPTS = 3


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert by key: the last write of each key stays. max_by adds up before the shuffle, so a hot key costs a row a task."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


@query("h1_insert_or_existing", f"WITH {JOBS} SELECT id, coalesce(first_value(id) OVER (PARTITION BY kind, idem_key ORDER BY created_at, id), id) AS kept_id FROM jobs WHERE idem_key IS NOT NULL UNION ALL SELECT id, id FROM jobs WHERE idem_key IS NULL")
def insert_or_existing(spark, sf_dir):
    """A key that exists gives back its row; rows without a key never collide."""
    j = jobs(spark, sf_dir)
    first = j.filter("idem_key IS NOT NULL").groupBy("kind", "idem_key").agg(F.min_by("id", F.struct("created_at", "id")).alias("kept"))
    return j.join(first, ["kind", "idem_key"], "left").select("id", F.coalesce("kept", "id").alias("kept_id"))


@query("h2_h3_upsert", f"WITH {JOBS} SELECT worker, kind, id, status FROM (SELECT *, row_number() OVER (PARTITION BY worker, kind ORDER BY created_at DESC, id DESC) AS k FROM jobs) WHERE k = 1")
def upsert(spark, sf_dir):
    return keep_last(jobs(spark, sf_dir).select("worker", "kind", "id", "status", "created_at"), ["worker", "kind"], ["created_at", "id"]).select("worker", "kind", "id", "status")


@query("h4_fenced_update", f"WITH {JOBS}, l AS (SELECT id, CASE WHEN id % 9 = 0 THEN 'w0' ELSE worker END AS w, attempts FROM jobs) SELECT l.id, j.id IS NULL AS lost FROM l LEFT JOIN jobs j ON j.id = l.id AND j.worker = l.w AND j.attempts = l.attempts AND j.status = 'running'")
def fenced_update(spark, sf_dir):
    """Updates match owner, attempt and state; what matches nothing has lost its lease."""
    j = jobs(spark, sf_dir)
    lease = j.select(F.col("id").alias("lid"), F.when(F.col("id") % 9 == 0, "w0").otherwise(F.col("worker")).alias("w"), F.col("attempts").alias("a"))
    held = j.filter("status = 'running'").select("id", "worker", "attempts")
    return lease.join(held, (F.col("id") == F.col("lid")) & (F.col("worker") == F.col("w")) & (F.col("attempts") == F.col("a")), "left").select(F.col("lid").alias("id"), F.col("id").isNull().alias("lost"))


@query("h5_complete", f"WITH {JOBS} SELECT id, CASE WHEN status = 'succeeded' AND NOT cancel_requested THEN idem_key END AS idem_key FROM jobs WHERE status IN ('succeeded', 'failed')")
def complete(spark, sf_dir):
    clean = (F.col("status") == "succeeded") & ~F.col("cancel_requested")
    return jobs(spark, sf_dir).filter(F.col("status").isin("succeeded", "failed")).select("id", F.when(clean, F.col("idem_key")).alias("idem_key"))


@query("h6_requeue", f"WITH {JOBS} SELECT id, CASE WHEN stage = 'inserting' THEN 'failed' WHEN attempts >= {ATTEMPTS} THEN 'failed' ELSE 'queued' END AS status FROM jobs WHERE status = 'running'")
def requeue(spark, sf_dir, most=ATTEMPTS):
    return jobs(spark, sf_dir).filter("status = 'running'").select("id", F.when((F.col("stage") == "inserting") | (F.col("attempts") >= most), "failed").otherwise("queued").alias("status"))


@query("h7_stale_recovery", f"WITH {JOBS} SELECT id, CASE WHEN cancel_requested THEN 'cancelled' WHEN stage = 'inserting' THEN 'failed:inserting' WHEN attempts >= {ATTEMPTS} THEN 'failed:exhausted' ELSE 'queued' END AS next FROM jobs WHERE status = 'running' AND created_at < (SELECT max(created_at) FROM jobs) - INTERVAL 2 DAY")
def stale_recovery(spark, sf_dir, most=ATTEMPTS, days=2):
    """Precedence: a cancel request, then an unsafe stage, then used-up attempts, else another try."""
    j = jobs(spark, sf_dir)
    now = F.broadcast(j.agg(F.max("created_at").alias("now")))  # one row
    what = F.when(F.col("cancel_requested"), "cancelled").when(F.col("stage") == "inserting", "failed:inserting").when(F.col("attempts") >= most, "failed:exhausted").otherwise("queued")
    return j.filter("status = 'running'").join(now, F.col("created_at") < F.col("now") - F.make_dt_interval(F.lit(days))).select("id", what.alias("next"))


@query("h8_cancel", f"WITH {JOBS} SELECT id, CASE WHEN status = 'queued' THEN 'cancelled' WHEN status = 'running' AND stage = 'inserting' THEN 'refused' WHEN status = 'running' THEN 'requested' ELSE 'finished' END AS outcome FROM jobs")
def cancel(spark, sf_dir):
    s = F.col("status")
    return jobs(spark, sf_dir).select("id", F.when(s == "queued", "cancelled").when((s == "running") & (F.col("stage") == "inserting"), "refused").when(s == "running", "requested").otherwise("finished").alias("outcome"))


@query("h12_staging_sweep", "SELECT page_id, CASE WHEN url LIKE 'https://%' THEN 'preview' ELSE 'batch' END AS class FROM pages WHERE (url LIKE 'https://%' AND page_id % 48 >= 24) OR (url LIKE 'http://%' AND page_id % 200 >= 168)")
def staging_sweep(spark, sf_dir, hours=(("preview", "^https://", 24), ("batch", "^http://", 168))):
    """Each class of key has its own lifetime; keys of no class are left alone. A page's number stands in for the age."""
    name, ttl, age = F.lit(None).cast("string"), F.lit(None).cast("int"), F.when(F.col("url").startswith("https"), F.col("page_id") % 48).otherwise(F.col("page_id") % 200)
    for label, pattern, most in reversed(hours):
        name, ttl = F.when(F.col("url").rlike(pattern), label).otherwise(name), F.when(F.col("url").rlike(pattern), most).otherwise(ttl)
    return table(spark, sf_dir, "pages").select("page_id", name.alias("class"), ttl.alias("ttl"), age.alias("age")).filter("class IS NOT NULL AND age >= ttl").select("page_id", "class")


@query("h13_orphan_guard", "WITH o AS (SELECT count(*) AS listed, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)) AS orphans FROM documents) SELECT listed, orphans, orphans >= 100 AND orphans > 0.9 * listed AS hold FROM o")
def orphan_guard(spark, sf_dir, least=100, share=0.9):
    known = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("known", F.lit(True))
    o = table(spark, sf_dir, "documents").select("doc_id").join(known, "doc_id", "left").agg(F.count(F.lit(1)).alias("listed"), F.count_if(F.col("known").isNull()).alias("orphans"))
    return o.withColumn("hold", (F.col("orphans") >= least) & (F.col("orphans") > share * F.col("listed")))


@query("h14_history", "SELECT user_id, max(CASE WHEN event_type = 'click' THEN event_id END) AS touch, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS success, arg_max(event_type, ts) AS last_kind FROM (SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1) GROUP BY 1")
def history(spark, sf_dir):
    e = keep_last(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id", "ts"], ["event_id"])
    return e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "click", F.col("event_id"))).alias("touch"), F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("success"), F.max_by("event_type", "ts").alias("last_kind"))


@query("h16_slots", f"WITH {JOBS}, s AS (SELECT worker, count(*) FILTER (WHERE status = 'running' AND attempts > 0) AS live FROM jobs GROUP BY 1) SELECT worker, live, live < 100 AS free FROM s")
def slots(spark, sf_dir, most=100):
    return jobs(spark, sf_dir).groupBy("worker").agg(F.count_if((F.col("status") == "running") & (F.col("attempts") > 0)).alias("live")).withColumn("free", F.col("live") < most)


@query("h17_idempotency_key", "SELECT event_id, sha256(event_type || '|' || coalesce(CAST(user_id AS VARCHAR), '') || '|' || CAST(floor(epoch(ts) / 300)::BIGINT AS VARCHAR)) AS key FROM events")
def idempotency_key(spark, sf_dir, seconds=300):
    """Digest of what is asked, in buckets of time."""
    bucket = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (1e6 * seconds)).cast("long")
    return table(spark, sf_dir, "events").select("event_id", F.sha2(F.concat_ws("|", "event_type", F.coalesce(F.col("user_id").cast("string"), F.lit("")), bucket.cast("string")), 256).alias("key"))


@query("h18_parent_validation", f"WITH {JOBS} SELECT c.id, CASE WHEN p.id IS NULL THEN 'missing' WHEN p.status <> 'succeeded' THEN 'not_succeeded' ELSE 'ok' END AS parent FROM jobs c LEFT JOIN jobs p ON p.id = c.parent_id WHERE c.parent_id IS NOT NULL")
def parent_validation(spark, sf_dir):
    j = jobs(spark, sf_dir)
    p = j.select(F.col("id").alias("pid"), F.col("status").alias("ps"))
    return j.filter("parent_id IS NOT NULL").join(p, F.col("parent_id") == F.col("pid"), "left").select("id", F.when(F.col("pid").isNull(), "missing").when(F.col("ps") != "succeeded", "not_succeeded").otherwise("ok").alias("parent"))


@query("p2_candidates", "WITH t AS (SELECT user_id, max(ts) AS touched, max(CASE WHEN event_type = 'purchase' THEN ts END) AS success FROM events GROUP BY 1) SELECT user_id FROM t WHERE touched > coalesce(success, TIMESTAMP '1970-01-01') ORDER BY touched, user_id LIMIT 100")
def candidates(spark, sf_dir, cap=100):
    """What was touched after its last success, oldest first, up to the night's capacity."""
    t = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("touched"), F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("success"))
    return t.filter(F.col("touched") > F.coalesce("success", F.lit("1970-01-01").cast("timestamp_ntz"))).orderBy("touched", "user_id").limit(cap).select("user_id")


@query("p3_i35_nights", "SELECT user_id, CAST(CASE WHEN hour(ts) >= 20 THEN ts::DATE ELSE ts::DATE - 1 END AS VARCHAR) AS night, count(*) AS n FROM events GROUP BY 1, 2")
def nights(spark, sf_dir, at=20):
    """A night belongs to the day on which it begins."""
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").groupBy("user_id", F.when(F.hour("ts") >= at, day).otherwise(F.date_sub(day, 1)).cast("string").alias("night")).agg(F.count(F.lit(1)).alias("n"))
