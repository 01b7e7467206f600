from docloom.streaming.nightly import newest_state, touches

SF = "/root/testdata/sf0.001"


def run(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    return spark.table(name)


def test_touches(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    got = {(r.user_id, str(r.start)): r.n for r in run(spark, touches(stream, "10000 days"), "touches", "update").collect()}
    want = {(r.user_id, str(r.start)): r.n for r in touches(events).collect()}
    assert got == want


def test_newest_state(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    got = {}
    for r in run(spark, newest_state(stream), "newest", "update").collect():
        got[r.user_id] = max(got.get(r.user_id, (-1, "")), (r.event_id, r.event_type))
    best = {}
    for r in events.collect():
        best[r.user_id] = max(best.get(r.user_id, (-1, "")), (r.event_id, r.event_type))
    assert got == best
