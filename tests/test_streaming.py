"""Streams give the batch answer: 1 vs N micro-batches, restart from checkpoint, replays."""

from pyspark.sql import functions as F

from rowtide.operators import consume, shape
from rowtide.session import scratch_dir
from rowtide.sources import feeds
from rowtide.streaming import stream as S

from .conftest import SF_SMALL

COLS = ["db", "tbl", "id", "value", "props", "last_op", "log_file", "log_pos", "n_changes"]


def _stage(spark, cl, files, path=None):
    path = path or scratch_dir(spark, "stage")
    (shape.envelope(cl).select(shape.envelope_text().alias("value")).repartition(files)
          .write.mode("append").text(path))
    return path


def _latest(spark, stage, per_trigger, out=None, ck=None):
    out = out or scratch_dir(spark, "out")
    ck = ck or scratch_dir(spark, "ck")
    S.run_to_end(S.latest_state_sink(S.envelope_stream(spark, stage, per_trigger), out, ck))
    return out


def _batch_answer(spark):
    return sorted(consume.latest_state(feeds.changelog(spark, SF_SMALL)).select(COLS).collect())


def test_one_vs_many_batches(spark):
    cl = feeds.changelog(spark, SF_SMALL)
    stage = _stage(spark, cl, 6)
    one = sorted(S.read_latest_state(spark, _latest(spark, stage, None)).select(COLS).collect())
    many = sorted(S.read_latest_state(spark, _latest(spark, stage, 1)).select(COLS).collect())
    assert one == many == _batch_answer(spark)


def test_restart_from_checkpoint(spark):
    cl = feeds.changelog(spark, SF_SMALL)
    stage, out, ck = scratch_dir(spark, "stage"), scratch_dir(spark, "out"), scratch_dir(spark, "ck")
    _stage(spark, cl.filter(F.col("file_no") % 2 == 1), 3, stage)        # odd files arrive first
    _latest(spark, stage, 1, out, ck)
    _stage(spark, cl.filter(F.col("file_no") % 2 == 0), 3, stage)        # the rest, out of log order
    _latest(spark, stage, 1, out, ck)                                    # same checkpoint: resumes
    got = sorted(S.read_latest_state(spark, out).select(COLS).collect())
    assert got == _batch_answer(spark)


def test_progress_written_after_sink(spark):
    cl = feeds.changelog(spark, SF_SMALL)
    stage, out, ck, prog = (scratch_dir(spark, n) for n in ("stage", "out", "ck", "progress"))
    _stage(spark, cl, 2, stage)
    S.run_to_end(S.latest_state_sink(S.envelope_stream(spark, stage, 1), out, ck, progress=prog))
    p = spark.read.parquet(prog)
    newest = p.agg(F.max_by(F.struct("log_file", "pos"), F.col("batch_id")).alias("x")).collect()[0]["x"]
    assert newest is not None and newest["log_file"].startswith("mysql-bin.")


def test_dedup_and_rates(spark):
    cl = feeds.changelog(spark, SF_SMALL)
    stage = _stage(spark, cl, 1)
    _stage(spark, cl.filter(F.col("file_no") == 1), 1, stage)           # a replayed file
    src = S.envelope_stream(spark, stage)
    name = "dedup_test"
    q = (S.dedup_stream(src, "3650 days").writeStream.format("memory").queryName(name)
         .trigger(availableNow=True).start())
    S.run_to_end(q)
    assert spark.table(name).count() == cl.count()
    rates = S.rate_stream(S.envelope_stream(spark, stage), "10 minutes", delay="3650 days")
    out, ck = scratch_dir(spark, "rates"), scratch_dir(spark, "ck")

    def write(b, i):
        b.write.mode("overwrite").parquet(f"{out}/batch_id={i}")
    S.run_to_end(rates.writeStream.outputMode("update").option("checkpointLocation", ck)
                 .foreachBatch(write).trigger(availableNow=True).start())
    got = spark.read.parquet(out).groupBy("window_start", "db").agg(F.max("n_changes").alias("n"))
    dedup = cl.dropDuplicates(["log_file", "log_pos", "row_no"]).withColumn("ts", F.col("ev_ts").cast("timestamp"))
    replayed = cl.filter(F.col("file_no") == 1).withColumn("ts", F.col("ev_ts").cast("timestamp"))
    exp = (dedup.unionByName(replayed).groupBy(F.window("ts", "10 minutes").start.alias("window_start"), "db")
                .agg(F.count(F.lit(1)).alias("n")))
    assert sorted(got.collect()) == sorted(exp.collect())


def test_compaction_keeps_answer(spark):
    cl = feeds.changelog(spark, SF_SMALL)
    out = _latest(spark, _stage(spark, cl, 4), 1)
    comp = S.compact_latest_state(spark, out, scratch_dir(spark, "compacted"))
    assert comp.count() == spark.read.parquet(out).select(*S.LATEST_KEYS).distinct().count()
    live = comp.filter(F.col("w.event_type") != "delete").select(
        "db", F.col("table").alias("tbl"), "id", F.col("w.after.value").alias("value"),
        F.col("w.log_pos").alias("log_pos"), "n_changes")
    exp = S.read_latest_state(spark, out).select("db", "tbl", "id", "value", "log_pos", "n_changes")
    assert sorted(live.collect()) == sorted(exp.collect())


def test_ordered_batches(spark):
    seen = {}

    def sink(batch, batch_id):
        rows = batch.select("db", "table", "pos_key", F.spark_partition_id().alias("p")).collect()
        seen[batch_id] = rows
    cl = feeds.changelog(spark, SF_SMALL)
    stage = _stage(spark, cl, 2)
    src = S.envelope_stream(spark, stage, 1).filter(F.col("event_type") != "query")
    S.run_to_end(src.writeStream.foreachBatch(S.ordered_batches(sink, partitions=3))
                 .option("checkpointLocation", scratch_dir(spark, "ck")).trigger(availableNow=True).start())
    assert seen
    for rows in seen.values():
        last = {}
        for r in rows:                       # per key, positions arrive increasing within a partition
            k = (r["db"], r["table"], r["p"])
            assert last.get(k, -1) < r["pos_key"]
            last[k] = r["pos_key"]


def test_session_stream_equals_batch_sessions(spark):
    from rowtide.functions.decode import utc_wall_clock
    from rowtide.operators.shape import event_seconds
    cl = feeds.changelog(spark, SF_SMALL)
    stage = _stage(spark, cl, 3)
    name = "sessions_test"
    q = (S.session_stream(S.envelope_stream(spark, stage, 1), "30 minutes", delay="3650 days")
         .writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start())
    S.run_to_end(q)
    got = spark.table(name).select("db", F.col("table").alias("tbl"),
                                   F.unix_seconds("session_start").alias("s"), F.unix_seconds("session_end").alias("e"),
                                   "n_changes")
    # the message carries whole seconds: compare with batch sessions over the same clock
    secs = cl.withColumn("ev_ts", utc_wall_clock(event_seconds("ev_ts")))
    b = consume.change_sessions(secs, ["db", "tbl"], 1800)
    exp = b.select("db", "tbl", event_seconds("session_start").alias("s"), event_seconds("session_end").alias("e"),
                   "n_changes")
    assert sorted(got.collect()) == sorted(exp.collect())


def _hot_key_changes(spark):
    """Every row change of the small feed on one record key: the hottest key possible."""
    cl = feeds.changelog(spark, SF_SMALL).filter(F.col("event_type") != "query")
    env = shape.envelope(cl)
    return env.select("db", "table", "event_type", "pos_key", "row_no", F.lit(1).alias("id"))


def test_ordered_batches_split_hot_key_in_order(spark):
    out = scratch_dir(spark, "ordered")
    hot = _hot_key_changes(spark).withColumn("db", F.lit("app")).withColumn("table", F.lit("t0"))

    def write(b, batch_id):
        b.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    S.ordered_batches(write, ("db", "table", "id"), partitions=4)(hot, 0)
    rep = S.delivery_order(out, spark).collect()
    assert len(rep) == 1 and rep[0]["n_changes"] == hot.count() and rep[0]["n_out_of_order"] == 0
    files = spark.read.parquet(out).select(F.col("_metadata.file_name")).distinct().count()
    assert files > 1                                                      # the key is not pinned to one task


def test_delivery_order_detects_unordered_writer(spark):
    out = scratch_dir(spark, "unordered")
    changes = _hot_key_changes(spark)
    changes.repartition(4).write.mode("overwrite").parquet(f"{out}/batch_id=0")
    rep = S.delivery_order(out, spark).agg(F.sum("n_out_of_order")).first()[0]
    assert rep > 0


def test_log_ordered_replay_is_deduplicated_by_state(spark):
    from rowtide.plans import queries as Q
    stage, per = Q._stage_in_log_order(spark, SF_SMALL, replay_last_file=True)
    q = S.append_sink(S.dedup_stream(S.envelope_stream(spark, stage, per), Q.REPLAY_DELAY).drop("before", "after"),
                      scratch_dir(spark, "dd"), scratch_dir(spark, "ck"))
    S.run_to_end(q)
    ops = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    dropped = sum(int(o["customMetrics"]["numDroppedDuplicateRows"]) for o in ops)
    late = sum(int(o["numRowsDroppedByWatermark"]) for o in ops)
    copies = spark.read.text(stage).count() - feeds.changelog(spark, SF_SMALL).count()
    assert late == 0 and copies > 0 and dropped == copies        # every resent copy caught by the state
    rate = S.rate_stream(S.envelope_stream(spark, *Q._stage_in_log_order(spark, SF_SMALL)), "10 minutes",
                         delay="10 minutes")
    q2 = S.update_sink(rate, scratch_dir(spark, "rt"), scratch_dir(spark, "ck"))
    S.run_to_end(q2)
    assert sum(int(p["stateOperators"][0]["numRowsDroppedByWatermark"]) for p in q2.recentProgress
               if p["stateOperators"]) == 0


def test_delivery_order_across_batches_needs_ordered_arrival(spark):
    from rowtide.plans import queries as Q
    stage, per = Q._stage_envelopes(spark, SF_SMALL)                   # files are random mixes of the log
    out = scratch_dir(spark, "ord")
    S.run_to_end(S.ordered_sink(S.envelope_stream(spark, stage, per), out, scratch_dir(spark, "ck")))
    within = S.delivery_order(out, spark).agg(F.sum("n_out_of_order")).first()[0]
    across = S.delivery_order(out, spark, across_batches=True).agg(F.sum("n_out_of_order")).first()[0]
    assert within == 0 and across > 0


def test_session_tie_follows_session_window(spark):
    """A change exactly ``gap`` after the previous one extends the session (Spark's rule)."""
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    secs = [0, 1800, 3601, 5401, 9000]
    rows = [("d", "t", base + dt.timedelta(seconds=s), 1, i) for i, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "db string, tbl string, ev_ts timestamp_ntz, pos_key long, row_no long")
    got = consume.change_sessions(df, ["db", "tbl"], 1800).select("session_start", "session_end", "n_changes")
    native = (df.withColumn("t", F.col("ev_ts").cast("timestamp"))
                .groupBy(F.session_window("t", "1800 seconds").alias("s")).count())
    # 0 and 1800 tie (one session), 3601 is 1801 s later (new), 5401 ties again, 9000 is new
    assert sorted(r["count"] for r in native.collect()) == [1, 2, 2]
    assert sorted(r["n_changes"] for r in got.collect()) == [1, 2, 2]
    sized = consume.change_sessions(df, ["db", "tbl"], 1800, bucket_seconds=None)     # width from the data
    assert sorted(sized.select("session_start", "session_end", "n_changes").collect()) == sorted(got.collect())


def test_partial_updates_treat_missing_mask_as_full_image(spark):
    img = "struct<id:bigint,value:double,props:string>"
    rows = [(1, "insert", (1, 1.0, "a"), None),       # no mask: a full image
            (2, "update", (1, None, None), 1),          # only the key present
            (3, "update", (1, 3.0, None), 3),           # value present, props absent
            (4, "insert", (2, 5.0, None), None)]        # no mask: props present and NULL
    df = spark.createDataFrame(
        [("d", "t", p, 0, op, a, None, m) for p, op, a, m in rows],
        f"db string, table string, pos_key long, row_no int, event_type string, after {img}, before {img}, "
        f"after_present long")
    got = {r["id"]: (r["value"], r["props"], r["n_changes"]) for r in S.latest_state_partial_updates(df).collect()}
    assert got == {1: (3.0, "a", 3), 2: (5.0, None, 1)}


def test_torn_and_keyless_messages_become_dead_letters(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    ok = ('{"binlog":"mysql-bin.000001:500","db":"shop","table":"li","query":"","event_type":"insert","primary":"id",'
          '"before":{},"after":{"id":%d,"value":1.0,"props":"p"},"timestamp":1500000000,"row_no":%d}')
    lines = [ok % (1, 0), ok % (2, 1), ok % (1, 2), ok[:40], "", "not json", ok.replace('"id":%d', '"id":null') % 3, ok.replace("000001:500", "x") % (4, 0)]
    (src / "a.txt").write_text("\n".join(lines) + "\n")
    got = []
    q = S.publish_sink(S.message_stream(spark, str(src)), lambda m, i: got.extend(m.collect()), str(tmp_path / "dead"),
                       str(tmp_path / "ck"), str(tmp_path / "progress"))
    S.run_to_end(q)
    assert sorted(r["key"] for r in got) == ["shop.li:1", "shop.li:1", "shop.li:2"]
    dead = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert sorted(r["reason"] for r in dead) == ["malformed message"] * 3 + ["no log position", "no record key"]
    assert {r["message"] for r in dead} == set(lines[3:])
    assert S.read_progress(spark, str(tmp_path / "progress")).first()["binlog"] == "mysql-bin.000001:500"


def test_every_change_of_an_event_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = ('{"binlog":"mysql-bin.000001:500","db":"shop","table":"li","query":"","event_type":"update","primary":"id",'
            '"before":{"id":1},"after":{"id":1,"value":%d.0,"props":"p"},"timestamp":1500000000,"row_no":%d}')
    (src / "a.txt").write_text("\n".join(line % (n, n) for n in (0, 2, 1, 2, 0)) + "\n")
    S.run_to_end(S.append_sink(S.dedup_stream(S.envelope_stream(spark, str(src))).drop("before", "after"), str(tmp_path / "out"), str(tmp_path / "ck")))
    assert sorted(r["row_no"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]
    S.run_to_end(S.latest_state_sink(S.envelope_stream(spark, str(src)), str(tmp_path / "latest"), str(tmp_path / "ck2")))
    assert S.read_latest_state(spark, str(tmp_path / "latest")).first()["value"] == 2.0


def test_a_message_is_parsed_once(spark):
    df = spark.createDataFrame([('{"binlog":"f.000001:4","event_type":"update","after":{"id":1}}',), ("torn",), (None,)], "value string")
    parsed = S.parse_messages(df)
    assert S.good(parsed).drop("before", "after")._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert S.good(parsed).count() == 1 and S.dead_letters(parsed).count() == 2
