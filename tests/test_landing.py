"""Streams from a position, reordering, late rows and one copy of each change."""

import json
import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rowtide.operators import shape
from rowtide.session import CLEANUP, scratch_dir, shuffles_released
from rowtide.sources import feeds
from rowtide.streaming import landing as L
from rowtide.streaming import stream as S


def message(i, user=None, ts=None, kind="update"):
    image = {"id": i % 3 if user is None else user, "value": float(i), "props": ""}
    return json.dumps({"binlog": f"mysql-bin.000001:{i * 10 + 4}", "db": "d", "table": "t", "query": "", "event_type": kind, "primary": "id",
                       "before": image, "after": image, "timestamp": 1_700_000_000 + (i if ts is None else ts)})


def stage(path, files, minute=0):
    """One text file per list of messages, modified a minute after the one before."""
    os.makedirs(path, exist_ok=True)
    for k, lines in enumerate(files):
        name = f"{path}/part-{minute + k:03d}.txt"
        with open(name, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(name, (1_700_000_000 + 60 * (minute + k),) * 2)


def position(i):
    return f"mysql-bin.000001:{i * 10 + 4}"


def test_start_skips_older_files_unread(spark, tmp_path):
    folder, index_dir = f"{tmp_path}/log", f"{tmp_path}/index"
    stage(folder, [[message(i) for i in range(k * 10, k * 10 + 10)] for k in range(6)])
    index = L.index_messages(spark, folder, index_dir)
    assert index.count() == 6 and L.newest_label(index) == position(59)

    def follow(start, ix, name):
        q = S.append_sink(L.envelopes_after(spark, folder, ix, start).select("pos_key"), f"{tmp_path}/{name}", f"{tmp_path}/{name}-ck")
        S.run_to_end(q)
        read = sum(p["numInputRows"] for p in q.recentProgress)
        return read, sorted(r[0] for r in spark.read.schema("pos_key long").parquet(f"{tmp_path}/{name}").collect())

    def keys(*ids):
        return [2 ** 32 + i * 10 + 4 for i in ids]

    read, got = follow(position(34), index, "a")
    assert got == keys(*range(35, 60)) and read <= 30
    stage(folder, [["not json", message(60), message(61)]], minute=6)  # what comes after the newest position
    read, got = follow(L.newest_label(index), index, "b")
    assert got == keys(60, 61) and read <= 13
    again = L.index_messages(spark, folder, index_dir)
    assert again.count() == 7 and L.newest_label(again) == position(61)
    assert follow("mysql-bin.000001:0", again, "c")[1] == keys(*range(62))
    assert L.index_messages(spark, folder, index_dir).count() == 7


def shuffled(rng, n, files, late):
    out = [[] for _ in range(files + late)]
    for i in range(n):
        out[i * files // n + rng.randrange(late + 1)].append(i)
    return out


def test_reordered_delivery(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    files = shuffled(rng, 300, 8, 2)
    straggler, files[0] = files[0][:3], files[0][3:]
    files[-1] += straggler  # far too late: behind the watermark
    for f in files:
        rng.shuffle(f)
    stage(f"{tmp_path}/log", [[message(i) for i in f] + [message(f[0])] for f in files])
    out = scratch_dir(spark, "reordered")
    release, fails = L._release, [5]

    def release_and_fail(spark, out, batch_id, *rest):
        release(spark, out, batch_id, *rest)
        if batch_id in fails:  # after everything is written, before the batch is committed
            fails.clear()
            raise RuntimeError("lost")

    monkeypatch.setattr(L, "_release", release_and_fail)
    with pytest.raises(Exception, match="lost"):
        S.run_to_end(L.reordered_sink(S.envelope_stream(spark, f"{tmp_path}/log", 1), out, f"{tmp_path}/ck", lag=2))
    S.run_to_end(L.reordered_sink(S.envelope_stream(spark, f"{tmp_path}/log", 1), out, f"{tmp_path}/ck", lag=2))
    L.flush_reordered(spark, out)
    order = S.delivery_order(f"{out}/delivered", spark, across_batches=True).collect()
    assert sum(r.n_out_of_order for r in order) == 0
    delivered = {r[0] for r in spark.read.parquet(f"{out}/delivered").select("log_pos").collect()}
    late = {r[0] for r in spark.read.parquet(f"{out}/late").select("log_pos").distinct().collect()}
    assert delivered | late == {i * 10 + 4 for i in range(300)} and late == {i * 10 + 4 for i in straggler}
    assert sum(r.n_changes for r in order) == 300 - len(straggler)


def test_rates_keep_late_rows(spark, tmp_path):
    # windows of 100 s: the second file moves the watermark to 350 - 100, so 120 of the third is late and 299 is not
    times = [[0, 50, 150], [350, 260], [120, 299, 360, 199]]
    stage(f"{tmp_path}/log", [[message(100 * k + j, ts=t) for j, t in enumerate(f)] for k, f in enumerate(times)])
    out = scratch_dir(spark, "rates")
    S.run_to_end(L.rate_sink(S.envelope_stream(spark, f"{tmp_path}/log", 1), out, f"{tmp_path}/ck", "100 seconds", delay="100 seconds"))

    def at(c):
        return (F.unix_seconds(c) - 1_700_000_000).alias("s")

    got = {r.s: r.n_changes for r in L.read_rates(spark, out).select(at(F.col("window_start")), "n_changes").collect()}
    assert got == {0: 2, 100: 1, 200: 2, 300: 2}
    assert sorted(r.s for r in L.read_late(spark, out).select(at(F.col("ts"))).collect()) == [120, 199]
    assert datetime.fromtimestamp(1_700_000_000, timezone.utc).second == 20  # windows start at whole hundreds of the epoch


def test_each_change_lands_once(spark, tmp_path):
    rng = random.Random(5)
    files = [[i for i in range(k * 20, k * 20 + 20)] for k in range(4)]
    files += [rng.sample(range(80), 40), [*range(0, 20), 80, 81], [3, 3, 82]]
    stage(f"{tmp_path}/log", [[message(i) for i in f] for f in files])
    out = scratch_dir(spark, "landed")
    S.run_to_end(L.landed_once_sink(S.envelope_stream(spark, f"{tmp_path}/log", 1), out, f"{tmp_path}/ck", bucket_bits=7))
    assert sorted(r[0] for r in L.read_landed(spark, out).select("log_pos").collect()) == [i * 10 + 4 for i in range(83)]
    assert spark.read.parquet(f"{out}/landed").where("batch_id >= 4").count() == 3


def test_landed_files_do_not_grow_with_stretches(spark, tmp_path):
    stage(f"{tmp_path}/log", [[message(i) for i in range(300)], [message(i) for i in [0, 299, 300]]])
    out = scratch_dir(spark, "landed")
    S.run_to_end(L.landed_once_sink(S.envelope_stream(spark, f"{tmp_path}/log", 1), out, f"{tmp_path}/ck", bucket_bits=3))
    landed = spark.read.parquet(f"{out}/landed")
    assert landed.select("stretch").distinct().count() > 200 and len(landed.inputFiles()) <= 8
    assert sorted(r[0] for r in L.read_landed(spark, out).select("log_pos").collect()) == [i * 10 + 4 for i in range(301)]


def test_ranges_hold_every_value(spark):
    values = [-5, 3, 3, 10 ** 6, 2 ** 40, 2 ** 40 + 1]
    ranges = L._ranges(spark.createDataFrame([(v,) for v in [*values, None]], "v long"), "v")
    assert len(ranges) == 2 and all(any(a <= v <= b for a, b in ranges) for v in values)
    assert L._ranges(spark.createDataFrame([], "v long"), "v") == []
    assert L._ranges(spark.createDataFrame([(7,)], "v long"), "v") == [(7, 7)]


def test_shuffled_steps_have_as_many_files_each(spark, tmp_path, monkeypatch):
    from rowtide.plans import queries as q
    monkeypatch.setattr(q, "ROWS_PER_MESSAGE_FILE", 10)
    t = datetime(2024, 1, 1)
    rows = [(i, t, i % 5, "view", 1.0, "p") for i in range(4000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    folder, files = q._stage_shuffled(spark, str(tmp_path))
    text = spark.read.text(folder)
    assert files == 4 and len(text.inputFiles()) == files * (q.SHUFFLED_STEPS + 2) and text.count() == 4000
    order = q.q_stream_reordered(spark, str(tmp_path)).agg(F.sum("n_changes"), F.sum("n_out_of_order")).first()
    assert tuple(order) == (4000 - 16, 0)


def test_arrived_rows_stay_for_one_batch(spark, tmp_path):
    stage(f"{tmp_path}/log", [[message(i) for i in range(20)], [message(i) for i in range(5, 25)], [message(i) for i in (3, 30, 31)]])
    out = scratch_dir(spark, "landed")
    with shuffles_released(spark):
        S.run_to_end(L.landed_once_sink(S.envelope_stream(spark, f"{tmp_path}/log", 1), out, f"{tmp_path}/ck", bucket_bits=3))
    assert sorted(r[0] for r in L.read_landed(spark, out).select("log_pos").collect()) == [i * 10 + 4 for i in [*range(25), 30, 31]]
    assert spark.read.parquet(f"{out}/arrived").count() == 3


def test_staged_row_changes_are_compressed(spark, tmp_path):
    from rowtide.plans import queries as q
    rows = [(i // 3, i % 50, i % 7, i % 3, 1.0 + i % 9, 2.5 * i) for i in range(3000)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    rest = {"l_discount": F.lit(0.1), "l_tax": F.lit(0.2), "l_shipdate": F.lit(datetime(2024, 1, 1)).cast("date"), "l_returnflag": F.lit("A"), "l_linestatus": F.lit("O")}
    spark.createDataFrame(rows, schema).withColumns(rest).write.parquet(f"{tmp_path}/lineitem.parquet")
    want = q._row_changes(feeds.row_events(spark, str(tmp_path))).select(shape.envelope_text(with_row_no=True).alias("value"))
    for resend in (False, True):
        folder, files = q._stage_row_changes(spark, str(tmp_path), resend)
        text = spark.read.text(folder)
        assert all(f.endswith(".lz4") for f in text.inputFiles()) and files == spark.sparkContext.defaultParallelism
        copies = want.unionByName(want) if resend else want
        assert text.exceptAll(copies).isEmpty() and copies.exceptAll(text).isEmpty()


def test_shuffles_are_released_within(spark):
    before = spark.conf.get(CLEANUP)
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files() -> set[str]:
        return {f for x in folder.getAllFiles().mkString("\n").split("\n") if (f := os.path.basename(x)).startswith("shuffle_")}

    def left() -> set[str]:
        there, df = files(), spark.range(1000).groupBy(F.col("id") % 7).count()
        assert len(df.collect()) == 7  # df holds on to its shuffle, whatever garbage is collected
        return files() - there

    with shuffles_released(spark):
        assert spark.conf.get(CLEANUP) == "true" and not left()
    assert spark.conf.get(CLEANUP) == before and left()
