"""Structured Streaming side of the feed.

* Sources: JSON envelope files (``readStream.json`` with ``maxFilesPerTrigger``
  as the intake bound) or Kafka (``startingOffsets`` / ``maxOffsetsPerTrigger``).
* Progress (P3/P4): offsets live in the query's ``checkpointLocation`` and are
  committed per micro-batch; a restart with the same folder resumes.
* Every ``foreachBatch`` writer is idempotent per ``batch_id`` (it overwrites
  that batch's folder), so a replayed batch after a failure writes the same
  files again instead of duplicating them; progress rows are written *after*
  the sink (P5), never before.
* Stateful operators key their state by record key and order by
  ``(pos_key, row_no)``, so arrival order never decides the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.position import file_no, parse_position, pos_key
from ..model import JSON_ENVELOPE

LATEST_KEYS = ("db", "table", "id")
# Envelopes of this type carry time only (a publisher's heartbeat on a quiet log): they
# advance the watermark, so closed windows and sessions are emitted, and are no change.
HEARTBEAT = "heartbeat"


def watermarked(env_stream: DataFrame, delay: str) -> DataFrame:
    """Watermark on ``ts``, then drop heartbeats.

    The filter mentions ``ts`` on purpose: Catalyst pushes predicates that do not
    touch the event-time column below the watermark, and a heartbeat that never
    reaches the watermark cannot advance it.
    """
    return env_stream.withWatermark("ts", delay).filter(
        (F.col("event_type") != HEARTBEAT) | F.col("ts").isNull())


# ---- sources ------------------------------------------------------------------
def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Follow a folder of JSON message files, one message (``value``) a line."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.text(path)


def parse_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Envelopes of JSON messages (``value``), none lost: ``reason`` says why a message is
    no usable envelope (then ``message`` has its text), and is null for the others.  Columns
    ``keep`` of the messages are handed on.

    The envelope comes out of an array of one: filters on its fields stay above that, while below a
    plain projection each field that they name would parse the message again."""
    text = F.col("value").cast("string")
    e = messages.select(F.explode(F.array(F.from_json(text, JSON_ENVELOPE))).alias("e"), text.alias("message"), *keep).select("e.*", "message", *keep)
    kind = F.col("event_type")
    row_change = ~kind.isin("query", HEARTBEAT)
    reason = (F.when(kind.isNull(), "malformed message")
               .when((kind != HEARTBEAT) & parse_position(F.col("binlog"))["pos_key"].isNull(), "no log position")
               .when(row_change & F.coalesce("after.id", "before.id").isNull(), "no record key"))
    return with_positions(e.withColumn("reason", reason).withColumn("message", F.when(F.col("reason").isNotNull(), F.col("message"))))


def good(parsed: DataFrame) -> DataFrame:
    """The usable envelopes of ``parse_messages``."""
    return parsed.filter(F.col("reason").isNull()).drop("reason", "message")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """K6: the messages that are no usable envelopes, whole, with the reason."""
    return parsed.filter(F.col("reason").isNotNull()).select("message", "reason")


def envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Usable envelopes of a folder of JSON message files; adds log_file, pos_key, row_no, ts.

    The other messages are ``dead_letters`` of the same folder: ``publish_sink`` writes both.
    """
    return good(parse_messages(message_stream(spark, path, max_files_per_trigger)))


def kafka_envelope_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                          max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1 / S4 over Kafka (requires the spark-sql-kafka package on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return parse_kafka_envelopes(r.load())


def parse_kafka_envelopes(raw: DataFrame) -> DataFrame:
    """Envelopes from Kafka records (binary ``value`` = the JSON text); batch or stream."""
    return good(parse_messages(raw))


def with_positions(env: DataFrame) -> DataFrame:
    """Position columns of parsed envelopes (the message carries ``file:pos`` and, for an event
    of several changes, ``row_no``)."""
    p = parse_position(F.col("binlog"))
    return env.select(*[c for c in env.columns if c != "row_no"], p["log_file"].alias("log_file"), p["pos"].alias("log_pos"),
                      p["pos_key"].alias("pos_key"), F.coalesce("row_no", F.lit(0)).alias("row_no"),
                      F.timestamp_seconds("timestamp").alias("ts"))


# ---- stateless pipeline to the columnar change table (K7) -------------------------
def change_table_sink(env_stream: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                      processing_time: str = "1 second"):
    """S1 -> K7: append envelopes to a parquet table partitioned by db, table and date."""
    # Event date from the epoch seconds: the same partition whatever the session zone.
    out_df = env_stream.withColumn("dt", F.date_from_unix_date(F.floor(F.col("timestamp") / 86400).cast("int")))
    w = (out_df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("db", "table", "dt").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(out)


# ---- A8: latest state kept by a stream ------------------------------------------------
def latest_state_updates(env_stream: DataFrame, keys: Sequence[str] = LATEST_KEYS) -> DataFrame:
    """Streaming aggregate: winning change per key so far (a delete wins too: its own tombstone).

    Changes without a key are no state of any record (``dead_letters`` has them).
    """
    k = env_stream.filter(~F.col("event_type").isin("query", HEARTBEAT)).withColumn(
        "id", F.coalesce(F.col("after.id"), F.col("before.id"))).filter(F.col("id").isNotNull())
    win = F.max_by(F.struct("event_type", "after", "log_file", "log_pos", "pos_key", "row_no"),
                   F.struct("pos_key", "row_no")).alias("w")
    return k.groupBy(*keys).agg(win, F.count(F.lit(1)).alias("n_changes"))


def latest_state_partial_updates(env_stream: DataFrame, keys: Sequence[str] = LATEST_KEYS) -> DataFrame:
    """A8 for partial (MINIMAL) after-images: per key, each column's newest *present* value
    (``after_present`` mask; a message without it carries a full image), the newest
    change's type and the change count.  A streaming aggregate: combined map-side,
    state of one row per key."""
    from ..functions.image import is_present
    names = JSON_ENVELOPE["after"].dataType.fieldNames()
    full = F.lit((1 << len(names)) - 1)
    mask = F.when(F.col("after").isNotNull(), F.coalesce(F.col("after_present"), full)).otherwise(F.lit(0))
    k = (env_stream.filter(~F.col("event_type").isin("query", HEARTBEAT))
         .withColumn("id", F.coalesce(F.col("after.id"), F.col("before.id"))).filter(F.col("id").isNotNull())
         .withColumn("__mask", mask))
    order = F.struct("pos_key", "row_no")
    cols = [F.max_by(F.col("after")[f], F.when(is_present(F.col("__mask"), i), order)).alias(f)
            for i, f in enumerate(names) if f not in keys]
    return k.groupBy(*keys).agg(*cols, F.max_by("event_type", order).alias("last_op"),
                                F.count(F.lit(1)).alias("n_changes"))


def latest_state_sink(env_stream: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                      processing_time: str = "1 second", progress: str | None = None):
    """A8 + P3 + P5: update-mode aggregate; each micro-batch's changed keys land in
    ``out/batch_id=N`` (overwritten on replay, so exactly once), then the progress row."""
    updates = latest_state_updates(env_stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if progress:
            # from the files just written: the state stage runs once
            (batch.sparkSession.read.schema(batch.schema).parquet(f"{out}/batch_id={batch_id}").agg(F.max_by(F.struct("w.log_file", "w.log_pos"), F.col("w.pos_key")).alias("p"))
                  .filter(F.col("p").isNotNull())
                  .select(F.lit("stream").alias("source"), "p.log_file", F.col("p.log_pos").alias("pos"),
                          F.lit(batch_id).alias("batch_id"))
                  .write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}"))

    w = (updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def publish_sink(messages: DataFrame, writer: Callable[[DataFrame, int], None], dead: str, checkpoint: str,
                 progress: str, available_now: bool = True, processing_time: str = "1 second"):
    """K1-K3, K6, P5: follow log messages, publish the usable ones, keep the others, then save progress.

    ``writer`` gets each micro-batch's (key, value) messages and its id, ordered by log
    position within record keys' partitions; it must be idempotent per batch id (overwrite
    that batch's output), for a batch is handed over again after a failure.  Dead letters go
    to ``dead/batch_id=N`` with their reason, and the newest position, DDL events included, to
    ``progress/batch_id=N`` once both are written.
    """
    from ..sinks.publish import to_messages

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch).persist()
        try:
            usable = good(parsed).filter(F.col("event_type") != HEARTBEAT)
            key = F.coalesce(F.col("after.id"), F.col("before.id"))
            ordered = usable.repartition("db", "table", key).sortWithinPartitions("pos_key", "row_no")
            writer(to_messages(ordered, with_row_no=True), batch_id)
            dead_letters(parsed).write.mode("overwrite").parquet(f"{dead}/batch_id={batch_id}")
            (usable.agg(F.max_by(F.struct("log_file", "log_pos"), F.col("pos_key")).alias("p"))
                   .filter(F.col("p").isNotNull())
                   .select(F.lit("stream").alias("source"), "p.log_file", F.col("p.log_pos").alias("pos"),
                           F.lit(batch_id).alias("batch_id"))
                   .write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}"))
        finally:
            parsed.unpersist()

    w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """P5: newest saved position per source from the progress rows (one per micro-batch).

    Positions compare by number (``pos_key``), so batches that arrived out of
    log order cannot move the saved position backwards.
    """
    p = spark.read.parquet(progress)
    k = pos_key(file_no(F.col("log_file")), F.col("pos"))
    return p.groupBy("source").agg(F.max_by(F.struct("log_file", "pos"), k).alias("p")).select(
        "source", "p.log_file", F.col("p.pos").alias("log_pos"),
        F.concat_ws(":", "p.log_file", F.col("p.pos").cast("string")).alias("binlog"))


def read_latest_state(spark: SparkSession, out: str, keep_deletes: bool = False) -> DataFrame:
    """Current table from the per-batch update files.

    Update mode emits a key's whole state each time the key changes, so the
    row from the key's newest batch is its answer (``max_by`` on batch id:
    partial aggregation, no per-key sort).
    """
    u = spark.read.parquet(out)
    agg = u.groupBy(*LATEST_KEYS).agg(F.max_by(F.struct("w", "n_changes"), F.col("batch_id")).alias("x"))
    if not keep_deletes:
        agg = agg.filter(F.col("x.w.event_type") != "delete")
    return agg.select(F.col("db"), F.col("table").alias("tbl"), "id",
                      F.col("x.w.after.value").alias("value"), F.col("x.w.after.props").alias("props"),
                      F.col("x.w.event_type").alias("last_op"), F.col("x.w.log_file").alias("log_file"),
                      F.col("x.w.log_pos").alias("log_pos"), F.col("x.n_changes").alias("n_changes"))


def compact_latest_state(spark: SparkSession, out: str, compacted: str) -> DataFrame:
    """Fold the per-batch update folders of a latest-state stream into one table.

    Long-running streams add one folder per micro-batch; readers then merge
    more and more files.  Compaction writes the merged table (deletes kept as
    tombstones) to ``compacted``; it is an aggregate with partial
    aggregation, safe to rerun after a failure because it overwrites.
    """
    u = spark.read.parquet(out)
    merged = u.groupBy(*LATEST_KEYS).agg(F.max_by(F.struct("w", "n_changes", "batch_id"), F.col("batch_id"))
                                         .alias("x"))
    merged.select(*LATEST_KEYS, "x.w", "x.n_changes", "x.batch_id").write.mode("overwrite").parquet(compacted)
    return spark.read.parquet(compacted)


# ---- P6, A7, P7 ----------------------------------------------------------------------
def dedup_stream(env_stream: DataFrame, delay: str = "10 minutes",
                 identity: Sequence[str] = ("log_file", "log_pos", "row_no")) -> DataFrame:
    """Drop replayed copies of a change within the watermark delay."""
    return watermarked(env_stream, delay).dropDuplicatesWithinWatermark(list(identity))


def rate_stream(env_stream: DataFrame, width: str, slide: str | None = None, by: Sequence[str] = ("db",),
                delay: str = "10 minutes") -> DataFrame:
    """Windowed change counts with a watermark for late changes."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return (watermarked(env_stream, delay).groupBy(w.alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n_changes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                    "n_changes"))


def session_stream(env_stream: DataFrame, gap: str, by: Sequence[str] = ("db", "table"),
                   delay: str = "10 minutes") -> DataFrame:
    """Session windows per group with a watermark.

    Spark runs streaming session windows in append mode (sessions are emitted
    once the watermark passes their end, and their state is dropped) or
    complete mode (the whole result each trigger; for small groupings and
    tests).  Update mode is not available for session windows.  On a quiet log
    the watermark only moves with ``heartbeat`` envelopes (counted by no
    session), so a publisher's heartbeats are what close the last sessions.
    """
    return (watermarked(env_stream, delay).groupBy(F.session_window("ts", gap).alias("s"), *by)
            .agg(F.count(F.lit(1)).alias("n_changes"))
            .select(*by, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_changes"))


def update_sink(agg_stream: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                processing_time: str = "1 second"):
    """Update-mode aggregate (e.g. windowed rates): each micro-batch's changed groups
    land in ``out/batch_id=N``, overwritten on replay (exactly once)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = (agg_stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def read_updates(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Current value of every group written by ``update_sink``: the row from its newest batch
    (``max_by`` on the batch id, partial aggregation, no per-group sort)."""
    u = spark.read.parquet(out)
    vals = [c for c in u.columns if c not in (*keys, "batch_id")]
    return (u.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("x"))
             .select(*keys, "x.*"))


def append_sink(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True,
                processing_time: str = "1 second"):
    """Append a stateless or watermarked stream to a Parquet folder (file sink: exactly once)."""
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(out)


def ordered_batches(fn: Callable[[DataFrame, int], None], key: Sequence[str] = ("db", "table"),
                    partitions: int | None = None) -> Callable[[DataFrame, int], None]:
    """Wrap a ``foreachBatch`` writer so each key's changes reach it in log order.

    The batch is range-partitioned on ``(key, pos_key, row_no)`` and sorted
    within partitions: partition ``i`` holds one contiguous slice of that
    order, so a key's changes run through consecutive partitions in log
    order.  A hot key is split over several partitions instead of pinning one
    task; a sink that numbers its output by partition (part files, table
    commits) keeps the per-key order.
    """
    cols = [*key, "pos_key", "row_no"]

    def run(batch: DataFrame, batch_id: int) -> None:
        b = batch.repartitionByRange(partitions, *cols) if partitions else batch.repartitionByRange(*cols)
        fn(b.sortWithinPartitions(*cols), batch_id)
    return run


def delivery_order(path: str, spark: SparkSession, key: Sequence[str] = ("db", "table", "id"),
                   across_batches: bool = False) -> DataFrame:
    """Check P7 on the part files written by an ``ordered_batches`` writer under ``path/batch_id=N``.

    Delivery order is (batch, part number, row index in the file).  Within a
    batch the writer guarantees log order per key; across batches it holds when
    the source delivers in log order (``across_batches=True`` checks that too).
    Returns one row per key: its change count and how many of its changes were
    delivered after a change with a later log position.  The neighbour
    comparison runs through ``keyed_window`` bucketed by (batch, part), so a key
    spread over many parts is spread over many tasks.
    """
    from ..operators.ordered import keyed_window
    d = spark.read.parquet(path).select(
        *key, "batch_id", "pos_key", "row_no",
        F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int").alias("part_no"),
        F.col("_metadata.row_index").alias("row_index"))
    group = [*key] if across_batches else [*key, "batch_id"]
    d = keyed_window(d, group, ["batch_id", "part_no", "row_index"], [F.col("batch_id"), F.col("part_no")],
                     lag=["pos_key", "row_no"])
    late = F.col("prev_pos_key").isNotNull() & (F.struct("prev_pos_key", "prev_row_no")
                                                 > F.struct("pos_key", "row_no"))
    return d.groupBy(*key).agg(F.count(F.lit(1)).alias("n_changes"),
                               F.count(F.when(late, 1)).alias("n_out_of_order"))


def ordered_sink(env_stream: DataFrame, out: str, checkpoint: str, key: Sequence[str] = ("db", "table", "id"),
                 available_now: bool = True, processing_time: str = "1 second"):
    """Deliver each micro-batch's row changes ordered per record key into ``out/batch_id=N``
    (overwritten on replay, so a re-run batch is written once)."""
    changes = env_stream.filter(F.col("event_type") != "query").withColumn(
        "id", F.coalesce(F.col("after.id"), F.col("before.id")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = (changes.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(ordered_batches(write, key)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def run_to_end(query) -> None:
    """Block until an availableNow query has drained its input; raise its error if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
