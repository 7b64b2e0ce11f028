"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the staged tables (through the derived feeds) and runs over
all of their rows.  Column names equal those of the oracle SQL of the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import header as H
from ..functions.decode import epoch_ntz
from ..functions.position import is_valid_position, parse_position, position_label
from ..model import POS_SHIFT
from ..operators import consume, filters, positions, rawlog, schema, shape
from ..session import scratch_dir, shuffles_released
from ..sinks import compaction
from ..sinks.publish import batch_writer, to_messages, write_change_table, write_routed
from ..sources import feeds
from ..sources.rawlog import damaged_events, raw_events
from ..sources.tables import read_table
from ..streaming import landing as L
from ..streaming import stream as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def reg(fn):
        QUERIES[name] = fn
        return fn
    return reg


def flat_envelope(cl: DataFrame) -> DataFrame:
    """Flat columns of the published envelope (R6 + R10 + R11)."""
    e = shape.envelope(cl)
    return e.select("binlog", "db", F.col("table").alias("tbl"), "event_type", "query", "primary",
                    *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after")
                      for c in ("id", "value", "props")],
                    "timestamp")


@query("envelope")
def q_envelope(spark, sf):
    return flat_envelope(feeds.changelog(spark, sf))


@query("latest_state")
def q_latest_state(spark, sf):
    return consume.latest_state(feeds.changelog(spark, sf))


@query("latest_state_partial")
def q_latest_state_partial(spark, sf):
    """A1 over MINIMAL row images: per column, the newest present value."""
    return consume.latest_state_partial(feeds.partial_changelog(spark, sf))


@query("change_rollup")
def q_change_rollup(spark, sf):
    return consume.change_rollup(feeds.changelog(spark, sf))


# -- D*: stored-value decode over cells derived from orders ------------------


@query("decode_unsigned")
def q_decode_unsigned(spark, sf):
    c = feeds.cells(spark, sf)
    return c.select("o_orderkey", D.unsigned("s_tiny", 8).alias("u_tiny"),
                    D.unsigned("s_small", 16).alias("u_small"), D.unsigned("s_medium", 24).alias("u_medium"),
                    D.signed24("raw24").alias("s_medium24"), D.unsigned("s_int", 32).alias("u_int"),
                    D.unsigned("s_bigint", 64).alias("u_bigint"))


@query("decode_bool")
def q_decode_bool(spark, sf):
    c = feeds.cells(spark, sf)
    return c.select("o_orderkey", "tiny1", D.tinyint_bool("tiny1").alias("as_bool"))


@query("decode_year")
def q_decode_year(spark, sf):
    return feeds.cells(spark, sf).select("o_orderkey", D.year("year_byte").alias("yr"))


@query("decode_decimal")
def q_decode_decimal(spark, sf):
    return feeds.cells(spark, sf).select("o_orderkey", D.exact_decimal("dec_text", 12, 2).alias("dec_value"))


@query("decode_date")
def q_decode_date(spark, sf):
    return feeds.packed(spark, sf).select("o_orderkey", D.packed_date("d3").alias("decoded_date"))


@query("decode_time")
def q_decode_time(spark, sf):
    c = feeds.cells(spark, sf).select("o_orderkey", D.time_hhmmss("time_int").alias("t1"),
                                      D.time2("time2_raw").alias("t2"))
    return c.select("o_orderkey", D.interval_seconds("t1").cast("long").alias("time_secs"),
                    D.interval_seconds("t2").cast("long").alias("time2_secs"),
                    D.interval_text("t1").alias("time_text"))


@query("decode_timestamp")
def q_decode_timestamp(spark, sf):
    c = feeds.cells(spark, sf)
    return c.select("o_orderkey", D.utc_wall_clock("ts_secs").alias("ts_value"))


@query("decode_datetime_int")
def q_decode_datetime_int(spark, sf):
    c = feeds.cells(spark, sf)
    return c.select("o_orderkey", "dt_int", D.datetime_from_int("dt_int").alias("dt_value"))


@query("decode_datetime_packed")
def q_decode_datetime_packed(spark, sf):
    return feeds.packed(spark, sf).select("o_orderkey", "dt2", D.datetime2("dt2").alias("dt_value"))


ORDER_STATUS_LABELS = ["F", "O", "P"]
SET_LABELS = ["s0", "s1", "s2"]


@query("decode_enum")
def q_decode_enum(spark, sf):
    c = feeds.cells(spark, sf)
    labels = F.array(*[F.lit(x) for x in ORDER_STATUS_LABELS])
    return c.select("o_orderkey", "enum_idx", D.enum_label("enum_idx", labels).alias("enum_value"))


@query("decode_set")
def q_decode_set(spark, sf):
    c = feeds.cells(spark, sf)
    return c.select("o_orderkey", "set_mask",
                    F.array_join(D.set_labels("set_mask", SET_LABELS), ",").alias("set_value"))


@query("decode_bit")
def q_decode_bit(spark, sf):
    return feeds.cells(spark, sf).select("o_orderkey", D.bit_value("bit_bytes").alias("bit_value"))


@query("decode_text")
def q_decode_text(spark, sf):
    cu = read_table(spark, sf, "customer").select("c_custkey", F.encode("c_name", "UTF-8").alias("raw"))
    t = D.text_value("raw", "utf8mb4")
    return cu.select("c_custkey", t.alias("name_text"), F.length(t).alias("n_chars"))


# -- positions (S3, S4, P2, P4, P6, F7) -------------------------------------

# Bounds as parts of the log, so they move as it grows.
SCAN_START, SCAN_STOP = (3, 10), (7, 10)
RESUME_AT = (1, 2)
LOG_COLS = ["seq", "log_file", "log_pos", "event_type"]


@query("bounded_scan")
def q_bounded_scan(spark, sf):
    cl = feeds.changelog(spark, sf)
    start, stop = positions.at_fraction(cl, *SCAN_START), positions.at_fraction(cl, *SCAN_STOP)
    return positions.bounded_scan(cl, start, stop).select(*LOG_COLS)


@query("latest_position")
def q_latest_position(spark, sf):
    return positions.latest_position(feeds.changelog(spark, sf))


@query("newest_position")
def q_newest_position(spark, sf):
    cl = feeds.changelog(spark, sf)
    cand = cl.select("db", position_label("log_file", "log_pos").alias("label"))
    return positions.newest_position(cand, ["db"])


@query("resume_after")
def q_resume_after(spark, sf):
    cl = feeds.changelog(spark, sf)
    return positions.resume_after(cl, positions.at_fraction(cl, *RESUME_AT)).select(*LOG_COLS)


@query("dedup_replay")
def q_dedup_replay(spark, sf):
    cl = feeds.stored(feeds.changelog(spark, sf))
    replay = positions.resume_after(cl, positions.at_fraction(cl, *RESUME_AT))
    return positions.dedup_replay(cl.unionByName(replay)).select(*LOG_COLS)


@query("valid_position")
def q_valid_position(spark, sf):
    cl = feeds.changelog(spark, sf)
    cands = F.array(position_label("log_file", "log_pos"), F.concat("log_file", F.lit(":")), F.col("log_file"))
    c = cl.select("seq", F.posexplode(cands).alias("variant", "candidate"))
    return c.select("seq", "variant", "candidate", is_valid_position("candidate").alias("valid"),
                    parse_position("candidate")["pos_key"].alias("pos_key"))


# -- filters (F1-F4) ---------------------------------------------------------
FILTER_COLS = ["seq", "db", "tbl", "event_type"]
INCLUDE = [("app", "t0"), ("audit", "t3")]
EXCLUDE = [("app", "t0")]


@query("type_subscription")
def q_type_subscription(spark, sf):
    return filters.subscribe(feeds.changelog(spark, sf), ["insert", "delete"]).select(*FILTER_COLS)


@query("db_allow")
def q_db_allow(spark, sf):
    return filters.allow_databases(feeds.changelog(spark, sf), ["app"]).select(*FILTER_COLS)


@query("table_include")
def q_table_include(spark, sf):
    return filters.include_tables(feeds.changelog(spark, sf), INCLUDE).select(*FILTER_COLS)


@query("table_exclude")
def q_table_exclude(spark, sf):
    return filters.exclude_tables(feeds.changelog(spark, sf), EXCLUDE).select(*FILTER_COLS)


# -- row shaping (R1-R7) -----------------------------------------------------
IMG = ["row_no", "l_partkey", "l_quantity", "l_extendedprice"]


@query("flatten_insert")
def q_flatten_insert(spark, sf):
    f = shape.flatten_inserts(feeds.row_events(spark, sf))
    return f.select("l_orderkey", *[F.col(f"after.{c}").alias(c) for c in IMG])


@query("flatten_delete")
def q_flatten_delete(spark, sf):
    f = shape.flatten_deletes(feeds.row_events(spark, sf))
    return f.select("l_orderkey", *[F.col(f"before.{c}").alias(c) for c in IMG])


@query("pair_update")
def q_pair_update(spark, sf):
    p = shape.pair_updates(feeds.row_events(spark, sf))
    per_event = feeds.ROWS_PER_EVENT // 2
    return p.select("l_orderkey", (F.col("chunk") * per_event + F.col("pair_no")).alias("pair_no"),
                    *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("before", "after") for c in IMG[:3]],
                    "status")


@query("pair_update_long")
def q_pair_update_long(spark, sf):
    """R3 on the long form: one row per image, paired by (event, row_no div 2)."""
    p = shape.pair_update_rows(feeds.row_images(spark, sf))
    return p.select("l_orderkey", "pair_no",
                    *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("before", "after") for c in IMG[:3]],
                    "status")


@query("drop_empty")
def q_drop_empty(spark, sf):
    ev = shape.drop_empty(shape.change_events(feeds.changelog(spark, sf)))
    return ev.select("log_file", "log_pos", "event_type", F.size("rows").alias("n_rows"))


@query("query_passthrough")
def q_query_passthrough(spark, sf):
    e = shape.query_passthrough(feeds.changelog(spark, sf))
    return e.select("binlog", "db", F.col("table").alias("tbl"), "query", "event_type", "primary", "timestamp",
                    F.col("before").isNull().alias("before_empty"), F.col("after").isNull().alias("after_empty"))


@query("envelope_json")
def q_envelope_json(spark, sf):
    js = shape.envelope_json(shape.envelope(feeds.changelog(spark, sf)))
    back = js.select(F.from_json("value", shape_json_schema()).alias("e"),
                     F.size(F.json_object_keys(F.get_json_object("value", "$.before"))).alias("before_keys"),
                     F.size(F.json_object_keys(F.get_json_object("value", "$.after"))).alias("after_keys"))
    return back.select("e.binlog", "e.db", F.col("e.table").alias("tbl"), "e.event_type", "e.query", "e.primary",
                       *[F.col(f"e.{s}.{c}").alias(f"{s}_{c}") for s in ("before", "after")
                         for c in ("id", "value", "props")],
                       F.col("e.timestamp").alias("timestamp"), "before_keys", "after_keys")


# Image structs of the two tables on the mixed queue.
CHANGE_IMAGE = "struct<id:bigint,value:double,props:string>"
SHOP_IMAGE = "struct<l_orderkey:bigint,l_linenumber:int,l_partkey:bigint,l_quantity:double>"
MIXED_COLS = ["binlog", "db", "tbl", "event_type", "key", "amount", "n_after_fields", "timestamp", "malformed"]


@query("envelope_variant")
def q_envelope_variant(spark, sf):
    """S2 on one queue carrying two tables: parse with variant images, land by table,
    type each table's images from its own folder; garbled messages come out malformed."""
    changes = shape.envelope(feeds.changelog(spark, sf)).select(shape.envelope_text().alias("value"))
    parsed = shape.parse_envelope_variant(changes.unionByName(feeds.shop_envelopes(spark, sf)))
    path = scratch_dir(spark, "routed")
    write_routed(parsed.withColumn("n_after_fields", shape.image_size("after")), path)
    routed = spark.read.parquet(path)

    def common(df, key, amount):
        return df.select("binlog", "db", F.col("table").alias("tbl"), "event_type", key.alias("key"),
                         amount.alias("amount"), "n_after_fields", "timestamp", "malformed")
    shop = shape.typed_images(routed.filter((F.col("db") == "shop") & (F.col("table") == "lineitem")), SHOP_IMAGE)
    rest = shape.typed_images(routed.filter(F.col("db").isin("app", "audit")), CHANGE_IMAGE)
    garbled = routed.filter(F.col("db").isNull())
    return (common(shop, F.coalesce(F.col("after.l_orderkey"), F.col("before.l_orderkey")), F.col("after.l_quantity"))
            .unionByName(common(rest, F.coalesce(F.col("after.id"), F.col("before.id")), F.col("after.value")))
            .unionByName(common(garbled, F.lit(None).cast("bigint"), F.lit(None).cast("double"))))


@query("envelope_inferred")
def q_envelope_inferred(spark, sf):
    """Two tables on one queue, their image types learnt from the feed itself."""
    changes = shape.envelope(feeds.changelog(spark, sf)).select(shape.envelope_text().alias("value"))
    parsed = feeds.stored(shape.parse_envelope_variant(changes.unionByName(feeds.growing_envelopes(spark, sf))), "parsed")
    tables = shape.typed_by_table(parsed, shape.image_types(parsed))

    def common(df, key, amount, more):
        return df.select("binlog", "db", F.col("table").alias("tbl"), "event_type", key.cast("bigint").alias("key"), amount.cast("double").alias("amount"),
                         more.cast("double").alias("tax"))

    parts = [common(df, F.col("after.l_orderkey"), F.col("after.l_quantity"), F.col("after.l_tax")) if db == "shop" else
             common(df, F.coalesce("after.id", "before.id"), F.col("after.value"), F.lit(None)) for (db, _), df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts)


def shape_json_schema():
    from ..model import JSON_ENVELOPE
    return JSON_ENVELOPE


# -- schema tracking (C1, C3-C5, R8, D17-D19) --------------------------------
@query("ddl_table")
def q_ddl_table(spark, sf):
    return schema.ddl_changes(feeds.changelog(spark, sf)).select("seq", "ddl_kind", "db", "tbl")


@query("table_identity")
def q_table_identity(spark, sf):
    """Every change of a log whose tables are renamed, dropped and made anew, with the table it belongs to."""
    log = feeds.stored(feeds.evolving_log(spark, sf))
    lives = schema.table_lives(log, schema.ddl_statements(log))
    return schema.table_identity(log, lives).select("seq", "db", "tbl", "event_type", "born", "first_db", "first_tbl", "last_db", "last_tbl", "n_names")


@query("schema_columns")
def q_schema_columns(spark, sf):
    """C1 + C4: the ordered columns of every version of every table of the evolving log."""
    log = feeds.stored(feeds.evolving_log(spark, sf))
    return schema.schema_columns(log, feeds.BASE_COLUMNS).drop("table")


@query("primary_keys_versions")
def q_primary_keys_versions(spark, sf):
    """The key of every version of every table of the evolving log."""
    log = feeds.stored(feeds.evolving_log(spark, sf))
    return schema.keys_of_versions(schema.schema_columns(log, feeds.BASE_COLUMNS))


@query("decode_by_schema")
def q_decode_by_schema(spark, sf):
    """Stored integers of the evolving log, each decoded by the column its table had at its position."""
    log = feeds.stored(feeds.evolving_log(spark, sf))
    columns = feeds.stored(schema.schema_columns(log, feeds.BASE_COLUMNS), "columns")
    return schema.decode_by_schema(feeds.schema_cells(log), columns).select("seq", "tbl", "ordinal", "stored", "name", "type", "unsigned", "value", "error")


@query("decode_decimal_bytes")
def q_decode_decimal_bytes(spark, sf):
    """Stored DECIMAL bytes of every precision and scale."""
    return feeds.stored_decimals(spark, sf).select("o_orderkey", "p", "s", F.length("raw").alias("n_bytes"), D.decimal_text("raw", F.col("p"), F.col("s")).alias("value"))


@query("decode_float")
def q_decode_float(spark, sf):
    """Stored FLOAT and DOUBLE bytes; infinities and NaN come as text."""
    c = feeds.stored_floats(spark, sf).select("o_orderkey", D.float_bytes("f").cast("double").alias("f"), D.double_bytes("d").alias("d"))
    finite = {n: F.when(F.abs(n) < float("inf"), F.col(n)).alias(f"{n}_value") for n in ("f", "d")}
    odd = {n: F.when(F.isnan(n), "nan").when(F.col(n) == float("inf"), "inf").when(F.col(n) == float("-inf"), "-inf").alias(f"{n}_odd") for n in ("f", "d")}
    return c.select("o_orderkey", *finite.values(), *odd.values())


@query("schema_intervals")
def q_schema_intervals(spark, sf):
    return schema.schema_versions(feeds.stored(feeds.changelog(spark, sf)), len(feeds.BASE_COLUMNS))


@query("schema_asof")
def q_schema_asof(spark, sf):
    cl = feeds.stored(feeds.changelog(spark, sf))
    rows = cl.filter(F.col("event_type") != "query")
    versions = feeds.stored(schema.schema_versions(cl, len(feeds.BASE_COLUMNS)), "versions")   # sized once, read by the join
    return schema.schema_asof(rows, versions).select("seq", "db", "tbl", "version", "n_columns")


@query("primary_keys")
def q_primary_keys(spark, sf):
    return schema.primary_keys(schema.catalogue(feeds.stored(feeds.changelog(spark, sf)), feeds.BASE_COLUMNS, feeds.added_key()))


@query("enum_labels")
def q_enum_labels(spark, sf):
    ct = feeds.column_types(spark, sf)
    labels = D.type_labels("column_type")
    return ct.select("o_orderkey", "column_type", F.array_join(labels, "|").alias("labels"),
                     F.size(labels).alias("n_labels"))


@query("column_flags")
def q_column_flags(spark, sf):
    ct = feeds.column_types(spark, sf)
    return ct.select("o_orderkey", "flag_type", "column_key", "extra",
                     D.column_flags("flag_type", "column_key", "extra").alias("f")).select(
        "o_orderkey", "flag_type", "column_key", "extra", "f.*")


@query("quarantine")
def q_quarantine(spark, sf):
    ct = feeds.column_types(spark, sf)
    err = D.decode_error("type_code")
    return ct.select("o_orderkey", "type_code", D.field_type_name("type_code").alias("type_name"),
                     err.alias("decode_error"),
                     F.when(err.isNull(), "ok").otherwise("quarantine").alias("route"))


# -- consumers (A2-A11, J4) --------------------------------------------------
KEY = ["db", "tbl", "id"]


@query("key_history")
def q_key_history(spark, sf):
    h = consume.key_history(feeds.stored(feeds.changelog(spark, sf)))
    return h.select(*KEY, "seq", "event_type", "version", "valid_from", "valid_to")


@query("key_order")
def q_key_order(spark, sf):
    return consume.key_order(feeds.stored(feeds.changelog(spark, sf))).select(*KEY, "seq", "key_seq")


@query("changed_columns")
def q_changed_columns(spark, sf):
    c = consume.changed_columns(feeds.changelog(spark, sf), ["id", "value", "props"])
    return c.select("db", "tbl", F.col("after.id").alias("id"), "seq", "changed", "n_changed")


@query("continuity")
def q_continuity(spark, sf):
    return consume.continuity(feeds.stored(feeds.changelog(spark, sf))).select(*KEY, "seq", "event_type", "status")


@query("last_changes")
def q_last_changes(spark, sf):
    return consume.last_changes(feeds.changelog(spark, sf), 20, "app", "t0").select(*LOG_COLS)


MERGE_A_TO, MERGE_B_FROM = (7, 10), (4, 10)


def _two_feeds(spark, sf):
    cl = feeds.stored(feeds.changelog(spark, sf))
    a = cl.filter(F.col("pos_key") <= F.lit(positions.label_key(positions.at_fraction(cl, *MERGE_A_TO))))
    b = cl.filter(F.col("pos_key") >= F.lit(positions.label_key(positions.at_fraction(cl, *MERGE_B_FROM))))
    return a, b


@query("merge_feeds")
def q_merge_feeds(spark, sf):
    a, b = _two_feeds(spark, sf)
    return consume.merge_feeds(a, b).select(*LOG_COLS)


@query("feed_difference")
def q_feed_difference(spark, sf):
    a, b = _two_feeds(spark, sf)
    return consume.feed_difference(a, b).select(*LOG_COLS)


@query("lookup_current")
def q_lookup_current(spark, sf):
    cl = feeds.stored(feeds.changelog(spark, sf))
    current = consume.latest_state(cl).select(*KEY, "value", "props", F.lit(True).alias("found"))
    out = consume.lookup_current(consume.keyed_changes(cl), current, KEY)
    return out.withColumn("found", F.coalesce("found", F.lit(False)))


@query("rate_tumbling")
def q_rate_tumbling(spark, sf):
    return consume.change_rate(feeds.changelog(spark, sf), "10 minutes")


@query("rate_sliding")
def q_rate_sliding(spark, sf):
    return consume.change_rate(feeds.changelog(spark, sf), "10 minutes", "5 minutes")


@query("rate_session")
def q_rate_session(spark, sf):
    return consume.change_sessions(feeds.stored(feeds.changelog(spark, sf)), ["db", "tbl"], 30 * 60)


# -- raw-event ingest (H1-H11) ----------------------------------------------


@query("header_split")
def q_header_split(spark, sf):
    ev = rawlog.decode_headers(raw_events(spark, sf))
    return ev.select("source", "ordinal", F.unix_seconds("ts").alias("ts_secs"), "type_code", "server_id",
                     "event_size", "log_pos", "flags", "checksum_ok",
                     (F.col("event_size") == F.length("payload")).alias("size_ok"))


@query("event_names")
def q_event_names(spark, sf):
    ev = rawlog.dispatch(rawlog.decode_headers(raw_events(spark, sf)))
    return ev.select("ordinal", "type_code", H.event_name("type_code").alias("event_name"),
                     shape.operation_name("type_code").alias("operation"))


@query("flag_names")
def q_flag_names(spark, sf):
    ev = rawlog.decode_headers(raw_events(spark, sf))
    return ev.select("ordinal", "flags", F.array_join(H.flag_names("flags"), ",").alias("flag_names"))


@query("query_body_split")
def q_query_body_split(spark, sf):
    ev = rawlog.decode_headers(raw_events(spark, sf)).filter(F.col("type_code") == 2)
    return ev.select("ordinal", H.query_body("payload").alias("q")).select(
        "ordinal", "q.proxy_id", "q.exec_time", "q.error_code", "q.schema", "q.query")


@query("raw_quarantine")
def q_raw_quarantine(spark, sf):
    """H9: damaged raw events are set aside with a reason; the whole ones are decoded on (counted by type)."""
    whole, bad = rawlog.whole_events(rawlog.decode_headers(feeds.stored(damaged_events(spark, sf), "damaged")))
    reasons = bad.select(F.regexp_replace("reason", r"size .*", "wrong size").alias("what"), "ordinal")
    kinds = whole.select(H.event_name("type_code").alias("what"), "ordinal")
    return reasons.unionByName(kinds).groupBy("what").agg(F.count(F.lit(1)).alias("n_events"), F.min("ordinal").alias("first_ordinal"))


@query("log_file_fill")
def q_log_file_fill(spark, sf):
    ev = rawlog.fill_log_file(rawlog.decode_headers(raw_events(spark, sf)))
    return ev.select("ordinal", "type_code", "log_file")


# -- streaming (S1, P3, K7, A8) ----------------------------------------------

# Micro-batches the staged feed is replayed in.
STAGE_BATCHES = 4


def _stage_envelopes(spark, sf, partial: bool = False) -> tuple[str, int]:
    """Publish the feed as JSON envelope files (the stream's input).

    One file per core of the cluster (at least STAGE_BATCHES), so the write is
    as parallel as the cluster and never funnels the feed through a few tasks;
    returns the folder and the files per trigger that replay it in about
    STAGE_BATCHES micro-batches.  ``partial`` publishes the MINIMAL-image feed with
    its column-present masks.
    """
    files = max(STAGE_BATCHES, spark.sparkContext.defaultParallelism)
    stage = scratch_dir(spark, "stage")
    env = shape.envelope((feeds.partial_changelog if partial else feeds.changelog)(spark, sf))
    (env.select(shape.envelope_text(with_mask=partial).alias("value")).repartition(files)
        .write.mode("overwrite").text(stage))
    return stage, max(1, files // STAGE_BATCHES)


def _stage_in_log_order(spark, sf, replay_last_file: bool = False,
                        heartbeat_after: int | None = None) -> tuple[str, int]:
    """Publish the feed in STAGE_BATCHES position ranges, one write per range in log
    order, so the file source (oldest files first) replays it in log order, one range
    per micro-batch -- the arrival a watermark assumes.  With ``replay_last_file`` the
    last log file of each range is written again right after it: a resend after a
    restart (P6).  With ``heartbeat_after`` a heartbeat envelope follows, that many
    seconds after the newest change: it advances event time past the last windows
    and sessions, as a publisher's heartbeat does on a quiet log.  Every range write
    has the same number of files (one per core per range)."""
    files = max(1, spark.sparkContext.defaultParallelism // STAGE_BATCHES)
    cl = feeds.stored(feeds.changelog(spark, sf))
    last = cl.agg(F.max("file_no")).first()[0]                 # one scalar: the range bounds
    bounds = [1 + (last * k) // STAGE_BATCHES for k in range(STAGE_BATCHES + 1)]
    bounds[-1] = last + 1
    stage = scratch_dir(spark, "stage")
    text = shape.envelope(cl).select(shape.envelope_text().alias("value"), "pos_key")

    def write(rows):
        rows.select("value").repartition(files).write.mode("append").text(stage)
    for lo, hi in zip(bounds, bounds[1:]):
        write(text.filter((F.col("pos_key") >= F.lit(lo * POS_SHIFT)) & (F.col("pos_key") < F.lit(hi * POS_SHIFT))))
        if replay_last_file:
            write(text.filter((F.col("pos_key") >= F.lit((hi - 1) * POS_SHIFT))
                              & (F.col("pos_key") < F.lit(hi * POS_SHIFT))))
    if heartbeat_after is not None:
        image = cl.schema["after"].dataType.simpleString()
        newest = cl.agg(F.max_by(position_label("log_file", "log_pos"), "pos_key").alias("binlog"),
                        F.max(shape.event_seconds("ev_ts")).alias("secs"))
        beat = newest.select("binlog", F.lit("").alias("db"), F.lit("").alias("table"), F.lit("").alias("query"),
                             F.lit(S.HEARTBEAT).alias("event_type"), F.lit("").alias("primary"),
                             F.lit(None).cast(image).alias("before"), F.lit(None).cast(image).alias("after"),
                             (F.col("secs") + heartbeat_after).alias("timestamp"))
        beat.select(shape.envelope_text().alias("value")).write.mode("append").text(stage)
    return stage, files


def _change_table_columns(t: DataFrame) -> DataFrame:
    return t.select("binlog", "db", F.col("table").alias("tbl"), "event_type", "query", "primary",
                    *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("before", "after")
                      for c in ("id", "value", "props")],
                    "timestamp", "dt")


@query("stream_envelope")
def q_stream_envelope(spark, sf):
    src = S.envelope_stream(spark, *_stage_envelopes(spark, sf))
    out, ck = scratch_dir(spark, "changes"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.change_table_sink(src, out, ck))
    return _change_table_columns(spark.read.parquet(out))


@query("stream_change_table_compacted")
def q_stream_change_table_compacted(spark, sf):
    """K7 on a stream: the landed table after compaction, read by its manifest."""
    src = S.envelope_stream(spark, *_stage_envelopes(spark, sf))
    table = scratch_dir(spark, "compacted")
    S.run_to_end(compaction.land_batches(src, table, scratch_dir(spark, "ckpt")))
    landed = src.withColumn("dt", F.lit(None).cast("date")).schema
    compaction.compact(spark, table, landed)
    return _change_table_columns(compaction.read_change_table(spark, table, landed))


@query("change_table")
def q_change_table(spark, sf):
    """K7 (batch): land the feed as the partitioned change table, read it back."""
    out = scratch_dir(spark, "change-table")
    write_change_table(shape.envelope(feeds.changelog(spark, sf)), out)
    return _change_table_columns(spark.read.parquet(out))


@query("table_scan")
def q_table_scan(spark, sf):
    """S3 + F3 over the landed change table: the table filter prunes folders, the
    position bounds reach the Parquet scan as pushed filters on ``pos_key``."""
    out = scratch_dir(spark, "change-table")
    write_change_table(shape.envelope(feeds.changelog(spark, sf)), out)
    cl = feeds.changelog(spark, sf)
    t = spark.read.parquet(out).filter((F.col("db") == "app") & (F.col("table") == "t0"))
    t = positions.bounded_scan(t, positions.at_fraction(cl, *SCAN_START), positions.at_fraction(cl, *SCAN_STOP))
    return t.select("binlog", "db", F.col("table").alias("tbl"), "event_type", "pos_key")


@query("stream_latest")
def q_stream_latest(spark, sf):
    src = S.envelope_stream(spark, *_stage_envelopes(spark, sf))
    out, ck = scratch_dir(spark, "latest"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.latest_state_sink(src, out, ck))
    return S.read_latest_state(spark, out)


@query("stream_latest_partial")
def q_stream_latest_partial(spark, sf):
    """A8 over MINIMAL images: the stream keeps each column's newest present value."""
    src = S.envelope_stream(spark, *_stage_envelopes(spark, sf, partial=True))
    out, ck = scratch_dir(spark, "latest-partial"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.update_sink(S.latest_state_partial_updates(src), out, ck))
    cur = S.read_updates(spark, out, list(S.LATEST_KEYS)).filter(F.col("last_op") != "delete")
    return cur.select("db", F.col("table").alias("tbl"), "id", "value", "props", "last_op", "n_changes")


@query("stream_progress")
def q_stream_progress(spark, sf):
    """P3 + P5: the progress rows a latest-state stream writes after its sink, read back
    as the newest saved position per source."""
    src = S.envelope_stream(spark, *_stage_envelopes(spark, sf))
    out, ck, prog = scratch_dir(spark, "latest"), scratch_dir(spark, "ckpt"), scratch_dir(spark, "progress")
    S.run_to_end(S.latest_state_sink(src, out, ck, progress=prog))
    return S.read_progress(spark, prog)


@query("stream_rate")
def q_stream_rate(spark, sf):
    """A7 on a stream: 10-minute change counts per db with a 10-minute watermark, input
    arriving in log order; update-mode batches read back per window."""
    src = S.envelope_stream(spark, *_stage_in_log_order(spark, sf))
    out, ck = scratch_dir(spark, "rates"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.update_sink(S.rate_stream(src, "10 minutes", delay="10 minutes"), out, ck))
    return S.read_updates(spark, out, ["window_start", "window_end", "db"])


# Event-time horizon of a resend: one log file of the derived feed spans at most a few days.
REPLAY_DELAY = "7 days"


@query("stream_dedup")
def q_stream_dedup(spark, sf):
    """P6 on a stream: every range's last log file is resent; copies inside the watermark
    are dropped by dropDuplicatesWithinWatermark, each change comes out once."""
    src = S.envelope_stream(spark, *_stage_in_log_order(spark, sf, replay_last_file=True))
    out, ck = scratch_dir(spark, "dedup"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.append_sink(S.dedup_stream(src, REPLAY_DELAY).drop("before", "after"), out, ck))
    return spark.read.parquet(out).select("log_file", "log_pos", "event_type")


SESSION_GAP_SECONDS, SESSION_DELAY_SECONDS = 30 * 60, 10 * 60


@query("stream_sessions")
def q_stream_sessions(spark, sf):
    """A7 sessions on a stream: 30-minute gap per table, 10-minute watermark, append mode
    (a session is emitted once, when the watermark passes its end; the closing heartbeat
    moves the watermark past the last sessions)."""
    stage, per = _stage_in_log_order(spark, sf, heartbeat_after=SESSION_GAP_SECONDS + SESSION_DELAY_SECONDS + 1)
    sessions = S.session_stream(S.envelope_stream(spark, stage, per), f"{SESSION_GAP_SECONDS} seconds",
                                delay=f"{SESSION_DELAY_SECONDS} seconds")
    out, ck = scratch_dir(spark, "sessions"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.append_sink(sessions, out, ck))
    return spark.read.parquet(out).select("db", F.col("table").alias("tbl"),
                                          F.unix_seconds("session_start").alias("session_start_s"),
                                          F.unix_seconds("session_end").alias("session_end_s"), "n_changes")


@query("ordered_delivery")
def q_ordered_delivery(spark, sf):
    """Per-key log order of everything an ordered stream delivered, across micro-batches
    (input arriving in log order, as a binlog does); the out-of-order count must be 0."""
    src = S.envelope_stream(spark, *_stage_in_log_order(spark, sf))
    out, ck = scratch_dir(spark, "ordered"), scratch_dir(spark, "ckpt")
    S.run_to_end(S.ordered_sink(src, out, ck))
    return S.delivery_order(out, spark, across_batches=True).select(
        "db", F.col("table").alias("tbl"), "id", "n_changes", "n_out_of_order")


# -- remaining subscription, lookup and publish operators ------------------------


@query("db_ignore")
def q_db_ignore(spark, sf):
    return filters.ignore_databases(feeds.changelog(spark, sf), ["audit"]).select(*FILTER_COLS)


@query("server_filter")
def q_server_filter(spark, sf):
    ev = filters.from_server(rawlog.decode_headers(raw_events(spark, sf)), 3)
    return ev.select("ordinal", "type_code", "server_id")


@query("known_tables")
def q_known_tables(spark, sf):
    cl = feeds.stored(feeds.changelog(spark, sf))
    ddl_tables = schema.ddl_changes(cl).select("db", "tbl")
    return schema.known_tables(cl, ddl_tables).select(*FILTER_COLS)


@query("attach_primary")
def q_attach_primary(spark, sf):
    cl = feeds.stored(feeds.changelog(spark, sf))
    keys = schema.primary_keys(schema.catalogue(cl, feeds.BASE_COLUMNS, feeds.added_key()))
    out = schema.attach_primary(cl.drop("primary", "primary_keys"), keys)
    return out.select("seq", "db", "tbl", F.col("primary_keys").alias("key_columns"),
                      F.col("primary").alias("key_primary"))


@query("publish_messages")
def q_publish_messages(spark, sf):
    msgs = to_messages(shape.envelope(feeds.changelog(spark, sf)))
    v = F.col("value")
    return msgs.select("key", F.get_json_object(v, "$.binlog").alias("binlog"),
                       F.get_json_object(v, "$.event_type").alias("event_type"),
                       F.get_json_object(v, "$.after.value").cast("double").alias("after_value"))


NAMED = ["orderkey", "partkey", "suppkey", "linenumber"]


@query("name_columns")
def q_name_columns(spark, sf):
    li = read_table(spark, sf, "lineitem")
    vals = F.array(*[F.col(c).cast("long") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    return li.select(shape.name_columns(vals, NAMED).alias("r")).select("r.*")


@query("decode_blob")
def q_decode_blob(spark, sf):
    cu = read_table(spark, sf, "customer").select("c_custkey", F.encode("c_name", "UTF-8").alias("raw"))
    return cu.select("c_custkey", D.blob_text("raw").alias("blob_b64"), F.length("raw").alias("n_bytes"))


# -- events of several changes, and messages that are none --------------------------


def _row_changes(ev):
    """Envelopes of multi-row events: one event per lineitem chunk, one change per image or image pair."""
    key = F.col("l_orderkey")
    image = F.transform("rows", lambda r: F.struct(r["l_partkey"].cast("long").alias("id"), r["l_extendedprice"].cast("double").alias("value"),
                                                   r["row_no"].cast("string").alias("props")))
    file = (key / ORDERS_PER_FILE).cast("int") + 1
    log_pos = (4 + (key % ORDERS_PER_FILE) * 1000 + F.col("chunk") * 10).cast("long")
    ev = ev.select(F.concat(F.lit("mysql-bin."), F.lpad(file.cast("string"), 6, "0")).alias("log_file"), log_pos.alias("log_pos"),
                   (file.cast("long") * POS_SHIFT + log_pos).alias("pos_key"), F.lit("shop").alias("db"), F.lit("li").alias("tbl"),
                   F.col("op").alias("event_type"), F.lit("").alias("query"), F.lit("id").alias("primary"),
                   F.timestamp_add("SECOND", F.lit(1_500_000_000) + (key / 100).cast("long"), epoch_ntz()).alias("ev_ts"), image.alias("rows"))
    return shape.envelope(shape.event_changes(ev))


ORDERS_PER_FILE = 20_000


@query("event_envelopes")
def q_event_envelopes(spark, sf):
    """R1-R3 -> R6: one envelope per image or image pair, numbered within its event."""
    return _row_changes(feeds.row_events(spark, sf)).select("binlog", "row_no", "event_type", F.col("before.id").alias("before_id"),
                                          F.col("before.props").alias("before_props"), F.col("after.id").alias("after_id"),
                                          F.col("after.props").alias("after_props"))


def _stage_row_changes(spark, sf, resend: bool) -> tuple[str, int]:
    """The multi-row changes as JSON messages; ``resend`` writes them all a second time.

    The events are dealt to the files before they become text, which is some twenty times the size of the
    table they come from and so is written compressed.  Such a file is read by one task: a trigger takes one
    per core.
    """
    ev = feeds.stored(feeds.row_events(spark, sf), "row-events")  # their shuffles go before those of the text come
    files = STAGE_BATCHES * spark.sparkContext.defaultParallelism
    stage = scratch_dir(spark, "stage-rows")
    for _ in range(2 if resend else 1):
        text = _row_changes(ev.repartition(files)).select(shape.envelope_text(with_row_no=True).alias("value"))
        text.write.mode("append").text(stage, compression="lz4")
    return stage, files // STAGE_BATCHES


@query("stream_dedup_rows")
def q_stream_dedup_rows(spark, sf):
    """P6 over events of several changes: everything is resent, every change comes out once."""
    out = scratch_dir(spark, "dedup-rows")
    with shuffles_released(spark):
        src = S.envelope_stream(spark, *_stage_row_changes(spark, sf, resend=True))
        S.run_to_end(L.landed_once_sink(src.drop("before", "after"), out, scratch_dir(spark, "ckpt"), bucket_bits=22))
    return L.read_landed(spark, out).select("binlog", "row_no", "event_type")


@query("stream_latest_rows")
def q_stream_latest_rows(spark, sf):
    """A8 where one event changes a key several times: the last change in the event wins."""
    out, ck = scratch_dir(spark, "latest-rows"), scratch_dir(spark, "ckpt")
    with shuffles_released(spark):
        src = S.envelope_stream(spark, *_stage_row_changes(spark, sf, resend=False))
        S.run_to_end(S.latest_state_sink(src, out, ck))
    return S.read_latest_state(spark, out).select("id", "value", "props", "last_op", "n_changes")


def _stage_torn(spark, sf) -> tuple[str, int]:
    """The feed as messages, of which every 97th change is torn in the middle and every 89th has no position."""
    files = max(STAGE_BATCHES, spark.sparkContext.defaultParallelism)
    cl = feeds.changelog(spark, sf)
    stage = scratch_dir(spark, "stage-torn")
    env = cl.select("seq", F.struct(F.when(F.col("seq") % 89 == 0, F.lit("mysql-bin")).otherwise(position_label("log_file", "log_pos")).alias("binlog")).alias("p"),
                    "db", F.col("tbl").alias("table"), "query", "event_type", "primary", "before", "after",
                    shape.event_seconds("ev_ts").alias("timestamp")).select("seq", "p.binlog", "db", "table", "query", "event_type", "primary",
                                                                            "before", "after", "timestamp")
    value = shape.envelope_text()
    torn = F.when(F.col("seq") % 97 == 0, value.substr(F.lit(1), F.length(value) - 20)).otherwise(value)
    env.select(torn.alias("value")).repartition(files).write.mode("overwrite").text(stage)
    return stage, max(1, files // STAGE_BATCHES)


def _published(spark, sf, sink: str = "callback", stage: tuple[str, int] | None = None) -> tuple[str, str, str]:
    """Folders of messages, dead letters and progress of a stream over the torn feed."""
    out, dead, prog = scratch_dir(spark, "published"), scratch_dir(spark, "dead"), scratch_dir(spark, "progress")

    def keep(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    src = S.message_stream(spark, *(stage or _stage_torn(spark, sf)))
    S.run_to_end(S.publish_sink(src, batch_writer(sink, out, callback=keep), dead, scratch_dir(spark, "ckpt"), prog))
    return out, dead, prog


@query("stream_publish_sinks")
def q_stream_publish_sinks(spark, sf):
    """K2 + K5: the same feed published by callback, as JSON and as text files; what each sink got."""
    stage = _stage_torn(spark, sf)
    got = {"callback": spark.read.parquet(_published(spark, sf, "callback", stage)[0]).select("value"),
           "json": spark.read.schema("key string, value string").json(_published(spark, sf, "json", stage)[0]).select("value"),
           "text": spark.read.schema("value string").text(_published(spark, sf, "text", stage)[0]).select("value")}
    rows = reduce(DataFrame.unionByName, [df.withColumn("sink", F.lit(n)) for n, df in got.items()])
    return rows.groupBy("sink", F.get_json_object("value", "$.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("n_messages"))


@query("stream_publish")
def q_stream_publish(spark, sf):
    """K1-K3: follow the log, publish every usable message once."""
    v = F.col("value")
    return spark.read.parquet(_published(spark, sf)[0]).select(
        "key", F.get_json_object(v, "$.binlog").alias("binlog"), F.get_json_object(v, "$.event_type").alias("event_type"),
        F.get_json_object(v, "$.after.value").cast("double").alias("after_value"))


@query("stream_dead_letters")
def q_stream_dead_letters(spark, sf):
    """K6: torn messages and messages without a position, each once, with the reason."""
    return spark.read.parquet(_published(spark, sf)[1]).groupBy("reason").agg(F.count("*").alias("n_messages"))


@query("stream_publish_progress")
def q_stream_publish_progress(spark, sf):
    """P5 beside a publishing stream: the newest published position, DDL events included."""
    return S.read_progress(spark, _published(spark, sf)[2])


# -- streams that start at a position, keep order, late rows and one copy -------------


def _stage_shuffled(spark, sf) -> tuple[str, int]:
    """The feed as messages that arrive out of order: step k holds the k-th tenth of the log, less
    every fifth change, which comes one or two steps late.  One write per step, in that order, of the
    same number of files each: (folder, files a step)."""
    cl = feeds.stored(feeds.changelog(spark, sf))
    last = cl.agg(F.max("seq")).first()[0] or 0
    seq = F.shiftright("pos_key", 32) * 1000 - 1000 + (F.col("pos_key").bitwiseAND(F.lit(POS_SHIFT - 1)) / 120).cast("long")
    step = (seq * SHUFFLED_STEPS / (last + 1)).cast("int") + F.when(seq % 5 == 0, 1 + seq % 2).otherwise(0)
    rows = feeds.stored(shape.envelope(cl).withColumn("step", step.cast("int")), "shuffled", by=["step"])
    sizes = {r["step"]: r["count"] for r in rows.groupBy("step").count().collect()}
    # a file that would be empty is not written, so no step may be too small for its files
    least = min(sizes.get(k, 0) for k in range(SHUFFLED_STEPS + 2))
    files = max(1, min(spark.sparkContext.defaultParallelism, least // ROWS_PER_MESSAGE_FILE))
    stage = scratch_dir(spark, "stage-shuffled")
    for k in range(SHUFFLED_STEPS + 2):
        rows.where(F.col("step") == k).repartition(files).select(shape.envelope_text().alias("value")).write.mode("append").text(stage)
    return stage, files


SHUFFLED_STEPS = 10
ROWS_PER_MESSAGE_FILE = 1000  # at least


@query("stream_from_position")
def q_stream_from_position(spark, sf):
    """S1 + S4 + P4: a stream that starts in the middle of the log, by an index of the message files."""
    stage, per_trigger = _stage_in_log_order(spark, sf)
    cl = feeds.changelog(spark, sf)
    index = L.index_messages(spark, stage, scratch_dir(spark, "index"))
    src = L.envelopes_after(spark, stage, index, positions.at_fraction(cl, *RESUME_AT), per_trigger)
    out = scratch_dir(spark, "from-position")
    S.run_to_end(S.append_sink(src.drop("before", "after"), out, scratch_dir(spark, "ckpt")))
    newest = F.lit(L.newest_label(index))
    return spark.read.schema(src.drop("before", "after").schema).parquet(out).select("binlog", "event_type", (F.col("binlog") == newest).alias("is_newest"))


@query("stream_reordered")
def q_stream_reordered(spark, sf):
    """Changes that arrive shuffled across micro-batches are delivered in log order, none lost."""
    out = scratch_dir(spark, "reordered")
    src = S.envelope_stream(spark, *_stage_shuffled(spark, sf))
    S.run_to_end(L.reordered_sink(src, out, scratch_dir(spark, "ckpt"), lag=3))
    L.flush_reordered(spark, out)
    return S.delivery_order(f"{out}/delivered", spark, across_batches=True).select("db", F.col("table").alias("tbl"), "id", "n_changes", "n_out_of_order")


@query("stream_rate_late")
def q_stream_rate_late(spark, sf):
    """Rates of a feed that arrives shuffled, the late rows beside them: together every change, once."""
    out = scratch_dir(spark, "rates")
    src = S.envelope_stream(spark, *_stage_shuffled(spark, sf))
    S.run_to_end(L.rate_sink(src, out, scratch_dir(spark, "ckpt"), "10 minutes", delay="0 seconds"))
    w = F.window("ts", "10 minutes")
    late = L.read_late(spark, out).groupBy(w["start"].alias("window_start"), w["end"].alias("window_end"), "db").agg(F.count(F.lit(1)).alias("n_changes"))
    both = L.read_rates(spark, out).unionByName(late).groupBy("window_start", "window_end", "db").agg(F.sum("n_changes").alias("n_changes"))
    return both


@query("decode_text_errors")
def q_decode_text_errors(spark, sf):
    """Customer names in several character sets, some with bytes that are no text there."""
    cu = read_table(spark, sf, "customer").select("c_custkey", F.encode("c_name", "UTF-8").alias("raw"))
    k = F.col("c_custkey")
    odd = F.when(k % 3 == 0, F.unhex(F.lit("FFFE"))).when(k % 3 == 1, F.unhex(F.lit("80"))).otherwise(F.col("raw"))
    cu = cu.select("c_custkey", odd.alias("raw"))
    return cu.select("c_custkey", D.text_value("raw", "utf8mb4").alias("utf8"), D.text_error("raw", "utf8mb4").alias("utf8_error"),
                     D.text_value("raw", "latin1").alias("latin1"), D.text_value("raw", "ascii").alias("ascii"),
                     D.text_error("raw", "koi9").alias("koi9_error"))


@query("decode_time2_fraction")
def q_decode_time2_fraction(spark, sf):
    """Signed TIME2 with three bytes of fraction, in microseconds."""
    k = F.col("o_orderkey")
    secs = k % 3_000_000
    whole = ((secs / 3600).cast("long") * 4096 + ((secs / 60).cast("long") % 60) * 64 + secs % 60) * 16777216 + (k * 7919) % 1000000
    stored = F.when(k % 2 == 0, -whole).otherwise(whole) + 8388608 * 16777216
    o = read_table(spark, sf, "orders").select("o_orderkey", F.shiftright(stored, 24).alias("x"), stored.bitwiseAND(F.lit(16777215)).alias("f"))
    iv = D.time2("x", "f")
    return o.select("o_orderkey", (D.interval_seconds(iv) * 1000000).cast("long").alias("time_us"))
