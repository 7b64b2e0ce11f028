"""Publishing change records (K1-K7).

* ``to_messages``: one (key, value) message per change -- key ``db.table:pk``,
  value the JSON envelope -- the shape every queue sink takes (K3).
* ``publish``: write messages to Kafka (K4, needs the Kafka package on the
  classpath; not present in this build environment), JSON / text files, or
  a user callback (K1, K5).
* ``write_change_table``: the columnar change table, partitioned by
  ``db, table, dt`` and sorted by position within files (K7).
* ``split_dead_letters``: rows a sink must not publish go to their own table
  instead of being logged and dropped (K6).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.shape import envelope_text


def to_messages(env: DataFrame, key_fields=("id",), with_row_no: bool = False) -> DataFrame:
    """K3: (key, value) messages from envelopes; key = ``db.table:key`` (empty key for queries)."""
    key = F.concat_ws(",", *[F.coalesce(F.col("after")[k], F.col("before")[k]).cast("string")
                             for k in key_fields])
    return env.select(F.concat(F.col("db"), F.lit("."), F.col("table"), F.lit(":"), key).alias("key"),
                      envelope_text(with_row_no=with_row_no).alias("value"))


def kafka_frame(messages: DataFrame) -> DataFrame:
    """K4: the (key, value) columns Spark's Kafka sink writes; records of one key go to one
    Kafka partition, so a consumer sees each record's changes in publish order."""
    return messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def publish(messages: DataFrame, fmt: str, path_or_topic: str, options: dict | None = None,
            callback: Callable[[DataFrame], None] | None = None) -> None:
    """K2: write a batch of messages with the chosen sink."""
    options = dict(options or {})
    if fmt == "kafka":
        kafka_frame(messages).write.format("kafka").option("topic", path_or_topic).options(**options).save()
    elif fmt == "json":
        messages.write.mode("append").options(**options).json(path_or_topic)
    elif fmt == "text":
        messages.select("value").write.mode("append").options(**options).text(path_or_topic)
    elif fmt == "callback":
        if callback is None:
            raise ValueError("callback sink needs a callback")
        callback(messages)
    else:
        raise ValueError(f"unknown sink format {fmt!r}")


def batch_writer(fmt: str, path_or_topic: str = "", options: dict | None = None,
                 callback: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """K2 + K5 under ``streaming.stream.publish_sink``: a writer for the chosen sink, safe to repeat.

    Files go to ``path/batch_id=N``, overwritten when a batch is handed over again; a callback gets the batch id
    to tell a repeat by; Kafka gets a repeated batch's messages twice, as its consumers expect.
    """
    if fmt == "callback":
        if callback is None:
            raise ValueError("callback sink needs a callback")
        return callback
    if fmt == "kafka":
        return lambda messages, batch_id: publish(messages, fmt, path_or_topic, options)
    if fmt not in ("json", "text"):
        raise ValueError(f"unknown sink format {fmt!r}")

    def write(messages: DataFrame, batch_id: int) -> None:
        rows = messages.select("value") if fmt == "text" else messages
        rows.write.mode("overwrite").options(**(options or {})).format(fmt).save(f"{path_or_topic}/batch_id={batch_id}")
    return write


# Log span one writer task takes of a (db, table, dt) folder: 2^26 bytes (64 MiB) of one log file.
FILE_BUCKET_BITS = 26


def write_change_table(env: DataFrame, path: str, mode: str = "append",
                       bucket_bits: int = FILE_BUCKET_BITS) -> None:
    """K7: columnar change table partitioned by db, table and event date, position-sorted files.

    The shuffle key is the folder plus a position bucket, not the folder
    alone: a table-day that holds a third of all changes is written by as
    many tasks as it has buckets instead of by one.  Each task sorts by
    (folder, position), which is also the order the partitioned writer needs,
    so files come out in log order with tight ``pos_key`` row-group ranges.
    """
    out = env.withColumn("dt", F.date_from_unix_date(F.floor(F.col("timestamp") / 86400).cast("int")))
    bucket = F.shiftright(F.col("pos_key"), bucket_bits)
    (out.repartition("db", "table", "dt", bucket)
        .sortWithinPartitions("db", "table", "dt", "pos_key", "row_no")
        .write.mode(mode).partitionBy("db", "table", "dt").parquet(path))


def write_routed(parsed: DataFrame, path: str, mode: str = "append") -> None:
    """Land parsed mixed-table envelopes (``variant`` images) once, one folder per db and table.

    Each table's typed reader then reads only its folder (partition pruning),
    so the feed is parsed once however many tables are routed.  No shuffle:
    every task writes its own rows to the folders they belong to, so a table
    holding a third of the feed is written by all tasks.  Malformed rows land
    in the null-partition folder.
    """
    parsed.write.mode(mode).partitionBy("db", "table").parquet(path)


def split_dead_letters(df: DataFrame, error_col: str = "decode_error") -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters) by an error column."""
    return df.filter(F.col(error_col).isNull()), df.filter(F.col(error_col).isNotNull())
