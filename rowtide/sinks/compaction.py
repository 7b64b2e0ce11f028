"""K7 on a stream: a change table that stays in few files.

``table/data/part=b<batch>/db=/table=/dt=`` holds what each micro-batch landed, and
``table/data/part=v<version>/..`` the files that compaction ``version`` wrote.  ``table/manifest/version=N`` is one
small file, so it appears in one step: the files that make up the table, and the last batch
they cover.  Readers take the newest manifest's files and the batches after it: every row once, before,
while and after a compaction runs.  Nothing is deleted here; files that no manifest in use names may be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import lookup_join
from ..operators.ordered import keyed_window, shift_bucket
from .publish import FILE_BUCKET_BITS

FOLDER = ["db", "table", "dt"]
MANIFEST = "db string, table string, dt date, file string, size long, first long, covers int"


def land_batches(env_stream: DataFrame, table: str, checkpoint: str, available_now: bool = True, processing_time: str = "1 second"):
    """Land each micro-batch as a part of its own, overwritten when the batch is handed over again."""
    out = env_stream.withColumn("dt", F.date_from_unix_date(F.floor(F.col("timestamp") / 86400).cast("int")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*FOLDER).parquet(f"{table}/data/{_batch(batch_id)}")

    w = out.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()


def _batch(n: int) -> str:
    return f"part=b{n:012d}"


def read_change_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The table as it is: ``schema`` is that of the landed envelopes with ``dt``."""
    files, covers = _newest(spark, table)[1:]
    rest = _all(spark, table, schema).where(F.col("part").startswith("b") & (F.col("part") > _batch(covers).split("=")[1]))
    return (_of_files(spark, table, schema, files).unionByName(rest) if files else rest).drop("part")


def _all(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    return spark.read.schema(_with_part(schema)).parquet(f"{table}/data")


def _of_files(spark: SparkSession, table: str, schema: StructType, files: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{table}/data").schema(_with_part(schema)).parquet(*files)


def _with_part(schema: StructType) -> StructType:
    from pyspark.sql.types import StringType
    inner = [f for f in schema if f.name not in FOLDER]
    return StructType([*inner, *StructType().add("part", StringType()), *[schema[c] for c in FOLDER]])


def _newest(spark: SparkSession, table: str) -> tuple[int, list[str], int]:
    """(version, files, last covered batch) of the newest manifest; (0, [], -1) before the first."""
    try:
        m = spark.read.schema(MANIFEST + ", version int").parquet(f"{table}/manifest")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0, [], -1
    version = m.agg(F.max("version")).first()[0]
    if version is None:
        return 0, [], -1
    rows = m.where(F.col("version") == version).select("file", "covers").collect()  # file names, which a reader lists anyway
    return version, [r["file"] for r in rows if r["file"] is not None], max(r["covers"] for r in rows)


def _files(df: DataFrame) -> DataFrame:
    """(folder, file, size, first): the files of a read, with their first position."""
    return (df.select(*FOLDER, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), "pos_key")
            .groupBy(*FOLDER, "file", "size").agg(F.min("pos_key").alias("first")))


def compact(spark: SparkSession, table: str, schema: StructType, target_bytes: int = 128 << 20) -> int:
    """Pack small files into files of about ``target_bytes``; returns the new version.

    The files of the newest manifest and of the batches after it that are smaller than the target are
    dealt to bins, folder by folder in log order, by the running sum of their sizes; each bin of two
    files or more becomes one file sorted by position, written by one task.  Large files and files alone in
    their bin stay as they are.  A run that failed left no manifest; the next one overwrites its part.
    """
    version, known, covers = _newest(spark, table)
    done = F.col("part") > _batch(covers).split("=")[1]
    batches = _all(spark, table, schema).where(F.col("part").startswith("b") & done)
    last = batches.agg(F.max("part")).first()[0]
    newest = int(last[1:]) if last else covers
    batches = batches.where(F.col("part") <= _batch(newest).split("=")[1])  # batches that land meanwhile wait for the next run
    live = _files(batches)
    if known:
        live = live.unionByName(_files(_of_files(spark, table, schema, known)))
    plan = f"{table}/plan/version={version + 1}"
    live.write.mode("overwrite").parquet(plan)
    live = spark.read.schema(live.schema).parquet(plan)
    small = keyed_window(live.where(F.col("size") < target_bytes), FOLDER, ["first", "file"], shift_bucket("first", FILE_BUCKET_BITS), sums=["size"])
    small = small.withColumn("bin", (F.col("sum_size") / target_bytes).cast("long"))
    several = small.groupBy(*FOLDER, "bin").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    bins = small.join(several, [*FOLDER, "bin"]).select("file", "bin")
    names = [r["file"] for r in bins.select("file").collect()]
    part = f"part=v{version + 1:012d}"
    stay = live
    if names:
        rows = _of_files(spark, table, schema, names).select("*", F.col("_metadata.file_path").alias("file"))
        rows = lookup_join(rows, bins, ["file"], "inner")
        (rows.repartition(*FOLDER, "bin").sortWithinPartitions(*FOLDER, "bin", "pos_key", "row_no").drop("file", "bin", "part")
             .write.mode("overwrite").partitionBy(*FOLDER).parquet(f"{table}/data/{part}"))
        stay = live.join(bins.select("file"), "file", "left_anti").unionByName(_files(_all(spark, table, schema).where(F.col("part") == part.split("=")[1])))
    manifest = stay.select(*FOLDER, "file", "size", "first", F.lit(newest).alias("covers"))
    nothing = spark.createDataFrame([(None,) * 6 + (newest,)], MANIFEST)  # says what is covered even when no file is
    manifest.unionByName(nothing).coalesce(1).write.mode("overwrite").parquet(f"{table}/manifest/version={version + 1}")
    return version + 1
