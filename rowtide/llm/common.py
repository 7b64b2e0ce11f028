"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Join hint for a side whose size Spark can't see: it takes an exploded array for one element and a compressed
#: file for its size, and a side it once meant to broadcast stays so, however large it turns out.
SHUFFLED = "merge"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a scratch folder only for local runs that leave it unset."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="rowtide-llm-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def ship() -> None:
    """Give the executors' Python workers this package (once for each Spark context)."""
    sc = SparkSession.active().sparkContext
    name = "rowtide-llm.zip"
    if any(os.path.basename(f) == name for f in sc._python_includes):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="rowtide-ship-"), name)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("rowtide/__init__.py", "")
        for f in sorted(os.listdir(here)):
            if f.endswith(".py"):
                z.write(os.path.join(here, f), f"rowtide/llm/{f}")
    sc.addPyFile(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """Two 64-bit hashes of the given columns: rows agree on it only if their values agree."""
    c = [F.col(x) for x in cols]
    return F.struct(F.xxhash64(*c).alias("a"), F.xxhash64(F.lit("second"), *c).alias("b"))
