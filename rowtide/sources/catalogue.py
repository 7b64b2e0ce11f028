"""Column catalogue of a live server (S5) as a SCHEMA_HISTORY snapshot.

``spark.read.jdbc`` runs one ``information_schema.columns`` query (pushed to
the server) and returns the catalogue rows valid from a given log position.
Appending snapshots taken at DDL positions builds the schema history that
``operators.schema.schema_asof`` joins against.  Needs a JDBC driver on the
classpath; not exercised in this repository's tests (no server is started).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE_SQL = """(SELECT TABLE_SCHEMA, TABLE_NAME, ORDINAL_POSITION, COLUMN_NAME, COLUMN_KEY, COLUMN_TYPE,
                           CHARACTER_SET_NAME, COLLATION_NAME, NUMERIC_SCALE, EXTRA
                    FROM information_schema.columns {where}) AS catalogue"""


def read_catalogue(spark: SparkSession, url: str, properties: dict, valid_from: int,
                   databases: list[str] | None = None) -> DataFrame:
    where = ""
    if databases:
        quoted = ", ".join("'" + d.replace("'", "''") + "'" for d in databases)
        where = f"WHERE TABLE_SCHEMA IN ({quoted})"
    raw = spark.read.jdbc(url, CATALOGUE_SQL.format(where=where), properties=properties)
    return raw.select(F.col("TABLE_SCHEMA").alias("db"), F.col("TABLE_NAME").alias("tbl"),
                      F.col("ORDINAL_POSITION").cast("int").alias("ordinal"),
                      F.col("COLUMN_NAME").alias("column_name"), F.col("COLUMN_KEY").alias("column_key"),
                      F.col("COLUMN_TYPE").alias("column_type"), F.col("CHARACTER_SET_NAME").alias("charset"),
                      F.col("COLLATION_NAME").alias("collation"),
                      F.col("NUMERIC_SCALE").cast("string").alias("numeric_scale"),
                      F.col("EXTRA").alias("extra"), F.lit(valid_from).cast("long").alias("valid_from"),
                      F.lit(None).cast("long").alias("valid_to"))
