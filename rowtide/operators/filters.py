"""Subscription filters.

Short literal lists become ``IN`` predicates (pushed into the scan when the
column is stored).  Table lists are (db, table) pairs and go through a
semi / anti join whose list side is broadcast only after its size is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import list_frame, lookup_join

# Literal lists up to this length stay an IN predicate; longer ones are joined.
MAX_IN_LIST = 1000


def subscribe(df: DataFrame, event_types: Sequence[str]) -> DataFrame:
    """keep the subscribed operations (insert / update / delete / query / codes)."""
    return df.filter(F.col("event_type").isin(list(event_types)))


def _values_filter(df: DataFrame, col: str, values, keep: bool) -> DataFrame:
    if isinstance(values, DataFrame):
        return lookup_join(df, values.select(F.col(values.columns[0]).alias(col)).distinct(), [col],
                           "left_semi" if keep else "left_anti")
    values = list(values)
    if len(values) <= MAX_IN_LIST:
        p = F.col(col).isin(values)
        return df.filter(p if keep else (~p | F.col(col).isNull()))
    frame = list_frame(df.sparkSession, [(v,) for v in values], [col])
    return lookup_join(df, frame, [col], "left_semi" if keep else "left_anti")


def allow_databases(df: DataFrame, dbs) -> DataFrame:
    """only these databases; an empty list means all."""
    if not isinstance(dbs, DataFrame) and not list(dbs):
        return df
    return _values_filter(df, "db", dbs, keep=True)


def ignore_databases(df: DataFrame, dbs) -> DataFrame:
    """drop these databases."""
    if not isinstance(dbs, DataFrame) and not list(dbs):
        return df
    return _values_filter(df, "db", dbs, keep=False)


def _tables(df: DataFrame, tables) -> DataFrame:
    if isinstance(tables, DataFrame):
        return tables.select(F.col(tables.columns[0]).alias("db"), F.col(tables.columns[1]).alias("tbl"))
    return list_frame(df.sparkSession, [tuple(t) for t in tables], ["db", "tbl"])


def include_tables(df: DataFrame, tables) -> DataFrame:
    """only these (db, table) pairs; an empty list means all."""
    if not isinstance(tables, DataFrame) and not list(tables):
        return df
    return lookup_join(df, _tables(df, tables).distinct(), ["db", "tbl"], "left_semi")


def exclude_tables(df: DataFrame, tables) -> DataFrame:
    """drop these (db, table) pairs."""
    if not isinstance(tables, DataFrame) and not list(tables):
        return df
    return lookup_join(df, _tables(df, tables).distinct(), ["db", "tbl"], "left_anti")


def from_server(df: DataFrame, server_id: int) -> DataFrame:
    """events written by one server."""
    return df.filter(F.col("server_id") == server_id)
