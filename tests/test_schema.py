"""DDL statements: the tables they name and what they do to columns."""

import pytest
from pyspark.sql import functions as F

from rowtide.operators import schema


def run(spark, sql, f):
    return spark.createDataFrame([(sql,)], "q string").select(f("q").alias("x")).first()["x"]


@pytest.mark.parametrize("sql, want", [
    ("ALTER TABLE t ADD c INT", [("add", "c", None, "int")]),
    ("/* a */ -- b\n # c\n alter table `d`.`t` add column `c` decimal(10,2) unsigned not null, add index i (c)", [("add", "c", None, "decimal(10,2) unsigned")]),
    ("ALTER TABLE t ADD (x INT, y VARCHAR(3))", [("add", "x", None, "int"), ("add", "y", None, "varchar(3)")]),
    ("ALTER TABLE t ADD COLUMN a INT, ADD COLUMN b INT, DROP COLUMN c, DROP d", [("add", "a", None, "int"), ("add", "b", None, "int"),
                                                                                ("drop", "c", None, None), ("drop", "d", None, None)]),
    ("ALTER TABLE t ADD INDEX idx_x (c)", []), ("ALTER TABLE t ADD PRIMARY KEY (id)", []), ("ALTER TABLE t ADD UNIQUE KEY u (c)", []),
    ("ALTER TABLE t DROP PRIMARY KEY, DROP INDEX i, ADD CONSTRAINT k CHECK (a > 1)", []),
    ("ALTER TABLE t MODIFY a BIGINT, CHANGE b c TEXT, RENAME COLUMN d TO e", [("modify", "a", None, "bigint"), ("change", "b", "c", "text"),
                                                                              ("rename", "d", "e", None)]),
    ("DROP TABLE t", []), ("", []), (None, None)])
def test_column_clauses(spark, sql, want):
    got = run(spark, sql, schema.column_clauses)
    assert [tuple(x) for x in got or []] == (want or [])


@pytest.mark.parametrize("sql, want", [
    ("DROP TABLE a, b", [("", "a"), ("", "b")]), ("DROP TABLE IF EXISTS `x`.`a`, b CASCADE;", [("x", "a"), ("", "b")]),
    ("-- note\nALTER TABLE s.t ADD c INT, ADD d INT", [("s", "t")]), ("CREATE TABLE IF NOT EXISTS t (a INT, b INT)", [("", "t")]),
    ("INSERT INTO t VALUES (1)", [("", "")])])
def test_tables_of_a_statement(spark, sql, want):
    assert [tuple(x) for x in run(spark, sql, schema.ddl_tables)] == want


def test_versions_count_net_columns(spark):
    rows = [("query", "d", "t", "ALTER TABLE t ADD (a INT, b INT)", 10, 0), ("query", "d", "t", "ALTER TABLE t DROP COLUMN a, ADD KEY k (b)", 20, 0),
            ("query", "d", "x", "DROP TABLE t, u", 30, 0), ("insert", "d", "t", "", 40, 0)]
    df = spark.createDataFrame(rows, "event_type string, db string, tbl string, query string, pos_key long, row_no int")
    got = {(r.tbl, r.version): (r.valid_from, r.valid_to, r.n_columns) for r in schema.schema_versions(df, 3).collect()}
    assert got == {("t", 0): (0, 10, 3), ("t", 1): (10, 20, 5), ("t", 2): (20, 30, 4), ("t", 3): (30, None, 4), ("x", 0): (0, None, 3), ("u", 1): (30, None, 3)}
    assert schema.ddl_changes(df).where(F.col("pos_key") == 30).count() == 2
