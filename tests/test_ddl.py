"""DDL text: tokens, statements, what they do to tables, columns and keys."""

from pyspark.sql import functions as F

from rowtide.operators import ddl, schema


def run(spark, sqls, f):
    """``f`` of every statement, in one job."""
    df = spark.createDataFrame(list(enumerate(sqls)), "i int, q string")
    return [r.x for r in df.select("i", f("q").alias("x")).orderBy("i").collect()]


def acts(spark, sqls):
    return [[tuple(a) for a in x] for x in run(spark, sqls, lambda q: ddl.actions(ddl.marked(q)))]


COLUMNS = [
    ("ALTER TABLE t ADD c INT COMMENT 'x, DROP y'", [("add", "c", None, "int")]),
    ("ALTER TABLE t ADD c INT -- note, ADD d INT", [("add", "c", None, "int")]),
    ("ALTER TABLE t ADD c INT -- note\n, ADD d INT", [("add", "c", None, "int"), ("add", "d", None, "int")]),
    ("ALTER TABLE t ADD COLUMN IF NOT EXISTS c INT", [("add", "c", None, "int")]),
    ("ALTER TABLE `my table` ADD `a,b (c)` ENUM('it''s, so', \"(x)\", 'back\\'slash')", [("add", "a,b (c)", None, "enum('it''s, so','(x)','back''slash')")]),
    ("ALTER IGNORE TABLE t ADD c DOUBLE PRECISION UNSIGNED DEFAULT 1.5", [("add", "c", None, "double precision unsigned")]),
    ("ALTER ONLINE TABLE d.t DROP COLUMN IF EXISTS c", [("drop", "c", None, None)]),
    ("alter/* x */table t/**/add`c`int#end\n", [("add", "c", None, "int")]),
    ("/*!40101 ALTER TABLE t ADD c INT */", [("add", "c", None, "int")]),
    ("ALTER TABLE t ADD c DECIMAL(10 , 2) DEFAULT (1 + (2 * (3, 4))), DROP d", [("add", "c", None, "decimal(10,2)"), ("drop", "d", None, None)]),
    ("ALTER TABLE t ADD `drop` INT, ADD `key` INT, CHANGE `add` `x y` SET('a','b')",
     [("add", "drop", None, "int"), ("add", "key", None, "int"), ("change", "add", "x y", "set('a','b')")]),
    ("CREATE TEMPORARY TABLE IF NOT EXISTS d.t (id BIGINT NOT NULL, v VARCHAR(20) DEFAULT 'a)', KEY k (v)) ENGINE=InnoDB COMMENT='(c)'",
     [("add", "id", None, "bigint"), ("add", "v", None, "varchar(20)")]),
    ("CREATE TABLE t LIKE u", []), ("INSERT INTO t VALUES ('ALTER TABLE t ADD c INT')", []),
    ("ALTER TABLE t ADD c INT /* open", [("add", "c", None, "int")])]


def test_columns(spark):
    for (sql, want), got in zip(COLUMNS, acts(spark, [s for s, _ in COLUMNS])):
        assert [a[:4] for a in got if a[1]] == want, sql


def test_places(spark):
    sql = "ALTER TABLE t ADD c INT FIRST, MODIFY d INT AFTER `c d`, ADD e INT COMMENT 'AFTER x'"
    assert [a[4:6] for a in acts(spark, [sql])[0]] == [("first", None), ("after", "c d"), (None, None)]


KEYS = [
    ("ALTER TABLE t ADD PRIMARY KEY (a, `b c`), ADD UNIQUE INDEX u (x(10) DESC, y), ADD INDEX (z), DROP INDEX `old`, DROP PRIMARY KEY",
     [("add_key", "PRIMARY", "PRI", ["a", "b c"]), ("add_key", "u", "UNI", ["x", "y"]), ("add_key", "z", "MUL", ["z"]), ("drop_key", "old", "", None),
      ("drop_key", "PRIMARY", "PRI", None)]),
    ("ALTER TABLE t ADD CONSTRAINT k PRIMARY KEY USING BTREE (a), ADD CONSTRAINT UNIQUE KEY (b), ADD FOREIGN KEY (c) REFERENCES o (d)",
     [("add_key", "PRIMARY", "PRI", ["a"]), ("add_key", "b", "UNI", ["b"])]),
    ("CREATE TABLE t (id INT AUTO_INCREMENT PRIMARY KEY, code CHAR(3) UNIQUE KEY, n INT KEY, INDEX i (code))",
     [("add_key", "PRIMARY", "PRI", ["id"]), ("add_key", "code", "UNI", ["code"]), ("add_key", "PRIMARY", "PRI", ["n"]), ("add_key", "i", "MUL", ["code"])])]


def test_keys(spark):
    for (sql, want), got in zip(KEYS, acts(spark, [s for s, _ in KEYS])):
        assert [(a[0], *a[6:9]) for a in got if a[6]] == want, sql


MOVES = [
    ("RENAME TABLE a TO b, c TO d", [("rename", "", "a", "", "b"), ("rename", "", "c", "", "d")]),
    ("RENAME TABLE x.a TO `y`.`b c`", [("rename", "x", "a", "y", "b c")]),
    ("ALTER TABLE t RENAME TO u", [("rename", "", "t", "", "u")]), ("ALTER TABLE t ADD c INT, RENAME AS d.u", [("rename", "", "t", "d", "u")]),
    ("ALTER TABLE t RENAME u;", [("rename", "", "t", "", "u")]), ("ALTER TABLE t RENAME COLUMN a TO b, RENAME INDEX i TO j", [("change", "", "t", "", "")]),
    ("DROP TABLE IF EXISTS a, `b,c`, d.e CASCADE;", [("drop_if", "", "a", "", ""), ("drop_if", "", "b,c", "", ""), ("drop_if", "d", "e", "", "")]),
    ("DROP TABLE a", [("drop", "", "a", "", "")]),
    ("CREATE TABLE IF NOT EXISTS d.t (a INT)", [("create", "d", "t", "", "")]), ("CREATE OR REPLACE TABLE t (a INT)", [("create", "", "t", "", "")]),
    ("TRUNCATE TABLE t", [("change", "", "t", "", "")]), ("SELECT 1", []), (None, [])]


def test_tables(spark):
    for (sql, want), got in zip(MOVES, run(spark, [s for s, _ in MOVES], lambda q: ddl.table_moves(ddl.marked(q)))):
        assert [tuple(r) for r in got] == want, sql


def test_targets(spark):
    for sql, want in [("ALTER TABLE `my table` ADD c INT", ("ALTER", "", "my table")), ("rename table a to b, c to d", ("RENAME", "", "a")),
                      ("CREATE TEMPORARY TABLE x.y (a INT)", ("CREATE", "x", "y")), ("UPDATE t SET a = 1", ("", "", ""))]:
        assert tuple(run(spark, [sql], schema.ddl_target)[0]) == want
    assert [tuple(t) for t in run(spark, ["RENAME TABLE a TO b, c TO d"], schema.ddl_tables)[0]] == [("", "a"), ("", "b"), ("", "c"), ("", "d")]
    df = spark.createDataFrame([("query", "s", "x", "ALTER TABLE t RENAME TO u", 7, 0)],
                               "event_type string, db string, tbl string, query string, pos_key long, row_no int")
    assert sorted(r.tbl for r in schema.ddl_changes(df).select(F.col("tbl")).collect()) == ["t", "u"]
