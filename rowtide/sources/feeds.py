"""Change feeds derived from the staged tables.

The staged tables are not change logs, so the test feeds are derived from them
with DataFrame operations (the same rules as the portable SQL in FIXTURES.md).
Every feed grows with its input table; none is a fixed small sample.

* ``changelog``  -- one change per ``events`` row, record key ``user_id``;
                    ``before`` is the key's previous event values.
* ``row_images`` -- long form: one image per ``lineitem`` row, numbered from 0
                    within its order (the order is one multi-row event).
* ``row_events`` -- the array form a binlog delivers: images grouped into
                    events of at most ``ROWS_PER_EVENT`` images, the way the
                    server splits a statement into size-capped row events.
* ``packed``     -- ``orders.o_orderdate`` packed as DATETIME2 and DATE cells.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import DIGIT_BYTES
from ..functions.header import le_hex
from ..functions.position import pos_key
from ..operators.ordered import keyed_window, shift_bucket
from .tables import read_table

# Window bucket for per-user neighbours: 2^20 consecutive event ids.
EVENT_BUCKET_BITS = 20
# Window bucket for image numbering inside one multi-row event: 2^16 part keys.
PARTKEY_BUCKET_BITS = 16
# Images per row event (even, so update pairs never straddle two events).
ROWS_PER_EVENT = 8
# Columns every derived table starts with (name, type, key, extra), ordinal 1..n.
BASE_COLUMNS = [("id", "bigint", "PRI", "auto_increment"), ("value", "double", "", ""),
                ("props", "varchar(64)", "", "")]


def added_key() -> Column:
    """Key kind of a column that the derived log adds: some tables get composite keys."""
    return F.when(F.col("seq") % 1000 == 0, "PRI").otherwise("")




def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENVELOPE rows of the derived change feed (one row per event)."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    ev = keyed_window(ev, ["user_id"], ["event_id"], shift_bucket("event_id", EVENT_BUCKET_BITS),
                      lag=["value", "props"])
    op = (F.when(F.col("event_id") % 250 == 0, "query")
          .when(F.col("event_type") == "signup", "insert")
          .when(F.col("event_type") == "error", "delete")
          .otherwise("update"))
    ev = ev.withColumn("event_type", op)
    et = F.col("event_type")
    fno = (F.floor(F.col("event_id") / 1000) + 1).cast("int")
    tno = (F.col("user_id") % 4).cast("string")
    has_before = et.isin("update", "delete")
    has_after = et.isin("insert", "update")
    return ev.select(
        F.concat(F.lit("mysql-bin."), F.lpad(fno.cast("string"), 6, "0")).alias("log_file"),
        fno.alias("file_no"),
        (F.lit(4) + (F.col("event_id") % 1000) * 120).cast("long").alias("log_pos"),
        F.lit(0).alias("row_no"),
        pos_key(fno, F.lit(4) + (F.col("event_id") % 1000) * 120).alias("pos_key"),
        F.when(F.col("user_id") % 2 == 0, "app").otherwise("audit").alias("db"),
        F.concat(F.lit("t"), tno).alias("tbl"),
        et.alias("event_type"),
        F.when(et == "query", _ddl(tno, F.col("event_id").cast("string"))).otherwise(F.lit("")).alias("query"),
        F.when(et == "query", F.lit("")).otherwise(F.lit("id")).alias("primary"),
        F.when(et == "query", F.array().cast("array<string>")).otherwise(F.array(F.lit("id")))
         .alias("primary_keys"),
        F.when(has_before, F.struct(F.col("user_id").alias("id"), F.col("prev_value").alias("value"),
                                    F.col("prev_props").alias("props"))).alias("before"),
        F.when(has_after, F.struct(F.col("user_id").alias("id"), F.col("value").alias("value"),
                                   F.col("props").alias("props"))).alias("after"),
        F.col("ts").alias("ev_ts"),
        F.col("event_id").alias("seq"),
    )


def _ddl(tno: Column, n: Column) -> Column:
    """The DDL of the feed, five kinds in turn: a column; a column and an index after a comment;
    two columns in a list; another type; a key.  They add 1, 1, 2, 0 and 0 columns."""
    table = F.concat(F.lit("ALTER TABLE `t"), tno, F.lit("` "))
    col = F.concat(F.lit("`c"), n, F.lit("` INT"))
    kinds = [F.concat(table, F.lit("ADD "), col),
             F.concat(F.lit("/* note */ "), table, F.lit("ADD COLUMN "), col, F.lit(", ADD INDEX `i"), n, F.lit("` (`id`)")),
             F.concat(table, F.lit("ADD ("), col, F.lit(", `d"), n, F.lit("` DECIMAL(10,2))")),
             F.concat(table, F.lit("MODIFY `props` TEXT")),
             F.concat(table, F.lit("ADD UNIQUE KEY `u"), n, F.lit("` (`value`)"))]
    return F.element_at(F.array(*kinds), ((F.col("event_id") / 250).cast("long") % len(kinds) + 1).cast("int"))


# Every so many events of the evolving log, one is a DDL statement.
DDL_EVERY = 50


def evolving_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log whose tables change shape and name: four tables, statements in cycles of twelve.

    A cycle adds, places, retypes, renames and drops columns, adds and drops keys, renames the
    table and back; every third cycle ends with a DROP and the next begins with a CREATE
    (no changes lie between).
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    is_ddl = F.col("event_id") % DDL_EVERY == DDL_EVERY // 2
    ev = ev.select("*", (F.col("user_id") % 4).alias("g"), is_ddl.cast("int").alias("is_ddl"))
    # j: statements of the table up to and with the row
    ev = keyed_window(ev, ["g"], ["event_id"], shift_bucket("event_id", EVENT_BUCKET_BITS), sums=["is_ddl"])
    j, ddl = F.col("sum_is_ddl").cast("long"), F.col("is_ddl") == 1
    step = F.when(ddl, (j - 1) % 12).otherwise(j % 12)
    home = F.concat(F.lit("t"), F.col("g").cast("string"))
    away = F.concat(home, F.lit("r"))
    fno = (F.floor(F.col("event_id") / 1000) + 1).cast("int")
    log = ev.where(ddl | (j == 0) | (j % 36 != 0))
    return log.select(
        pos_key(fno, F.lit(4) + (F.col("event_id") % 1000) * 120).alias("pos_key"), F.lit(0).alias("row_no"),
        F.when(F.col("user_id") % 2 == 0, "app").otherwise("audit").alias("db"), F.when(step.isin(10, 11), away).otherwise(home).alias("tbl"),
        F.when(ddl, "query").when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update").alias("event_type"),
        F.when(ddl, _evolution(j - 1, home, away)).otherwise(F.lit("")).alias("query"), F.col("event_id").alias("seq"))


# FIXED VALUES: the statements of a cycle, then the CREATE and the DROP between lives of a table.
EVOLUTION = [
    "ALTER TABLE `{t}` ADD COLUMN `a{c}` INT UNSIGNED NOT NULL COMMENT 'x, DROP `y`' AFTER `id`",
    "alter table {t} add `b{c}` ENUM('new','it''s, so') first, ADD INDEX `i{c}` (`value`)",
    "/* two, ADD x INT */ ALTER TABLE `{t}` ADD (`c{c}` VARCHAR(20), `d{c}` DECIMAL(10,2) DEFAULT '1,5')",
    "ALTER TABLE `{t}` MODIFY `b{c}` ENUM('new','it''s, so','done')",
    "ALTER TABLE `{t}` CHANGE COLUMN `c{c}` `cc{c}` VARCHAR(40) NULL AFTER `b{c}`",
    "ALTER TABLE `{t}` RENAME COLUMN `d{c}` TO `dd{c}`",
    "ALTER TABLE `{t}` DROP COLUMN `a{c}`, ADD `e{c}` BIGINT UNSIGNED AFTER `cc{c}` -- later, ADD `z` INT",
    "ALTER TABLE `{t}` MODIFY COLUMN `dd{c}` DECIMAL(12,4) FIRST",
    "ALTER TABLE `{t}` ADD UNIQUE KEY `u{c}` (`e{c}`)",
    "RENAME TABLE `{t}` TO `{t}_tmp`, `{t}_tmp` TO `{r}`",
    "ALTER TABLE `{r}` DROP `dd{c}`, DROP INDEX `i{c}`, ALTER `value` SET DEFAULT 0",
    "ALTER TABLE `{r}` RENAME TO `{t}`",
    "CREATE TABLE IF NOT EXISTS `{t}` (`id` BIGINT NOT NULL AUTO_INCREMENT, `a{c}` INT UNSIGNED COMMENT 'a, b', `value` DOUBLE, "
    "`props` VARCHAR(64), PRIMARY KEY (`id`)) ENGINE=InnoDB",
    "DROP TABLE IF EXISTS `other{c}`, `{r}`"]


def _evolution(k: Column, home: Column, away: Column) -> Column:
    """Statement ``k`` (from 0) of a table; {c} is its cycle, {t} and {r} the table's two names."""
    fill = {"{c}": (k / 12).cast("long").cast("string"), "{t}": home, "{r}": away}

    def sql(template: str) -> Column:
        return F.concat(*[fill.get(p, F.lit(p)) for p in re.split(r"(\{[ctr]\})", template)])

    steps = [sql(t) for t in EVOLUTION]
    usual = F.element_at(F.array(*steps[:12]), (k % 12 + 1).cast("int"))
    return F.when((k > 0) & (k % 36 == 0), steps[12]).when(k % 36 == 35, steps[13]).otherwise(usual)


def partial_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog as a log of MINIMAL row images, with ``after_present``: a bigint
    mask over the after-image's fields in order (bit 0 ``id``, bit 1 ``value``, bit 2
    ``props``).  Inserts carry every column; an update whose ``seq`` is a multiple of 3
    leaves ``props`` out, one whose ``seq`` is a multiple of 5 leaves ``value`` out (an
    absent column is null *and* unmarked); deletes have no after-image (mask 0)."""
    cl = changelog(spark, sf_dir)
    et, seq = F.col("event_type"), F.col("seq")
    drop_props = (et == "update") & (seq % 3 == 0)
    drop_value = (et == "update") & (seq % 5 == 0)
    mask = F.when(et.isin("insert", "update"),
                  F.lit(7) - F.when(drop_props, 4).otherwise(0) - F.when(drop_value, 2).otherwise(0)).otherwise(0)
    after = F.when(F.col("after").isNotNull(), F.struct(
        F.col("after.id").alias("id"), F.when(~drop_value, F.col("after.value")).alias("value"),
        F.when(~drop_props, F.col("after.props")).alias("props")))
    return cl.withColumn("after", after).withColumn("after_present", mask.cast("long"))


def row_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form: (l_orderkey, op, row_no, l_partkey, l_quantity, l_extendedprice)."""
    li = read_table(spark, sf_dir, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
    # Bucket on a monotone prefix of the order, so a huge multi-row event still
    # spreads over many window partitions: 2^16 part keys per line number, which
    # keeps a hot event's buckets and its bucket summary both near sqrt(rows).
    numbered = keyed_window(li, ["l_orderkey"], order,
                            [F.col("l_linenumber"), shift_bucket("l_partkey", PARTKEY_BUCKET_BITS)], seq="__seq")
    op = (F.when(F.col("l_orderkey") % 3 == 0, "insert")
          .when(F.col("l_orderkey") % 3 == 1, "update").otherwise("delete"))
    return numbered.select("l_orderkey", op.alias("op"), (F.col("__seq") - 1).cast("long").alias("row_no"),
                           "l_partkey", "l_quantity", "l_extendedprice")


def row_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array form: one row event per (order, chunk) with ``rows`` in log order.

    ``collect_list`` is bounded: a chunk never holds more than ROWS_PER_EVENT
    images, just as a server caps the size of one row event.
    """
    ri = row_images(spark, sf_dir)
    img = F.struct(F.col("row_no"), F.col("l_partkey"), F.col("l_quantity"), F.col("l_extendedprice"))
    return (ri.groupBy("l_orderkey", "op", (F.col("row_no") / ROWS_PER_EVENT).cast("long").alias("chunk"))
              .agg(F.array_sort(F.collect_list(img)).alias("rows")))


SHOP_FILE = "shop-bin.000001"
# Every lineitem with this line number is published garbled: a stray byte ahead of the
# whole message (the tail of an interrupted write), so it is not JSON.
GARBLED_LINE = 7


def shop_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second table on the same queue: each ``lineitem`` row as an insert envelope
    of ``shop.lineitem`` (key ``l_orderkey``), JSON text in ``value``; lines numbered
    GARBLED_LINE carry a stray byte in front of the whole message."""
    from ..operators.shape import envelope_text, event_seconds
    li = read_table(spark, sf_dir, "lineitem")
    env = li.select(
        F.concat(F.lit(SHOP_FILE + ":"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"))
         .alias("binlog"),
        F.lit("shop").alias("db"), F.lit("lineitem").alias("table"), F.lit("").alias("query"),
        F.lit("insert").alias("event_type"), F.lit("l_orderkey").alias("primary"),
        F.lit(None).cast("struct<l_orderkey:bigint,l_linenumber:int,l_partkey:bigint,l_quantity:double>")
         .alias("before"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("after"),
        event_seconds("l_shipdate").alias("timestamp"), "l_linenumber")
    text = env.select(envelope_text().alias("t"), "l_linenumber")
    garbled = F.concat(F.lit("#"), F.col("t"))
    return text.select(F.when(F.col("l_linenumber") == GARBLED_LINE, garbled).otherwise(F.col("t")).alias("value"))


def growing_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shop.lineitem`` as JSON envelopes whose images change in mid-feed: the later half of the orders has
    quantities with a fraction and a field ``l_tax`` more."""
    from ..operators.shape import envelope_text, event_seconds
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_shipdate")
    half = (li.agg(F.max("l_orderkey")).first()[0] or 0) / 2

    def text(rows: DataFrame, *fields) -> DataFrame:
        return rows.select(
            F.concat(F.lit(SHOP_FILE + ":"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string")).alias("binlog"),
            F.lit("shop").alias("db"), F.lit("lineitem").alias("table"), F.lit("").alias("query"), F.lit("insert").alias("event_type"),
            F.lit("l_orderkey").alias("primary"), F.lit(None).cast("struct<l_orderkey:bigint>").alias("before"),
            F.struct("l_orderkey", "l_linenumber", *fields).alias("after"), event_seconds("l_shipdate").alias("timestamp")).select(envelope_text().alias("value"))

    early = text(li.where(F.col("l_orderkey") <= half), F.col("l_quantity").cast("long").alias("l_quantity"))
    late = text(li.where(F.col("l_orderkey") > half), (F.col("l_quantity") + 0.25).alias("l_quantity"), "l_tax")
    return early.unionByName(late)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, dt2, d3, o_orderdate): DATETIME2 (40-bit) and DATE (24-bit) cells."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    d = F.col("o_orderdate")
    y, m, dd = [F.extract(F.lit(p), d).cast("long") for p in ("YEAR", "MONTH", "DAY")]
    h, mi = [F.extract(F.lit(p), d).cast("long") for p in ("HOUR", "MINUTE")]
    se = F.floor(F.extract(F.lit("SECOND"), d)).cast("long")
    dt2 = (F.lit(549755813888).bitwiseOR(F.shiftleft(y * 13 + m, 22)).bitwiseOR(F.shiftleft(dd, 17))
           .bitwiseOR(F.shiftleft(h, 12)).bitwiseOR(F.shiftleft(mi, 6)).bitwiseOR(se))
    d3 = F.shiftleft(y, 9).bitwiseOR(F.shiftleft(m, 5)).bitwiseOR(dd)
    return o.select("o_orderkey", dt2.alias("dt2"), d3.alias("d3"), "o_orderdate")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored cells of a wide MySQL row, derived per ``orders`` row.

    Each column holds what a row image stores for one MySQL type; the values
    are functions of the order, so every decoder can be checked against a value
    computed independently from the same order.
    """
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    secs = (k * 7919) % 3020400
    hh, mm, ss = (secs / 3600).cast("long"), (secs / 60).cast("long") % 60, secs % 60
    neg = k % 5 == 0
    sign = F.when(neg, F.lit(-1)).otherwise(F.lit(1))
    y, mo, dd = [F.extract(F.lit(p), d).cast("long") for p in ("YEAR", "MONTH", "DAY")]
    h, mi = [F.extract(F.lit(p), d).cast("long") for p in ("HOUR", "MINUTE")]
    se = F.floor(F.extract(F.lit("SECOND"), d)).cast("long")
    dt_int = y * 10000000000 + mo * 100000000 + dd * 1000000 + h * 10000 + mi * 100 + se
    return o.select(
        k.alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        (-((k % 128) + 1)).alias("s_tiny"),
        (-((k % 32768) + 1)).alias("s_small"),
        (-((k % 8388608) + 1)).alias("s_medium"),
        ((k * 40503) % 16777216).alias("raw24"),
        (-((k % 2147483648) + 1)).alias("s_int"),
        (-k).alias("s_bigint"),
        (k % 3).alias("tiny1"),
        (k % 256).alias("year_byte"),
        F.concat((F.col("o_custkey") % 100000).cast("string"), F.lit("."),
                 F.lpad((k % 100).cast("string"), 2, "0")).alias("dec_text"),
        (sign * (hh * 10000 + mm * 100 + ss)).alias("time_int"),
        (F.lit(8388608) + sign * (F.shiftleft(hh, 12) + F.shiftleft(mm, 6) + ss)).alias("time2_raw"),
        (F.lit(1500000000) + k * 37).alias("ts_secs"),
        F.when(k % 50 == 0, F.lit(0).cast("long")).otherwise(dt_int).alias("dt_int"),
        F.when(k % 97 == 0, F.lit(0))
         .otherwise(F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
                    .when(F.col("o_orderstatus") == "P", 3)).alias("enum_idx"),
        (k % 8).alias("set_mask"),
        F.unhex(F.lpad(F.hex(k), 16, "0")).alias("bit_bytes"),
    )


# FIXED VALUES: catalogue type texts, key kinds and field type codes cycled over orders.
FLAG_TYPES = ["tinyint(1)", "int(10) unsigned", "bigint", "tinyint(4)", "int", "bigint(20) unsigned"]
KEY_KINDS = ["PRI", "", "UNI", "MUL"]
TYPE_CODES = [1, 2, 3, 8, 9, 10, 0, 245, 255, 19, 18, 247, 248, 100]


def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue cells per ``orders`` row: an ENUM/SET type text whose labels
    carry commas, quotes and brackets, a type text with flags, a key kind, an
    EXTRA text and a field type code."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kind = F.when(k % 2 == 0, F.lit("enum")).otherwise(F.lit("set"))
    ctype = F.concat(kind, F.lit("('"), F.col("o_orderstatus"), F.lit(","), F.col("o_orderpriority"),
                     F.lit("','it''s "), (F.col("o_custkey") % 10).cast("string"), F.lit(")')"))

    def pick(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))
    return o.select(k.alias("o_orderkey"), ctype.alias("column_type"), pick(FLAG_TYPES).alias("flag_type"),
                    pick(KEY_KINDS).alias("column_key"),
                    F.when(k % 5 == 0, F.lit("auto_increment")).otherwise(F.lit("")).alias("extra"),
                    pick(TYPE_CODES).alias("type_code"))


def stored(df: DataFrame, name: str = "feed", by: Sequence[str] = ()) -> DataFrame:
    """Land a derived feed once, as a change table would be landed.

    A feed read twice in one plan (a keyed window's summary branch, a self
    join, a union with its own replay) would otherwise be derived twice,
    shuffles included.  Writing it as Parquet under the shared folder named by
    ``spark.checkpoint.dir`` cuts the lineage (an executor loss re-reads files
    instead of re-deriving) and keeps column pruning and filter pushdown for
    every reader, which ``DataFrame.checkpoint()`` would not.  ``by``: integer columns
    of few values whose folders readers prune.
    """
    from ..session import scratch_dir
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return spark.read.parquet(path)


def stored_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, p, s, raw): a stored DECIMAL per ``orders`` row, every precision to 65 and scale to 30 in turn.

    The digits are the last ``p`` of the order key times 40503, doubled up with its reverse; every third is negative.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    p = (k % 65 + 1).cast("int")
    s = F.least((k / 65).cast("int") % 31, p).cast("int")
    text = (k * 40503).cast("string")
    digits = F.lpad(F.right(F.concat(text, F.reverse(text), text), p), p, F.lit("0"))
    o = o.select("o_orderkey", p.alias("p"), s.alias("s"), digits.alias("digits"))
    whole = F.col("p") - F.col("s")
    head = whole % 9
    groups = F.concat(
        F.array(F.substr("digits", F.lit(1), head)),
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.when(i < (whole / 9).cast("int"), F.substr("digits", head + i * 9 + 1, F.lit(9))).otherwise("")),
        F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i < (F.col("s") / 9).cast("int"), F.substr("digits", whole + i * 9 + 1, F.lit(9))).otherwise("")),
        F.array(F.right("digits", F.col("s") % 9)))
    sizes = F.array(*[F.lit(x) for x in DIGIT_BYTES])
    hexed = F.array_join(F.transform(groups, lambda g: F.when(F.length(g) == 0, "").otherwise(
        F.lpad(F.hex(g.cast("long")), F.get(sizes, F.length(g)) * 2, F.lit("0")))), "")
    minus = F.col("o_orderkey") % 3 == 0
    hexed = F.when(minus, F.translate(hexed, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(hexed)
    return o.select("o_orderkey", "p", "s", F.unhex(F.concat(F.translate(F.substring(hexed, 1, 1), "0123456789ABCDEF", "89ABCDEF01234567"),
                                                             F.substr(hexed, F.lit(2)))).alias("raw"))


def stored_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, f, d): a stored FLOAT and DOUBLE per ``orders`` row, put together from sign, exponent and fraction."""
    k = F.col("o_orderkey")
    sign = k % 2
    e32, e64 = 117 + k % 30, 1003 + k % 60
    f32, f64 = k * 7919 % (1 << 23), k * 2654435761 % (1 << 52)
    special = k % 50 == 0  # infinite, not a number, zero
    e32 = F.when(special, F.when(k % 150 == 0, 0).otherwise(255)).otherwise(e32)
    e64 = F.when(special, F.when(k % 150 == 0, 0).otherwise(2047)).otherwise(e64)
    f32 = F.when(special, F.when(k % 150 == 50, 1).otherwise(0)).otherwise(f32)
    f64 = F.when(special, F.when(k % 150 == 50, 1).otherwise(0)).otherwise(f64)
    bits32 = F.shiftleft(sign, 31).bitwiseOR(F.shiftleft(e32, 23)).bitwiseOR(f32)
    bits64 = F.shiftleft(sign, 63).bitwiseOR(F.shiftleft(e64, 52)).bitwiseOR(f64)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    swapped = F.concat(le_hex(bits64.bitwiseAND(F.lit(0xFFFFFFFF)), 4), le_hex(F.shiftrightunsigned(bits64, 32), 4))
    return o.select("o_orderkey", F.unhex(le_hex(bits32, 4)).alias("f"), F.unhex(swapped).alias("d"))


def schema_cells(log: DataFrame) -> DataFrame:
    """Stored cells of the evolving log's row changes: the first eight ordinals, whether the table has them or not."""
    cells = log.where(F.col("event_type") != "query").select("seq", "db", "tbl", "pos_key", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("ordinal"))
    return cells.withColumn("stored", F.when(F.col("seq") % 11 != 0, (F.col("seq") * 7 + F.col("ordinal")) % 5 - 1))
