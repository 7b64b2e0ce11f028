"""keyed_window equals plain per-key windows, including for a key holding a third of the rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from rowtide.operators.ordered import keyed_window, shift_bucket

# all keys split, only the hot one, none
HOT_ROWS = pytest.mark.parametrize("hot_rows", [0, 500, 1 << 20])


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)       # key 0: a third of all rows
        val = None if rnd.random() < 0.2 else rnd.randint(0, 99)
        rows.append((key, i * 7 + rnd.randint(0, 6), val))
    return spark.createDataFrame(rows, "k long, pos long, v long")


@HOT_ROWS
def test_matches_plain_window(spark, hot_rows):
    df = _frame(spark)
    got = keyed_window(df, ["k"], ["pos"], shift_bucket("pos", 6), lag=["v"], lead=["v"], fill=["v"], seq="n",
                       hot_rows=hot_rows)
    w = Window.partitionBy("k").orderBy("pos")
    exp = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("fill_v"),
                    F.row_number().over(w).cast("long").alias("n"))
    cols = ["k", "pos", "v", "prev_v", "next_v", "fill_v", "n"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())


def test_hot_key_spreads_over_buckets(spark):
    df = _frame(spark)
    # the hot key spans many (key, bucket) window partitions
    nb = df.filter("k = 0").select(shift_bucket("pos", 6).alias("b")).distinct().count()
    assert nb > 50


@HOT_ROWS
def test_multi_column_bucket(spark, hot_rows):
    df = _frame(spark).withColumn("k2", F.col("k") % 2)
    got = keyed_window(df, ["k", "k2"], ["pos"], [shift_bucket("pos", 8), F.lit(0)], seq="n", hot_rows=hot_rows)
    w = Window.partitionBy("k", "k2").orderBy("pos")
    exp = df.select("*", F.row_number().over(w).cast("long").alias("n"))
    assert sorted(got.select("k", "pos", "n").collect()) == sorted(exp.select("k", "pos", "n").collect())


@HOT_ROWS
def test_running_sum(spark, hot_rows):
    df = _frame(spark)
    got = keyed_window(df, ["k"], ["pos"], shift_bucket("pos", 6), sums=["v"], lag=["v"], hot_rows=hot_rows)
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("*", F.sum(F.coalesce("v", F.lit(0))).over(w).alias("sum_v"))
    cols = ["k", "pos", "sum_v"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())


@HOT_ROWS
def test_null_keys_form_their_own_group(spark, hot_rows):
    rnd = random.Random(11)
    rows = [(None if i % 4 == 0 else rnd.choice(["a", "b"]), None if i % 9 == 0 else i % 3, i * 5, i)
            for i in range(1200)]
    df = spark.createDataFrame(rows, "k string, k2 long, pos long, v long")
    got = keyed_window(df, ["k", "k2"], ["pos"], shift_bucket("pos", 5), lag=["v"], lead=["v"], fill=["v"],
                       sums=["v"], seq="n", hot_rows=hot_rows)
    w = Window.partitionBy("k", "k2").orderBy("pos")
    exp = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("fill_v"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sum_v"),
                    F.row_number().over(w).cast("long").alias("n"))
    cols = ["k", "k2", "pos", "prev_v", "next_v", "fill_v", "sum_v", "n"]
    assert sorted(got.select(cols).collect(), key=str) == sorted(exp.select(cols).collect(), key=str)


def test_only_hot_keys_are_split(spark):
    """A key of a third of the rows beside as many keys as rows: the summary holds the hot key's buckets only."""
    rnd = random.Random(3)
    rows = [(0 if i % 3 == 0 else i, i * 7, rnd.randint(0, 99)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, pos long, v long").repartition(6)
    got = keyed_window(df, ["k"], ["pos"], shift_bucket("pos", 9), lag=["v"], seq="n", hot_rows=500)
    w = Window.partitionBy("k").orderBy("pos")
    exp = df.select("*", F.lag("v").over(w).alias("prev_v"), F.row_number().over(w).cast("long").alias("n"))
    assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str)


def test_no_hot_key_leaves_one_shuffle_of_the_rows(spark):
    df = _frame(spark)
    got = keyed_window(df, ["k"], ["pos"], shift_bucket("pos", 6), lag=["v"], seq="n")
    got.write.format("noop").mode("overwrite").save()
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("Initial Plan")[0]
