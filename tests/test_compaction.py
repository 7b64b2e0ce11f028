"""Compaction of a streamed change table: same rows, few files, readers undisturbed."""

import pytest
from pyspark.sql import functions as F

from rowtide.session import scratch_dir
from rowtide.sinks import compaction as C
from rowtide.streaming import stream as S

from .test_landing import message, stage


def test_few_files_and_every_row_once(spark, tmp_path, monkeypatch):
    table, ck = scratch_dir(spark, "change-table"), f"{tmp_path}/ck"
    day = 86_400

    def follow(files, minute):
        stage(f"{tmp_path}/log", files, minute)
        src = S.envelope_stream(spark, f"{tmp_path}/log", 1)
        S.run_to_end(C.land_batches(src, table, ck))
        return src.withColumn("dt", F.lit(None).cast("date")).schema

    def rows():
        return sorted(r[0] for r in C.read_change_table(spark, table, schema).select("log_pos").collect())

    def files():
        return C.read_change_table(spark, table, schema).select(F.input_file_name()).distinct().count()

    def ids(n):
        return [i * 10 + 4 for i in range(n)]

    schema = follow([[message(i, ts=(i % 2) * day) for i in range(k * 20, k * 20 + 20)] for k in range(6)], 0)
    assert rows() == ids(120) and files() >= 12
    one = C._files(C._all(spark, table, schema)).agg(F.max("size")).first()[0]
    # a run that fails before its manifest changes nothing for readers
    with monkeypatch.context() as m:
        m.setattr(C, "MANIFEST", "broken")
        with pytest.raises(Exception):
            C.compact(spark, table, schema, 3 * one)
    assert rows() == ids(120)
    assert C.compact(spark, table, schema, 3 * one) == 1
    assert rows() == ids(120) and files() <= 6
    # batches that land after it are seen at once, and join the next version
    follow([[message(i, ts=0) for i in range(k * 20, k * 20 + 20)] for k in range(6, 9)], 6)
    assert rows() == ids(180)
    assert C.compact(spark, table, schema, 100 * one) == 2
    assert rows() == ids(180) and files() == 2
    assert C.compact(spark, table, schema, 100 * one) == 3 and files() == 2 and rows() == ids(180)
    # files are in log order
    by_file = {}
    for r in C._all(spark, table, schema).where(F.col("part").startswith("v")).select("_metadata.file_path", "_metadata.row_index", "pos_key").collect():
        by_file.setdefault(r[0], []).append((r[1], r[2]))
    assert all([p for _, p in sorted(v)] == sorted(p for _, p in v) for v in by_file.values())
