"""Table reads: the footer schema is inferred once per file version."""

import os
import tempfile
import time

import pandas as pd
import pytest

from churnkit.sources import io


def test_schema_declared_after_first_read(spark):
    d = tempfile.mkdtemp(prefix="churnkit-io-")
    path = os.path.join(d, "t.parquet")
    pd.DataFrame({"id": [0, 1, 2], "s": ["a", "b", "c"]}).to_parquet(path)
    first = io.read_table(spark, d, "t")
    key = (spark.sparkContext.applicationId, *io.file_version(path))
    assert io._FOOTER_SCHEMAS[key] == first.schema
    again = io.read_table(spark, d, "t")
    assert again.schema == first.schema and again.count() == 3

    # a rewritten file (another time or size) is inferred again
    time.sleep(1.1)
    pd.DataFrame({"id": [0, 1], "v": [0, 2]}).to_parquet(path)
    changed = io.read_table(spark, d, "t")
    assert [f.name for f in changed.schema.fields] == ["id", "v"]
    assert changed.count() == 2


def _is_broadcast(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_small_table_broadcast_after_a_proven_bound(spark):
    d = tempfile.mkdtemp(prefix="churnkit-io-")
    pd.DataFrame({"id": range(25)}).to_parquet(os.path.join(d, "dim.parquet"))
    pd.DataFrame({"id": range(50)}).to_parquet(os.path.join(d, "big.parquet"))
    assert _is_broadcast(io.read_small_table(spark, d, "dim", 100))
    assert io._ROW_BOUNDS[io.file_version(os.path.join(d, "dim.parquet"))] == 100
    assert _is_broadcast(io.read_small_table(spark, d, "dim", 100))  # proof reused, no count
    assert not _is_broadcast(io.read_small_table(spark, d, "big", 10))  # bound fails: no hint


def test_nothing_is_remembered_of_a_folder(spark):
    """A folder's time says nothing of the files in it."""
    d = tempfile.mkdtemp(prefix="churnkit-io-")
    spark.range(5).write.parquet(os.path.join(d, "dim.parquet"))
    assert _is_broadcast(io.read_small_table(spark, d, "dim", 10))
    spark.range(50).write.mode("append").parquet(os.path.join(d, "dim.parquet"))
    assert not _is_broadcast(io.read_small_table(spark, d, "dim", 10))


def test_csv_keeps_blanks_quotes_and_line_breaks(spark):
    d = tempfile.mkdtemp(prefix="churnkit-io-")
    rows = [(" 0", " NY "), ('say "hi"', "a,b"), ("", None), ("back\\slash", "tab\t"), ("two\nlines", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    io.write_csv(df, f"{d}/csv")
    assert sorted(map(str, map(tuple, io.read_csv(spark, f"{d}/csv", df.schema, line_breaks=True).collect()))) == \
        sorted(map(str, rows))
    io.write_csv(df.where("a not like 'two%'"), f"{d}/one-line")
    assert sorted(map(str, map(tuple, io.read_csv(spark, f"{d}/one-line", df.schema).collect()))) == \
        sorted(map(str, rows[:-1]))


def test_bad_json_lines_fail_or_are_kept(spark):
    d = tempfile.mkdtemp(prefix="churnkit-io-")
    path = os.path.join(d, "log.json")
    with open(path, "w") as f:
        f.write('{"userId":"1","ts":5,"length":1.5}\n{"userId":"2","ts":"x"}\n{broken\n{"userId":"3","length":"12.5"}\n')
    with pytest.raises(Exception):
        io.read_events_json(spark, path).collect()
    rows = io.read_events_json(spark, path, keep_bad_lines=True).collect()
    bad = [r[io.CORRUPT] for r in rows if r[io.CORRUPT] is not None]
    assert len(rows) == 4 and len(bad) == 3 and '{broken' in bad
