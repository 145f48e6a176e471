import random

import pytest
from pyspark.sql import functions as F

from oncolake.sources.sorted_tables import read_sorted_table, table_index, upsert_sorted_table, write_sorted_table

SCHEMA = "resource_type string, id string, value string"


def contents(spark, folder):
    return {(r.resource_type, r.id): r.value for r in read_sorted_table(spark, folder).collect()}


def apart(spark, folder):
    ranges = sorted((tuple(r.low), tuple(r.high)) for r in table_index(spark, folder).collect())
    return all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_upserts_equal_a_dictionary_and_ranges_stay_apart(spark, tmp_path):
    rng, folder = random.Random(2), str(tmp_path / "t")
    want = {(rng.choice(["A", "B"]), f"{rng.randrange(10**6):06}"): "0" for _ in range(800)}
    write_sorted_table(spark.createDataFrame([(*k, v) for k, v in want.items()], SCHEMA), folder, files=8)
    assert contents(spark, folder) == want and apart(spark, folder)
    for turn in range(1, 4):
        batch = {k: str(turn) for k in rng.sample(sorted(want), 20)}
        batch |= {(rng.choice(["", "A", "B", "C"]), f"{rng.randrange(10**6):06}"): str(turn) for _ in range(60)}
        rows = [(*k, v) for k, v in batch.items()] + [(*k, "") for k in list(batch)[:5]]  # repeated keys: greatest
        upsert_sorted_table(spark.createDataFrame(rows, SCHEMA), folder, rows_per_file=90)
        want |= batch
        assert contents(spark, folder) == want and apart(spark, folder)
    assert max(r.rows for r in table_index(spark, folder).collect()) <= 110  # untouched files stay as they were


def test_a_small_batch_rewrites_the_files_it_hits(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(1000).select(
        F.lit("A").alias("resource_type"), F.format_string("%04d", "id").alias("id"), F.lit("x").alias("value"))
    write_sorted_table(rows, folder, files=10)
    before = {r.file: r.rows for r in table_index(spark, folder).collect()}
    batch = spark.createDataFrame([("A", "0500", None), ("A", "0501", "y"), ("Z", "1", "z")], SCHEMA)
    hit = {r.file for r in upsert_sorted_table(batch, folder).collect()}
    after = {r.file: r.rows for r in table_index(spark, folder).collect()}
    assert 2 <= len(hit) <= 3 and set(before) - set(after) == hit  # two owners, three if a border lies between
    assert sum(after.values()) == 1001
    found = read_sorted_table(spark, folder, between=(("A", "0499"), ("A", "0502")))
    assert {(r.id, r.value) for r in found.collect()} == {("0499", "x"), ("0500", None), ("0501", "y"), ("0502", "x")}
    assert len(found.inputFiles()) < len(after)
    assert read_sorted_table(spark, folder, between=(("B", "0"), ("B", "1"))).count() == 0


def test_empty_batches_null_keys_and_failed_writers(spark, tmp_path):
    folder = str(tmp_path / "t")
    write_sorted_table(spark.createDataFrame([("A", "1", "x")], SCHEMA), folder)
    version = table_index(spark, folder).inputFiles()
    assert upsert_sorted_table(spark.createDataFrame([], SCHEMA), folder).count() == 0
    with pytest.raises(Exception, match="id is null"):
        upsert_sorted_table(spark.createDataFrame([("A", None, "x")], SCHEMA), folder)
    assert table_index(spark, folder).inputFiles() == version
    extra = spark.createDataFrame([("A", "1", "y", 7)], SCHEMA + ", owner int")  # a column named like ours
    upsert_sorted_table(extra, folder)
    assert contents(spark, folder) == {("A", "1"): "y"}
