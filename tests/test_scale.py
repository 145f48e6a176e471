"""What keeps time and disk of large tables down: order of lists, version of a text, packed ids, staged tables."""

import os
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oncolake.functions import ids
from oncolake.operators import bundles as B
from oncolake.operators import staging
from oncolake.quality import paths as X
from oncolake.quality import suites as Q
from oncolake.quality import views as V
from oncolake.queries import QUERIES
from oncolake.sources import grouped_files as GF
from oncolake.sources import reports as SR


def test_lists_are_sorted_without_inner_structs_in_the_same_order(spark):
    kind = "pos struct<rank: struct<a: int, b: string>, seq: int>, url string"
    rows = [
        (((2, "x"), 1), "r1"), (((1, None), 1), "r2"), (((1, "y"), 3), "r3"), (((None, "z"), 9), "r4"), ((None, 0), "r5"),
        (None, "r6"), (((1, "y"), 2), "r7"), (((None, None), 0), "r8"), ((None, None), "r9"), (((1, "y"), 2), "r10"),
    ]
    df = spark.createDataFrame(rows, kind).withColumns({"k": F.lit("k"), "__order": F.struct("pos", "url"), "__item": F.col("url")})
    items = B.sorted_items(df, "items")
    found, plain = df.groupBy("k").agg(items, F.sort_array(F.collect_list(F.struct("__order", "__item"))).alias("pairs")).first()[1:]
    assert found == [pair["__item"] for pair in plain] and len(found) == 10
    sorted_kind = df.agg(F.collect_list(F.struct(*B.flat_order(F.col("__order"), df.schema["__order"].dataType)))).schema
    assert sorted_kind.simpleString().count("struct<") == 2  # the row and the listed one


def test_usual_reports_are_told_apart_before_texts_are_read_in_small_letters(spark):
    first = spark.createDataFrame([("",)], "xml string").select(SR.report_version(F.col("xml")))
    assert "lower" not in first.columns[0].split(" THEN ")[0]
    texts = {
        '<oBDS Schema_Version="3.0.2">': "v3", '<OBDS SCHEMA_VERSION="3.0.2">': "v3", ' \n<obds x="1" schema_version="3.1"/>': "v3",
        '<oBDS Schema_Version="2.0">': "unknown", '<ADT_GEKID Schema_Version="2.1.1">': "v2", " \n": "empty", "x": "unknown", None: "empty",
    }
    df = spark.createDataFrame([(t,) for t in texts], "xml string")
    assert {r.xml: r.v for r in df.select("xml", SR.report_version(F.col("xml")).alias("v")).collect()} == texts


def test_references_of_packed_ids_equal_packed_references(spark):
    texts = ["", "abc", None, "a" * 64, "A" * 64, "Patient/" + "b" * 64, "ä/" + "c" * 64, "x" * 63 + "é", "1" * 65, "g" * 64]
    df = spark.createDataFrame([(t,) for t in texts], "id string").withColumn("data", ids.packed(F.col("id")))
    both = df.select(
        "id", ids.unpacked(F.col("data")).alias("back"), ids.packed_reference("Patient", F.col("data")).alias("found"),
        ids.packed(F.concat(F.lit("Patient/"), F.col("id"))).alias("want"),
    ).collect()
    assert all(r.id == r.back and r.found == r.want for r in both)


def test_a_quality_run_joins_and_counts_packed_ids(spark, monkeypatch):
    patient, other = "a" * 64, "unhashed"
    codings = "array<struct<system: string, code: string>>"
    observations = spark.createDataFrame(
        [(f"{n}", f"Patient/{p}", d) for n, p, d in ((1, patient, "2001"), (2, patient, "2001"), (3, other, "2002"), (4, "gone", None))],
        "id string, patient_ref string, day string",
    ).select(
        "id", "patient_ref", F.struct(F.col("day").alias("value")).alias("effective"), F.lit(Q.DEFAULT.profile("tod")).alias("profile"),
        *[F.array(F.struct(F.lit("s").alias("system"), F.lit("c").alias("code"))).cast(codings).alias(n) for n in ("code", "value_codings", "interpretation")],
    )
    patients = spark.createDataFrame([(patient, "1950"), (other, "2003")], "id string, born string").select(
        "id", F.lit("male").alias("gender"), F.struct(F.col("born").alias("value")).alias("birth_date"),
        F.struct(F.lit("2001").alias("value")).alias("deceased_date"), F.lit(True).alias("deceased"),
    )
    kinds = []
    kept = Q.stage_table
    monkeypatch.setattr(Q, "stage_table", lambda df, name, *more: kinds.append((name, dict(df.dtypes))) or kept(df, name, *more))
    tables = {"Observation": observations, "Patient": patients}
    found = {(r.suite, r.expectation): (r.evaluated, r.unexpected) for r in Q.quality_run(tables, "2001-12-31").collect()}
    views = V.joined_views(V.views_from_tables(tables))
    plain = {(r.suite, r.expectation): (r.evaluated, r.unexpected) for r in Q.run_suites(views, "2001-12-31").collect()}
    assert found == plain
    assert found["observations", "one death observation per patient"] == (3, 2)
    assert found["observations", "observed not before birth"] == (3, 1)
    assert {kind[c] for _, kind in kinds for c in ("patient_id", "subject_reference") if c in kind} == {"binary"}


def test_staged_tables_leave_no_shuffle_and_can_be_dropped(spark):
    folder = staging.checkpoint_dir(spark).removeprefix("file:")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: blocks.getAllFiles().size()
    files = held()
    staged = staging.stage_table(spark.range(1000).repartition(7, "id"), "dropped")
    for _ in range(50):  # they are deleted by another thread
        if held() <= files:
            break
        time.sleep(0.1)
    assert held() <= files
    assert spark.conf.get(name) == before and staged.count() == 1000
    path = staged._staged_at.removeprefix("file:")
    assert path.startswith(folder) and os.path.isdir(path)
    staging.drop_staged(staged)
    assert not os.path.exists(path)


def test_views_by_path_deletes_what_it_has_read(spark):
    folder = staging.checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rows = QUERIES["views_by_path"](spark, "/root/testdata/sf0.001").collect()
    assert {r.view for r in rows} == set(V.BASE_TABLES) and all(r.resources > 0 and r.differing == 0 for r in rows)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"compared"}


def test_views_by_path_compares_packed_ids(spark):
    texts = ['{"id": "%s", "gender": "male"}' % ("a" * 64), '{"id": "%s", "gender": "male"}' % ("a" * 64), '{"id": "A"}']
    rows = spark.createDataFrame([("Patient", t) for t in texts], "resource_type string, resource_json string")
    paths = {"patient_id": "id", "gender": "gender"}
    found = X.view_of_resources(rows, "Patient", paths, change=V.pack_ids)
    assert dict(found.dtypes)["patient_id"] == "binary"
    plain = X.view_of_resources(rows, "Patient", paths)
    assert sorted(map(tuple, V.unpack_ids(found).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_a_task_makes_its_files_in_a_folder_of_its_own(tmp_path, monkeypatch):
    class Context:
        partitionId, taskAttemptId, get = staticmethod(lambda: 0), staticmethod(lambda: 1), classmethod(lambda cls: cls)

    monkeypatch.setattr(GF, "TaskContext", Context)
    writer, seen = GF.GroupedFilesWriter(str(tmp_path), ".json", ",", "]"), []
    publish = writer._publish
    writer._publish = lambda *given: seen.append(os.listdir(tmp_path)) or publish(*given)
    rows = pa.RecordBatch.from_pydict({"name": ["a", "a", "a", "b"], "text": ["[", "1", "2", "["]})
    writer.commit([writer.write(iter([rows]))])
    assert [len(names) for names in seen] == [1]  # no file in the common folder before all are written
    assert {n: (tmp_path / n).read_text() for n in ("a.json", "b.json")} == {"a.json": "[1,2]", "b.json": "[]"}
    again = pa.RecordBatch.from_pydict({"name": ["c", "d", "c"], "text": ["[", "[", "1"]})
    with pytest.raises(ValueError, match="do not come together"):
        writer.write(iter([again]))
    assert sorted(os.listdir(tmp_path)) == ["_SUCCESS", "_files", "a.json", "b.json"]
