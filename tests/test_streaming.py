import random

import pytest
from pyspark.sql import functions as F

from oncolake.operators.consolidate import latest_by_key
from oncolake.streaming import report_set

SCHEMA = "patient_id string, report_id string, version int, export_id string, payload string, retract boolean"


def run_stream(spark, tmp_path, batches):
    source, out = tmp_path / "in", tmp_path / "out"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(str(source / f"{n}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{source}/*")
    published = []

    def publish(current, batch_id):
        current.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        published.append(batch_id)

    writer = report_set.emit_updates(
        report_set.maintain_report_set(stream), str(tmp_path / "log"), publish, buckets=3
    )
    query = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.option("basePath", str(out)).parquet(str(out)), str(tmp_path / "log")


def test_current_versions_do_not_depend_on_arrival(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"p{rng.randrange(3)}", f"r{rng.randrange(4)}", rng.randrange(5), f"{i:03}", f"x{i}", False) for i in range(30)]
    shuffled = rng.sample(rows, len(rows))
    out, log = run_stream(spark, tmp_path, [shuffled[:10], shuffled[10:20], shuffled[20:]])
    got = latest_by_key(out, ["patient_id", "report_id"], ["batch"]).collect()
    batch = latest_by_key(spark.createDataFrame(rows, SCHEMA), ["patient_id", "report_id"], ["version", "export_id"])
    want = {(r["patient_id"], r["report_id"], r["export_id"]) for r in batch.collect()}
    assert {(r["patient_id"], r["report_id"], r["export_id"]) for r in got} == want
    current = report_set.current_reports(spark, log).collect()
    assert sorted((r["patient_id"], r["report_id"], r["export_id"]) for r in current) == sorted(want)


def test_space_and_files_do_not_grow_with_history(spark, tmp_path):
    """The same report changed in every batch, beside one that is taken back in the end."""
    batches = [[("p", "r", n, f"{n:03}", f"x{n}", False)] for n in range(6)]
    batches[0].append(("q", "s", 1, "q1", "y", False))
    batches.append([("q", "s", 1, "q1", "y", True)])
    out, log = run_stream(spark, tmp_path, batches)
    current = report_set.current_reports(spark, log).collect()
    assert [(r["patient_id"], r["payload"]) for r in current] == [("p", "x5")]
    import pathlib

    rows = spark.read.parquet(f"{log}/current").filter("not marker")
    assert rows.filter("patient_id = 'p'").count() == 2  # this state and the one before
    assert len(list(pathlib.Path(log, "pointers").iterdir())) == 2
    with pytest.raises(ValueError):
        report_set._pointers(spark, log, None, buckets=99)


def test_retraction_restores_the_version_before(spark, tmp_path):
    first = [("p", "r", 1, "a", "old", False), ("p", "r", 2, "b", "new", False), ("p", "q", 1, "c", "only", False)]
    second = [("p", "r", 2, "b", "new", True), ("p", "q", 1, "c", "only", True)]
    out, _ = run_stream(spark, tmp_path, [first, second])
    last = out.filter(F.col("batch") == out.agg(F.max("batch")).collect()[0][0]).collect()
    assert [(r["report_id"], r["payload"]) for r in last] == [("r", "old")]


def test_changed_record_survives_in_any_order(spark, tmp_path):
    """Old state out and new state in under one export id, in one batch, both ways round."""
    first = [("p", r, 1, r, "old", False) for r in ("a", "b", "c")]
    second = [
        ("p", "a", 1, "a", "old", True), ("p", "a", 1, "a", "new", False),
        ("p", "b", 1, "b", "new", False), ("p", "b", 1, "b", "old", True),
        ("p", "c", 2, "c", "mid", False), ("p", "c", 1, "c", "old", True),
        ("p", "c", 2, "c", "mid", True), ("p", "c", 1, "c", "new", False),
    ]
    out, _ = run_stream(spark, tmp_path, [first, second])
    last = out.filter(F.col("batch") == out.agg(F.max("batch")).collect()[0][0]).collect()
    assert {(r["report_id"], r["payload"]) for r in last} == {("a", "new"), ("b", "new"), ("c", "new")}


def test_a_report_is_read_and_written_once_per_batch():
    """However many versions come, the state is called once to read and once to write."""
    from pyspark.sql import Row

    class State:
        kept, calls = [], []

        def get(self):
            self.calls.append("get")
            return iter(self.kept)

        def put(self, values):
            self.calls.append("put")
            self.kept = values

        def clear(self):
            self.calls.append("clear")
            self.kept = []

    class Handle:
        def getListState(self, name, schema):  # noqa: N802
            return State()

    processor = report_set.current_version()
    processor.init(Handle())
    change = lambda version, retract: Row(version=version, export_id=f"e{version}", payload="p", retract=retract)
    added = list(processor.handleInputRows(("p", "r"), iter([change(v, False) for v in range(50)]), None))
    assert [(r.version, r.retracted) for r in added] == [(49, False)] and State.calls == ["get", "put"]
    gone = list(processor.handleInputRows(("p", "r"), iter([change(v, True) for v in range(50)]), None))
    assert [(r.version, r.retracted) for r in gone] == [(49, True)] and State.calls[2:] == ["get", "clear"]
    assert list(processor.handleInputRows(("p", "r"), iter([change(1, True)]), None)) == []
