"""Continuous report sets: current versions as state, touched patients re-emitted per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERSION = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("export_id", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)
CURRENT = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("report_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("export_id", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("retracted", T.BooleanType()),
    ]
)


def latest_by_key_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: Column | None = None
) -> DataFrame:
    """Newest record per key of a stream, for update mode; a deleting record is flagged.

    The state is one row per key, reduced per task before the shuffle.
    """
    rest = [name for name in df.columns if name not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    rows = newest.select(*keys, "__row.*").select(*df.columns)
    flag = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    return rows.withColumn("deleted", flag)


def current_version() -> StatefulProcessor:
    """The processor behind ``maintain_report_set``.

    The class is local so that it travels to the workers by value; they need not have this package.
    """

    class CurrentVersion(StatefulProcessor):
        """Keeps every version of one report of one patient and emits the current one on change.

        The state of a key is the versions of a single report, so a patient with very many reports is
        spread over as many keys. All versions stay, so taking back the newest restores the one before.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.versions = handle.getListState("versions", VERSION)

        def handleInputRows(self, key, rows, timerValues):
            # The rows of a batch come in any order. A retraction takes out the record it names and
            # no other: an addition of the same batch, or what is stored. So the result is the same
            # for each order, and a changed record is never lost with its former state.
            net, wiped = {}, set()
            for row in rows:
                if row.retract and row.payload is None:
                    wiped.add(row.export_id)  # names no content: whatever was stored before
                    continue
                record = (int(row.version), row.export_id, row.payload)
                net[record] = net.get(record, 0) + (-1 if row.retract else 1)
            # The state is read once and written once: each call of it is a message to the engine.
            stored = {value[1]: tuple(value) for value in self.versions.get()}
            versions = {export_id: value for export_id, value in stored.items() if export_id not in wiped}
            for record, count in net.items():
                if count < 0 and versions.get(record[1]) == record:
                    del versions[record[1]]
            for record in sorted((r for r, count in net.items() if count > 0), key=lambda r: (r[0], r[2] or "")):
                versions[record[1]] = record
            if versions == stored:
                return
            if versions:
                self.versions.put(list(versions.values()))
            else:
                self.versions.clear()
            before, after = self._current(stored), self._current(versions)
            if after != before:
                values = (*key, *(after or before), after is None)
                yield Row(**dict(zip(CURRENT.names, values)))

        @staticmethod
        def _current(versions):
            return max(versions.values(), key=lambda v: v[:2], default=None)

        def close(self) -> None:
            pass

    return CurrentVersion()


def maintain_report_set(changes: DataFrame) -> DataFrame:
    """Current version of every report from a stream of additions and retractions.

    Input: ``patient_id, report_id, version, export_id, payload, retract``. Emits a row whenever the
    current version of a report changes; ``retracted`` when none is left. Arrival order does not
    matter, versions decide, so there is no watermark. Sets the state store of the session to RocksDB,
    without which Spark does not run this operator.
    """
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        changes.select("patient_id", "report_id", "version", "export_id", "payload", "retract")
        .groupBy("patient_id", "report_id")
        .transformWithState(
            statefulProcessor=current_version(),
            outputStructType=CURRENT,
            outputMode="Update",
            timeMode="None",
        )
    )


def changelog_diff(previous: DataFrame, batch: DataFrame, key: str = "export_id") -> DataFrame:
    """Additions and retractions that turn a table into its next state.

    A changed record is taken out of its old group and put into its new one. ``batch`` has a
    ``deleted`` flag; each key occurs once in either table.
    """
    incoming = batch.select(F.col(key).alias("__key")).distinct()
    old = previous.join(incoming, previous[key] == incoming["__key"], "left_semi")
    new = batch.filter(~F.coalesce("deleted", F.lit(False))).select(*previous.columns)
    same = [c for c in previous.columns]
    return (
        old.withColumn("retract", F.lit(True))
        .unionByName(new.withColumn("retract", F.lit(False)))
        .select(*same, "retract")
    )


#: What the table of current reports holds; ``marker`` rows only make a bucket without reports exist.
TABLE = "patient_id string, report_id string, version int, export_id string, payload string, marker boolean"
#: Which of its two folders a bucket is current in, after which batch.
POINTERS = "batch_id bigint, buckets int, bucket int, slot int"


def _read(spark: SparkSession, schema: str, *paths: str, base: str | None = None) -> DataFrame:
    """Files of a known schema; an empty table where there is no such folder yet."""
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _pointers(spark: SparkSession, folder: str, before: int | None, buckets: int | None = None):
    """(slot of the pointer table, {bucket: slot}) of the last batch before another one.

    Both have at most one row per bucket, a number the caller sets.
    """
    known = {}
    for slot in (0, 1):
        rows = _read(spark, POINTERS, f"{folder}/pointers/{slot}").collect()
        if rows and (before is None or rows[0]["batch_id"] < before):
            known[rows[0]["batch_id"]] = (slot, rows)
    if not known:
        return 1, {}
    slot, rows = known[max(known)]
    if buckets is not None and rows[0]["buckets"] != buckets:
        raise ValueError(f"{folder} was written with {rows[0]['buckets']} buckets")
    return slot, {row["bucket"]: row["slot"] for row in rows}


def _bucket_rows(spark: SparkSession, folder: str, slots: dict[int, int]) -> DataFrame:
    """The reports of some buckets; only the folders of these buckets are listed and read."""
    paths = [f"{folder}/current/slot={slot}/bucket={bucket}" for bucket, slot in slots.items()]
    if not paths:
        return spark.createDataFrame([], TABLE).drop("marker")
    rows = _read(spark, TABLE, *paths, base=f"{folder}/current")
    return rows.filter(~F.col("marker")).drop("marker", "slot", "bucket")


def current_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All current reports that ``emit_updates`` keeps in a folder, after its last whole batch."""
    return _bucket_rows(spark, folder, _pointers(spark, folder, None)[1])


def emit_updates(
    changes: DataFrame,
    folder: str,
    publish: Callable[[DataFrame, int], None],
    buckets: int = 512,
) -> DataStreamWriter:
    """Keep the current reports as a table and publish the touched patients of each batch.

    ``publish(reports, batch_id)`` gets all current reports of every patient the batch touched. The
    table is split by patient into ``buckets``; a batch reads and rewrites those it touches, so its cost
    follows the current reports of these buckets and not the history. Each bucket has two folders: the
    new state goes to the one not in use, then the pointers are switched. A repeated batch starts from
    the pointers before it and gives the same result; space is at most twice the current reports.
    """
    keys = ["patient_id", "report_id"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumn("bucket", F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).cast("int"))
        placed.write.mode("overwrite").parquet(f"{folder}/changes")
        news = spark.read.schema(placed.schema).parquet(f"{folder}/changes")
        touched = [row["bucket"] for row in news.select("bucket").distinct().collect()]
        place, slots = _pointers(spark, folder, batch_id, buckets)
        old = _bucket_rows(spark, folder, {b: slots[b] for b in touched if b in slots})
        kept = old.join(news.select(*[F.col(k).alias(f"__{k}") for k in keys]),
                        F.col("patient_id").eqNullSafe(F.col("__patient_id"))
                        & F.col("report_id").eqNullSafe(F.col("__report_id")), "left_anti")
        now = kept.unionByName(news.filter(~F.col("retracted")).drop("bucket", "retracted"))
        target = {b: 1 - slots.get(b, 1) for b in touched}
        marks = spark.createDataFrame([(b, slot) for b, slot in target.items()], "bucket int, slot int")
        bucket = F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).cast("int")
        rows = now.withColumn("marker", F.lit(False)).withColumn("bucket", bucket).join(
            marks, "bucket"
        ).unionByName(marks.withColumn("marker", F.lit(True)), allowMissingColumns=True)
        (
            rows.hint("rebalance", "bucket").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("slot", "bucket").parquet(f"{folder}/current")
        )
        if touched:
            after = [(batch_id, buckets, b, slot) for b, slot in {**slots, **target}.items()]
            spark.createDataFrame(after, POINTERS).coalesce(1).write.mode("overwrite").parquet(
                f"{folder}/pointers/{1 - place}"
            )
        patients = news.select(F.col("patient_id").alias("__patient")).distinct()
        written = _bucket_rows(spark, folder, target)
        publish(
            written.join(patients, F.col("patient_id").eqNullSafe(F.col("__patient")), "left_semi"), batch_id
        )

    return changes.writeStream.outputMode("update").foreachBatch(write)
