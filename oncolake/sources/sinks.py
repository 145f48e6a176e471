"""Writers for bundles, grouped reports, resource tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from oncolake.operators.consolidate import pick_by_key


def write_bundles_json(bundles: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """One JSON line per bundle; overwrites the folder. ``bundle_id`` is the bundle's own id."""
    lines = bundles.select("bundle_json", *partition_by)
    lines.write.mode("overwrite").partitionBy(*partition_by).text(path)


def keyed_messages(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))


def write_bundle_stream(
    bundles: DataFrame,
    checkpoint: str,
    topic: str | None = None,
    servers: str | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataStreamWriter:
    """A stream of keyed bundles to a topic (when the connector is deployed) or a folder.

    Returned unstarted, so the caller chooses the trigger.
    """
    messages = keyed_messages(bundles, "bundle_key", "bundle_json")
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if topic:
        tuned = {
            "kafka.compression.type": "zstd",
            "kafka.batch.size": "1048576",
            "kafka.linger.ms": "200",
            "kafka.max.request.size": "20971520",
            **(options or {}),
        }
        return writer.format("kafka").options(
            **{"kafka.bootstrap.servers": servers, "topic": topic, **tuned}
        )
    return writer.format("parquet").option("path", path)


def grouped_report_xml(groups: DataFrame) -> DataFrame:
    """Merged reports as XML documents keyed by ``patient-tumour``.

    Input: ``patient_id, tumor_id, part, recorded, master, items`` as merged by
    ``merge_report_group``.
    """
    patient = F.struct(
        F.col("patient_id").alias("_Patient_ID"),
        F.col("master").alias("Patienten_Stammdaten"),
        F.struct(F.col("items").alias("Meldung")).alias("Menge_Meldung"),
    )
    document = F.struct(
        F.lit("3.0.2").alias("_Schema_Version"),
        F.col("recorded").alias("Meldedatum"),
        F.struct(F.array(patient).alias("Patient")).alias("Menge_Patient"),
    )
    return groups.select(
        F.concat_ws("-", "patient_id", "tumor_id").alias("key"),
        "part",
        F.to_xml(document, {"rowTag": "oBDS"}).alias("value"),
    )


def write_grouped_reports(groups: DataFrame, path: str) -> None:
    """Write merged reports as keyed XML rows."""
    grouped_report_xml(groups).write.mode("overwrite").parquet(path)


def write_resource_tables(envelopes: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Resources as parquet, one partition per resource type."""
    envelopes.write.mode(mode).partitionBy("resource_type").parquet(folder)


def upsert_resource_tables(envelopes: DataFrame, folder: str, target: str) -> None:
    """Merge newer resources into a written table and write the result to a new folder.

    The newer row of a resource wins; readers keep using the old folder until they switch.
    """
    old = envelopes.sparkSession.read.parquet(folder)
    both = old.withColumn("__new", F.lit(0)).unionByName(
        envelopes.select(*old.columns).withColumn("__new", F.lit(1))
    )
    merged = pick_by_key(both, ["resource_type", "id"], ["__new"]).drop("__new")
    write_resource_tables(merged, target)
