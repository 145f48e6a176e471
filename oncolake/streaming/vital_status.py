"""Vital status observations from a stream of patient status rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake.config import DEFAULT, MappingConfig
from oncolake.operators.patient_reference import patient_reference
from oncolake.resources.envelope import to_envelope
from oncolake.resources.outcomes import map_status_deaths, map_vital_status


def vital_status_stream(
    status: DataFrame, cfg: MappingConfig = DEFAULT, lookup: DataFrame | None = None
) -> DataFrame:
    """Envelopes of vital status and death observations, keyed by the vital status resource.

    Rows without a patient or without any date are dropped. Stateless, so it runs on a stream and on
    a table alike.
    """
    referred = patient_reference(status, cfg, lookup=lookup)
    vital = to_envelope(map_vital_status(referred, cfg), "Observation", cfg)
    deaths = to_envelope(map_status_deaths(referred, cfg), "Observation", cfg)
    return vital.unionByName(deaths)


def write_vital_status(envelopes: DataFrame, path: str, checkpoint: str):
    """The stream of envelopes appended to a folder; returned unstarted."""
    return (
        envelopes.select(
            F.coalesce("subject_ref", "full_url").alias("key"), "full_url", "emit_seq", "resource_json"
        )
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
