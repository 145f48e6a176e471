"""Patient resources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake import schemas
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.codes import lookup
from oncolake.functions.dates import partial_date, report_partial_date
from oncolake.functions.ids import max_id, nonblank
from oncolake.resources.base import typed

# Administrative gender of the report's sex codes.
GENDER = {"W": "female", "M": "male", "D": "other", "U": "unknown", "X": "other"}


def map_patients(
    reports: DataFrame, cfg: MappingConfig = DEFAULT, group_cols: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """One patient per group from all its reports.

    Demographics come from the newest report. The latest death date wins; a death report without
    any date still marks the patient as deceased. Aggregates only, so reports of a patient are
    reduced before the shuffle.
    """
    death = F.col("report")["Tod"]
    died_on = F.when(death.isNotNull(), F.try_to_date(F.substring(death["Sterbedatum"], 1, 10), "yyyy-MM-dd"))
    newest = F.struct("report_date", "report_id")
    keys = list(dict.fromkeys([*group_cols, "patient_id"]))
    grouped = reports.groupBy(*keys).agg(
        F.max_by("master", newest).alias("master"),
        max_id(F.col("patient_ref"), "Patient/").alias("patient_ref"),
        F.max("patient_identifier").alias("patient_identifier"),
        max_id(F.col("bundle_id")).alias("bundle_id"),
        F.bool_or("write_patient").alias("write_patient"),
        F.coalesce(F.bool_or(death.isNotNull()), F.lit(False)).alias("died"),
        F.max(died_on).alias("died_on"),
        F.min("rank_key").alias("rank_key"),
        *([] if "tumor_id" in keys else [F.lit(None).cast("string").alias("tumor_id")]),
    ).filter("write_patient")
    master = F.col("master")
    address = master["Adresse"]
    country = F.when(address["Land"].rlike("^[a-zA-Z]{2,3}$"), F.upper(address["Land"]))
    identifier = F.coalesce(
        F.when(F.col("bundle_id") == F.substring_index("patient_ref", "/", -1), F.col("patient_identifier")),
        F.col("patient_id"),
    )
    table = typed(
        grouped.withColumn("seq", F.lit(0)).withColumn("section", F.lit("Patient")),
        cfg,
        {**schemas.PATIENTS, "bundle_id": "string"},
        "Patient",
        "patient-id",
        identifier,
        cfg.patient_profile,
        slug=False,
        bundle_id=F.col("bundle_id"),
        gender=lookup(master["Geschlecht"], GENDER),
        birth_date=report_partial_date(master["Geburtsdatum"]),
        deceased=F.when(F.col("died"), F.lit(True)),
        deceased_date=partial_date(F.col("died_on").cast("string")),
        has_address=address.isNotNull(),
        postal_code=nonblank(address["PLZ"]),
        country=country,
    )
    # The bundle carries the patient's id, which may be the source id or that of a known patient.
    return table.withColumn("id", F.coalesce("bundle_id", "id")).drop("bundle_id")
