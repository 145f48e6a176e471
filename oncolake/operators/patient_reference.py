"""How resources point to their patient: hashed, plain or looked up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.ids import resource_id


def _derived(strategy: str, cfg: MappingConfig):
    patient = F.col("patient_id")
    return {
        "sha256": resource_id(cfg.identifier_system("patient-id"), patient),
        "md5": F.md5(patient),
        "dashes": F.translate(patient, "_", "-"),
        "plain": patient,
    }[strategy]


def pseudonymize(df: DataFrame, pseudonyms: DataFrame | None = None, key: str | None = None,
                 column: str = "patient_id") -> DataFrame:
    """Replace an id by its pseudonym from a table (``original, pseudonym``) or by a keyed hash.

    With a table, ``pseudonym_error`` names ids that it lacks, for quarantine; their id becomes null.
    """
    if pseudonyms is None:
        from oncolake.operators.deidentify import keyed_hash

        return df.withColumn(column, keyed_hash(F.col(column), key))
    known = pseudonyms.groupBy(F.col("original").alias("__original")).agg(
        F.min("pseudonym").alias("__pseudonym")
    )
    joined = df.join(known, F.col(column) == F.col("__original"), "left")
    lacking = F.when(
        F.col(column).isNotNull() & F.col("__pseudonym").isNull(), F.lit("no pseudonym for the patient id")
    )
    joined = joined.withColumn("pseudonym_error", lacking)
    return joined.withColumn(column, F.col("__pseudonym")).drop("__original", "__pseudonym")


def patient_reference(
    df: DataFrame,
    cfg: MappingConfig = DEFAULT,
    strategy: str | None = None,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Add ``patient_ref``, ``patient_identifier``, ``patient_exists`` and ``patient_ref_error``.

    Strategies: ``sha256`` (of identifier system and id), ``md5``, ``dashes`` (underscores
    replaced), ``plain``, ``record_id`` (lookup columns ``patient_id, record_id``; the found id also
    replaces the identifier) and ``existing`` (lookup columns ``identifier_value, id`` of known
    patients; more than one match is an error). A patient not found keeps an identifier-only
    reference. The lookup is reduced to one row per patient first, so the join adds no rows and
    only the report side can be skewed, which the adaptive planner may split.
    """
    strategy = strategy or cfg.patient_reference_strategy
    if strategy in ("sha256", "md5", "dashes", "plain"):
        return (
            df.withColumn("patient_ref", F.concat(F.lit("Patient/"), _derived(strategy, cfg)))
            .withColumn("patient_identifier", F.col("patient_id"))
            .withColumn("patient_exists", F.lit(False))
            .withColumn("patient_ref_error", F.lit(None).cast("string"))
        )
    if lookup is None:
        raise ValueError(f"strategy {strategy} needs a lookup table")
    key, value = {
        "record_id": ("patient_id", "record_id"),
        "existing": ("identifier_value", "id"),
    }[strategy]
    found = (
        lookup.filter(F.trim(value) != "")
        .groupBy(F.col(key).alias("__key"))
        .agg(F.min(value).alias("__id"), F.count_distinct(value).alias("__matches"))
    )
    joined = df.join(found, F.col("patient_id") == F.col("__key"), "left")
    unique = F.col("__matches") == 1
    identifier = F.col("patient_id")
    if strategy == "record_id":
        identifier = F.coalesce(F.when(unique, F.col("__id")), identifier)
    return (
        joined.withColumn("patient_ref", F.when(unique, F.concat(F.lit("Patient/"), F.col("__id"))))
        .withColumn("patient_identifier", identifier)
        .withColumn("patient_exists", F.coalesce(unique, F.lit(False)))
        .withColumn(
            "patient_ref_error",
            F.when(F.col("__matches") > 1, F.lit("more than one patient matches the identifier")),
        )
        .drop("__key", "__id", "__matches")
    )
