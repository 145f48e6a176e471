"""Patient status rows (last information, death) from tables and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.functions.dates import german_date

# Column headings of the status export.
CSV_COLUMNS = {
    "patient_id": "Patienten-ID",
    "last_information": "Letzte Information (LetzteInformation)",
    "death_date": "Sterbedatum",
}


def join_patient_status(
    patients: DataFrame, links: DataFrame, status: DataFrame, after=None
) -> DataFrame:
    """Patient, link and status rows joined, changed after the last seen time.

    The time filter is on the patient side, so it is pushed to the source before the joins.
    """
    changed = patients if after is None else patients.filter(F.col("BEARBEITET_AM") > F.lit(after))
    joined = changed.alias("p").join(links.alias("l"), F.col("l.PATIENT_ID") == F.col("p.ID"), "inner")
    joined = joined.join(status.alias("s"), F.col("s.ID") == F.col("l.ID"), "inner")
    return joined.select(
        F.col("p.ID").cast("string").alias("id"),
        F.col("p.PATIENTEN_ID").alias("patient_id"),
        F.col("s.LETZTEINFORMATION").cast("date").alias("last_information"),
        F.col("s.STERBEDATUM").cast("date").alias("death_date"),
        F.col("p.BEARBEITET_AM").cast("timestamp").alias("modified_at"),
    )


def read_patient_status_table(
    spark: SparkSession, jdbc_options: dict[str, str], after=None
) -> DataFrame:
    """Changed patient status rows over JDBC, from the patient, procedure and status tables."""

    def table(name):
        return spark.read.format("jdbc").options(**{**jdbc_options, "dbtable": name}).load()

    return join_patient_status(table("patient"), table("prozedur"), table("dk_bestoftumor"), after)


def read_patient_status_csv(spark: SparkSession, path: str) -> DataFrame:
    """Status rows of a ``;``-separated export with German dates.

    Missing columns are an error. Values are trimmed, impossible dates become null and are flagged
    in ``bad_date``, rows without a patient id are dropped.
    """
    rows = spark.read.csv(
        path, sep=";", header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    missing = [heading for heading in CSV_COLUMNS.values() if heading not in rows.columns]
    if missing:
        raise ValueError(f"missing columns in {path}: {', '.join(missing)}")

    def text(name):
        return F.nullif(F.trim(F.col(f"`{CSV_COLUMNS[name]}`")), F.lit(""))

    def date(name):
        return german_date(text(name))

    def bad(name):
        return text(name).isNotNull() & date(name).isNull()

    return rows.select(
        F.lit(None).cast("string").alias("id"),
        text("patient_id").alias("patient_id"),
        date("last_information").alias("last_information"),
        date("death_date").alias("death_date"),
        (bad("last_information") | bad("death_date")).alias("bad_date"),
    ).filter(F.col("patient_id").isNotNull())
