"""Code maps and code lists as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.operators.consolidate import pick_by_key

DRUG_COLUMNS = ("Substanzbezeichnung", "ATC-Code")
CLASSIFICATION_COLUMNS = (
    "name stadium code_system code_version code_code code_display "
    "value_system value_version value_code value_display"
).split()


def override_code_map(
    rows: DataFrame, keys: Sequence[str], code: str, order: Sequence[str | Column], ignore: Sequence[str] = ()
) -> DataFrame:
    """Last row per key by ``order`` among rows that carry a code."""
    text = F.trim(F.col(code))
    usable = rows.filter((text != "") & ~text.isin(*ignore)) if ignore else rows.filter(text != "")
    return pick_by_key(usable, keys, order)


def read_code_map(
    spark: SparkSession,
    base: str,
    extra: str | None = None,
    key_cols: Sequence[str] = DRUG_COLUMNS[:1],
    code_col: str = DRUG_COLUMNS[1],
    ignore: Sequence[str] = ("fehlt",),
) -> DataFrame:
    """A ``;``-separated map with header and ``#`` comments; later rows and the extra file win."""
    parts = []
    for priority, path in enumerate(p for p in (base, extra) if p):
        rows = spark.read.csv(path, sep=";", header=True, comment="#")
        trimmed = [F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in rows.columns]
        parts.append(
            rows.select(
                *trimmed,
                F.lit(priority).alias("__priority"),
                F.col("_metadata.file_block_start").alias("__block"),
                F.monotonically_increasing_id().alias("__row"),
            )
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    chosen = override_code_map(
        rows, list(key_cols), code_col, ["__priority", "__block", "__row"], ignore
    )
    return chosen.drop("__priority", "__block", "__row")


def read_drug_map(spark: SparkSession, base: str, extra: str | None = None) -> DataFrame:
    """Drug name to ATC code: ``name, atc_code``."""
    rows = read_code_map(spark, base, extra)
    return rows.select(
        F.col(DRUG_COLUMNS[0]).alias("name"), F.col(f"`{DRUG_COLUMNS[1]}`").alias("atc_code")
    )


def read_classification_map(spark: SparkSession, base: str, extra: str | None = None) -> DataFrame:
    """Classification name and stage to a code and an optional value code."""
    rows = read_code_map(
        spark, base, extra, CLASSIFICATION_COLUMNS[:2], "code_code", ignore=()
    )
    return rows.select(*CLASSIFICATION_COLUMNS)


def code_lookup(
    df: DataFrame,
    code: Column,
    codelist: DataFrame,
    system: str,
    display: str = "display",
    error: str = "code_error",
) -> DataFrame:
    """Add the display text of a code; an unlisted code sets the error column.

    The list (``system, code, display``) is reduced to one row per code. Its size decides whether
    the planner broadcasts it.
    """
    listed = (
        codelist.filter(F.col("system") == system)
        .groupBy(F.col("code").alias("__code"))
        .agg(F.min("display").alias("__display"), F.lit(1).alias("__listed"))
    )
    joined = df.withColumn("__lookup", code).join(listed, F.col("__lookup") == F.col("__code"), "left")
    unlisted = F.col("__lookup").isNotNull() & F.col("__listed").isNull()
    return (
        joined.withColumn(display, F.col("__display"))
        .withColumn(error, F.when(unlisted, F.concat(F.lit(f"not in {system}: "), F.col("__lookup"))))
        .drop("__lookup", "__code", "__display", "__listed")
    )
