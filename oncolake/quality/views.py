"""Flat views of resources and the joined views the suites check.

Dates stay ISO text of their own precision, whose order is the order of the dates. Joins are written
so that a patient with a large share of all rows only makes the splittable side large, and pairs
within a patient are never formed.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, NumericType, StringType

from oncolake import config as C
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.ids import packed, packed_reference, unpacked
from oncolake.operators.staging import full_join_hot_left, left_join_hot_right
from oncolake.quality.paths import extract_paths


def extract_view(
    df: DataFrame, columns: dict[str, Column], repeated: dict[str, Column] | None = None, keep_packed: bool = False
) -> DataFrame:
    """Distinct rows of projected columns; each ``repeated`` list is un-nested to rows first.

    Projected columns may use the un-nested element under its name. ``keep_packed`` leaves hashed ids as
    they went through the shuffle.
    """
    for name, items in (repeated or {}).items():
        df = df.withColumn(name, F.explode_outer(items))
    rows = pack_ids(df.select(*[c.alias(name) for name, c in columns.items()])).distinct()
    return rows if keep_packed else unpack_ids(rows)


#: Columns of the views that hold hashed ids or references to them; they travel packed.
IDS = (
    "patient_id", "condition_id", "observation_id", "procedure_id", "medication_statement_id",
    "subject_reference", "subject_reference_procedure", "reason_reference_condition_id",
)


def _ids(df: DataFrame, kind: DataType) -> list[str]:
    return [field.name for field in df.schema.fields if field.name in IDS and field.dataType == kind]


def _changed(df: DataFrame, names: list[str], change) -> DataFrame:
    return df.withColumns({name: change(F.col(name)) for name in names}) if names else df


def pack_ids(df: DataFrame) -> DataFrame:
    """The rows with packed ids, as they go into a shuffle."""
    return _changed(df, _ids(df, StringType()), packed)


def unpack_ids(df: DataFrame, *before: DataFrame) -> DataFrame:
    """The rows as they were before ``pack_ids``; those ids that tables ``before`` had packed stay so."""
    kept = {name for table in before for name in _ids(table, BinaryType())}
    return _changed(df, [name for name in _ids(df, BinaryType()) if name not in kept], unpacked)


def where_system(codings: Column, system: str) -> Column:
    """The codings of one code system."""
    return F.filter(codings, lambda c: c["system"] == system)


def _first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


BASE_TABLES = {
    "patients": "Patient",
    "conditions": "Condition",
    "observations": "Observation",
    "procedures": "Procedure",
    "medication_statements": "MedicationStatement",
}


def base_paths(cfg: MappingConfig = DEFAULT) -> dict[str, dict[str, str]]:
    """The base views as tables of paths."""
    icd = f"code.coding.where(system='{C.ICD10GM}')"
    ops = f"code.coding.where(system='{C.OPS}')"
    death = cfg.code_system("tod")
    return {
        "patients": {
            "patient_id": "id",
            "gender": "gender",
            "date_of_birth": "birthDate",
            "deceased_date_time": "deceasedDateTime",
            "deceased": "deceasedBoolean",
        },
        "conditions": {
            "condition_id": "id",
            "icd_code": f"{icd}.code",
            "icd_version": f"{icd}.version",
            "subject_reference": "subject.reference",
            "asserted_date": f"extension('{C.ASSERTED_DATE}').valueDateTime.first()",
            "recorded_date": "recordedDate",
            "meta_profile_con": "meta.profile",
        },
        "observations": {
            "observation_id": "id",
            "subject_reference": "subject.reference",
            "code_system": "code.coding.system",
            "code_code": "code.coding.code.first()",
            "value_codeable_concept_coding_code": "valueCodeableConcept.coding.code",
            "value_codeable_concept_coding_system": "valueCodeableConcept.coding.system",
            "effective_date_time": "effectiveDateTime",
            "meta_profile": "meta.profile.first()",
            "interpretation_tod_tumorbedingt_code": f"interpretation.coding.where(system='{death}').code",
        },
        "procedures": {
            "procedure_id": "id",
            "ops_system": f"{ops}.system.first()",
            "ops_version": f"{ops}.version.first()",
            "ops_code": f"{ops}.code.first()",
            "subject_reference_procedure": "subject.reference",
            "performed_date_time": "performedDateTime",
            "performed_period_start": "performedPeriod.start",
            "meta_profile_procedure": "meta.profile.first()",
            "reason_reference_condition_id": "reasonReference.reference.referenceId()",
        },
        "medication_statements": {
            "medication_statement_id": "id",
            "subject_reference": "subject.reference",
            "effective_period_start": "effectivePeriod.start",
            "effective_period_end": "effectivePeriod.end",
            "meta_profile": "meta.profile.first()",
        },
    }


def views_from_resources(tables: dict[str, DataFrame], cfg: MappingConfig = DEFAULT) -> dict[str, DataFrame]:
    """Base views from decoded resources (``read_bundles``), one per table that is given."""
    return {
        name: extract_paths(tables[BASE_TABLES[name]], paths)
        for name, paths in base_paths(cfg).items()
        if BASE_TABLES[name] in tables
    }


def views_from_tables(
    tables: dict[str, DataFrame], cfg: MappingConfig = DEFAULT, keep_packed: bool = False
) -> dict[str, DataFrame]:
    """The same base views from typed resource tables (``map_all``), without a detour over JSON.

    With ``keep_packed`` hashed ids stay packed, and do so through ``joined_view``.
    """
    col = F.col
    extract = partial(extract_view, keep_packed=keep_packed)
    ops = F.filter(col("code"), lambda c: c["system"] == C.OPS)
    makers = {
        "patients": lambda: extract(
            tables["Patient"],
            {
                "patient_id": col("id"),
                "gender": col("gender"),
                "date_of_birth": col("birth_date.value"),
                "deceased_date_time": col("deceased_date.value"),
                "deceased": F.when(col("deceased_date").isNull(), col("deceased")),
            },
        ),
        "conditions": lambda: extract(
            tables["Condition"],
            {
                "condition_id": col("id"),
                "icd_code": col("icd_coding")["code"],
                "icd_version": col("icd_coding")["version"],
                "subject_reference": col("patient_ref"),
                "asserted_date": col("asserted_date.value"),
                "recorded_date": col("recorded_date.value"),
                "meta_profile_con": col("profile"),
            },
            {"icd_coding": col("icd")},
        ),
        "observations": lambda: extract(
            tables["Observation"],
            {
                "observation_id": col("id"),
                "subject_reference": col("patient_ref"),
                "code_system": col("code_coding")["system"],
                "code_code": _first(col("code"))["code"],
                "value_codeable_concept_coding_code": col("value_coding")["code"],
                "value_codeable_concept_coding_system": col("value_coding")["system"],
                "effective_date_time": col("effective.value"),
                "meta_profile": col("profile"),
                "interpretation_tod_tumorbedingt_code": col("tod_coding")["code"],
            },
            {
                "code_coding": col("code"),
                "value_coding": col("value_codings"),
                "tod_coding": where_system(col("interpretation"), cfg.code_system("tod")),
            },
        ),
        "procedures": lambda: extract(
            tables["Procedure"],
            {
                "procedure_id": col("id"),
                "ops_system": _first(ops)["system"],
                "ops_version": _first(ops)["version"],
                "ops_code": _first(ops)["code"],
                "subject_reference_procedure": col("patient_ref"),
                "performed_date_time": col("performed.value"),
                "performed_period_start": col("period_start.value"),
                "meta_profile_procedure": col("profile"),
                "reason_reference_condition_id": col("reason_condition_id"),
            },
        ),
        "medication_statements": lambda: extract(
            tables["MedicationStatement"],
            {
                "medication_statement_id": col("id"),
                "subject_reference": col("patient_ref"),
                "effective_period_start": col("period_start.value"),
                "effective_period_end": col("period_end.value"),
                "meta_profile": col("profile"),
            },
        ),
    }
    return {name: make() for name, make in makers.items() if BASE_TABLES[name] in tables}


def with_patients(rows: DataFrame, patients: DataFrame, reference: str, how: str = "full") -> DataFrame:
    """Full outer (or ``inner``) join of referring rows and patients. Ids that come packed stay packed."""
    before = (rows, patients)
    if isinstance(patients.schema["patient_id"].dataType, BinaryType):
        key = packed_reference("Patient", F.col("patient_id"))
    else:
        key = packed(F.concat(F.lit("Patient/"), F.col("patient_id").cast("string")))
    rows, patients = pack_ids(rows), pack_ids(patients.withColumn("__key", key))
    key = patients["__key"]
    if how == "inner":
        joined = rows.join(patients, rows[reference] == key, "inner")
    else:
        joined = full_join_hot_left(rows, patients, rows[reference] == key, rows[reference], key)
    return unpack_ids(joined.drop("__key"), *before)


# Base views each suite's view is joined from.
NEEDS = {
    "conditions": ("conditions", "patients"),
    "observations": ("observations", "patients"),
    "procedures": ("procedures", "patients"),
    "medication_statements": ("medication_statements", "patients"),
    "condition_procedure": ("conditions", "procedures", "patients"),
    "metastases": ("observations", "patients"),
    "performance_death": ("observations", "patients"),
    "death_completeness": ("observations",),
    "death_dates": ("observations",),
}


# Suites without a join whose rules share one aggregation, so that they read their base view once.
READ_ONCE = ("death_completeness", "death_dates")


def patient_observations(base: dict[str, DataFrame]) -> DataFrame:
    """Observations with their patients, full outer; ``base`` may hold the join already."""
    if "patient_observations" in base:
        return base["patient_observations"]
    return with_patients(base["observations"], base["patients"], "subject_reference")


def joined_view(name: str, base: dict[str, DataFrame], cfg: MappingConfig = DEFAULT) -> DataFrame:
    """The view a suite checks, from the base views it needs."""

    def of_patients(rows: DataFrame, reference: str) -> DataFrame:
        return with_patients(rows, base["patients"], reference, "inner")

    def observed() -> DataFrame:
        return patient_observations(base)

    def deaths() -> DataFrame:
        return base["observations"].filter(F.col("meta_profile").startswith(cfg.profile("tod")))

    def treated() -> DataFrame:
        before = (base["conditions"], base["procedures"])
        conditions, procedures = (pack_ids(view) for view in before)
        joined = left_join_hot_right(
            conditions,
            procedures,
            conditions["condition_id"] == procedures["reason_reference_condition_id"],
            conditions["condition_id"],
            procedures["reason_reference_condition_id"],
        )
        return unpack_ids(joined, *before)

    makers = {
        "conditions": lambda: with_patients(base["conditions"], base["patients"], "subject_reference"),
        "observations": observed,
        "procedures": lambda: of_patients(base["procedures"], "subject_reference_procedure"),
        "medication_statements": lambda: of_patients(
            base["medication_statements"], "subject_reference"
        ),
        "condition_procedure": lambda: of_patients(treated(), "subject_reference"),
        "metastases": lambda: observed().filter(
            F.col("meta_profile").startswith(cfg.profile("fernmetastasen"))
        ),
        "performance_death": lambda: performance_and_death(observed(), cfg),
        "death_completeness": deaths,
        "death_dates": lambda: death_dates(deaths()),
    }
    return makers[name]()


def joined_views(base: dict[str, DataFrame], cfg: MappingConfig = DEFAULT) -> dict[str, DataFrame]:
    """All views whose base views are there, by suite name."""
    return {
        name: joined_view(name, base, cfg)
        for name, needed in NEEDS.items()
        if all(part in base for part in needed)
    }


def performance_and_death(patient_observations: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Performance observations with the death profiles of their patient, full outer.

    Death rows are first reduced to one row per patient and profile with their number, carried as
    ``row_weight``; a patient with many rows of both kinds gives no pairs, the weighted counts are
    those of the plain join.
    """
    ecog_system = cfg.code_system("allgemeiner-leistungszustand-ecog")
    performance = patient_observations.filter(
        F.col("value_codeable_concept_coding_system") == ecog_system
    ).select(
        "subject_reference",
        "value_codeable_concept_coding_code",
        "value_codeable_concept_coding_system",
    )
    deaths = (
        patient_observations.filter(F.col("meta_profile").startswith(cfg.profile("tod")))
        .groupBy(
            F.col("subject_reference").alias("subject_reference_death"),
            F.col("meta_profile").alias("meta_profile_death"),
        )
        .agg(F.count(F.lit(1)).alias("row_weight"))
    )
    joined = full_join_hot_left(
        performance,
        deaths,
        performance["subject_reference"] == deaths["subject_reference_death"],
        performance["subject_reference"],
        deaths["subject_reference_death"],
    )
    return joined.withColumn("row_weight", F.coalesce("row_weight", F.lit(1)))


def death_dates(deaths: DataFrame) -> DataFrame:
    """Number of distinct death dates per patient."""
    return deaths.groupBy("subject_reference").agg(
        F.count_distinct("effective_date_time").alias("distinct_dates_count")
    )


def duplicate_ids(view: DataFrame, column: str) -> DataFrame:
    """Ids that occur in more than one row."""
    return view.groupBy(column).count().filter(F.col("count") > 1)


def null_counts(view: DataFrame, column: str, group: str) -> DataFrame:
    """Rows without a value, per group."""
    return view.filter(F.col(column).isNull()).groupBy(group).count()


def row_counts(tables: dict[str, DataFrame], views: dict[str, DataFrame], names: dict[str, str]) -> DataFrame:
    """Rows read and rows extracted per resource type, as one table."""
    parts = []
    for kind, view in names.items():
        for stage, df in (("read", tables[kind]), ("extracted", views[view])):
            parts.append(
                df.agg(F.count(F.lit(1)).alias("rows")).select(
                    F.lit(kind).alias("resource_type"), F.lit(stage).alias("stage"), "rows"
                )
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def column_summary(view: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, smallest and largest value of a column.

    Mean and deviation are null for columns that are not numbers.
    """
    numeric = isinstance(view.schema[column].dataType, NumericType)
    number = F.col(column).cast("double") if numeric else F.lit(None).cast("double")
    return view.agg(
        F.count(column).alias("count"),
        F.avg(number).alias("mean"),
        F.stddev_samp(number).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def several_death_dates(dates: DataFrame) -> DataFrame:
    """All patients with more than one distinct death date, most dates first."""
    several = dates.filter(F.col("distinct_dates_count") > 1)
    return several.orderBy(F.desc("distinct_dates_count"), "subject_reference")
