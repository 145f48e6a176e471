"""From parsed documents to one row per report: explode, patient ids, order, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.ids import resource_id, slugify
from oncolake.operators.consolidate import COMPLETED, STATUS_CHANGE
from oncolake.operators.patient_reference import patient_reference
from oncolake.operators.staging import rank_in_groups
from oncolake.schemas import COMMON, SECTIONS


def explode_reports(df: DataFrame, document: str = "document") -> DataFrame:
    """One row per report with its patient; a patient without reports keeps one row.

    Adds ``patient_pos, report_pos, source_patient_id, master, report_id, tumor_id, report_date``
    and the whole ``report``. Other columns pass through.
    """
    others = [name for name in df.columns if name != document]
    patients = df.select(
        *others,
        F.col(document)["Meldedatum"].alias("recorded"),
        F.posexplode_outer(F.col(document)["Menge_Patient"]["Patient"]).alias(
            "patient_pos", "patient"
        ),
    )
    reports = patients.select(
        *others,
        "recorded",
        F.coalesce("patient_pos", F.lit(0)).alias("patient_pos"),
        F.col("patient")["_Patient_ID"].alias("source_patient_id"),
        F.col("patient")["Patienten_Stammdaten"].alias("master"),
        F.posexplode_outer(F.col("patient")["Menge_Meldung"]["Meldung"]).alias(
            "report_pos", "report"
        ),
    )
    report = F.col("report")
    return reports.select(
        *others,
        "patient_pos",
        F.coalesce("report_pos", F.lit(0)).alias("report_pos"),
        "source_patient_id",
        "master",
        report["_Meldung_ID"].alias("report_id"),
        report["Tumorzuordnung"]["_Tumor_ID"].alias("tumor_id"),
        F.try_to_date(F.substring("recorded", 1, 10), "yyyy-MM-dd").alias("report_date"),
        "report",
    )


def normalize_patient_id(
    df: DataFrame,
    regex: str = DEFAULT.patient_id_regex,
    source: str = "source_patient_id",
    target: str = "patient_id",
) -> DataFrame:
    """Capture group 1 of a full match on the trimmed id; ``patient_id_error`` tells why not."""
    trimmed = F.trim(F.col(source))
    pattern = f"^(?:{regex})$"
    matches = F.coalesce(trimmed.rlike(pattern), F.lit(False))
    value = F.nullif(F.regexp_extract(trimmed, pattern, 1), F.lit(""))
    return df.withColumn(target, F.when(matches, value)).withColumn(
        f"{target}_error",
        F.when(
            ~matches | value.isNull(),
            F.concat(F.lit("patient id does not match: "), F.coalesce(F.col(source), F.lit("none"))),
        ),
    )


def report_priority(report: Column) -> Column:
    """0 normal, 1 or 2 for reports that must be processed after others of the same therapy."""

    def reason(section):
        return F.lower(report[section]["Meldeanlass"])

    done = lambda section: F.when(reason(section) == COMPLETED, 2).otherwise(0)
    board = (
        F.when(reason("Tumorkonferenz") == COMPLETED, 2)
        .when(reason("Tumorkonferenz") == STATUS_CHANGE, 1)
        .otherwise(0)
    )
    return (
        F.when(report["ST"].isNotNull(), done("ST"))
        .when(report["SYST"].isNotNull(), done("SYST"))
        .when(report["Tumorkonferenz"].isNotNull(), board)
        .when(
            report["Verlauf"].isNotNull(),
            F.when(reason("Verlauf") == STATUS_CHANGE, 2).otherwise(0),
        )
        .otherwise(0)
    )


def with_rank_key(df: DataFrame) -> DataFrame:
    """Add ``rank_key``, whose natural order is the processing order of a patient's reports.

    Diagnosis reports come last so that they overwrite the incomplete conditions of others; before
    that the reason decides, then (after consolidation) section and date, then the position.
    Comparing keys replaces numbering rows, so no window over a patient is needed.
    """
    consolidated = "section_rank" in df.columns
    return df.withColumn(
        "rank_key",
        F.struct(
            F.when(F.col("report")["Diagnose"].isNotNull(), 1).otherwise(0).alias("has_diagnosis"),
            report_priority(F.col("report")).alias("priority"),
            (F.col("section_rank") if consolidated else F.lit(0)).alias("section_rank"),
            (F.col("report_date") if consolidated else F.lit(None)).cast("date").alias("report_date"),
            (F.lit(0) if consolidated else F.col("report_pos")).cast("bigint").alias("pos"),
            F.col("report_id").alias("report_id"),
        ).cast(COMMON["rank_key"]),
    )


def rank_reports(
    df: DataFrame,
    keys: tuple[str, ...] = ("patient_id",),
    order: tuple[str | Column, ...] = ("rank_key",),
    name: str = "report_rank",
) -> DataFrame:
    """Number the rows of each group in processing order, safe for a hot patient."""
    return rank_in_groups(df, keys, list(order), name)


def with_references(df: DataFrame, cfg: MappingConfig = DEFAULT, lookup: DataFrame | None = None) -> DataFrame:
    """Add patient reference columns and the primary condition's identifier and id."""
    referenced = patient_reference(df, cfg, lookup=lookup)
    value = slugify(F.concat_ws("-", "patient_id", "tumor_id"))
    return referenced.withColumn(
        "condition_value", F.when(F.col("tumor_id").isNotNull(), value)
    ).withColumn("condition_id", primary_condition_id(cfg))


def primary_condition_id(cfg: MappingConfig = DEFAULT) -> Column:
    """The id of a report's primary condition, from its identifier."""
    return resource_id(cfg.identifier_system("primaerdiagnose-condition-id"), F.col("condition_value"))


def own_patient_id(cfg: MappingConfig = DEFAULT) -> Column:
    """The id under which a patient not known elsewhere is written."""
    patient = F.col("patient_id")
    return patient if cfg.use_source_patient_id else resource_id(cfg.identifier_system("patient-id"), patient)


def entries_bundle_id(cfg: MappingConfig = DEFAULT) -> Column:
    """The id ``patient_policy`` gives a patient, as an aggregate over the patient's entries.

    The id of a known patient, where it is taken over, is the one all entries refer to.
    """
    own = F.max(own_patient_id(cfg))
    looked_up = cfg.patient_reference_strategy in ("record_id", "existing")
    if not (looked_up and cfg.create_patients and cfg.create_patient_if_exists):
        return own
    return F.coalesce(F.max(F.substring_index("subject_ref", "/", -1)), own)


def patient_policy(df: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Decide per row whether the patient is written and which id the bundle carries.

    Adds ``write_patient`` and ``bundle_id``; drops patients nobody knows when so configured.
    """
    known = F.col("patient_exists")
    write = F.lit(cfg.create_patients) & (~known | F.lit(cfg.create_patient_if_exists))
    reuse = write & known & F.lit(cfg.create_patient_if_exists)
    decided = df.withColumn("write_patient", write).withColumn(
        "bundle_id",
        F.when(reuse, F.substring_index("patient_ref", "/", -1)).otherwise(own_patient_id(cfg)),
    )
    if cfg.skip_unknown_patients:
        decided = decided.filter(known | F.col("patient_ref").isNotNull())
    return decided


def section_set(report: Column) -> Column:
    """Names of the sections a report carries, joined by ``+``; a cheap partition column."""
    names = [F.when(report[name].isNotNull(), F.lit(name)) for name in SECTIONS]
    return F.concat_ws("+", *names)


def prepare_reports(
    documents: DataFrame,
    cfg: MappingConfig = DEFAULT,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Documents to mapping-ready reports: explode, patient id, references, policy, order, sections.

    Rows whose patient id does not match are kept with ``patient_id_error`` set; split them off
    with ``split_quarantine``.
    """
    reports = normalize_patient_id(explode_reports(documents), cfg.patient_id_regex)
    if "source_document" not in reports.columns:
        reports = reports.withColumn("source_document", F.lit(None).cast("string"))
    ready = patient_policy(with_references(reports, cfg, lookup), cfg)
    return with_rank_key(ready).withColumn("sections", section_set(F.col("report")))
