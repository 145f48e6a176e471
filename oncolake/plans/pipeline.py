"""Reports to resource tables, envelopes and bundles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake import resources as R
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import application_code, gleason_score
from oncolake.functions.ids import resource_id, slugify
from oncolake.operators.bundles import add_provenance, build_bundles, upsert_entries
from oncolake.operators.consolidate import bundle_key, current_reports
from oncolake.operators.deidentify import keyed_hash
from oncolake.operators.deidentify_rules import Deidentifier
from oncolake.operators.patient_reference import patient_reference
from oncolake.operators.reports import (
    entries_bundle_id,
    patient_policy,
    prepare_reports,
    primary_condition_id,
    with_rank_key,
)
from oncolake.operators.staging import stage_table
from oncolake.resources.outcomes import PROGRESS_LISTS
from oncolake.resources.envelope import BodyChange, to_envelope
from oncolake.schemas import SECTIONS
from oncolake.sources.reports import parse_reports, split_errors, with_error

# Sections whose reports a job reads; with staged reports only those partitions are scanned.
JOB_SECTIONS = {
    "performance_status": ("Diagnose", "Verlauf"),
    "metastases": ("Diagnose", "Verlauf", "Pathologie"),
    "specimens": ("Diagnose", "Verlauf", "OP", "Pathologie"),
    "course_histology": ("Verlauf", "OP", "Pathologie"),
    "grading": ("Diagnose", "Verlauf", "OP", "Pathologie"),
    "lymph_nodes": ("Diagnose", "Verlauf", "OP", "Pathologie"),
    "study_participation": ("Diagnose", "Verlauf", "SYST", "ST", "OP"),
    "genetic_variants": ("Diagnose", "Verlauf", "OP", "Pathologie"),
    "tnm": ("Diagnose", "Verlauf", "OP", "Pathologie"),
    "prostate_module": ("Diagnose", "Verlauf", "OP", "Pathologie"),
    "classifications": ("Diagnose", "Verlauf", "Pathologie"),
    "evidence_lists": ("Diagnose",),
    "earlier_tumours": ("Diagnose",),
    "progress": ("Verlauf",),
    "systemic_procedures": ("SYST",),
    "medication_statements": ("SYST",),
    "medications": ("SYST",),
    "adverse_events": ("SYST", "ST"),
    "radiotherapy": ("ST",),
    "deaths": ("Tod",),
    "surgeries": ("OP",),
    "residual_status": ("OP",),
    "pathology_reports": ("Pathologie",),
    "tumour_boards": ("Tumorkonferenz",),
}
OBSERVATION_JOBS = (
    "performance_status metastases course_histology grading lymph_nodes study_participation "
    "genetic_variants tnm prostate_module classifications progress deaths residual_status"
).split()


def with_sections(reports: DataFrame, sections: tuple[str, ...]) -> DataFrame:
    """Reports that carry any of the sections."""
    wanted = [F.array_contains(F.split("sections", r"\+"), name) for name in sections]
    return reports.filter(reduce(lambda a, b: a | b, wanted))


def run_job(reports: DataFrame, job: str, cfg: MappingConfig = DEFAULT, **maps) -> DataFrame:
    """One mapping job over the reports that can feed it."""
    return getattr(R, f"map_{job}")(with_sections(reports, JOB_SECTIONS[job]), cfg, **maps)


def map_observations(
    reports: DataFrame,
    cfg: MappingConfig = DEFAULT,
    classification_map: DataFrame | None = None,
    jobs: tuple[str, ...] | None = None,
) -> DataFrame:
    """All observations (or those of some jobs) in one table."""
    tables = []
    for job in jobs or OBSERVATION_JOBS:
        maps = {"code_map": classification_map} if job == "classifications" else {}
        tables.append(run_job(reports, job, cfg, **maps))
    return reduce(DataFrame.unionByName, tables)


def map_procedures(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Surgery, radiotherapy and systemic therapy procedures in one table."""
    tables = [run_job(reports, j, cfg) for j in ("surgeries", "radiotherapy", "systemic_procedures")]
    return reduce(DataFrame.unionByName, tables)


RESOURCE_TYPES = (
    "Patient Condition Observation Procedure MedicationStatement Medication Specimen "
    "DiagnosticReport AdverseEvent CarePlan List"
).split()


def map_all(
    reports: DataFrame,
    cfg: MappingConfig = DEFAULT,
    drug_map: DataFrame | None = None,
    classification_map: DataFrame | None = None,
    patient_group: tuple[str, ...] = ("patient_id",),
    types: tuple[str, ...] | None = None,
    observation_jobs: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """Every resource table (or those of some types), keyed by resource type.

    Stage the reports first; many jobs read them.
    """
    job = lambda name, **maps: run_job(reports, name, cfg, **maps)
    makers = {
        "Patient": lambda: R.map_patients(reports, cfg, patient_group),
        "Condition": lambda: R.map_conditions(reports, cfg).unionByName(job("earlier_tumours")),
        "Observation": lambda: map_observations(reports, cfg, classification_map, observation_jobs),
        "Procedure": lambda: map_procedures(reports, cfg),
        "MedicationStatement": lambda: job("medication_statements", drug_map=drug_map),
        "Medication": lambda: job("medications", drug_map=drug_map),
        "Specimen": lambda: job("specimens"),
        "DiagnosticReport": lambda: job("pathology_reports"),
        "AdverseEvent": lambda: job("adverse_events"),
        "CarePlan": lambda: job("tumour_boards"),
        "List": lambda: job("evidence_lists"),
    }
    wanted = [kind for kind in types or RESOURCE_TYPES if kind != "Patient" or cfg.create_patients]
    return {kind: makers[kind]() for kind in wanted}


def needed_reports(
    reports: DataFrame, types: tuple[str, ...] | None = None, observation_jobs: tuple[str, ...] | None = None
) -> DataFrame:
    """Reports as ``map_all`` reads them for some types: without sections that none of their jobs reads.

    Patients and conditions come from every report; without them, reports that have none of the sections
    go as well. Stage what comes out instead of whole reports.
    """
    jobs = {*(observation_jobs or OBSERVATION_JOBS)} if "Observation" in (types or RESOURCE_TYPES) else set()
    jobs |= {job for job, kind in JOB_TYPE.items() if kind in (types or RESOURCE_TYPES)}
    read = {name for job in jobs for name in JOB_SECTIONS[job]}
    every = {"Patient": "Tod", "Condition": "Diagnose"}
    whole = {name for kind, name in every.items() if kind in (types or RESOURCE_TYPES)}
    rows = reports if whole else with_sections(reports, tuple(sorted(read)))
    unread = [name for name in SECTIONS if name not in read | whole]
    return rows.withColumn("report", F.col("report").dropFields(*unread)) if unread else rows


#: What a report's patient and condition identifiers give without a lookup.
REFERENCES = (
    "patient_ref", "patient_identifier", "patient_exists", "patient_ref_error",
    "condition_id", "write_patient", "bundle_id",
)


def stage_reports(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Prepared reports, staged by section.

    Without a lookup the references follow from the ids beside them. They are hashes, most of a report's
    bytes on disk, so they are not written but derived again by those who read them.
    """
    if cfg.patient_reference_strategy in ("record_id", "existing"):
        return stage_table(reports, "reports", ["sections"])
    staged = stage_table(reports.drop(*REFERENCES), "reports", ["sections"])
    derived = patient_policy(patient_reference(staged, cfg), cfg).withColumn("condition_id", primary_condition_id(cfg))
    return derived.select(*reports.columns)


def to_envelopes(
    tables: dict[str, DataFrame], cfg: MappingConfig = DEFAULT, change: BodyChange | None = None
) -> DataFrame:
    """One uniform table of all resources; the patient comes first in its bundle.

    ``change`` may alter resources before they are written, as de-identification does.
    """
    parts = []
    for kind, table in tables.items():
        rows = to_envelope(table, kind, cfg, change)
        if kind == "Patient":
            rows = rows.withColumn("rank_key", F.lit(None).cast(rows.schema["rank_key"].dataType))
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts)


# The jobs of each section.
SECTION_JOBS = {
    "Diagnose": "performance_status metastases specimens grading lymph_nodes study_participation "
    "genetic_variants tnm prostate_module classifications evidence_lists earlier_tumours",
    "Verlauf": "progress metastases performance_status specimens course_histology grading "
    "lymph_nodes study_participation genetic_variants tnm prostate_module classifications",
    "SYST": "systemic_procedures medication_statements medications study_participation adverse_events",
    "ST": "radiotherapy study_participation adverse_events",
    "OP": "surgeries residual_status specimens course_histology grading lymph_nodes "
    "study_participation genetic_variants tnm prostate_module",
    "Pathologie": "specimens course_histology grading lymph_nodes metastases genetic_variants tnm "
    "prostate_module classifications pathology_reports",
    "Tod": "deaths",
    "Tumorkonferenz": "tumour_boards",
}
JOB_TYPE = {
    "systemic_procedures": "Procedure",
    "radiotherapy": "Procedure",
    "surgeries": "Procedure",
    "medication_statements": "MedicationStatement",
    "medications": "Medication",
    "specimens": "Specimen",
    "pathology_reports": "DiagnosticReport",
    "adverse_events": "AdverseEvent",
    "tumour_boards": "CarePlan",
    "evidence_lists": "List",
    "earlier_tumours": "Condition",
}


def _section_tables(
    reports: DataFrame, section: str, cfg: MappingConfig, **maps: DataFrame
) -> list[tuple[str, DataFrame]]:
    """Resource type and rows of every job of a section."""
    rows = with_sections(reports, (section,))
    tables = []
    for job in SECTION_JOBS[section].split():
        extra = {}
        if job in ("medication_statements", "medications"):
            extra = {"drug_map": maps.get("drug_map")}
        if job == "classifications":
            extra = {"code_map": maps.get("classification_map")}
        table = getattr(R, f"map_{job}")(rows, cfg, **extra)
        tables.append(
            (JOB_TYPE.get(job, "Observation"), table.filter(F.col("source_section") == section))
        )
    return tables


def _envelopes_by_type(tables: list[tuple[str, DataFrame]], cfg: MappingConfig) -> DataFrame:
    """Tables of one type are put together first, so that a type's JSON is built once."""
    grouped: dict[str, list[DataFrame]] = {}
    for kind, table in tables:
        grouped.setdefault(kind, []).append(table)
    return to_envelopes(
        {kind: reduce(DataFrame.unionByName, parts) for kind, parts in grouped.items()}, cfg
    )


def _section_mapper(section: str) -> Callable[..., DataFrame]:
    def map_section(reports: DataFrame, cfg: MappingConfig = DEFAULT, **maps: DataFrame) -> DataFrame:
        return _envelopes_by_type(_section_tables(reports, section, cfg, **maps), cfg)

    map_section.__doc__ = f"Envelopes of everything the {section} section of a report gives rise to."
    return map_section


map_diagnosis_section = _section_mapper("Diagnose")
map_progress_section = _section_mapper("Verlauf")
map_systemic_section = _section_mapper("SYST")
map_radiotherapy_section = _section_mapper("ST")
map_surgery_section = _section_mapper("OP")
map_pathology_section = _section_mapper("Pathologie")
map_death_section = _section_mapper("Tod")
map_board_section = _section_mapper("Tumorkonferenz")


def dispatch_sections(reports: DataFrame, cfg: MappingConfig = DEFAULT, **maps: DataFrame) -> DataFrame:
    """Envelopes of the conditions and of every section present."""
    tables = [("Condition", R.map_conditions(reports, cfg))]
    for section in SECTION_JOBS:
        tables += _section_tables(reports, section, cfg, **maps)
    return _envelopes_by_type(tables, cfg)


def report_checks() -> dict[str, Column]:
    """Conditions (or error texts) under which a report cannot be mapped and goes to quarantine."""
    report = F.col("report")
    blank = lambda value: value.isNull() | (F.trim(value) == "")

    def missing_id(section, field):
        return report[section].isNotNull() & blank(report[section][field])

    checks = {
        "patient id does not match": F.col("patient_id_error").isNotNull(),
        "patient reference is ambiguous": F.col("patient_ref_error").isNotNull(),
        "report without tumour assignment": report.isNotNull() & blank(F.col("tumor_id")),
        "report without id": report.isNotNull() & blank(F.col("report_id")),
        "board without id": missing_id("Tumorkonferenz", "_Tumorkonferenz_ID"),
        "surgery without id": missing_id("OP", "_OP_ID"),
        "radiotherapy without id": missing_id("ST", "_ST_ID"),
        "systemic therapy without id": missing_id("SYST", "_SYST_ID"),
        "progress without id": missing_id("Verlauf", "_Verlauf_ID"),
        "substance without code and name": F.exists(
            report["SYST"]["Menge_Substanz"]["Substanz"],
            lambda s: blank(s["ATC"]["Code"]) & s["Bezeichnung"].isNull(),
        ),
        "irradiation with unknown application": F.exists(
            report["ST"]["Menge_Bestrahlung"]["Bestrahlung"],
            lambda b: b["Applikationsart"].isNotNull() & application_code(b["Applikationsart"]).isNull(),
        ),
    }
    progress = report["Verlauf"]
    for field, entries in PROGRESS_LISTS.items():
        checks[f"unknown code in {field}"] = ~F.upper(progress[field]).isin(*entries)
    for section in ("Diagnose", "Verlauf", "OP", "Pathologie"):
        score = report[section]["Modul_Prostata"]["GleasonScore"]
        text = gleason_score(score["GradPrimaer"], score["GradSekundaer"], score["ScoreErgebnis"])
        checks[f"Gleason score of {section} does not match"] = score.isNotNull() & ~F.coalesce(
            text.rlike(r"^\d{1,2}[ab]?$"), F.lit(False)
        )
    rules = {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}
    return {"unreadable": F.col("parse_error"), **rules}


def prepare_documents(
    raw: DataFrame, cfg: MappingConfig = DEFAULT, lookup: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Document texts to (mappable reports, quarantined reports); stages the decoded reports once."""
    parsed = raw if "document" in raw.columns else parse_reports(raw, schema_path=cfg.schema_path)
    if "parse_error" not in parsed.columns:
        parsed = parsed.withColumn("parse_error", F.lit(None).cast("string"))
    numbered = prepare_reports(parsed, cfg, lookup).withColumn("row_id", F.monotonically_increasing_id())
    # Errors are written with the reports: to find them takes most of a report, to read them one column.
    return split_errors(stage_table(with_error(numbered, report_checks()), "reports"))


def consolidated(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Newest versions, winning therapy reports, in processing order; staged by section.

    ``reports`` as ``prepare_documents`` stages them, with their ``row_id``.
    """
    current = current_reports(reports, "row_id", cfg.include_pathology)
    picked = with_rank_key(current.drop("rank_key"))
    return stage_table(picked.drop("section", "row_id"), "consolidated", ["sections"])


def bundle_entries(
    reports: DataFrame,
    cfg: MappingConfig = DEFAULT,
    keys: tuple[str, ...] = ("patient_id",),
    drug_map: DataFrame | None = None,
    classification_map: DataFrame | None = None,
    change: BodyChange | None = None,
) -> DataFrame:
    """Upserted envelope rows of staged reports, one per bundle and resource.

    ``change`` alters the resources, not the columns beside them.
    """
    tables = map_all(reports, cfg, drug_map, classification_map, keys)
    envelopes = to_envelopes(tables, cfg, change)
    if cfg.create_provenance:
        envelopes = stage_table(envelopes, "envelopes")
        provenance = to_envelope(add_provenance(envelopes, cfg), "Provenance", cfg, change)
        envelopes = envelopes.unionByName(provenance)
    return upsert_entries(envelopes, [*keys, "full_url"])


def reports_to_bundles(
    raw: DataFrame,
    cfg: MappingConfig = DEFAULT,
    by_tumor: bool = True,
    lookup: DataFrame | None = None,
    drug_map: DataFrame | None = None,
    classification_map: DataFrame | None = None,
    max_entries: int | None = None,
    hide: Deidentifier | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Report exports to (bundles, quarantine), consolidated per patient and tumour.

    ``raw`` has ``export_id, version, xml`` (or a decoded ``document``). Bundle id and key hold the id
    under which the patient is written. ``max_entries`` cuts bundles into parts with ids and keys of
    their own; without it each is whole. With ``hide`` no identifier of the source leaves: resources,
    bundles and keys follow its rules, and of the quarantine only hashed ids and errors are returned.
    """
    good, bad = prepare_documents(raw, cfg, lookup)
    keys = ("patient_id", "tumor_id") if by_tumor else ("patient_id",)
    reports = consolidated(good.filter(F.col("report").isNotNull()), cfg)
    change = hide.change if hide else None
    entries = stage_table(
        bundle_entries(reports, cfg, keys, drug_map, classification_map, change), "entries"
    )
    bundle_id = entries_bundle_id(cfg)
    condition = F.lit(None).cast("string")
    if by_tumor:
        value = slugify(F.concat_ws("-", "patient_id", "tumor_id"))
        system = cfg.identifier_system("primaerdiagnose-condition-id")
        condition = F.when(F.col("tumor_id").isNotNull(), resource_id(system, value))
    shown = entries
    if hide:
        bundle_id, condition = hide.text("Bundle.id", bundle_id), hide.text("Resource.id", condition)
        shown = entries.withColumns({
            "full_url": hide.text("Bundle.entry.fullUrl", F.col("full_url")),
            "request_url": hide.text("Bundle.entry.request.url", F.col("full_url")),
        })
    bundles = build_bundles(shown, keys, bundle_id, max_entries)
    # The patient's id is that of part 0; further parts add their number to the key.
    whole = entries.groupBy("patient_id").agg(bundle_id.alias("__patient"))
    keyed = bundles.join(whole, "patient_id") if max_entries else bundles.withColumn("__patient", F.col("bundle_id"))
    key = bundle_key(F.col("__patient"), condition)
    key = F.when(F.col("part") == 0, key).otherwise(F.concat_ws(" - Part/", key, "part"))
    bundles = keyed.withColumn("bundle_key", key).drop("__patient")
    if hide:
        bundles = bundles.withColumns({name: keyed_hash(F.col(name), hide.key) for name in keys})
        ids = [keyed_hash(F.col(c), hide.key).alias(c) for c in ("patient_id", "report_id")]
        bad = bad.select(*ids, F.regexp_replace("error", "'[^']*'", "'...'").alias("error"))
    return bundles, bad


def documents_to_bundles(
    raw: DataFrame,
    cfg: MappingConfig = DEFAULT,
    document_key: str = "file_name",
    drug_map: DataFrame | None = None,
    classification_map: DataFrame | None = None,
    max_entries: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Directory mode: every document by itself, (one bundle per document and patient, quarantine).

    ``document_key`` names the column that identifies a document.
    """
    good, bad = prepare_documents(raw.withColumn("source_document", F.col(document_key)), cfg)
    keys = ("source_document", "patient_id")
    entries = stage_table(bundle_entries(good, cfg, keys, drug_map, classification_map), "entries")
    return build_bundles(entries, keys, entries_bundle_id(cfg), max_entries), bad
