"""Primary and earlier tumour conditions and the evidence list of a first diagnosis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake import config as C
from oncolake import schemas
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import distinct_by_code
from oncolake.functions.codes import icd_coding, lookup, make_coding, many, one, onco, reference, snomed
from oncolake.functions.dates import partial_date, report_partial_date, year_date
from oncolake.functions.ids import first_nonblank, nonblank, resource_id, slugify, text_hash
from oncolake.resources.base import elements_of, rows_of, section, typed

# Laterality codes (SNOMED CT) and their display texts.
LATERALITY = {
    "L": ("7771000", "Left (qualifier value)"),
    "R": ("24028007", "Right (qualifier value)"),
    "B": ("51440002", "Right and left (qualifier value)"),
    "M": ("260528009", "Median (qualifier value)"),
    "T": ("385432009", "Not applicable (qualifier value)"),
    "U": ("261665006", "Unknown (qualifier value)"),
}


def _earlier_value(primary_value, item):
    """Identifier of an earlier tumour: primary value, code or text hash, and date."""
    code = first_nonblank(item["ICD"]["Code"], text_hash(_with_text(item["Freitext"])))
    return slugify(F.concat_ws("-", primary_value, code, item["Diagnosedatum"]))


def _with_text(text):
    return F.when(F.trim(text) != "", text)


def _earlier_usable(item):
    return item["ICD"]["Code"].isNotNull() | F.coalesce(F.trim(item["Freitext"]) != "", F.lit(False))


def _earlier_items():
    path = "Menge_Fruehere_Tumorerkrankung.Fruehere_Tumorerkrankung"
    return section("Diagnose", path)


def map_conditions(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """The primary condition of every report, incomplete unless it is a diagnosis report.

    Evidence list and earlier tumours belong to the same report, so their ids are computed in the
    row; no join is needed.
    """
    tumor = F.col("report")["Tumorzuordnung"]
    diagnosis = F.col("report")["Diagnose"]
    histology = diagnosis["Histologie"]
    with_parts = reports.filter(tumor.isNotNull() & F.col("condition_id").isNotNull()).withColumn(
        "__evidence", F.when(diagnosis.isNotNull(), _evidence_id(cfg))
    )
    single = tumor["Morphologie_ICD_O"]
    from_histology = F.transform(
        distinct_by_code(histology["Morphologie_ICD_O"]),
        lambda m: F.struct(
            m["Code"].alias("code"), m["Version"].alias("version"),
            histology["Morphologie_Freitext"].alias("text"),
        ),
    )
    from_tumor = F.when(
        single["Code"].isNotNull(),
        F.array(
            F.struct(single["Code"].alias("code"), single["Version"].alias("version"),
                     F.lit(None).cast("string").alias("text"))
        ),
    )
    topography = diagnosis["Primaertumor_Topographie_ICD_O"]
    free_text = diagnosis["Primaertumor_Topographie_Freitext"]
    side = tumor["Seitenlokalisation"]
    side_code = lookup(side, {k: v[0] for k, v in LATERALITY.items()})
    side_text = lookup(side, {k: v[1] for k, v in LATERALITY.items()})
    certainty = diagnosis["Diagnosesicherung"]
    earlier_system = F.lit(cfg.identifier_system("fruehere-tumorerkrankung-condition-id"))
    follows = F.transform(
        F.filter(_earlier_items(), _earlier_usable),
        lambda item: resource_id(earlier_system, _earlier_value(F.col("condition_value"), item)),
    )
    return typed(
        with_parts.withColumn("section", F.lit("Tumorzuordnung")).withColumn("seq", F.lit(1)),
        cfg,
        schemas.CONDITIONS,
        "Condition",
        "primaerdiagnose-condition-id",
        F.col("condition_value"),
        cfg.profile("diagnose-primaertumor"),
        slug=False,
        category=F.lit("primary"),
        icd=one(icd_coding(tumor["Primaertumor_ICD"]["Code"], tumor["Primaertumor_ICD"]["Version"])),
        incomplete=diagnosis.isNull(),
        morphology=F.when(histology.isNotNull(), from_histology).otherwise(from_tumor),
        topography=F.when(
            topography.isNotNull() | free_text.isNotNull(),
            F.struct(
                topography["Code"].alias("code"),
                topography["Version"].alias("version"),
                free_text.alias("text"),
            ),
        ),
        verification=F.when(
            certainty.isNotNull(),
            many(
                make_coding(C.CONDITION_VER_STATUS, "confirmed"),
                onco(cfg, "primaertumor-diagnosesicherung", certainty),
            ),
        ),
        laterality=F.when(
            side.isNotNull(),
            many(
                onco(cfg, "seitenlokalisation", side),
                F.when(side_code.isNotNull(), snomed(cfg, side_code, side_text)),
            ),
        ),
        asserted_date=report_partial_date(tumor["Diagnosedatum"]),
        recorded_date=partial_date(F.col("report_date").cast("string")),
        evidence_list_id=F.col("__evidence"),
        follows_condition_ids=follows,
    )


def _evidence_id(cfg: MappingConfig):
    value = slugify(F.concat_ws("-", "patient_id", "tumor_id"))
    return resource_id(cfg.identifier_system("erstdiagnose-evidenz-list-id"), value)


def map_evidence_lists(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """One list per diagnosis report with the observations that report gives rise to.

    The references are computed from the report itself. Diagnosis reports never yield diagnostic
    reports, so only observations can be listed.
    """
    from oncolake.resources.evidence import diagnosis_observation_ids

    rows = rows_of(
        reports, "evidence", {"Diagnose": section("Diagnose")}, {"report": F.col("report")}
    )
    return typed(
        rows,
        cfg,
        schemas.LISTS,
        "List",
        "erstdiagnose-evidenz-list-id",
        F.concat_ws("-", "patient_id", "tumor_id"),
        cfg.profile("liste-evidenz-erstdiagnose"),
        title=F.lit("Liste der Evidenz zum Erstdiagnosezeitpunkt"),
        status=F.lit("current"),
        mode=F.lit("snapshot"),
        entry_refs=F.transform(diagnosis_observation_ids(cfg), lambda i: reference("Observation", i)),
    )


def map_earlier_tumours(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Conditions for the earlier tumours of a diagnosis report; free text is the label if given."""
    rows = elements_of(
        reports, "earlier", {"Diagnose": _earlier_items()}, {"report_date": F.col("report_date")}
    ).filter(_earlier_usable(F.col("item")))
    item = F.col("item")
    code = nonblank(item["ICD"]["Code"])
    return typed(
        rows,
        cfg,
        schemas.CONDITIONS,
        "Condition",
        "fruehere-tumorerkrankung-condition-id",
        _earlier_value(F.col("condition_value"), item),
        cfg.profile("fruehere-tumorerkrankung"),
        slug=False,
        category=F.lit("earlier"),
        icd=one(icd_coding(code, item["ICD"]["Version"]), code.isNotNull()),
        code_text=first_nonblank(item["Freitext"], code),
        incomplete=F.lit(False),
        asserted_date=year_date(item["Diagnosedatum"]),
        recorded_date=partial_date(F.col("report_date").cast("string")),
    )


def earlier_tumour_links(conditions: DataFrame) -> DataFrame:
    """Pairs of a primary condition and the earlier tumours it followed."""
    return conditions.filter(F.col("category") == "primary").select(
        F.col("id").alias("condition_id"),
        "report_id",
        F.posexplode("follows_condition_ids").alias("pos", "earlier_condition_id"),
    )


