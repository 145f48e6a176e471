"""Everything that hangs on a histology: specimens, grading, lymph nodes, course histology, reports.

The histology of a report is looked up once per section; the pathology report joins its specimen by
computing the same id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake import config as C
from oncolake import schemas
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import distinct_by_code
from oncolake.functions.codes import loinc, make_coding, many, one, snomed
from oncolake.functions.dates import report_partial_date
from oncolake.functions.ids import first_nonblank, resource_id, slugify
from oncolake.resources.base import (
    concept,
    effective_or_absent,
    observations,
    rows_of,
    section,
    typed,
)

SOURCES = ("Diagnose", "Verlauf", "OP", "Pathologie")

# Field, id suffix, profile, LOINC and SNOMED CT code of each lymph node count.
LYMPH_NODE_COUNTS = (
    ("LK_befallen", "befallen", "anzahl-befallene-lymphknoten", "21893-3", "443527007"),
    ("LK_untersucht", "untersucht", "anzahl-untersuchte-lymphknoten", "21894-1", "444025001"),
    (
        "Sentinel_LK_befallen",
        "befallen-sentinel",
        "anzahl-befallene-sentinel-lymphknoten",
        "92832-5",
        "1264491009",
    ),
    (
        "Sentinel_LK_untersucht",
        "untersucht-sentinel",
        "anzahl-untersuchte-sentinel-lymphknoten",
        "85347-3",
        "444411008",
    ),
)


def base_value(histology: Column, report_id: Column) -> Column:
    """The histology id, else the report id."""
    return first_nonblank(histology["_Histologie_ID"], report_id)


def specimen_id(cfg: MappingConfig, histology: Column, report_id: Column) -> Column:
    value = slugify(base_value(histology, report_id))
    return F.when(
        histology.isNotNull(), resource_id(cfg.identifier_system("histologie-specimen-id"), value)
    )


def histology_fanout(reports: DataFrame, job: str, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One row per histology of any section, with its base value."""
    rows = rows_of(reports, job, {s: section(s, "Histologie") for s in sources})
    return rows.withColumn("base", base_value(F.col("item"), F.col("report_id")))


def map_specimens(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """One specimen per histology."""
    item = F.col("item")
    return typed(
        histology_fanout(reports, "specimen"),
        cfg,
        schemas.SPECIMENS,
        "Specimen",
        "histologie-specimen-id",
        F.col("base"),
        cfg.profile("specimen"),
        accession_no=item["Histologie_EinsendeNr"],
        collected=report_partial_date(item["Tumor_Histologiedatum"]),
    )


def map_grading(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """The grade of each histology that has one."""
    rows = histology_fanout(reports, "grading").filter(F.col("item.Grading").isNotNull())
    item = F.col("item")
    return observations(
        rows,
        cfg,
        "grading",
        "grading-observation-id",
        F.concat(F.col("base"), F.lit("-grading")),
        "grading",
        category=one(make_coding(C.OBSERVATION_CATEGORY, "laboratory", "Laboratory")),
        code=many(
            loinc(cfg, "33732-9", "Histology grade [Identifier] in Cancer specimen"),
            snomed(cfg, "371469007", "Histologic grade of neoplasm (observable entity)"),
        ),
        specimen_id=specimen_id(cfg, item, F.col("report_id")),
        value_kind=F.lit("concept"),
        value_codings=concept(cfg, "grading", item["Grading"]),
        **effective_or_absent(item["Tumor_Histologiedatum"]),
    )


def map_lymph_nodes(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Up to four counts per histology: affected and examined nodes, ordinary and sentinel."""
    item = F.col("item")
    counts = [
        F.when(
            item[field].isNotNull(),
            F.struct(
                F.lit(number).alias("number"),
                item[field].alias("count"),
                F.lit(suffix).alias("suffix"),
                F.lit(cfg.profile(profile)).alias("profile"),
                F.lit(loinc_code).alias("loinc"),
                F.lit(snomed_code).alias("snomed"),
            ),
        )
        for number, (field, suffix, profile, loinc_code, snomed_code) in enumerate(LYMPH_NODE_COUNTS)
    ]
    rows = histology_fanout(reports, "lymph").withColumn(
        "node", F.explode(F.array_compact(F.array(*counts)))
    )
    return observations(
        rows,
        cfg,
        "lymph_nodes",
        "lymphknotenuntersuchung-observation-id",
        F.concat_ws("-", "base", "node.suffix"),
        F.col("node.profile"),
        seq=F.col("seq") + F.col("node.number"),
        category=one(make_coding(C.OBSERVATION_CATEGORY, "laboratory", "Laboratory")),
        code=many(loinc(cfg, F.col("node.loinc")), snomed(cfg, F.col("node.snomed"))),
        specimen_id=specimen_id(cfg, item, F.col("report_id")),
        value_kind=F.lit("quantity"),
        value_num=F.col("node.count").try_cast("int"),
        value_unit=F.lit("#"),
        value_unit_code=F.lit("1"),
        **effective_or_absent(item["Tumor_Histologiedatum"]),
    )


def map_course_histology(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """One observation per distinct morphology code, except for diagnosis reports."""
    rows = histology_fanout(reports, "course_histology", SOURCES[1:])
    rows = rows.select(
        "*", F.posexplode(distinct_by_code(F.col("item.Morphologie_ICD_O"))).alias("pos", "morphology")
    )
    item, code = F.col("item"), F.col("morphology.Code")
    return observations(
        rows,
        cfg,
        "course_histology",
        "verlaufshistologie-observation-id",
        F.concat(F.col("base"), F.lit("-ICDO3-"), code),
        "histologie-icdo3",
        seq=F.col("seq") + F.col("pos"),
        code=one(loinc(cfg, "59847-4", "Histology and Behavior ICD-O-3 Cancer")),
        effective=report_partial_date(item["Tumor_Histologiedatum"]),
        specimen_id=specimen_id(cfg, item, F.col("report_id")),
        value_kind=F.lit("concept"),
        value_codings=one(make_coding(C.ICDO3, code, version=F.col("morphology.Version"))),
        value_text=item["Morphologie_Freitext"],
    )


def map_pathology_reports(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """The diagnostic report of a pathology section; the whole finding text is the conclusion."""
    rows = rows_of(reports, "report", {"Pathologie": section("Pathologie")})
    item = F.col("item")
    conclusion = F.when(F.trim(item["Befundtext"]) != "", item["Befundtext"])
    return typed(
        rows,
        cfg,
        schemas.DIAGNOSTIC_REPORTS,
        "DiagnosticReport",
        "histologiebefund-diagnostic-report-id",
        first_nonblank(item["Befund_ID"], F.col("report_id")),
        cfg.profile("befund"),
        code=one(loinc(cfg, "22034-3", "Pathology report Cancer Narrative")),
        conclusion=conclusion,
        conclusion_absent=F.when(conclusion.isNull(), F.lit("unknown")),
        specimen_id=specimen_id(cfg, item["Histologie"], F.col("report_id")),
    )
