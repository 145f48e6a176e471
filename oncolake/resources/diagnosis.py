"""Metastases, genetics, performance status, study participation and other classifications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncolake import config as C
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import ecog_bucket
from oncolake.functions.codes import loinc, lookup, make_coding, many, one, onco, snomed
from oncolake.functions.dates import partial_date, report_partial_date
from oncolake.functions.ids import nonblank
from oncolake.operators.consolidate import pick_by_key
from oncolake.resources.base import (
    concept,
    effective_or_absent,
    elements_of,
    observations,
    rows_of,
    section,
)

# Answer codes of the ECOG grades.
ECOG_ANSWERS = {
    "0": "LA9622-7",
    "1": "LA9623-5",
    "2": "LA9624-3",
    "3": "LA9625-0",
    "4": "LA9626-8",
}


def map_metastases(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """One observation per distant metastasis; the position in its list is part of the id."""
    sources = ("Diagnose", "Verlauf", "Pathologie")
    rows = elements_of(
        reports, "metastases", {s: section(s, "Menge_FM.Fernmetastase") for s in sources}
    )
    item = F.col("item")
    site = nonblank(item["Lokalisation"])
    return observations(
        rows,
        cfg,
        "metastasis",
        "fernmetastasen-observation-id",
        F.concat_ws("-", "report_id", "section", "pos"),
        "fernmetastasen",
        code=one(
            snomed(
                cfg,
                "385421009",
                "Anatomic location of metastatic spread of malignant neoplasm (observable entity)",
            )
        ),
        value_kind=F.lit("concept"),
        value_codings=concept(cfg, "fernmetastasen", site),
        value_absent=F.when(site.isNull(), F.lit("unknown")),
        **effective_or_absent(item["Diagnosedatum"]),
    )


def map_genetic_variants(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """One observation per genetic variant with its expression as interpretation."""
    sources = ("Diagnose", "OP", "Verlauf", "Pathologie")
    rows = elements_of(
        reports, "genetics", {s: section(s, "Menge_Genetik.Genetische_Variante") for s in sources}
    )
    item = F.col("item")
    expression, other = item["Auspraegung"], item["Sonstige_Auspraegung"]
    code = F.coalesce(expression, F.when(other.isNotNull(), F.lit("S")))
    return observations(
        rows,
        cfg,
        "genetic_variant",
        "genetische-variante-observation-id",
        F.concat_ws("-", F.lit("GenetischeAusprägung"), "section", "report_id", expression, "pos"),
        "genetische-variante",
        category=many(
            make_coding(C.OBSERVATION_CATEGORY, "laboratory", "Laboratory"),
            make_coding(C.DIAGNOSTIC_SECTION, "GE", "Genetics"),
        ),
        code=one(loinc(cfg, "69548-6", "Genetic variant assessment")),
        effective=report_partial_date(item["Datum"]),
        interpretation=one(onco(cfg, "genetische-variante-auspraegung", code), code.isNotNull()),
        interpretation_text=F.when(expression.isNull(), other),
        note=item["Bezeichnung"],
    )


def map_performance_status(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """ECOG grade from an ECOG or Karnofsky value; the unknown grade has no answer code."""
    tumor_date = F.col("report")["Tumorzuordnung"]["Diagnosedatum"]
    rows = rows_of(
        reports,
        "performance",
        {s: section(s, "Allgemeiner_Leistungszustand") for s in ("Diagnose", "Verlauf")},
        {"diagnosed": tumor_date, "examined": section("Verlauf", "Untersuchungsdatum_Verlauf")},
    )
    grade = ecog_bucket(F.col("item"))
    answer = lookup(grade, ECOG_ANSWERS)
    return observations(
        rows,
        cfg,
        "performance_status",
        "allgemeiner-leistungszustand-ecog-id",
        F.concat(F.lit("ECOG-"), F.col("report_id")),
        "allgemeiner-leistungszustand-ecog",
        code=many(
            snomed(
                cfg,
                "423740007",
                "Eastern Cooperative Oncology Group performance status (observable entity)",
            ),
            loinc(cfg, "89262-0", "ECOG Performance Status [Interpretation]"),
        ),
        effective=F.when(
            F.col("section") == "Diagnose", report_partial_date(F.col("diagnosed"))
        ).otherwise(partial_date(F.col("examined"))),
        value_kind=F.lit("concept"),
        value_codings=many(
            onco(cfg, "allgemeiner-leistungszustand-ecog", grade), loinc(cfg, answer)
        ),
    )


def map_study_participation(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Yes with a date, else the reported no or unknown."""
    sources = ("Diagnose", "Verlauf", "SYST", "ST", "OP")
    rows = rows_of(
        reports, "study", {s: section(s, "Modul_Allgemein.Studienteilnahme") for s in sources}
    )
    item = F.col("item")
    answer = F.when(item["Datum"].isNotNull(), "J").otherwise(item["NU"])
    return observations(
        rows,
        cfg,
        "study",
        "studienteilnahme-observation-id",
        F.concat(F.col("report_id"), F.lit("-Studienteilnahme")),
        "studienteilnahme",
        code=one(snomed(cfg, "709491003", "Enrollment in clinical trial (procedure)")),
        effective=partial_date(item["Datum"]),
        value_kind=F.lit("concept"),
        value_codings=concept(cfg, "studienteilnahme", answer),
    )


def map_classifications(
    reports: DataFrame, cfg: MappingConfig = DEFAULT, code_map: DataFrame | None = None
) -> DataFrame:
    """Other classifications, coded through a map of (name, stage) where it has them.

    Of several map rows for one name and stage the least by its columns is taken, so a classification
    stays one row. The map joins from the right, so a hot classification only makes the splittable left
    side large.
    """
    sources = ("Diagnose", "Verlauf", "Pathologie")
    rows = elements_of(
        reports,
        "classifications",
        {s: section(s, "Menge_Weitere_Klassifikation.Weitere_Klassifikation") for s in sources},
    )
    rows = rows.withColumn("__name", F.col("item.Name")).withColumn("__stage", F.col("item.Stadium"))
    mapped = ["code_system", "code_version", "code_code", "code_display",
              "value_system", "value_version", "value_code", "value_display"]
    if code_map is None:
        rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in mapped])
    else:
        one_each = pick_by_key(code_map.select("name", "stadium", *mapped), ["name", "stadium"], mapped, last=False)
        rows = rows.join(
            one_each,
            (F.col("__name") == F.col("name")) & (F.col("__stage") == F.col("stadium")),
            "left",
        )
    item = F.col("item")
    found = F.col("code_code").isNotNull()
    day = F.substring(item["Datum"]["_VALUE"], 1, 10)
    mapped_value = make_coding(
        F.col("value_system"), F.col("value_code"), F.col("value_display"), F.col("value_version")
    )
    return observations(
        rows,
        cfg,
        "classification",
        "weitere-klassifikation-observation-id",
        F.concat_ws("-", "report_id", item["Name"], day, item["Stadium"]),
        "weitere-klassifikationen",
        code=one(
            make_coding(
                F.col("code_system"), F.col("code_code"), F.col("code_display"), F.col("code_version")
            ),
            found,
        ),
        code_text=item["Name"],
        effective=report_partial_date(item["Datum"]),
        value_kind=F.lit("concept"),
        value_codings=F.when(
            found, one(mapped_value, F.coalesce(F.trim("value_code") != "", F.lit(False)))
        ).otherwise(one(make_coding(None, item["Stadium"]))),
        value_text=F.when(found, item["Stadium"]),
    )
