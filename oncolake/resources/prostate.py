"""Prostate module: PSA, biopsy cores, complications and the Gleason grading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import (
    GLEASON_PATTERN,
    gleason_grade_group,
    gleason_score,
)
from oncolake.functions.codes import loinc, lookup, many, one, onco, reference, snomed
from oncolake.functions.dates import partial_date
from oncolake.functions.ids import resource_id, slugify
from oncolake.resources.base import observations, rows_of, section

SOURCES = ("Diagnose", "Verlauf", "OP", "Pathologie")

# Field, date field, id suffix, profile, LOINC code and display of each measurement.
MEASUREMENTS = (
    ("PSA", "DatumPSA", "psa", "prostate-psa", "prostata-psa-observation-id", "2857-1",
     "Prostate specific Ag [Mass/volume] in Serum or Plasma"),
    ("AnzahlStanzen", "DatumStanzen", "anzahl-stanzen", "prostate-anzahl-stanzen",
     "prostata-anzahl-stanzen-observation-id", "44652-6", "Total number of cores in Tissue core"),
    ("AnzahlPosStanzen", "DatumStanzen", "anzahl-positive-stanzen", "prostate-anzahl-positive-stanzen",
     "prostata-anzahl-positive-stanzen-observation-id", "44651-8",
     "Tissue cores.positive.carcinoma in Tissue core"),
    ("CaBefallStanze", "DatumStanzen", "ca-befall-stanze", "prostate-ca-befall-stanze",
     "prostata-ca-befall-stanze-observation-id", "44654-2",
     "Tissue involved by tumor in Prostate tumor"),
)
# How the Gleason specimen was taken.
GLEASON_METHOD = {
    "O": ("65801008", "Excision (procedure)"),
    "S": ("86273004", "Biopsy (procedure)"),
    "U": ("261665006", "Unknown (qualifier value)"),
}
GLEASON_SYSTEM = "prostata-gleason-patterns-observation-id"
CLAVIEN_SYSTEM = "prostata-clavien-dindo-observation-id"


def _module_rows(reports: DataFrame, job: str = "prostate") -> DataFrame:
    report = F.col("report")
    return rows_of(
        reports,
        job,
        {s: section(s, "Modul_Prostata") for s in SOURCES},
        {
            "diagnosed": report["Tumorzuordnung"]["Diagnosedatum"]["_VALUE"],
            "examined": report["Verlauf"]["Untersuchungsdatum_Verlauf"],
            "operated": report["OP"]["Datum"],
            "surgery_value": slugify(report["OP"]["_OP_ID"]),
        },
    )


def _reference_date() -> Column:
    name = F.col("section")
    return (
        F.when(name == "Diagnose", F.col("diagnosed"))
        .when(name == "Verlauf", F.col("examined"))
        .when(name == "OP", F.col("operated"))
    )


def module_value(report_id: Column, suffix: str) -> Column:
    return F.concat(report_id, F.lit(f"-modul-prostata-{suffix}"))


def prostate_observation_ids(cfg: MappingConfig, module: Column, report_id: Column) -> list[Column]:
    """Ids of all observations of a module in emission order, null where there is none."""

    def identifier(system, suffix):
        return resource_id(cfg.identifier_system(system), slugify(module_value(report_id, suffix)))

    ids = [F.when(module[f].isNotNull(), identifier(system, suffix)) for f, _, suffix, _, system, *_ in MEASUREMENTS]
    ids.append(F.when(module["KomplPostOP_ClavienDindo"].isNotNull(), identifier(CLAVIEN_SYSTEM, "clavien-dindo")))
    score = module["GleasonScore"]
    ids.append(F.when(score.isNotNull(), identifier(GLEASON_SYSTEM, "gleason-grade-group")))
    ids.append(F.when(score["GradPrimaer"].isNotNull(), identifier(GLEASON_SYSTEM, "primary-gleason-pattern")))
    ids.append(F.when(score["GradSekundaer"].isNotNull(), identifier(GLEASON_SYSTEM, "secondary-gleason-pattern")))
    return ids


def map_prostate_module(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """PSA, cores, positive cores, core involvement, complications and Gleason observations."""
    rows = _module_rows(reports)
    item = F.col("item")
    entries = []
    for number, (field, date, suffix, profile, system, code, display) in enumerate(MEASUREMENTS):
        present, absent, unit, unit_code = item[field], F.lit(None).cast("string"), None, None
        number_text = item[field]
        kind = "integer"
        if field == "PSA":
            kind, unit, unit_code = "quantity", "ng/ml", "ng/mL"
        elif field == "CaBefallStanze":
            kind, unit, unit_code = "quantity", "%", "%"
            number_text = item[field]["Prozentzahl"]
            absent = F.when(number_text.isNull() & item[field]["U"].isNotNull(), F.lit("unknown"))
        entries.append(
            F.when(
                present.isNotNull(),
                F.struct(
                    F.lit(number).alias("number"),
                    F.lit(suffix).alias("suffix"),
                    F.lit(cfg.profile(profile)).alias("profile"),
                    F.lit(cfg.identifier_system(system)).alias("system"),
                    F.lit(code).alias("code"),
                    F.lit(display).alias("display"),
                    F.lit(kind).alias("kind"),
                    number_text.try_cast("decimal(18,6)").alias("value"),
                    F.lit(unit).cast("string").alias("unit"),
                    F.lit(unit_code).cast("string").alias("unit_code"),
                    absent.alias("absent"),
                    item[date].alias("date"),
                ),
            )
        )
    measured = rows.withColumn("m", F.explode(F.array_compact(F.array(*entries))))
    m = F.col("m")
    measurements = observations(
        measured,
        cfg,
        "prostate",
        m["system"],
        F.concat(F.col("report_id"), F.lit("-modul-prostata-"), m["suffix"]),
        m["profile"],
        seq=F.col("seq") + m["number"],
        code=one(loinc(cfg, m["code"], m["display"])),
        effective=partial_date(m["date"]),
        value_kind=m["kind"],
        value_num=m["value"],
        value_unit=m["unit"],
        value_unit_code=m["unit_code"],
        value_absent=m["absent"],
    )
    grade = item["KomplPostOP_ClavienDindo"]
    surgery = resource_id(cfg.identifier_system("operation-procedure-id"), F.col("surgery_value"))
    complications = observations(
        rows.filter(grade.isNotNull()),
        cfg,
        "clavien_dindo",
        CLAVIEN_SYSTEM,
        module_value(F.col("report_id"), "clavien-dindo"),
        "prostate-clavien-dindo",
        seq=F.col("seq") + 10,
        focus_refs=F.array_compact(
            F.array(
                reference("Condition", F.col("condition_id")),
                F.when(F.col("section") == "OP", reference("Procedure", surgery)),
            )
        ),
        code=one(snomed(cfg, "789279006", "Clavien-Dindo classification grade (observable entity)")),
        effective=partial_date(_reference_date()),
        value_kind=F.lit("concept"),
        value_codings=one(onco(cfg, "prostata-postsurgical-complications", grade)),
    )
    return measurements.unionByName(complications).unionByName(map_gleason(reports, cfg))


def map_gleason(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Grade group and the primary and secondary pattern it is derived from."""
    rows = _module_rows(reports).filter(F.col("item.GleasonScore").isNotNull())
    item = F.col("item")
    score = item["GleasonScore"]
    taken = item["AnlassGleasonScore"]
    method_code = lookup(taken, {k: v[0] for k, v in GLEASON_METHOD.items()})
    method_text = lookup(taken, {k: v[1] for k, v in GLEASON_METHOD.items()})
    shared = {
        "effective": partial_date(_reference_date()),
        "method": one(snomed(cfg, method_code, method_text), method_code.isNotNull()),
        "value_kind": F.lit("concept"),
    }
    *_, primary_id, secondary_id = prostate_observation_ids(cfg, item, F.col("report_id"))
    graded = rows.withColumn(
        "grade",
        gleason_grade_group(
            score["GradPrimaer"],
            score["GradSekundaer"],
            gleason_score(score["GradPrimaer"], score["GradSekundaer"], score["ScoreErgebnis"]),
        ),
    )
    groups = observations(
        graded,
        cfg,
        "gleason_grade_group",
        GLEASON_SYSTEM,
        module_value(F.col("report_id"), "gleason-grade-group"),
        "prostate-gleason-grade-group",
        seq=F.col("seq") + 20,
        code=one(
            snomed(
                cfg,
                "1812491000004107",
                "Histologic grade of primary malignant neoplasm of prostate by International Society "
                "of Urological Pathology technique (observable entity)",
            )
        ),
        value_codings=one(snomed(cfg, F.col("grade.code"), ordinal=F.col("grade.ordinal"))),
        value_text=F.col("grade.text"),
        derived_from_ids=F.array_compact(F.array(primary_id, secondary_id)),
        **shared,
    )
    patterns = [
        F.when(
            score[field].isNotNull(),
            F.struct(
                F.lit(number).alias("number"),
                score[field].alias("pattern"),
                F.lit(which).alias("which"),
                F.lit(code).alias("code"),
                F.lit(display).alias("display"),
            ),
        )
        for number, (field, which, code, display) in enumerate(
            (
                ("GradPrimaer", "primary", "384994009", "Primary Gleason pattern (observable entity)"),
                ("GradSekundaer", "secondary", "384995005", "Secondary Gleason pattern (observable entity)"),
            )
        )
    ]
    found = rows.withColumn("p", F.explode(F.array_compact(F.array(*patterns))))
    p = F.col("p")
    single = observations(
        found,
        cfg,
        "gleason_pattern",
        GLEASON_SYSTEM,
        F.concat(F.col("report_id"), F.lit("-modul-prostata-"), p["which"], F.lit("-gleason-pattern")),
        "prostate-gleason-patterns",
        seq=F.col("seq") + 21 + p["number"],
        code=one(snomed(cfg, p["code"], p["display"])),
        value_codings=many(
            snomed(
                cfg,
                lookup(p["pattern"], GLEASON_PATTERN),
                F.concat(F.lit("Gleason Pattern "), p["pattern"], F.lit(" (finding)")),
                ordinal=p["pattern"].try_cast("decimal(18,6)"),
            )
        ),
        **shared,
    )
    return groups.unionByName(single)
