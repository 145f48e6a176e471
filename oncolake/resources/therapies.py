"""Surgery, radiotherapy and systemic therapy, with medications and side effects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncolake import config as C
from oncolake import schemas
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.clinical import application_code, distinct_by_code, ops_category
from oncolake.functions.codes import (
    loinc,
    lookup,
    make_coding,
    many,
    one,
    onco,
    ops,
    quantity,
    snomed,
)
from oncolake.functions.dates import partial_date, report_partial_date
from oncolake.functions.ids import first_nonblank, nonblank, resource_id, slugify
from oncolake.operators.consolidate import COMPLETED
from oncolake.resources.base import concept, observations, rows_of, section, typed

# Therapy types with category and code of the procedure.
_DRUG = ("18629005", "Administration of drug or medicament (procedure)")
_CHEMO = ("8-54", "Zytostatische Chemotherapie, Immuntherapie und antiretrovirale Therapie")
DRUG_THERAPY_OPS = {
    **{kind: _CHEMO for kind in ("CH", "IM", "CI", "CIZ", "CZ", "IZ", "ZS")},
    "SZ": ("8-86", "Therapie mit besonderen Zellen und Blutbestandteilen"),
    "HO": ("6-00", "Applikation von Medikamenten"),
}
OTHER_THERAPY = {
    "WW": ("373818007", "No anti-cancer treatment - watchful waiting (finding)"),
    "AS": ("424313000", "Active surveillance (regime/therapy)"),
    "WS": ("310341009", "Follow-up (wait and see) (finding)"),
    "SO": ("74964007", "Other (qualifier value)"),
}
_OTHER_CATEGORY = ("394841004", "Other category (qualifier value)")


def _codes(table):
    return {key: value[0] for key, value in table.items()}


def _displays(table):
    return {key: value[1] for key, value in table.items()}


def progress_status(reason: Column, done: str = "completed", running: str = "in-progress") -> Column:
    return F.when(F.lower(reason) == COMPLETED, done).otherwise(running)


def map_surgeries(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """A parent procedure per surgery and a part of it for every distinct procedure code."""
    rows = rows_of(reports, "surgeries", {"OP": section("OP")})
    item = F.col("item")
    performed = partial_date(item["Datum"])
    shared = {
        "status": F.lit("completed"),
        "performed": performed,
        "performed_absent": F.when(performed.isNull(), F.lit("unknown")),
        "reason_condition_id": F.col("condition_id"),
        "intention": concept(cfg, "intention", item["Intention"]),
        "outcome": concept(
            cfg, "residualstatus", item["Residualstatus"]["Lokale_Beurteilung_Residualstatus"]
        ),
    }
    system, profile = "operation-procedure-id", cfg.profile("operation")
    parents = typed(
        rows, cfg, schemas.PROCEDURES, "Procedure", system, item["_OP_ID"], profile,
        kind=F.lit("surgery"),
        code=one(snomed(cfg, "387713003", "Surgical procedure (procedure)")),
        **shared,
    )
    codes = rows.select(
        "*", F.posexplode(distinct_by_code(item["Menge_OPS"]["OPS"])).alias("pos", "ops")
    )
    code, version = F.col("ops.Code"), nonblank(F.col("ops.Version"))
    category = ops_category(code)
    children = typed(
        codes, cfg, schemas.PROCEDURES, "Procedure", system,
        F.concat_ws("-", item["_OP_ID"], code), profile,
        seq=F.col("seq") + 1 + F.col("pos"),
        kind=F.lit("surgery_part"),
        code=one(
            make_coding(C.OPS, code, version=version,
                        version_absent=F.when(version.isNull(), F.lit("unknown")))
        ),
        category=one(snomed(cfg, category["code"], category["display"])),
        part_of_id=resource_id(cfg.identifier_system(system), slugify(item["_OP_ID"])),
        **shared,
    )
    return parents.unionByName(children)


def map_residual_status(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """Overall residual status after a surgery."""
    rows = rows_of(reports, "residual", {"OP": section("OP")})
    item = F.col("item")
    overall = item["Residualstatus"]["Gesamtbeurteilung_Residualstatus"]
    return observations(
        rows.filter(overall.isNotNull()),
        cfg,
        "residual_status",
        "residualstatus-observation-id",
        item["_OP_ID"],
        "residualstatus",
        code=one(loinc(cfg, "84892-9", "Residual tumor classification [Type] in Cancer specimen")),
        effective=partial_date(item["Datum"]),
        value_kind=F.lit("concept"),
        value_codings=concept(cfg, "residualstatus", overall),
    )


def _radiation_kind(cfg: MappingConfig, metabolic: Column) -> dict[str, Column]:
    def pick(nuclear, radiation):
        return F.when(metabolic, nuclear).otherwise(radiation)

    return {
        "category": one(
            snomed(cfg, pick("399315003", "1287742003"),
                   pick("Radionuclide therapy", "Radiotherapy (procedure)"))
        ),
        "code": one(ops(cfg, pick("8-53", "8-52"), pick("Nuklearmedizinische Therapie", "Strahlentherapie"))),
    }


def _iso(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def map_radiotherapy(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """A bracket procedure per radiotherapy and one per irradiation with an application type.

    The position of an irradiation counts skipped ones too.
    """
    rows = rows_of(reports, "radiotherapy", {"ST": section("ST")})
    item = F.col("item")
    doses = item["Menge_Bestrahlung"]["Bestrahlung"]
    applied = F.filter(doses, lambda b: b["Applikationsart"].isNotNull())
    all_metabolic = F.coalesce(
        (F.size(applied) > 0)
        & F.forall(applied, lambda b: b["Applikationsart"]["Metabolisch"].isNotNull()),
        F.lit(False),
    )
    start = partial_date(F.array_min(F.transform(doses, lambda b: _iso(b["Beginn"]))).cast("string"))
    end = partial_date(F.array_max(F.transform(doses, lambda b: _iso(b["Ende"]))).cast("string"))
    brackets = typed(
        rows, cfg, schemas.PROCEDURES, "Procedure", "strahlentherapie-procedure-id",
        first_nonblank(item["_ST_ID"], F.col("report_id")), cfg.profile("strahlentherapie"),
        kind=F.lit("radiotherapy"),
        status=progress_status(item["Meldeanlass"]),
        period_start=start,
        period_start_absent=F.when(start.isNull(), F.lit("unknown")),
        period_end=end,
        reason_condition_id=F.col("condition_id"),
        outcome=concept(cfg, "therapie-ende-grund", item["Ende_Grund"]),
        intention=concept(cfg, "intention", item["Intention"]),
        position_to_surgery=concept(cfg, "therapie-stellungzurop", item["Stellung_OP"]),
        **_radiation_kind(cfg, all_metabolic),
    )
    single = rows.select(
        "*", F.posexplode(doses).alias("pos", "dose")
    ).filter(F.col("dose.Applikationsart").isNotNull())
    b, a = F.col("dose"), F.col("dose.Applikationsart")
    nuclear = a["Metabolisch"]
    full = {"Zielgebiet", "Seite_Zielgebiet", "Strahlenart", "Einzeldosis", "Gesamtdosis", "Boost"}
    fields = {
        "Perkutan": full,
        "Kontakt": full,
        "Metabolisch": full - {"Boost"},
        "Sonstige": full - {"Strahlenart", "Boost"},
    }

    def chosen(field):
        """The field of the first application type that is given."""
        value = None
        for name, known in fields.items():
            inner = a[name][field] if field in known else F.lit(None)
            value = (F if value is None else value).when(a[name].isNotNull(), inner)
        return value

    target = chosen("Zielgebiet")
    site = F.coalesce(target["CodeVersion2014"], target["CodeVersion2021"])
    begin = partial_date(b["Beginn"])
    single_dose, total_dose = chosen("Einzeldosis"), chosen("Gesamtdosis")
    dose = lambda d: quantity(d["Dosis"].try_cast("decimal(18,6)"), d["Einheit"])
    st_value = first_nonblank(item["_ST_ID"], F.col("report_id"))
    irradiations = typed(
        single, cfg, schemas.PROCEDURES, "Procedure", "strahlentherapie-bestrahlung-procedure-id",
        F.concat_ws("-", st_value, "pos"),
        F.when(nuclear.isNotNull(), cfg.profile("strahlentherapie-bestrahlung-nuklearmedizin")).otherwise(
            cfg.profile("strahlentherapie-bestrahlung-strahlentherapie")
        ),
        seq=F.col("seq") + 1 + F.col("pos"),
        kind=F.lit("irradiation"),
        status=F.when(b["Ende"].isNotNull(), "completed").otherwise("in-progress"),
        period_start=begin,
        period_start_absent=F.when(b["Beginn"].isNull(), F.lit("unknown")),
        period_end=partial_date(b["Ende"]),
        part_of_id=resource_id(cfg.identifier_system("strahlentherapie-procedure-id"), slugify(st_value)),
        used_code=concept(cfg, "strahlentherapie-strahlenart", chosen("Strahlenart")),
        method=concept(cfg, "strahlentherapie-applikationsart", application_code(a)),
        body_site=concept(cfg, "strahlentherapie-zielgebiet", site),
        body_site_side=concept(cfg, "seitenlokalisation", chosen("Seite_Zielgebiet")),
        single_dose=dose(single_dose),
        total_dose=dose(total_dose),
        boost=concept(cfg, "strahlentherapie-boost", chosen("Boost")),
        **_radiation_kind(cfg, nuclear.isNotNull()),
    )
    return brackets.unionByName(irradiations)


def map_systemic_procedures(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """The procedure of a systemic therapy, coded by its type."""
    rows = rows_of(reports, "systemic", {"SYST": section("SYST")})
    item = F.col("item")
    kind = item["Therapieart"]
    drug_code, drug_text = lookup(kind, _codes(DRUG_THERAPY_OPS)), lookup(kind, _displays(DRUG_THERAPY_OPS))
    other_code, other_text = lookup(kind, _codes(OTHER_THERAPY)), lookup(kind, _displays(OTHER_THERAPY))
    absent = lambda system, version: make_coding(system, None, version=version, code_absent="unknown")
    category = (
        F.when(kind.isNull(), one(absent(C.SNOMED, cfg.snomed_version)))
        .when(drug_code.isNotNull(), one(snomed(cfg, *_DRUG)))
        .when(kind == "SO", one(snomed(cfg, *_OTHER_CATEGORY)))
    )
    code = F.when(kind.isNull(), one(absent(C.OPS, cfg.ops_version))).otherwise(
        many(
            F.when(drug_code.isNotNull(), ops(cfg, drug_code, drug_text)),
            F.when(other_code.isNotNull(), snomed(cfg, other_code, other_text)),
            onco(cfg, "therapie-typ", kind),
        )
    )
    undated = item["Beginn"].isNull() & item["Ende"].isNull()
    return typed(
        rows, cfg, schemas.PROCEDURES, "Procedure", "systemische-therapie-procedure-id",
        item["_SYST_ID"], cfg.profile("systemische-therapie"),
        kind=F.lit("systemic"),
        status=progress_status(item["Meldeanlass"]),
        category=category,
        code=code,
        period_start=report_partial_date(item["Beginn"]),
        period_start_absent=F.when(undated, F.lit("unknown")),
        period_end=partial_date(item["Ende"]),
        reason_condition_id=F.col("condition_id"),
        outcome=concept(cfg, "therapie-ende-grund", item["Ende_Grund"]),
        intention=concept(cfg, "intention", item["Intention"]),
        position_to_surgery=concept(cfg, "therapie-stellungzurop", item["Stellung_OP"]),
        protocol=item["Protokoll"],
    )


def _substances(reports: DataFrame, drug_map: DataFrame | None) -> DataFrame:
    """One row per distinct substance of a systemic therapy, with given or looked-up code."""
    rows = rows_of(reports, "medication", {"SYST": section("SYST")})
    given = lambda s: nonblank(s["ATC"]["Code"])
    distinct = distinct_by_code(
        F.col("item.Menge_Substanz.Substanz"),
        lambda s: F.coalesce(given(s), s["Bezeichnung"]),
        lambda s: F.when(given(s).isNotNull(), s["ATC"]["Version"]),
    )
    exploded = rows.select("*", F.posexplode(distinct).alias("pos", "substance"))
    s = F.col("substance")
    named = exploded.withColumn("given_code", given(s)).withColumn(
        "substance_key", F.coalesce("given_code", s["Bezeichnung"])
    ).filter(F.col("substance_key").isNotNull())
    if drug_map is None:
        return named.withColumn("mapped_code", F.lit(None).cast("string"))
    # One code per name, so that a name listed twice does not multiply rows.
    names = drug_map.groupBy(F.col("name").alias("__name")).agg(F.min("atc_code").alias("mapped_code"))
    lookup_name = F.when(F.col("given_code").isNull(), F.trim(s["Bezeichnung"]))
    return named.withColumn("__lookup", lookup_name).join(
        names, F.col("__lookup") == F.col("__name"), "left"
    )


def map_medication_statements(
    reports: DataFrame, cfg: MappingConfig = DEFAULT, drug_map: DataFrame | None = None
) -> DataFrame:
    """One statement per distinct substance of a systemic therapy.

    Its id rests on the reported code or name, so it does not change when the drug map grows.
    """
    rows = _substances(reports, drug_map)
    item, s = F.col("item"), F.col("substance")
    code = F.coalesce("given_code", "mapped_code")
    return typed(
        rows, cfg, schemas.MEDICATION_STATEMENTS, "MedicationStatement",
        "systemische-therapie-medication-statement-id",
        F.concat_ws("-", "condition_id", item["_SYST_ID"], "substance_key"),
        cfg.profile("systemische-therapie-medikation"),
        seq=F.col("seq") + 2 * F.col("pos"),
        status=progress_status(item["Meldeanlass"], running="active"),
        medication_id=resource_id(cfg.identifier_system("systemische-therapie-medication-id"), code),
        medication_text=s["Bezeichnung"],
        code_absent=F.when(code.isNull(), F.lit("as-text")),
        period_start=report_partial_date(item["Beginn"]),
        period_end=partial_date(item["Ende"]),
        part_of_id=resource_id(
            cfg.identifier_system("systemische-therapie-procedure-id"), slugify(item["_SYST_ID"])
        ),
        reason_condition_id=F.col("condition_id"),
    )


def map_medications(
    reports: DataFrame, cfg: MappingConfig = DEFAULT, drug_map: DataFrame | None = None
) -> DataFrame:
    """The medication of each statement with a code; its id is the code alone."""
    rows = _substances(reports, drug_map)
    code = F.coalesce("given_code", "mapped_code")
    s = F.col("substance")
    given = F.col("given_code").isNotNull()
    coding = F.when(
        given, make_coding(C.ATC, code, version=s["ATC"]["Version"], user_selected=True)
    ).otherwise(make_coding(C.ATC, code, version=cfg.atc_version, user_selected=False))
    return typed(
        rows.filter(code.isNotNull()), cfg, schemas.MEDICATIONS, "Medication",
        "systemische-therapie-medication-id", code, cfg.medication_profile, slug=False,
        seq=F.col("seq") + 2 * F.col("pos") + 1,
        code=one(coding),
        text=s["Bezeichnung"],
    )


def map_adverse_events(reports: DataFrame, cfg: MappingConfig = DEFAULT) -> DataFrame:
    """One event per reported side effect, and one for a grade of at most two or unknown."""

    def source(name, id_field, system):
        part = section(name)
        value = part[id_field]
        return F.when(
            part["Nebenwirkungen"].isNotNull(),
            F.struct(
                value.alias("id"),
                resource_id(cfg.identifier_system(system), slugify(value)).alias("procedure_id"),
                part["Nebenwirkungen"].alias("effects"),
            ),
        )

    rows = rows_of(
        reports,
        "adverse",
        {
            "SYST": source("SYST", "_SYST_ID", "systemische-therapie-procedure-id"),
            "ST": source("ST", "_ST_ID", "strahlentherapie-procedure-id"),
        },
    )
    item = F.col("item")
    system, profile = "nebenwirkung-adverse-event-id", cfg.profile("nebenwirkung-adverse-event")
    prefix = F.concat(F.lit("mii-pr-onko-nebenwirkung-"), item["id"])
    single = rows.select(
        "*", F.posexplode(item["effects"]["Menge_Nebenwirkung"]["Nebenwirkung"]).alias("pos", "effect")
    )
    effect = F.col("effect")
    code, name = effect["Art"]["MedDRA_Code"], effect["Art"]["Bezeichnung"]
    events = typed(
        single, cfg, schemas.ADVERSE_EVENTS, "AdverseEvent", system,
        F.concat_ws("-", prefix, "pos"), profile,
        seq=F.col("seq") + F.col("pos"),
        event=one(make_coding(C.MEDDRA, code, name, effect["Version"]), code.isNotNull()),
        event_text=F.when(code.isNull(), name),
        event_absent=F.when(code.isNull(), F.lit("unknown")),
        grade=concept(cfg, "nebenwirkung-ctcae-grad", effect["Grad"]),
        suspect_procedure_id=item["procedure_id"],
    )
    limit = item["effects"]["Grad_maximal2_oder_unbekannt"]
    limits = typed(
        rows.filter(limit.isNotNull()), cfg, schemas.ADVERSE_EVENTS, "AdverseEvent", system,
        F.concat(prefix, F.lit("-Grad-maximal-2-unbekannt")), profile,
        seq=F.col("seq") + 500_000_000,
        event_absent=F.lit("not-applicable"),
        grade=concept(cfg, "nebenwirkung-ctcae-grad", limit),
        suspect_procedure_id=item["procedure_id"],
    )
    return events.unionByName(limits)
