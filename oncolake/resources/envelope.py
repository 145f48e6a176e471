"""Resource tables to uniform envelope rows that carry the resource as JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oncolake import config as C
from oncolake.config import DEFAULT, MappingConfig
from oncolake.functions.codes import data_absent, reference
from oncolake.schemas import CODINGS, ENVELOPE_COLUMNS

BodyChange = Callable[[str, Column, StructType], Column]


def _object(**fields: Column | None) -> Column:
    """A JSON object; null members vanish when it is written. ``x_`` writes the sibling ``_x``."""
    named = []
    for name, value in fields.items():
        if value is not None:
            named.append(value.alias(f"_{name[:-1]}" if name.endswith("_") else name))
    return F.struct(*named)


def _absent(reason: Column | str) -> Column:
    extension = data_absent(reason)
    return F.when(extension.isNotNull(), F.struct(extension.alias("extension")))


def _filled(items: Column) -> Column:
    """A list, or null when it is empty."""
    return F.when(F.size(items) > 0, items)


def _coding(c: Column) -> Column:
    ordinal = F.when(
        c["ordinal"].isNotNull(),
        F.array(F.struct(F.lit(C.ORDINAL_VALUE).alias("url"), c["ordinal"].alias("valueDecimal"))),
    )
    return _object(
        extension=ordinal,
        system=c["system"],
        version=c["version"],
        version_=_absent(c["version_absent"]),
        code=c["code"],
        code_=_absent(c["code_absent"]),
        display=c["display"],
        userSelected=c["user_selected"],
    )


def _codings(items: Column) -> Column:
    return F.transform(items, _coding)


def _concept(items: Column, text: Column | None = None, extension: Column | None = None) -> Column:
    """A codeable concept, null when it would be empty."""
    coding = _codings(_filled(items))
    present = coding.isNotNull()
    for part in (text, extension):
        if part is not None:
            present = present | part.isNotNull()
    return F.when(present, _object(extension=extension, coding=coding, text=text))


def _single(concept: Column) -> Column:
    return F.when(concept.isNotNull(), F.array(concept))


def _each_concept(items: Column) -> Column:
    """One concept per coding."""
    return F.transform(_filled(items), lambda c: F.struct(F.array(_coding(c)).alias("coding")))


def _ref(ref: Column) -> Column:
    return F.when(ref.isNotNull(), F.struct(ref.alias("reference")))


def _refs(items: Column) -> Column:
    return F.transform(_filled(items), lambda r: F.struct(r.alias("reference")))


def _quantity(value, unit, code, extension=None) -> Column:
    present = value.isNotNull()
    system = F.when(code.isNotNull(), F.lit(C.UCUM))
    if extension is not None:
        present = present | extension.isNotNull()
        system = F.when(value.isNotNull(), system)
        unit, code = F.when(value.isNotNull(), unit), F.when(value.isNotNull(), code)
    return F.when(
        present, _object(extension=extension, value=value, unit=unit, system=system, code=code)
    )


def _partial(date: Column) -> Column:
    return date["value"]


def _period(start: Column, end: Column) -> Column:
    """A period with what there is of it, null without either date."""
    start, end = _partial(start), _partial(end)
    return F.when(start.isNotNull() | end.isNotNull(), _object(start=start, end=end))


def _subject(cfg: MappingConfig) -> Column:
    kind = F.struct(
        F.array(
            F.struct(
                F.lit(C.IDENTIFIER_TYPE).alias("system"),
                F.lit("MR").alias("code"),
                F.lit("Medical record number").alias("display"),
            )
        ).alias("coding")
    )
    identifier = F.when(
        F.col("patient_identifier").isNotNull(),
        F.struct(
            kind.alias("type"),
            F.lit(cfg.identifier_system("patient-id")).alias("system"),
            F.col("patient_identifier").alias("value"),
        ),
    )
    return F.struct(F.col("patient_ref").alias("reference"), identifier.alias("identifier"))


def _identifier() -> Column:
    return F.struct(
        F.col("identifier_system").alias("system"), F.col("identifier_value").alias("value")
    )


def _meta(cfg: MappingConfig, tag: Column | None = None) -> Column:
    source = F.lit(cfg.meta_source) if cfg.meta_source else None
    profile = F.when(F.col("profile").isNotNull(), F.array("profile"))
    return _object(source=source, profile=profile, tag=tag)


def _head(cfg: MappingConfig, tag: Column | None = None, **after) -> dict[str, Column]:
    return {
        "resourceType": F.col("resource_type"),
        "id": F.col("id"),
        "meta": _meta(cfg, tag),
        **after,
    }


def _patient(cfg: MappingConfig) -> dict[str, Column]:
    kind = F.struct(
        F.array(
            F.struct(
                F.lit(C.IDENTIFIER_TYPE).alias("system"),
                F.lit("MR").alias("code"),
                F.lit("Medical record number").alias("display"),
            ),
            F.struct(
                F.lit(C.V3_OBSERVATION_VALUE).alias("system"),
                F.lit("PSEUDED").alias("code"),
                F.lit("pseudonymized").alias("display"),
            ),
        ).alias("coding")
    )
    address = _object(
        type=F.lit("both"),
        postalCode=F.col("postal_code"),
        postalCode_=F.when(F.col("postal_code").isNull(), _absent("unknown")),
        country=F.col("country"),
        country_=F.when(F.col("country").isNull(), _absent("unknown")),
    )
    return _head(
        cfg,
        identifier=F.array(
            F.struct(
                kind.alias("type"),
                F.col("identifier_system").alias("system"),
                F.col("identifier_value").alias("value"),
            )
        ),
        gender=F.col("gender"),
        birthDate=_partial(F.col("birth_date")),
        deceasedDateTime=_partial(F.col("deceased_date")),
        deceasedBoolean=F.when(F.col("deceased_date").isNull(), F.col("deceased")),
        address=F.when(F.col("has_address"), F.array(address)),
    )


def _condition(cfg: MappingConfig) -> dict[str, Column]:
    asserted = _partial(F.col("asserted_date"))
    extension_type = (
        "array<struct<url:string,valueCodeableConcept:struct<coding:array<struct<system:string,"
        "version:string,code:string>>,text:string>,valueDateTime:string,_valueDateTime:struct<"
        "extension:array<struct<url:string,valueCode:string>>>,valueReference:struct<"
        "reference:string>>>"
    )

    def extension(url, concept=None, date=None, date_absent=None, ref=None):
        null = F.lit(None)
        return F.struct(
            F.lit(url).alias("url"),
            (concept if concept is not None else null).alias("valueCodeableConcept"),
            (date if date is not None else null).alias("valueDateTime"),
            (date_absent if date_absent is not None else null).alias("_valueDateTime"),
            (ref if ref is not None else null).alias("valueReference"),
        )

    morphology = F.transform(
        F.coalesce("morphology", F.array().cast("array<struct<code:string,version:string,text:string>>")),
        lambda m: extension(
            cfg.extension("histology-morphology-behavior-icdo3"),
            concept=F.struct(
                F.array(
                    F.struct(F.lit(C.ICDO3).alias("system"), m["version"].alias("version"), m["code"].alias("code"))
                ).alias("coding"),
                m["text"].alias("text"),
            ),
        ),
    ).cast(extension_type)
    date = F.array(
        extension(C.ASSERTED_DATE, date=asserted, date_absent=F.when(asserted.isNull(), _absent("unknown")))
    ).cast(extension_type)
    follows = F.transform(
        F.coalesce("follows_condition_ids", F.array().cast("array<string>")),
        lambda i: extension(C.OCCURRED_FOLLOWING, ref=F.struct(reference("Condition", i).alias("reference"))),
    ).cast(extension_type)
    topography = F.col("topography")
    site = F.when(
        topography.isNotNull(),
        F.struct(
            F.when(
                topography["code"].isNotNull(),
                F.array(
                    F.struct(
                        F.lit(C.ICDO3).alias("system"),
                        topography["version"].alias("version"),
                        topography["code"].alias("code"),
                        F.lit(None).cast("string").alias("display"),
                    )
                ),
            ).alias("coding"),
            topography["text"].alias("text"),
        ),
    )
    side = F.when(
        F.col("laterality").isNotNull(),
        F.struct(
            F.transform(
                "laterality",
                lambda c: F.struct(
                    c["system"].alias("system"),
                    c["version"].alias("version"),
                    c["code"].alias("code"),
                    c["display"].alias("display"),
                ),
            ).alias("coding"),
            F.lit(None).cast("string").alias("text"),
        ),
    )
    primary = F.col("category") == "primary"
    tag = F.when(
        primary & F.col("incomplete"),
        F.array(
            F.struct(
                F.lit(C.SNOMED).alias("system"),
                F.lit(cfg.snomed_version).alias("version"),
                F.lit("255599008").alias("code"),
                F.lit("Incomplete (qualifier value)").alias("display"),
            )
        ),
    )
    category = F.when(
        ~primary,
        F.array(
            F.struct(
                F.array(
                    F.struct(
                        F.lit(C.SNOMED).alias("system"),
                        F.lit(cfg.snomed_version).alias("version"),
                        F.lit("394593009").alias("code"),
                        F.lit("Medical oncology (qualifier value)").alias("display"),
                    )
                ).alias("coding")
            )
        ),
    )
    recorded = _partial(F.col("recorded_date"))
    evidence = F.when(
        F.col("evidence_list_id").isNotNull(),
        F.array(F.struct(F.array(_ref(reference("List", F.col("evidence_list_id")))).alias("detail"))),
    )
    return _head(
        cfg,
        tag,
        extension=F.concat(morphology, date, follows),
        identifier=F.array(_identifier()),
        verificationStatus=_concept(F.col("verification")),
        category=category,
        code=_concept(F.col("icd"), F.col("code_text")),
        bodySite=_filled(F.array_compact(F.array(site, side))),
        subject=_subject(cfg),
        recordedDate=recorded,
        recordedDate_=F.when(recorded.isNull(), _absent("unknown")),
        evidence=evidence,
    )


def _observation(cfg: MappingConfig) -> dict[str, Column]:
    kind, absent = F.col("value_kind"), F.col("value_absent")
    prefix = _filled(
        F.transform(
            "code_extension",
            lambda c: F.struct(
                F.lit(cfg.extension("tnm-cp-praefix")).alias("url"),
                F.struct(F.array(_coding(c)).alias("coding")).alias("valueCodeableConcept"),
            ),
        )
    )
    suffix = _filled(
        F.transform(
            "value_suffixes",
            lambda c: F.struct(
                F.when(c["code"] == "sn", cfg.extension("tnm-sn-suffix"))
                .otherwise(cfg.extension("tnm-itc-suffix"))
                .alias("url"),
                F.struct(F.array(_coding(c)).alias("coding")).alias("valueCodeableConcept"),
                F.lit(None).cast("string").alias("valueCode"),
            ),
        )
    )
    missing = F.transform(
        data_absent(absent),
        lambda e: F.struct(
            e["url"].alias("url"),
            F.lit(None).cast(
                "struct<coding:array<struct<extension:array<struct<url:string,valueDecimal:decimal(18,6)>>,"
                "system:string,version:string,_version:struct<extension:array<struct<url:string,valueCode:string>>>,"
                "code:string,_code:struct<extension:array<struct<url:string,valueCode:string>>>,"
                "display:string,userSelected:boolean>>>"
            ).alias("valueCodeableConcept"),
            e["valueCode"].alias("valueCode"),
        ),
    )
    concept = _concept(F.col("value_codings"), F.col("value_text"), F.coalesce(suffix, missing))
    effective = _partial(F.col("effective"))
    specimen = F.col("specimen_id")
    components = F.transform(
        _filled(F.col("components")),
        lambda c: F.struct(
            F.struct(F.array(_coding(c["code"])).alias("coding")).alias("code"),
            F.struct(F.array(_coding(c["value"])).alias("coding")).alias("valueCodeableConcept"),
        ),
    )
    note = F.when(
        F.col("kind") == "genetic_variant", F.array(F.struct(F.col("note").alias("text")))
    )
    interpretation = _concept(F.col("interpretation"), F.col("interpretation_text"))
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        status=F.lit("final"),
        category=_each_concept(F.col("category")),
        code=_concept(F.col("code"), F.col("code_text"), prefix),
        subject=_subject(cfg),
        focus=_refs(F.col("focus_refs")),
        effectiveDateTime=effective,
        effectiveDateTime_=_absent(F.when(effective.isNull(), F.col("effective_absent"))),
        valueCodeableConcept=F.when(kind == "concept", concept),
        valueQuantity=F.when(
            kind == "quantity",
            _quantity(F.col("value_num"), F.col("value_unit"), F.col("value_unit_code"), data_absent(absent)),
        ),
        valueInteger=F.when(kind == "integer", F.col("value_num").cast("bigint")),
        interpretation=_single(interpretation),
        note=note,
        method=_concept(F.col("method")),
        specimen=_ref(reference("Specimen", specimen)),
        hasMember=F.transform(
            _filled(F.col("member_ids")), lambda i: F.struct(reference("Observation", i).alias("reference"))
        ),
        derivedFrom=F.transform(
            _filled(F.col("derived_from_ids")),
            lambda i: F.struct(reference("Observation", i).alias("reference")),
        ),
        component=components,
    )


def _procedure(cfg: MappingConfig) -> dict[str, Column]:
    kind = F.col("kind")

    def by_kind(suffix, kinds):
        url = None
        for name, stem in kinds.items():
            url = (F if url is None else url).when(kind.isin(*name), cfg.extension(f"{stem}-{suffix}"))
        return url

    stems = {
        ("surgery", "surgery_part"): "operation",
        ("radiotherapy",): "strahlentherapie",
        ("systemic",): "systemische-therapie",
    }
    shape = "struct<url:string,valueCodeableConcept:struct<coding:array<struct<system:string,code:string>>>," \
            "valueQuantity:struct<value:decimal(18,6),unit:string,system:string,code:string>>"

    def concept_extension(url, codings):
        value = F.struct(
            F.transform(
                codings, lambda c: F.struct(c["system"].alias("system"), c["code"].alias("code"))
            ).alias("coding")
        )
        return F.when(
            codings.isNotNull(),
            F.struct(url.alias("url"), value.alias("valueCodeableConcept"), F.lit(None).alias("valueQuantity")),
        ).cast(shape)

    def dose_extension(suffix, dose):
        value = F.struct(
            dose["value"].alias("value"), dose["unit"].alias("unit"),
            F.lit(C.UCUM).alias("system"), dose["unit"].alias("code"),
        )
        return F.when(
            dose.isNotNull(),
            F.struct(
                F.lit(cfg.extension(f"strahlentherapie-bestrahlung-{suffix}")).alias("url"),
                F.lit(None).alias("valueCodeableConcept"),
                value.alias("valueQuantity"),
            ),
        ).cast(shape)

    extensions = F.array_compact(
        F.array(
            concept_extension(by_kind("intention", stems), F.col("intention")),
            concept_extension(by_kind("stellungzurop", stems), F.col("position_to_surgery")),
            concept_extension(F.lit(C.PROCEDURE_METHOD), F.col("method")),
            dose_extension("gesamtdosis", F.col("total_dose")),
            dose_extension("einzeldosis", F.col("single_dose")),
            concept_extension(F.lit(cfg.extension("strahlentherapie-bestrahlung-boost")), F.col("boost")),
        )
    )
    side = F.when(
        F.col("body_site_side").isNotNull(),
        F.array(
            F.struct(
                F.lit(cfg.extension("strahlentherapie-bestrahlung-seitenlokalisation")).alias("url"),
                _concept(F.col("body_site_side")).alias("valueCodeableConcept"),
            )
        ),
    )
    performed = _partial(F.col("performed"))
    start, end = _partial(F.col("period_start")), _partial(F.col("period_end"))
    period = F.when(
        start.isNotNull() | end.isNotNull() | F.col("period_start_absent").isNotNull(),
        _object(start=start, start_=_absent(F.col("period_start_absent")), end=end),
    )
    used = F.array_compact(
        F.array(
            _concept(F.col("used_code"), F.lit(None).cast("string")),
            _concept(F.lit(None).cast(CODINGS), F.col("protocol")),
        )
    )
    return _head(
        cfg,
        extension=_filled(extensions),
        identifier=F.array(_identifier()),
        partOf=_single(_ref(reference("Procedure", F.col("part_of_id")))),
        status=F.col("status"),
        category=_concept(F.col("category")),
        code=_concept(F.col("code")),
        subject=_subject(cfg),
        performedDateTime=performed,
        performedDateTime_=_absent(F.col("performed_absent")),
        performedPeriod=period,
        reasonReference=_single(_ref(reference("Condition", F.col("reason_condition_id")))),
        bodySite=_single(_concept(F.col("body_site"), None, side)),
        outcome=_concept(F.col("outcome")),
        usedCode=_filled(used),
    )


def _medication_statement(cfg: MappingConfig) -> dict[str, Column]:
    medication = F.col("medication_id")
    absent_code = F.struct(
        F.array(
            F.struct(F.lit(C.ATC).alias("system"), _absent(F.col("code_absent")).alias("_code"))
        ).alias("coding"),
        F.col("medication_text").alias("text"),
    )
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        partOf=_single(_ref(reference("Procedure", F.col("part_of_id")))),
        status=F.col("status"),
        medicationReference=F.when(
            medication.isNotNull(),
            F.struct(
                reference("Medication", medication).alias("reference"),
                F.col("medication_text").alias("display"),
            ),
        ),
        medicationCodeableConcept=F.when(medication.isNull(), absent_code),
        subject=_subject(cfg),
        effectivePeriod=_period(F.col("period_start"), F.col("period_end")),
        reasonReference=_single(_ref(reference("Condition", F.col("reason_condition_id")))),
    )


def _medication(cfg: MappingConfig) -> dict[str, Column]:
    unknown = F.struct(
        F.array(
            F.struct(
                F.lit(C.SNOMED).alias("system"),
                F.lit(cfg.snomed_version).alias("version"),
                _absent("not-applicable").alias("_code"),
            )
        ).alias("coding")
    )
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        code=_concept(F.col("code"), F.col("text")),
        ingredient=F.array(F.struct(unknown.alias("itemCodeableConcept"))),
    )


def _specimen(cfg: MappingConfig) -> dict[str, Column]:
    collected = _partial(F.col("collected"))
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        accessionIdentifier=F.when(
            F.col("accession_no").isNotNull(), F.struct(F.col("accession_no").alias("value"))
        ),
        subject=_subject(cfg),
        collection=F.when(collected.isNotNull(), F.struct(collected.alias("collectedDateTime"))),
    )


def _diagnostic_report(cfg: MappingConfig) -> dict[str, Column]:
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        basedOn=_single(_ref(reference("CarePlan", F.col("based_on_id")))),
        status=F.lit("final"),
        code=_concept(F.col("code")),
        subject=_subject(cfg),
        specimen=_single(_ref(reference("Specimen", F.col("specimen_id")))),
        conclusion=F.col("conclusion"),
        conclusion_=_absent(F.col("conclusion_absent")),
    )


def _adverse_event(cfg: MappingConfig) -> dict[str, Column]:
    return _head(
        cfg,
        identifier=_identifier(),
        actuality=F.lit("actual"),
        event=_concept(F.col("event"), F.col("event_text"), data_absent(F.col("event_absent"))),
        subject=_subject(cfg),
        seriousness=_concept(F.col("grade")),
        suspectEntity=F.array(
            F.struct(_ref(reference("Procedure", F.col("suspect_procedure_id"))).alias("instance"))
        ),
    )


def _care_plan(cfg: MappingConfig) -> dict[str, Column]:
    activity = F.transform(
        _filled(F.col("activities")),
        lambda a: F.struct(
            F.struct(
                F.struct(F.array(_coding(a["code"])).alias("coding")).alias("code"),
                a["status"].alias("status"),
                F.struct(F.array(_coding(a["status_reason"])).alias("coding")).alias("statusReason"),
            ).alias("detail")
        ),
    )
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        status=F.col("status"),
        intent=F.lit("plan"),
        category=_single(_concept(F.col("category"), None, data_absent(F.col("category_absent")))),
        subject=_subject(cfg),
        created=_partial(F.col("created")),
        addresses=_single(_ref(reference("Condition", F.col("condition_id")))),
        activity=activity,
    )


def _list(cfg: MappingConfig) -> dict[str, Column]:
    return _head(
        cfg,
        identifier=F.array(_identifier()),
        status=F.col("status"),
        mode=F.col("mode"),
        title=F.col("title"),
        subject=_subject(cfg),
        entry=F.transform(
            _filled(F.col("entry_refs")), lambda r: F.struct(F.struct(r.alias("reference")).alias("item"))
        ),
    )


def _coding_literal(system: str, code: str, display: str) -> Column:
    return F.struct(F.lit(system).alias("system"), F.lit(code).alias("code"), F.lit(display).alias("display"))


def _concept_literal(system: str, code: str, display: str) -> Column:
    return F.struct(F.array(_coding_literal(system, code, display)).alias("coding"))


def _provenance(cfg: MappingConfig) -> dict[str, Column]:
    recorded = F.date_format("recorded", "yyyy-MM-dd'T'HH:mm:ssXXX")
    agent = F.struct(
        _concept_literal(C.PROVENANCE_PARTICIPANT, "assembler", "Assembler").alias("type"),
        F.array(_concept_literal(C.V3_PARTICIPATION_TYPE, "AUT", "author")).alias("role"),
        F.struct(
            F.struct(
                F.lit(cfg.identifier_system("device-id")).alias("system"),
                F.col("agent_device").alias("value"),
            ).alias("identifier"),
            F.col("agent_display").alias("display"),
        ).alias("who"),
    )
    source = F.struct(
        F.lit("source").alias("role"),
        F.struct(
            F.struct(
                F.lit(cfg.identifier_system("obds-meldung-id")).alias("system"),
                F.col("entity_report_id").alias("value"),
            ).alias("identifier")
        ).alias("what"),
    )
    return {
        "resourceType": F.col("resource_type"),
        "id": F.col("id"),
        "target": _refs(F.col("target_refs")),
        "occurredDateTime": recorded,
        "recorded": recorded,
        "activity": _concept_literal(C.V3_DATA_OPERATION, "CREATE", "create"),
        "agent": F.array(agent),
        "entity": F.array(source),
    }


def _device(cfg: MappingConfig) -> dict[str, Column]:
    return {
        "resourceType": F.col("resource_type"),
        "id": F.col("id"),
        "identifier": F.array(_identifier()),
        "status": F.col("status"),
        "deviceName": F.array(
            F.struct(F.col("name").alias("name"), F.lit("user-friendly-name").alias("type"))
        ),
        "type": _concept(F.col("type")),
        "version": F.array(F.struct(F.col("version").alias("value"))),
    }


BODIES = {
    "Patient": _patient,
    "Condition": _condition,
    "Observation": _observation,
    "Procedure": _procedure,
    "MedicationStatement": _medication_statement,
    "Medication": _medication,
    "Specimen": _specimen,
    "DiagnosticReport": _diagnostic_report,
    "AdverseEvent": _adverse_event,
    "CarePlan": _care_plan,
    "List": _list,
    "Provenance": _provenance,
    "Device": _device,
}


def _carries_decimal(kind: str) -> Column | None:
    """Which rows of a type have a decimal in their JSON; none for most types."""
    if kind == "Observation":
        return (F.col("value_kind") == "quantity") | F.col("kind").startswith("gleason")
    if kind == "Procedure":
        return F.col("single_dose").isNotNull() | F.col("total_dose").isNotNull()
    return None


def resource_body(kind: str, cfg: MappingConfig = DEFAULT) -> Column:
    """A resource of one type as a struct, from the columns of its table."""
    return _object(**BODIES[kind](cfg))


def body_json(kind: str, body: Column) -> Column:
    """JSON text of a resource struct. Decimals lose the zeros their fixed scale adds."""
    text = F.to_json(body)
    decimal = _carries_decimal(kind)
    if decimal is None:
        return text
    trimmed = F.regexp_replace(
        text, r'("(?:value|valueDecimal)":-?\d+)(?:\.0+|(\.\d*?[1-9])0+)(?=[,}])', "$1$2"
    )
    return F.when(decimal, trimmed).otherwise(text)


def resource_json(kind: str, cfg: MappingConfig = DEFAULT) -> Column:
    """JSON text of a resource of one type from the columns of its table."""
    return body_json(kind, resource_body(kind, cfg))


def to_envelope(
    table: DataFrame, kind: str, cfg: MappingConfig = DEFAULT, change: BodyChange | None = None
) -> DataFrame:
    """Envelope rows of one resource table; ``kind`` is its resource type.

    ``change`` gets the type, the resource as a struct column and its schema, and returns the struct to
    write instead.
    """
    subject = F.lit(None).cast("string") if kind in ("Medication", "Provenance", "Device", "Patient") else F.col("patient_ref")
    body = resource_body(kind, cfg)
    if change is not None:
        body = change(kind, body, table.select(body.alias("body")).schema["body"].dataType)
    return table.select(
        "*",
        F.concat_ws("/", "resource_type", "id").alias("full_url"),
        subject.alias("subject_ref"),
        body_json(kind, body).alias("resource_json"),
    ).select(*ENVELOPE_COLUMNS)
