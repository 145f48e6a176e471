"""Schemas: the report document, report exports, patient status rows and resource tables."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _many(kind) -> T.ArrayType:
    return T.ArrayType(kind)


CODE = _struct(Code=S, Version=S)
# A date whose attribute says how exact it is: E day, T month, M year, V not at all.
PDATE = _struct(_Datumsgenauigkeit=S, _VALUE=S)
DOSE = _struct(Dosis=S, Einheit=S)
TARGET = _struct(CodeVersion2014=S, CodeVersion2021=S)

HISTOLOGY = _struct(
    _Histologie_ID=S,
    Tumor_Histologiedatum=PDATE,
    Histologie_EinsendeNr=S,
    Morphologie_ICD_O=_many(CODE),
    Morphologie_Freitext=S,
    Grading=S,
    LK_untersucht=S,
    LK_befallen=S,
    Sentinel_LK_untersucht=S,
    Sentinel_LK_befallen=S,
)
TNM = _struct(
    _ID=S,
    Datum=S,
    Version=S,
    y_Symbol=S,
    r_Symbol=S,
    a_Symbol=S,
    m_Symbol=S,
    c_p_u_Praefix_T=S,
    T=S,
    c_p_u_Praefix_N=S,
    N=S,
    c_p_u_Praefix_M=S,
    M=S,
    L=S,
    V=S,
    Pn=S,
    S=S,
    UICC_Stadium=S,
)
PROSTATE = _struct(
    GleasonScore=_struct(GradPrimaer=S, GradSekundaer=S, ScoreErgebnis=S),
    AnlassGleasonScore=S,
    DatumStanzen=S,
    AnzahlStanzen=S,
    AnzahlPosStanzen=S,
    CaBefallStanze=_struct(Prozentzahl=S, U=S),
    PSA=S,
    DatumPSA=S,
    KomplPostOP_ClavienDindo=S,
)
GENERAL = _struct(Studienteilnahme=_struct(Datum=S, NU=S))
SITES = _struct(Fernmetastase=_many(_struct(Lokalisation=S, Diagnosedatum=PDATE)))
GENES = _struct(
    Genetische_Variante=_many(
        _struct(Bezeichnung=S, Auspraegung=S, Sonstige_Auspraegung=S, Datum=PDATE)
    )
)
CLASSES = _struct(Weitere_Klassifikation=_many(_struct(Datum=PDATE, Name=S, Stadium=S)))
SIDE_EFFECTS = _struct(
    Grad_maximal2_oder_unbekannt=S,
    Menge_Nebenwirkung=_struct(
        Nebenwirkung=_many(
            _struct(Art=_struct(Bezeichnung=S, MedDRA_Code=S), Grad=S, Version=S)
        )
    ),
)
DIAGNOSIS = _struct(
    Primaertumor_Topographie_ICD_O=CODE,
    Primaertumor_Topographie_Freitext=S,
    Diagnosesicherung=S,
    Menge_Fruehere_Tumorerkrankung=_struct(
        Fruehere_Tumorerkrankung=_many(_struct(Freitext=S, ICD=CODE, Diagnosedatum=S))
    ),
    Histologie=HISTOLOGY,
    Menge_FM=SITES,
    cTNM=TNM,
    pTNM=TNM,
    Menge_Weitere_Klassifikation=CLASSES,
    Menge_Genetik=GENES,
    Allgemeiner_Leistungszustand=S,
    Modul_Prostata=PROSTATE,
    Modul_Allgemein=GENERAL,
)
PROGRESS = _struct(
    _Verlauf_ID=S,
    Meldeanlass=S,
    Histologie=HISTOLOGY,
    TNM=TNM,
    Menge_Weitere_Klassifikation=CLASSES,
    Untersuchungsdatum_Verlauf=S,
    Gesamtbeurteilung_Tumorstatus=S,
    Verlauf_Lokaler_Tumorstatus=S,
    Verlauf_Tumorstatus_Lymphknoten=S,
    Verlauf_Tumorstatus_Fernmetastasen=S,
    Menge_FM=SITES,
    Menge_Genetik=GENES,
    Allgemeiner_Leistungszustand=S,
    Modul_Prostata=PROSTATE,
    Modul_Allgemein=GENERAL,
)
SYSTEMIC = _struct(
    _SYST_ID=S,
    Meldeanlass=S,
    Intention=S,
    Stellung_OP=S,
    Therapieart=S,
    Protokoll=S,
    Beginn=PDATE,
    Menge_Substanz=_struct(Substanz=_many(_struct(Bezeichnung=S, ATC=CODE))),
    Ende_Grund=S,
    Ende=S,
    Nebenwirkungen=SIDE_EFFECTS,
    Modul_Allgemein=GENERAL,
)
RADIATION = _struct(
    Beginn=S,
    Ende=S,
    Applikationsart=_struct(
        Perkutan=_struct(
            Zielgebiet=TARGET,
            Seite_Zielgebiet=S,
            Strahlenart=S,
            Radiochemo=S,
            Stereotaktisch=S,
            Atemgetriggert=S,
            Einzeldosis=DOSE,
            Gesamtdosis=DOSE,
            Boost=S,
        ),
        Kontakt=_struct(
            Interstitiell_endokavitaer=S,
            Rate_Type=S,
            Zielgebiet=TARGET,
            Seite_Zielgebiet=S,
            Strahlenart=S,
            Einzeldosis=DOSE,
            Gesamtdosis=DOSE,
            Boost=S,
        ),
        Metabolisch=_struct(
            Metabolisch_Typ=S,
            Zielgebiet=TARGET,
            Seite_Zielgebiet=S,
            Strahlenart=S,
            Einzeldosis=DOSE,
            Gesamtdosis=DOSE,
        ),
        Sonstige=_struct(
            Zielgebiet=TARGET,
            Seite_Zielgebiet=S,
            Einzeldosis=DOSE,
            Gesamtdosis=DOSE,
        ),
    ),
)
RADIOTHERAPY = _struct(
    _ST_ID=S,
    Meldeanlass=S,
    Intention=S,
    Stellung_OP=S,
    Ende_Grund=S,
    Menge_Bestrahlung=_struct(Bestrahlung=_many(RADIATION)),
    Nebenwirkungen=SIDE_EFFECTS,
    Modul_Allgemein=GENERAL,
)
SURGERY = _struct(
    _OP_ID=S,
    Intention=S,
    Datum=S,
    Menge_OPS=_struct(OPS=_many(CODE)),
    Histologie=HISTOLOGY,
    TNM=TNM,
    Residualstatus=_struct(Lokale_Beurteilung_Residualstatus=S, Gesamtbeurteilung_Residualstatus=S),
    Menge_Genetik=GENES,
    Modul_Prostata=PROSTATE,
    Modul_Allgemein=GENERAL,
)
PATHOLOGY = _struct(
    Befund_ID=S,
    Befundtext=S,
    Histologie=HISTOLOGY,
    Menge_FM=SITES,
    Menge_Genetik=GENES,
    cTNM=TNM,
    pTNM=TNM,
    Modul_Prostata=PROSTATE,
    Menge_Weitere_Klassifikation=CLASSES,
)
BOARD = _struct(
    _Tumorkonferenz_ID=S,
    Meldeanlass=S,
    Datum=PDATE,
    Typ=S,
    Therapieempfehlung=_struct(
        Menge_Typ_Therapieempfehlung=_struct(Typ_Therapieempfehlung=_many(S)),
        Abweichung_Patientenwunsch=S,
    ),
)
DEATH = _struct(
    _Abschluss_ID=S,
    Sterbedatum=S,
    Tod_tumorbedingt=S,
    Menge_Todesursachen=_struct(Todesursache_ICD=_many(CODE)),
)
TUMOR = _struct(
    _Tumor_ID=S,
    Primaertumor_ICD=CODE,
    Diagnosedatum=PDATE,
    Seitenlokalisation=S,
    Morphologie_ICD_O=CODE,
)
# The eight sections a report may carry, in the order their resources are emitted.
SECTIONS = {
    "Diagnose": DIAGNOSIS,
    "Verlauf": PROGRESS,
    "SYST": SYSTEMIC,
    "ST": RADIOTHERAPY,
    "Tod": DEATH,
    "OP": SURGERY,
    "Pathologie": PATHOLOGY,
    "Tumorkonferenz": BOARD,
}
REPORT = _struct(
    _Meldung_ID=S,
    _Melder_ID=S,
    Meldebegruendung=S,
    Eigene_Leistung=S,
    Tumorzuordnung=TUMOR,
    **SECTIONS,
)
MASTER_DATA = _struct(
    Nachname=S,
    Vornamen=S,
    Geschlecht=S,
    Geburtsdatum=PDATE,
    Adresse=_struct(Strasse=S, Hausnummer=S, Land=S, PLZ=S, Ort=S),
)
PATIENT = _struct(
    _Patient_ID=S,
    Patienten_Stammdaten=MASTER_DATA,
    Menge_Meldung=_struct(Meldung=_many(REPORT)),
)
DOCUMENT = _struct(
    _Schema_Version=S,
    Meldedatum=S,
    Menge_Patient=_struct(Patient=_many(PATIENT)),
)

EXPORT_ROW = "export_id STRING, reference_number STRING, report_number STRING, version INT, xml STRING"
PATIENT_STATUS = (
    "id STRING, patient_id STRING, last_information DATE, death_date DATE, modified_at TIMESTAMP"
)

# ---- resource tables -------------------------------------------------------------------------

CODING = (
    "struct<system:string,version:string,code:string,display:string,user_selected:boolean,"
    "code_absent:string,version_absent:string,ordinal:decimal(18,6)>"
)
CODINGS = f"array<{CODING}>"
PARTIAL_DATE = "struct<value:string,precision:string,date:date>"
QUANTITY = "struct<value:decimal(18,6),unit:string>"

# Every resource table starts with these columns.
COMMON = {
    "resource_type": "string",
    "id": "string",
    "identifier_system": "string",
    "identifier_value": "string",
    "profile": "string",
    "patient_id": "string",
    "patient_ref": "string",
    "patient_identifier": "string",
    "tumor_id": "string",
    "report_id": "string",
    "source_document": "string",
    "rank_key": "struct<has_diagnosis:int,priority:int,section_rank:int,report_date:date,pos:bigint,report_id:string>",
    "emit_seq": "bigint",
    "source_section": "string",
}
PATIENTS = {
    "gender": "string",
    "birth_date": PARTIAL_DATE,
    "deceased": "boolean",
    "deceased_date": PARTIAL_DATE,
    "has_address": "boolean",
    "postal_code": "string",
    "country": "string",
}
CONDITIONS = {
    "category": "string",
    "icd": CODINGS,
    "code_text": "string",
    "incomplete": "boolean",
    "morphology": "array<struct<code:string,version:string,text:string>>",
    "topography": "struct<code:string,version:string,text:string>",
    "verification": CODINGS,
    "laterality": CODINGS,
    "asserted_date": PARTIAL_DATE,
    "recorded_date": PARTIAL_DATE,
    "evidence_list_id": "string",
    "follows_condition_ids": "array<string>",
}
OBSERVATIONS = {
    "kind": "string",
    "category": CODINGS,
    "code": CODINGS,
    "code_text": "string",
    "code_extension": CODINGS,
    "value_kind": "string",
    "value_codings": CODINGS,
    "value_text": "string",
    "value_num": "decimal(18,6)",
    "value_unit": "string",
    "value_unit_code": "string",
    "value_absent": "string",
    "value_suffixes": CODINGS,
    "effective": PARTIAL_DATE,
    "effective_absent": "string",
    "interpretation": CODINGS,
    "interpretation_text": "string",
    "method": CODINGS,
    "focus_refs": "array<string>",
    "specimen_id": "string",
    "member_ids": "array<string>",
    "derived_from_ids": "array<string>",
    "components": f"array<struct<code:{CODING},value:{CODING}>>",
    "note": "string",
}
PROCEDURES = {
    "kind": "string",
    "status": "string",
    "category": CODINGS,
    "code": CODINGS,
    "performed": PARTIAL_DATE,
    "performed_absent": "string",
    "period_start": PARTIAL_DATE,
    "period_start_absent": "string",
    "period_end": PARTIAL_DATE,
    "reason_condition_id": "string",
    "part_of_id": "string",
    "outcome": CODINGS,
    "intention": CODINGS,
    "position_to_surgery": CODINGS,
    "used_code": CODINGS,
    "protocol": "string",
    "body_site": CODINGS,
    "body_site_side": CODINGS,
    "method": CODINGS,
    "single_dose": QUANTITY,
    "total_dose": QUANTITY,
    "boost": CODINGS,
}
MEDICATION_STATEMENTS = {
    "status": "string",
    "medication_id": "string",
    "medication_text": "string",
    "code_absent": "string",
    "period_start": PARTIAL_DATE,
    "period_end": PARTIAL_DATE,
    "part_of_id": "string",
    "reason_condition_id": "string",
}
MEDICATIONS = {"code": CODINGS, "text": "string"}
SPECIMENS = {"accession_no": "string", "collected": PARTIAL_DATE}
DIAGNOSTIC_REPORTS = {
    "code": CODINGS,
    "conclusion": "string",
    "conclusion_absent": "string",
    "specimen_id": "string",
    "based_on_id": "string",
}
ADVERSE_EVENTS = {
    "event": CODINGS,
    "event_text": "string",
    "event_absent": "string",
    "grade": CODINGS,
    "suspect_procedure_id": "string",
}
CARE_PLANS = {
    "status": "string",
    "category": CODINGS,
    "category_absent": "string",
    "created": PARTIAL_DATE,
    "condition_id": "string",
    "activities": f"array<struct<code:{CODING},status:string,status_reason:{CODING}>>",
}
LISTS = {"title": "string", "status": "string", "mode": "string", "entry_refs": "array<string>"}
PROVENANCE = {
    "target_refs": "array<string>",
    "recorded": "timestamp",
    "agent_device": "string",
    "agent_display": "string",
    "entity_report_id": "string",
}
DEVICES = {"name": "string", "version": "string", "status": "string", "type": CODINGS}

# The uniform row every resource can be turned into.
ENVELOPE_COLUMNS = [
    "patient_id",
    "tumor_id",
    "report_id",
    "source_document",
    "rank_key",
    "emit_seq",
    "resource_type",
    "id",
    "full_url",
    "profile",
    "identifier_system",
    "identifier_value",
    "subject_ref",
    "resource_json",
]
