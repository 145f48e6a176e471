"""Registry reports derived from order and customer tables, so that every job runs at table scale.

One report per order, one patient per customer. Each value is a plain SQL expression over the order
(``SOURCE`` first, ``VALUES`` on top of it, with ``{i}`` for the position of a repeated element), so
the expected results can be written independently in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncolake import schemas as S
from oncolake.config import MappingConfig

CONFIG = MappingConfig(patient_id_regex=r"^Customer#0*([1-9]\d*)$")
KINDS = ("Diagnose", "Verlauf", "SYST", "ST", "OP", "Pathologie", "Tumorkonferenz", "Tod")


def _pick(number: str, *values: str | None) -> str:
    """CASE that picks by a number; None gives null."""
    cases = " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(values) if v is not None)
    return f"CASE {number} {cases} END"


SOURCE = {
    "k": "o_orderkey",
    "cust": "o_custkey",
    "name": "c_name",
    "day": "CAST(o_orderdate AS DATE)",
    "status": "o_orderstatus",
    "nation": "c_nationkey",
    "prec": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'E' WHEN '2-HIGH' THEN 'T' "
        "WHEN '3-MEDIUM' THEN 'M' WHEN '4-NOT SPECIFIED' THEN 'V' END"
    ),
    "kind": "CAST(o_orderkey % 97 % 8 AS INT)",
}
_TEXT = "CAST({} AS STRING)"
_K = _TEXT.format("k")
_C = _TEXT.format("cust")
_DAY = "CAST(day AS STRING)"

VALUES = {
    "export_id": f"lpad({_K}, 12, '0')",
    "version": "CAST(month(day) AS INT)",
    "report_id": f"{_C} || '_' || CAST(kind AS STRING) || '/M' || CAST(k % 5 AS STRING)",
    "tumor_id": "'T' || CAST(k % 3 AS STRING)",
    "recorded": _DAY,
    "sex": _pick("nation % 5", "W", "M", "D", "U", "X"),
    "birth": "CAST(DATE '1930-01-01' + CAST(cust * 37 % 25000 AS INT) AS STRING)",
    "birth_prec": _pick("nation % 4", "E", "T", "M", "V"),
    "country": _pick("nation % 4", "de", "AUT", "Germany"),
    "postcode": f"CASE WHEN cust % 7 <> 0 THEN lpad({_C}, 5, '0') END",
    "icd": _pick("k % 6", "C61", "C50.9", "C34.1", "C18.7", "D05.1", "C20"),
    "icd_version": _pick("k % 4", "10 2023 GM", "10 2019 WHO", "Sonstige"),
    "diagnosed": "CAST(day - CAST(k % 400 AS INT) AS STRING)",
    "side": _pick("k % 7", "L", "R", "B", "M", "T", "U"),
    "morphology": "CASE WHEN k % 4 <> 1 THEN '8140/3' END",
    "reason_end": _pick("CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END",
                        "behandlungsende", "behandlungsbeginn"),
    "reason_change": _pick("CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END",
                           "statusaenderung", "statusmeldung"),
    # histology
    "has_histology": "k % 5 <> 4",
    "histology_id": f"CASE WHEN k % 3 <> 2 THEN 'H ' || {_K} END",
    "histology_date": _DAY,
    "accession": f"'E-' || {_K}",
    "grading": _pick("k % 7", "1", "2", "3", "T", "U"),
    "nodes_examined": "CASE WHEN k % 3 <> 0 THEN CAST(k % 30 AS STRING) END",
    "nodes_affected": "CASE WHEN k % 2 = 0 THEN CAST(k % 11 AS STRING) END",
    "sentinel_examined": "CASE WHEN k % 9 = 1 THEN CAST(k % 4 AS STRING) END",
    "sentinel_affected": "CASE WHEN k % 9 = 2 THEN CAST(k % 3 AS STRING) END",
    "morphologies": "1 + k % 4",
    "morphology_code": _pick("{i}", "8140/3", "8500/3", "8140/3", "8500/3"),
    "morphology_version": _pick("{i}", "32", None, "33", "31"),
    # repeated findings
    "sites": "k % 4",
    "site": _pick("{i}", "OSS", "BRA"),
    "site_prec": _pick("{i}", "E", "T", "V"),
    "genes": "CASE WHEN k % 2 = 1 THEN 1 + k % 3 ELSE 0 END",
    "gene": _pick("{i}", "NRAS", "KRAS", "BRAF"),
    "gene_expression": _pick("{i}", "M", None, "W"),
    "gene_other": _pick("{i}", None, "andere"),
    "classes": "k % 3",
    "class_name": _pick("{i}", "FIGO", "Ann Arbor"),
    "class_stage": _pick("{i}", "IIIB", "II"),
    "class_date": f"CASE {{i}} WHEN 0 THEN {_DAY} END",
    "performance": _pick("k % 7", "0", "2", "90%", "30%", "U", "70%"),
    "study_date": f"CASE WHEN k % 3 = 0 THEN {_DAY} END",
    "study_answer": "CASE WHEN k % 3 = 1 THEN 'N' END",
    "has_study": "k % 3 <> 2",
    # staging
    "has_ctnm": "k % 3 <> 0",
    "has_ptnm": "k % 5 = 0",
    "tnm_id": f"CASE WHEN k % 4 <> 0 THEN 'S' || {_K} END",
    "tnm_date": f"CASE WHEN k % 6 <> 0 THEN {_DAY} END",
    "tnm_version": "'8'",
    "tnm_t": _pick("k % 5", "1", "2a", "3", "is"),
    "tnm_t_prefix": _pick("k % 4", "c", "p", "u"),
    "tnm_n": _pick("k % 6", "0", "1(sn)", "0 (i-)(sn)", "2b", "0(i+)"),
    "tnm_n_prefix": _pick("k % 3", "c", "p"),
    "tnm_m": _pick("k % 4", "0", "1", "0(i+)"),
    "tnm_m_prefix": _pick("k % 5", "c", "p", "u"),
    "tnm_a": "CASE WHEN k % 13 = 0 THEN 'a' END",
    "tnm_multi": "CASE WHEN k % 11 = 0 THEN 'm' END",
    "tnm_l": "CASE WHEN k % 4 = 1 THEN 'L1' END",
    "tnm_pn": "CASE WHEN k % 4 = 2 THEN 'PnX' END",
    "tnm_r": "CASE WHEN k % 7 = 0 THEN 'r' END",
    "tnm_s": "CASE WHEN k % 9 = 0 THEN 'S1' END",
    "tnm_v": "CASE WHEN k % 4 = 3 THEN 'V0' END",
    "tnm_y": "CASE WHEN k % 5 = 1 THEN 'y' END",
    "stage": _pick("k % 5", "IV", "IIA", "okk", "unsinn"),
    # prostate module
    "has_prostate": "k % 3 = 1",
    "gleason_primary": _pick("k % 4", "3", "4", "5"),
    "gleason_secondary": _pick("k % 5", "3", "4", "5", "4"),
    "gleason_result": "CASE WHEN k % 4 = 3 OR k % 5 = 4 THEN CAST(6 + k % 4 AS STRING) END",
    "gleason_method": _pick("k % 4", "O", "S", "U"),
    "psa": "CASE WHEN k % 2 = 0 THEN CAST(k % 50 AS STRING) || '.5' END",
    "cores": "CASE WHEN k % 4 <> 1 THEN CAST(k % 13 AS STRING) END",
    "positive_cores": "CASE WHEN k % 4 = 2 THEN CAST(k % 6 AS STRING) END",
    "core_percent": "CASE WHEN k % 5 = 1 THEN CAST(k % 100 AS STRING) END",
    "core_unknown": "CASE WHEN k % 5 IN (1, 2) THEN 'U' END",
    "clavien": _pick("k % 6", "N", "IIIa", "V"),
    # diagnosis only
    "topography": "CASE WHEN k % 5 <> 0 THEN 'C50.' || CAST(k % 10 AS STRING) END",
    "topography_text": f"CASE WHEN k % 3 = 0 THEN 'Region ' || {_C} END",
    "certainty": _pick("k % 5", "1", "2", "7"),
    "earlier": "k % 4",
    "earlier_icd": "CASE {i} WHEN 0 THEN 'C4' || CAST(k % 9 AS STRING) || '.9' END",
    "earlier_version": _pick("{i}", "10 2018 GM"),
    "earlier_text": f"CASE {{i}} WHEN 1 THEN 'früherer Tumor ' || {_C} END",
    "earlier_year": "CASE WHEN {i} = 0 THEN CAST(1980 + k % 30 AS STRING) END",
    # progress
    "course_id": f"{_C} || '.V' || CAST(k % 2 AS STRING)",
    "overall": _pick("k % 5", "V", "t", "K", "P"),
    "local_status": _pick("k % 4", "K", "r", "X"),
    "node_status": _pick("k % 3", "N", "F"),
    "distant_status": _pick("k % 5", "U", "P", "t"),
    # therapies
    "therapy_id": f"{_C} || '.' || CAST(kind AS STRING)",
    "intention": _pick("k % 3", "K", "P", "S"),
    "position": _pick("k % 4", "O", "A", "N"),
    "therapy": _pick(
        "k % 13", "CH", "IM", "CI", "CIZ", "CZ", "IZ", "ZS", "SZ", "HO", "WW", "AS", "SO"
    ),
    "protocol": "CASE WHEN k % 3 = 0 THEN 'FOLFOX ' || CAST(k % 7 AS STRING) END",
    "start": f"CASE WHEN k % 7 <> 0 THEN {_DAY} END",
    "finish": "CASE WHEN k % 4 <> 0 THEN CAST(day + CAST(k % 90 AS INT) AS STRING) END",
    "end_reason": _pick("k % 5", "E", "V", "A"),
    "substances": "1 + k % 4",
    "substance_code": _pick("{i}", "L01FF05", None, "L01FF05"),
    "substance_version": _pick("{i}", "2020", None, "2022"),
    "substance_name": _pick("{i}", "Atezolizumab", "Bicalutamid", "Atezolizumab neu", "Unbekannt-X"),
    "effects": "k % 3",
    "effect_name": _pick("{i}", "Schüttelfrost", "Fieber"),
    "effect_code": _pick("{i}", None, "10016558"),
    "effect_grade": _pick("{i}", "3", "5"),
    "effect_version": _pick("{i}", "Sonstige", "26.1"),
    "effect_limit": "CASE WHEN k % 5 = 0 THEN 'U' END",
    "doses": "k % 5",
    "dose_kind": "CASE WHEN k % 6 = 0 THEN 2 ELSE (k + {i}) % 5 END",
    "dose_start": "CASE WHEN {i} <> 1 THEN CAST(day + {i} AS STRING) END",
    "dose_finish": "CASE WHEN k % 2 = 0 THEN CAST(day + 30 + {i} AS STRING) END",
    "dose_target_old": "CASE WHEN k % 3 = 0 THEN '1.' || CAST({i} AS STRING) || '.' END",
    "dose_target_new": "'6.' || CAST({i} AS STRING)",
    "dose_side": _pick("k % 4", "L", "R"),
    "dose_single": "CAST(1 + {i} AS STRING) || '.8'",
    "dose_total": "CASE WHEN k % 2 = 1 THEN CAST(40 + {i} AS STRING) END",
    # surgery
    "procedures": "k % 4",
    "procedure_code": _pick("{i}", "5-604.02", "1-100", "5-604.02", "8-900"),
    "procedure_version": _pick("{i}", "2021", None, "2023"),
    "residual_local": _pick("k % 4", "R0", "R1", "RX"),
    "residual_total": _pick("k % 5", "R0", "R1", "R2"),
    # pathology
    "finding_id": f"CASE WHEN k % 2 = 0 THEN 'B/' || {_K} END",
    "finding": f"CASE WHEN k % 3 <> 0 THEN 'Befund \"' || {_K} || '\" ohne Auffälligkeit' END",
    # board and death
    "board_id": f"{_C} || '-TK'",
    "board_type": _pick("k % 3", "praeth", "postth"),
    "advice": "k % 4",
    "advice_kind": _pick("{i}", "OP", "ST", "CH"),
    "deviation": _pick("k % 3", "J", "N", "U"),
    "death_related": _pick("k % 4", "J", "N", "U"),
    "has_causes": "k % 3 <> 0",
    "causes": "1 + k % 2",
    "cause": _pick("{i}", "C61", "I21.9"),
    "cause_version": _pick("{i}", "10 2022 GM"),
}
MOST_REPEATS = 4


def _value(name: str, i: int | None = None) -> str:
    return f"({VALUES[name].replace('{i}', str(i))})"


def _when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _present(name: str, value: str, i: int | None = None) -> str:
    return _when(f"{_value(name, i)} IS NOT NULL", value)


def _shaped(kind: T.StructType, values: dict[str, str]) -> str:
    """SQL for a struct of a schema type; fields that are not given are null."""
    members = []
    for field in kind.fields:
        null = f"CAST(NULL AS {field.dataType.simpleString()})"
        members.append(f"'{field.name}', {values.get(field.name, null)}")
    return f"named_struct({', '.join(members)})"


def _repeat(count: str, kind: T.ArrayType, make) -> str:
    """SQL for the first ``count`` elements made for positions 0, 1, ..."""
    items = [_when(f"{_value(count)} > {i}", _shaped(kind.elementType, make(i))) for i in range(MOST_REPEATS)]
    return f"array_compact(array({', '.join(items)}))"


def _histology() -> str:
    codes = S.HISTOLOGY["Morphologie_ICD_O"].dataType
    return _when(
        VALUES["has_histology"],
        _shaped(
            S.HISTOLOGY,
            {
                "_Histologie_ID": _value("histology_id"),
                "Tumor_Histologiedatum": _date("histology_date"),
                "Histologie_EinsendeNr": _value("accession"),
                "Morphologie_ICD_O": _repeat(
                    "morphologies",
                    codes,
                    lambda i: {"Code": _value("morphology_code", i), "Version": _value("morphology_version", i)},
                ),
                "Morphologie_Freitext": "'Karzinom'",
                "Grading": _value("grading"),
                "LK_untersucht": _value("nodes_examined"),
                "LK_befallen": _value("nodes_affected"),
                "Sentinel_LK_untersucht": _value("sentinel_examined"),
                "Sentinel_LK_befallen": _value("sentinel_affected"),
            },
        ),
    )


def _date(name: str, precision: str = "prec", i: int | None = None) -> str:
    given = "prec" if precision == "prec" else _value(precision, i)
    return _present(
        name, _shaped(S.PDATE, {"_VALUE": _value(name, i), "_Datumsgenauigkeit": given}), i
    )


def _tnm() -> str:
    fields = {
        "_ID": "tnm_id", "Datum": "tnm_date", "Version": "tnm_version", "T": "tnm_t",
        "c_p_u_Praefix_T": "tnm_t_prefix", "N": "tnm_n", "c_p_u_Praefix_N": "tnm_n_prefix",
        "M": "tnm_m", "c_p_u_Praefix_M": "tnm_m_prefix", "a_Symbol": "tnm_a",
        "m_Symbol": "tnm_multi", "L": "tnm_l", "Pn": "tnm_pn", "r_Symbol": "tnm_r", "S": "tnm_s",
        "V": "tnm_v", "y_Symbol": "tnm_y", "UICC_Stadium": "stage",
    }
    return _shaped(S.TNM, {field: _value(name) for field, name in fields.items()})


def _sites() -> str:
    kind = S.SITES["Fernmetastase"].dataType

    def make(i):
        date = _shaped(S.PDATE, {"_VALUE": _DAY, "_Datumsgenauigkeit": _value("site_prec", i)})
        return {"Lokalisation": _value("site", i), "Diagnosedatum": date}

    return _shaped(S.SITES, {"Fernmetastase": _repeat("sites", kind, make)})


def _genes() -> str:
    kind = S.GENES["Genetische_Variante"].dataType

    def make(i):
        return {
            "Bezeichnung": _value("gene", i),
            "Auspraegung": _value("gene_expression", i),
            "Sonstige_Auspraegung": _value("gene_other", i),
            "Datum": _shaped(S.PDATE, {"_VALUE": _DAY, "_Datumsgenauigkeit": "prec"}),
        }

    return _shaped(S.GENES, {"Genetische_Variante": _repeat("genes", kind, make)})


def _classes() -> str:
    kind = S.CLASSES["Weitere_Klassifikation"].dataType

    def make(i):
        day = _value("class_date", i)
        date = _present("class_date", _shaped(S.PDATE, {"_VALUE": day, "_Datumsgenauigkeit": "'E'"}), i)
        return {"Name": _value("class_name", i), "Stadium": _value("class_stage", i), "Datum": date}

    return _shaped(S.CLASSES, {"Weitere_Klassifikation": _repeat("classes", kind, make)})


def _study() -> str:
    answer = _shaped(
        S.GENERAL["Studienteilnahme"].dataType,
        {"Datum": _value("study_date"), "NU": _value("study_answer")},
    )
    return _when(VALUES["has_study"], _shaped(S.GENERAL, {"Studienteilnahme": answer}))


def _prostate() -> str:
    score = _shaped(
        S.PROSTATE["GleasonScore"].dataType,
        {
            "GradPrimaer": _value("gleason_primary"),
            "GradSekundaer": _value("gleason_secondary"),
            "ScoreErgebnis": _value("gleason_result"),
        },
    )
    involvement = _shaped(
        S.PROSTATE["CaBefallStanze"].dataType,
        {"Prozentzahl": _value("core_percent"), "U": _value("core_unknown")},
    )
    return _when(
        VALUES["has_prostate"],
        _shaped(
            S.PROSTATE,
            {
                "GleasonScore": score,
                "AnlassGleasonScore": _value("gleason_method"),
                "DatumStanzen": _DAY,
                "AnzahlStanzen": _value("cores"),
                "AnzahlPosStanzen": _value("positive_cores"),
                "CaBefallStanze": _present("core_unknown", involvement),
                "PSA": _value("psa"),
                "DatumPSA": _DAY,
                "KomplPostOP_ClavienDindo": _value("clavien"),
            },
        ),
    )


def _side_effects() -> str:
    listed = S.SIDE_EFFECTS["Menge_Nebenwirkung"].dataType
    kind = listed["Nebenwirkung"].dataType

    def make(i):
        art = _shaped(
            kind.elementType["Art"].dataType,
            {"Bezeichnung": _value("effect_name", i), "MedDRA_Code": _value("effect_code", i)},
        )
        return {"Art": art, "Grad": _value("effect_grade", i), "Version": _value("effect_version", i)}

    return _shaped(
        S.SIDE_EFFECTS,
        {
            "Grad_maximal2_oder_unbekannt": _value("effect_limit"),
            "Menge_Nebenwirkung": _shaped(listed, {"Nebenwirkung": _repeat("effects", kind, make)}),
        },
    )


def _doses() -> str:
    listed = S.RADIOTHERAPY["Menge_Bestrahlung"].dataType
    kind = listed["Bestrahlung"].dataType
    applied = S.RADIATION["Applikationsart"].dataType

    def make(i):
        target = _shaped(
            S.TARGET,
            {"CodeVersion2014": _value("dose_target_old", i), "CodeVersion2021": _value("dose_target_new", i)},
        )
        single = _shaped(S.DOSE, {"Dosis": _value("dose_single", i), "Einheit": "'Gy'"})
        total = _present(
            "dose_total", _shaped(S.DOSE, {"Dosis": _value("dose_total", i), "Einheit": "'Gy'"}), i
        )
        shared = {
            "Zielgebiet": target,
            "Seite_Zielgebiet": _value("dose_side", i),
            "Einzeldosis": single,
            "Gesamtdosis": total,
        }
        number = _value("dose_kind", i)
        outer = {**shared, "Strahlenart": "'UH'", "Radiochemo": "'RCN'",
                 "Stereotaktisch": "'ST'", "Boost": "'SIB'"}
        contact = {**shared, "Strahlenart": "'Co-60'", "Interstitiell_endokavitaer": "'I'",
                   "Rate_Type": "'HDR'"}
        nuclear = {**shared, "Strahlenart": "'Y-90'", "Metabolisch_Typ": "'SIRT'"}
        kinds = {
            "Perkutan": _when(f"{number} = 0", _shaped(applied["Perkutan"].dataType, outer)),
            "Kontakt": _when(f"{number} = 1", _shaped(applied["Kontakt"].dataType, contact)),
            "Metabolisch": _when(f"{number} = 2", _shaped(applied["Metabolisch"].dataType, nuclear)),
            "Sonstige": _when(f"{number} = 3", _shaped(applied["Sonstige"].dataType, shared)),
        }
        return {
            "Beginn": _value("dose_start", i),
            "Ende": _value("dose_finish", i),
            "Applikationsart": _when(f"{number} < 4", _shaped(applied, kinds)),
        }

    return _shaped(listed, {"Bestrahlung": _repeat("doses", kind, make)})


def _sections() -> dict[str, str]:
    earlier = S.DIAGNOSIS["Menge_Fruehere_Tumorerkrankung"].dataType
    substances = S.SYSTEMIC["Menge_Substanz"].dataType
    procedures = S.SURGERY["Menge_OPS"].dataType
    advice = S.BOARD["Therapieempfehlung"].dataType
    causes = S.DEATH["Menge_Todesursachen"].dataType
    clinical = {
        "Histologie": _histology(),
        "Menge_FM": _sites(),
        "Menge_Genetik": _genes(),
        "Menge_Weitere_Klassifikation": _classes(),
        "Modul_Prostata": _prostate(),
    }
    staged = {"cTNM": _when(VALUES["has_ctnm"], _tnm()), "pTNM": _when(VALUES["has_ptnm"], _tnm())}
    kinds_of_therapy = advice["Menge_Typ_Therapieempfehlung"].dataType
    advised = ", ".join(
        _when(f"{_value('advice')} > {i}", _value("advice_kind", i)) for i in range(3)
    )
    return {
        "Diagnose": _shaped(
            S.DIAGNOSIS,
            {
                **clinical,
                **staged,
                "Primaertumor_Topographie_ICD_O": _present(
                    "topography",
                    _shaped(S.CODE, {"Code": _value("topography"), "Version": "'32'"}),
                ),
                "Primaertumor_Topographie_Freitext": _value("topography_text"),
                "Diagnosesicherung": _value("certainty"),
                "Menge_Fruehere_Tumorerkrankung": _shaped(
                    earlier,
                    {
                        "Fruehere_Tumorerkrankung": _repeat(
                            "earlier",
                            earlier["Fruehere_Tumorerkrankung"].dataType,
                            lambda i: {
                                "Freitext": _value("earlier_text", i),
                                "ICD": _present(
                                    "earlier_icd",
                                    _shaped(S.CODE, {"Code": _value("earlier_icd", i),
                                                     "Version": _value("earlier_version", i)}),
                                    i,
                                ),
                                "Diagnosedatum": _value("earlier_year", i),
                            },
                        )
                    },
                ),
                "Allgemeiner_Leistungszustand": _value("performance"),
                "Modul_Allgemein": _study(),
            },
        ),
        "Verlauf": _shaped(
            S.PROGRESS,
            {
                **clinical,
                "TNM": _when(VALUES["has_ctnm"], _tnm()),
                "_Verlauf_ID": _value("course_id"),
                "Meldeanlass": _value("reason_change"),
                "Untersuchungsdatum_Verlauf": _DAY,
                "Gesamtbeurteilung_Tumorstatus": _value("overall"),
                "Verlauf_Lokaler_Tumorstatus": _value("local_status"),
                "Verlauf_Tumorstatus_Lymphknoten": _value("node_status"),
                "Verlauf_Tumorstatus_Fernmetastasen": _value("distant_status"),
                "Allgemeiner_Leistungszustand": _value("performance"),
                "Modul_Allgemein": _study(),
            },
        ),
        "SYST": _shaped(
            S.SYSTEMIC,
            {
                "_SYST_ID": _value("therapy_id"),
                "Meldeanlass": _value("reason_end"),
                "Intention": _value("intention"),
                "Stellung_OP": _value("position"),
                "Therapieart": _value("therapy"),
                "Protokoll": _value("protocol"),
                "Beginn": _date("start"),
                "Ende": _value("finish"),
                "Ende_Grund": _value("end_reason"),
                "Menge_Substanz": _shaped(
                    substances,
                    {
                        "Substanz": _repeat(
                            "substances",
                            substances["Substanz"].dataType,
                            lambda i: {
                                "Bezeichnung": _value("substance_name", i),
                                "ATC": _present("substance_code", _shaped(S.CODE, {"Code": _value("substance_code", i),
                                                     "Version": _value("substance_version", i)}), i),
                            },
                        )
                    },
                ),
                "Nebenwirkungen": _side_effects(),
                "Modul_Allgemein": _study(),
            },
        ),
        "ST": _shaped(
            S.RADIOTHERAPY,
            {
                "_ST_ID": _value("therapy_id"),
                "Meldeanlass": _value("reason_end"),
                "Intention": _value("intention"),
                "Stellung_OP": _value("position"),
                "Ende_Grund": _value("end_reason"),
                "Menge_Bestrahlung": _doses(),
                "Nebenwirkungen": _side_effects(),
                "Modul_Allgemein": _study(),
            },
        ),
        "OP": _shaped(
            S.SURGERY,
            {
                **{k: v for k, v in clinical.items() if k in ("Histologie", "Menge_Genetik", "Modul_Prostata")},
                "TNM": _when(VALUES["has_ctnm"], _tnm()),
                "_OP_ID": f"{_value('therapy_id')} || '-' || {_K}",
                "Intention": _value("intention"),
                "Datum": _value("start"),
                "Menge_OPS": _shaped(
                    procedures,
                    {
                        "OPS": _repeat(
                            "procedures",
                            procedures["OPS"].dataType,
                            lambda i: {"Code": _value("procedure_code", i), "Version": _value("procedure_version", i)},
                        )
                    },
                ),
                "Residualstatus": _shaped(
                    S.SURGERY["Residualstatus"].dataType,
                    {
                        "Lokale_Beurteilung_Residualstatus": _value("residual_local"),
                        "Gesamtbeurteilung_Residualstatus": _value("residual_total"),
                    },
                ),
                "Modul_Allgemein": _study(),
            },
        ),
        "Pathologie": _shaped(
            S.PATHOLOGY,
            {**clinical, **staged, "Befund_ID": _value("finding_id"), "Befundtext": _value("finding")},
        ),
        "Tumorkonferenz": _shaped(
            S.BOARD,
            {
                "_Tumorkonferenz_ID": _value("board_id"),
                "Meldeanlass": _value("reason_end"),
                "Datum": _date("histology_date"),
                "Typ": _value("board_type"),
                "Therapieempfehlung": _shaped(
                    advice,
                    {
                        "Menge_Typ_Therapieempfehlung": _shaped(
                            kinds_of_therapy, {"Typ_Therapieempfehlung": f"array_compact(array({advised}))"}
                        ),
                        "Abweichung_Patientenwunsch": _value("deviation"),
                    },
                ),
            },
        ),
        "Tod": _shaped(
            S.DEATH,
            {
                "_Abschluss_ID": _K,
                "Sterbedatum": _value("start"),
                "Tod_tumorbedingt": _value("death_related"),
                "Menge_Todesursachen": _when(
                    VALUES["has_causes"],
                    _shaped(
                        causes,
                        {
                            "Todesursache_ICD": _repeat(
                                "causes",
                                causes["Todesursache_ICD"].dataType,
                                lambda i: {"Code": _value("cause", i), "Version": _value("cause_version", i)},
                            )
                        },
                    ),
                ),
            },
        ),
    }


#: Orders that one task expands at most; their documents fit into a small task's memory when they are sorted.
ORDERS_PER_TASK = 200_000


def _spread(df: DataFrame, tasks: int, key: str = "o_orderkey") -> DataFrame:
    """Deal some rows out evenly; expanding them to documents is costly, moving them is not.

    The number of tasks is given, as without one the adaptive planner would merge partitions by their
    small size before the expansion.
    """
    return df.repartition(tasks, key)


def _tasks(spark: SparkSession, rows: int) -> int:
    """The default parallelism as often as the number of rows asks for, so that a task's share, and with
    it what it spills, does not grow with the table."""
    slots = spark.sparkContext.defaultParallelism
    return slots * max(1, -(-rows // (slots * ORDERS_PER_TASK)))


def derived_documents(
    spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = KINDS
) -> DataFrame:
    """One decoded document per order: ``export_id, version, document``.

    ``kinds`` keeps the orders whose report has one of these sections, so that a job on one section
    does not build the others.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    # Dealt out after the join: where that is no broadcast, its own shuffle would undo what was dealt before.
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    source = joined.select(*[F.expr(sql).alias(name) for name, sql in SOURCE.items()])
    if set(kinds) != set(KINDS):
        source = source.filter(F.col("kind").isin([KINDS.index(k) for k in kinds]))
    source = _spread(source, _tasks(spark, orders.count()), "k")
    sections = {
        name: _when(f"kind = {KINDS.index(name)}", section)
        for name, section in _sections().items()
        if name in kinds
    }
    tumor = _shaped(
        S.TUMOR,
        {
            "_Tumor_ID": _value("tumor_id"),
            "Primaertumor_ICD": _shaped(S.CODE, {"Code": _value("icd"), "Version": _value("icd_version")}),
            "Diagnosedatum": _date("diagnosed"),
            "Seitenlokalisation": _value("side"),
            "Morphologie_ICD_O": _present(
                "morphology", _shaped(S.CODE, {"Code": _value("morphology"), "Version": "'32'"})
            ),
        },
    )
    report = _shaped(
        S.REPORT,
        {
            "_Meldung_ID": _value("report_id"),
            "Meldebegruendung": "'I'",
            "Tumorzuordnung": tumor,
            **sections,
        },
    )
    address = _shaped(
        S.MASTER_DATA["Adresse"].dataType, {"Land": _value("country"), "PLZ": _value("postcode")}
    )
    master = _shaped(
        S.MASTER_DATA,
        {
            "Geschlecht": _value("sex"),
            "Geburtsdatum": _date("birth", "birth_prec"),
            "Adresse": _when("cust % 5 <> 3", address),
        },
    )
    patient = _shaped(
        S.PATIENT,
        {
            "_Patient_ID": "name",
            "Patienten_Stammdaten": master,
            "Menge_Meldung": _shaped(
                S.PATIENT["Menge_Meldung"].dataType, {"Meldung": f"array({report})"}
            ),
        },
    )
    document = _shaped(
        S.DOCUMENT,
        {
            "_Schema_Version": "'3.0.2'",
            "Meldedatum": _value("recorded"),
            "Menge_Patient": _shaped(
                S.DOCUMENT["Menge_Patient"].dataType, {"Patient": f"array({patient})"}
            ),
        },
    )
    return source.select(
        F.expr(_value("export_id")).alias("export_id"),
        F.expr(_value("version")).alias("version"),
        F.expr(document).alias("document"),
    )


def derived_xml(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The derived documents as XML text: ``export_id, version, xml``."""
    documents = derived_documents(spark, sf_dir, kinds)
    return documents.select(
        "export_id", "version", F.to_xml("document", {"rowTag": "oBDS"}).alias("xml")
    )
