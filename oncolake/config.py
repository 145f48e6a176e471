"""Settings shared by every operator, as one immutable value."""

from __future__ import annotations

from dataclasses import dataclass

# Public code-system and extension addresses that results must carry unchanged.
LOINC = "http://loinc.org"
SNOMED = "http://snomed.info/sct"
OPS = "http://fhir.de/CodeSystem/bfarm/ops"
ATC = "http://fhir.de/CodeSystem/bfarm/atc"
ICD10GM = "http://fhir.de/CodeSystem/bfarm/icd-10-gm"
ICDO3 = "http://terminology.hl7.org/CodeSystem/icd-o-3"
UCUM = "http://unitsofmeasure.org"
MEDDRA = "https://www.meddra.org"
TNM_UICC = "https://www.uicc.org/resources/tnm"
OBSERVATION_CATEGORY = "http://terminology.hl7.org/CodeSystem/observation-category"
DIAGNOSTIC_SECTION = "http://terminology.hl7.org/CodeSystem/v2-0074"
IDENTIFIER_TYPE = "http://terminology.hl7.org/CodeSystem/v2-0203"
V3_OBSERVATION_VALUE = "http://terminology.hl7.org/CodeSystem/v3-ObservationValue"
V3_DATA_OPERATION = "http://terminology.hl7.org/CodeSystem/v3-DataOperation"
V3_PARTICIPATION_TYPE = "http://terminology.hl7.org/CodeSystem/v3-ParticipationType"
PROVENANCE_PARTICIPANT = "http://terminology.hl7.org/CodeSystem/provenance-participant-type"
CONDITION_VER_STATUS = "http://terminology.hl7.org/CodeSystem/condition-ver-status"
VITAL_STATUS = "https://www.medizininformatik-initiative.de/fhir/core/modul-person/CodeSystem/Vitalstatus"
DATA_ABSENT_REASON = "http://hl7.org/fhir/StructureDefinition/data-absent-reason"
ASSERTED_DATE = "http://hl7.org/fhir/StructureDefinition/condition-assertedDate"
OCCURRED_FOLLOWING = "http://hl7.org/fhir/StructureDefinition/condition-occurredFollowing"
ORDINAL_VALUE = "http://hl7.org/fhir/StructureDefinition/ordinalValue"
PROCEDURE_METHOD = "http://hl7.org/fhir/StructureDefinition/procedure-method"
ONCOLOGY = "https://www.medizininformatik-initiative.de/fhir/ext/modul-onko"
PERSON = "https://www.medizininformatik-initiative.de/fhir/core/modul-person"
MEDICATION = "https://www.medizininformatik-initiative.de/fhir/core/modul-medikation"


@dataclass(frozen=True)
class MappingConfig:
    """What a deployment may change. Defaults give neutral identifiers."""

    identifier_base_url: str = "https://oncolake.example/identifiers"
    patient_id_regex: str = r"^(.*)$"
    meta_source: str = ""
    patient_reference_strategy: str = "sha256"
    use_source_patient_id: bool = False
    create_patients: bool = True
    create_patient_if_exists: bool = False
    skip_unknown_patients: bool = False
    create_provenance: bool = False
    include_pathology: bool = True
    device_name: str = "oncolake"
    device_version: str = "0.1.0"
    loinc_version: str = "2.82"
    snomed_version: str = "http://snomed.info/sct/900000000000207008/version/20250701"
    ops_version: str = "2026"
    atc_version: str = "2025"
    #: XSD that report documents must conform to, readable by every executor; None: not checked.
    schema_path: str | None = None

    def identifier_system(self, kind: str) -> str:
        """Address of one identifier namespace, e.g. ``patient-id``."""
        return f"{self.identifier_base_url}/{kind}"

    def profile(self, suffix: str) -> str:
        return f"{ONCOLOGY}/StructureDefinition/mii-pr-onko-{suffix}"

    def extension(self, suffix: str) -> str:
        return f"{ONCOLOGY}/StructureDefinition/mii-ex-onko-{suffix}"

    def code_system(self, suffix: str) -> str:
        return f"{ONCOLOGY}/CodeSystem/mii-cs-onko-{suffix}"

    @property
    def patient_profile(self) -> str:
        return f"{PERSON}/StructureDefinition/PatientPseudonymisiert"

    @property
    def vital_status_profile(self) -> str:
        return f"{PERSON}/StructureDefinition/Vitalstatus"

    @property
    def medication_profile(self) -> str:
        return f"{MEDICATION}/StructureDefinition/Medication"


DEFAULT = MappingConfig()
