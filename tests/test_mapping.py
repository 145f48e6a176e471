"""Own reports through the whole pipeline, checked on the resource JSON."""

import json
from dataclasses import replace

import pytest

from oncolake import DEFAULT
from oncolake.operators.bundles import stamp_source
from oncolake.operators.deidentify import deidentify
from oncolake.plans import pipeline
from oncolake.sources.sinks import grouped_report_xml
from oncolake.sources.reports import parse_reports
from tests import fixtures as X

CFG = replace(DEFAULT, create_provenance=True)


@pytest.fixture(scope="module")
def resources(spark):
    rows = [
        ("001", 1, X.document("9", X.report("V1", X.radiotherapy("behandlungsbeginn")), recorded="2024-01-01")),
        ("002", 1, X.document("9", X.report("V2", X.radiotherapy("behandlungsende", "2021-03-01")))),
        ("003", 1, X.document("9", X.report("D1", X.DIAGNOSIS, icd="C34"))),
        ("004", 2, X.document("9", X.report("D1", X.DIAGNOSIS))),
        ("005", 1, X.document("9", X.report("S1", X.SYSTEMIC))),
        ("006", 1, X.document("9", X.report("O1", X.SURGERY, version=None, date=None))),
        ("007", 1, X.document("9", X.report("X1", X.death()), X.report("X2", X.death("2023-04-05")))),
        ("008", 1, X.document("9", X.report("B1", X.BOARD))),
        ("009", 1, "<oBDS"),
        ("010", 1, '<ADT_GEKID Schema_Version="2.2.1"><Absender/></ADT_GEKID>'),
    ]
    raw = spark.createDataFrame(rows, "export_id string, version int, xml string")
    drugs = spark.createDataFrame([("Bicalutamid", "L02BB03")], "name string, atc_code string")
    bundles, bad = pipeline.reports_to_bundles(raw, CFG, drug_map=drugs)
    made = bundles.collect()
    assert len(made) == 1 and made[0]["part"] == 0
    assert sorted(r["error"] for r in bad.collect()) == ["document is not well-formed", "legacy report format"]
    bundle = json.loads(made[0]["bundle_json"])
    assert made[0]["bundle_key"].startswith(f"Patient/{bundle['id']} - Condition/")
    for entry in bundle["entry"]:
        assert entry["request"] == {"method": "PUT", "url": entry["fullUrl"]}
        assert entry["fullUrl"] == f"{entry['resource']['resourceType']}/{entry['resource']['id']}"
    return [entry["resource"] for entry in bundle["entry"]]


def find(resources, kind, suffix="", **fields):
    found = [
        r
        for r in resources
        if r["resourceType"] == kind
        and any(p.endswith(suffix) for p in r.get("meta", {}).get("profile", [""]))
        and all(r.get(k) == v for k, v in fields.items())
    ]
    return found


def codes(concept):
    return [c.get("code") for c in concept["coding"]]


def test_patient(resources):
    (patient,) = find(resources, "Patient")
    assert resources[0] == patient
    assert patient["gender"] == "male" and patient["birthDate"] == "1950"
    assert patient["deceasedDateTime"] == "2023-04-05" and "deceasedBoolean" not in patient
    (address,) = patient["address"]
    assert address["country"] == "DE" and "_postalCode" in address and "postalCode" not in address


def test_diagnosis_overwrites_incomplete_condition_in_place(resources):
    primary, earlier = find(resources, "Condition")
    assert resources.index(primary) == 1
    assert "tag" not in primary["meta"]
    assert codes(primary["code"]) == ["C61"] and primary["code"]["coding"][0]["version"] == "2023"
    assert [codes(s) for s in primary["bodySite"]] == [["C61.9"], ["L", "7771000"]]
    urls = [e["url"].rsplit("/", 1)[-1] for e in primary["extension"]]
    assert urls == ["mii-ex-onko-histology-morphology-behavior-icdo3", "condition-assertedDate", "condition-occurredFollowing"]
    assert primary["extension"][0]["valueCodeableConcept"]["coding"][0]["version"] == "33"
    assert primary["extension"][2]["valueReference"]["reference"] == f"Condition/{earlier['id']}"
    assert earlier["code"] == {"text": "Hautkrebs"}
    assert earlier["extension"][0]["valueDateTime"] == "1999"


def test_evidence_list_names_exactly_the_observations_of_the_diagnosis(resources):
    (evidence,) = find(resources, "List")
    primary = find(resources, "Condition")[0]
    assert primary["evidence"][0]["detail"][0]["reference"] == f"List/{evidence['id']}"
    listed = [e["item"]["reference"] for e in evidence["entry"]]
    made = [
        f"Observation/{r['id']}"
        for r in resources
        if r["resourceType"] == "Observation"
        and not any(p.endswith(("tod", "residualstatus", "clavien-dindo")) for p in r["meta"]["profile"])
    ]
    assert listed == made


def test_staging(resources):
    (grouping,) = find(resources, "Observation", "tnm-klassifikation")
    assert codes(grouping["valueCodeableConcept"]) == ["IIA"] and len(grouping["hasMember"]) == 3
    (nodes,) = find(resources, "Observation", "tnm-n-kategorie")
    assert nodes["identifier"][0]["value"] == "T7-c-N"
    assert codes(nodes["code"]) == ["371494008"] and codes(nodes["valueCodeableConcept"]) == ["N1"]
    assert [e["valueCodeableConcept"]["coding"][0]["code"] for e in nodes["valueCodeableConcept"]["extension"]] == ["sn", "i+"]


def test_observations(resources):
    sites = find(resources, "Observation", "fernmetastasen")
    assert [s["identifier"][0]["value"] for s in sites] == ["D1-Diagnose-0", "D1-Diagnose-1"]
    assert "_effectiveDateTime" in sites[0] and codes(sites[0]["valueCodeableConcept"]) == ["OSS"]
    assert sites[1]["valueCodeableConcept"]["extension"][0]["valueCode"] == "unknown"
    (psa,) = find(resources, "Observation", "prostate-psa")
    assert psa["valueQuantity"]["value"] == 4.5 and psa["effectiveDateTime"] == "2020-01-15"
    (involved,) = find(resources, "Observation", "ca-befall-stanze")
    assert involved["valueQuantity"] == {"extension": [{"url": "http://hl7.org/fhir/StructureDefinition/data-absent-reason", "valueCode": "unknown"}]}
    (grade,) = find(resources, "Observation", "gleason-grade-group")
    assert grade["valueCodeableConcept"]["text"] == "3+4" and len(grade["derivedFrom"]) == 2
    assert grade["valueCodeableConcept"]["coding"][0]["extension"][0]["valueDecimal"] == 7
    (ecog,) = find(resources, "Observation", "leistungszustand-ecog")
    assert codes(ecog["valueCodeableConcept"]) == ["1", "LA9623-5"]
    (gene,) = find(resources, "Observation", "genetische-variante")
    assert gene["interpretation"][0]["text"] == "selten" and codes(gene["interpretation"][0]) == ["S"]
    (complication,) = find(resources, "Observation", "clavien-dindo")
    parent = [p for p in find(resources, "Procedure", "operation") if "partOf" not in p][0]
    assert [f["reference"].split("/")[0] for f in complication["focus"]] == ["Condition", "Procedure"]
    assert complication["focus"][1]["reference"] == f"Procedure/{parent['id']}"


def test_therapies(resources):
    (bracket,) = find(resources, "Procedure", "onko-strahlentherapie")
    assert bracket["status"] == "completed"
    assert bracket["performedPeriod"] == {"start": "2021-01-05", "end": "2021-03-01"}
    (dose,) = find(resources, "Procedure", "bestrahlung-strahlentherapie")
    assert dose["identifier"][0]["value"] == "R-1-1"
    assert dose["partOf"][0]["reference"] == f"Procedure/{bracket['id']}"
    method = [e for e in dose["extension"] if e["url"].endswith("procedure-method")][0]
    assert codes(method["valueCodeableConcept"]) == ["PRCN-4D"]
    total = [e for e in dose["extension"] if e["url"].endswith("gesamtdosis")][0]
    assert total["valueQuantity"]["value"] == 50.4
    surgeries = find(resources, "Procedure", "operation")
    assert [codes(s["code"])[0] for s in surgeries] == ["387713003", "1-100", "5-604.02"]
    assert surgeries[2]["code"]["coding"][0]["version"] == "2023" and "_performedDateTime" in surgeries[0]


def test_medication(resources):
    statements = find(resources, "MedicationStatement")
    medications = find(resources, "Medication")
    assert len(statements) == 3
    assert sorted(m["identifier"][0]["value"] for m in medications) == ["L01FF05", "L02BB03"]
    unmapped = [s for s in statements if "medicationCodeableConcept" in s]
    assert [s["medicationCodeableConcept"]["text"] for s in unmapped] == ["Neu-1"]
    mapped = [m for m in medications if m["identifier"][0]["value"] == "L02BB03"][0]
    assert mapped["code"]["coding"][0]["userSelected"] is False
    (event,) = find(resources, "AdverseEvent")
    assert event["event"]["extension"][0]["valueCode"] == "not-applicable"


def test_board_death_and_provenance(resources):
    (plan,) = find(resources, "CarePlan")
    assert plan["status"] == "completed" and plan["activity"][0]["detail"]["status"] == "completed"
    assert plan["category"][0]["extension"][0]["valueCode"] == "unknown"
    deaths = find(resources, "Observation", "onko-tod")
    assert len(deaths) == 1 and deaths[0]["effectiveDateTime"] == "2023-04-05"
    provenance = [r for r in resources if r["resourceType"] == "Provenance"]
    by_report = {p["entity"][0]["what"]["identifier"]["value"]: p for p in provenance}
    assert set(by_report) == {"V2", "D1", "S1", "O1", "X1", "X2", "B1"}
    assert [t["reference"].split("/")[0] for t in by_report["B1"]["target"]] == ["Condition", "CarePlan"]


@pytest.mark.parametrize("strategy", ["sha256", "md5", "dashes", "plain", "record_id", "existing"])
def test_entries_give_the_bundle_id_of_the_policy(spark, strategy):
    from pyspark.sql.functions import lit

    from oncolake.operators.patient_reference import patient_reference
    from oncolake.operators.reports import entries_bundle_id, patient_policy

    known = {"record_id": "patient_id string, record_id string", "existing": "identifier_value string, id string"}
    lookup = spark.createDataFrame([("7", "k-7")], known[strategy]) if strategy in known else None
    patients = spark.createDataFrame([("7",), ("8",)], "patient_id string")
    for source_id in (False, True):
        for reuse in (False, True):
            cfg = replace(
                DEFAULT, patient_reference_strategy=strategy, use_source_patient_id=source_id,
                create_patient_if_exists=reuse,
            )
            decided = patient_policy(patient_reference(patients, cfg, lookup=lookup), cfg)
            # Two entries a patient, one of a kind that names no subject.
            entries = decided.withColumn("subject_ref", decided["patient_ref"]).unionByName(
                decided.withColumn("subject_ref", lit(None).cast("string"))
            )
            rows = entries.groupBy("patient_id", "bundle_id").agg(entries_bundle_id(cfg).alias("made")).collect()
            assert len(rows) == 2 and all(r["made"] == r["bundle_id"] for r in rows)


@pytest.mark.parametrize("strategy, source_id, reuse", [("existing", False, True), ("md5", True, False)])
def test_bundle_id_and_key_follow_the_patient_policy(spark, strategy, source_id, reuse):
    cfg = replace(
        DEFAULT, patient_reference_strategy=strategy, use_source_patient_id=source_id,
        create_patients=True, create_patient_if_exists=reuse,
    )
    known = {"record_id": ("patient_id string, record_id string"), "existing": "identifier_value string, id string"}
    lookup = spark.createDataFrame([("7", "k-7")], known[strategy]) if strategy in known else None
    raw = spark.createDataFrame(
        [("1", 1, X.document("7", X.report("a", X.BOARD))), ("2", 1, X.document("8", X.report("b", X.BOARD)))],
        "export_id string, version int, xml string",
    )
    bundles, _ = pipeline.reports_to_bundles(raw, cfg, lookup=lookup)
    rows = {r["patient_id"]: r for r in bundles.collect()}
    assert set(rows) == {"7", "8"}
    for patient, row in rows.items():
        made = json.loads(row["bundle_json"])
        written = [e["resource"]["id"] for e in made["entry"] if e["resource"]["resourceType"] == "Patient"]
        found = patient == "7" and strategy in known
        assert len(written) == (0 if found and not reuse else 1)
        assert all(i == made["id"] for i in written)
        assert row["bundle_key"].startswith(f"Patient/{made['id']} - Condition/")
        if found and reuse:
            assert made["id"] == "k-7"
        elif source_id:
            assert made["id"] == patient


def test_directory_mode_keeps_documents_apart(spark):
    rows = [("a.xml", X.document("1", X.report("r1", X.BOARD), X.report("r2", X.DIAGNOSIS))), ("b.xml", X.document("1"))]
    raw = spark.createDataFrame(rows, "file_name string, xml string")
    bundles, bad = pipeline.documents_to_bundles(raw)
    made = {r["source_document"]: json.loads(r["bundle_json"]) for r in bundles.collect()}
    assert set(made) == {"a.xml", "b.xml"} and bad.count() == 0
    kinds = [e["resource"]["resourceType"] for e in made["b.xml"]["entry"]]
    assert kinds == ["Patient"]
    condition = [e["resource"] for e in made["a.xml"]["entry"] if e["resource"]["resourceType"] == "Condition"][0]
    assert "tag" not in condition["meta"]


def test_deidentified_json_holds_no_source_id(spark, resources):
    from pyspark.sql import functions as F

    rows = [
        ("9", "T1", "r", r["resourceType"], r["id"], f"{r['resourceType']}/{r['id']}", "9", "Patient/x", json.dumps(r, separators=(",", ":")))
        for r in resources
    ]
    schema = "patient_id string, tumor_id string, report_id string, resource_type string, id string, full_url string, identifier_value string, subject_ref string, resource_json string"
    df = deidentify(spark.createDataFrame(rows, schema), "key")
    ids = {r["id"] for r in resources}
    for row in df.collect():
        body = json.loads(row["resource_json"])
        assert body["id"] == row["id"] and not any(i in row["resource_json"] for i in ids)
    stamped = stamp_source(df, "urn:x").filter(F.col("resource_type") == "Patient").collect()[0]
    assert json.loads(stamped["resource_json"])["meta"]["source"] == "urn:x"


def test_grouped_reports_round_trip(spark):
    from pyspark.sql import functions as F

    raw = spark.createDataFrame(
        [("1", 1, X.document("9", X.report("a", X.BOARD), X.report("b", X.SURGERY)))], "export_id string, version int, xml string"
    )
    from oncolake.operators.consolidate import merge_report_group
    from oncolake.operators.reports import explode_reports, normalize_patient_id

    rows = normalize_patient_id(explode_reports(parse_reports(raw)))
    merged = merge_report_group(
        rows, ["patient_id", "tumor_id"], F.col("report"), ["report_pos"],
        {"recorded": F.col("report_date").cast("string"), "master": F.col("master")}, ["report_date", "report_pos"],
    )
    written = grouped_report_xml(merged)
    assert written.select("key").collect()[0]["key"] == "9-T1"
    again = explode_reports(parse_reports(written.withColumnRenamed("value", "xml")))
    assert [r["report_id"] for r in again.orderBy("report_pos").collect()] == ["a", "b"]
