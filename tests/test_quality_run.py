"""The nine suites over all sections against a plain version on collected base views."""

import collections
import re

from oncolake import config as C
from oncolake.plans import derived
from oncolake.quality import suites as Q
from oncolake.quality import views as V
from oncolake.queries import AS_OF, CFG, _tables

SF = "/root/testdata/sf0.001"


def plain(base):
    patients = {p["patient_id"]: p for p in base["patients"]}
    empty = dict.fromkeys(base["patients"][0]) if base["patients"] else {}

    def join(rows, reference, full=False, inner=False):
        out, seen = [], set()
        for r in rows:
            ref = r.get(reference)
            patient = patients.get(ref[8:]) if ref and ref.startswith("Patient/") else None
            seen.add(patient and patient["patient_id"])
            if patient or not inner:
                out.append({**r, **(patient or empty)})
        if full:
            nothing = dict.fromkeys(rows[0]) if rows else {}
            out += [{**nothing, **p} for i, p in patients.items() if i not in seen]
        return out

    conditions = join(base["conditions"], "subject_reference", full=True)
    observations = join(base["observations"], "subject_reference", full=True)
    procedures = join(base["procedures"], "subject_reference_procedure", inner=True)
    statements = join(base["medication_statements"], "subject_reference", inner=True)
    treated = []
    by_condition = collections.defaultdict(list)
    for p in base["procedures"]:
        by_condition[p["reason_reference_condition_id"]].append(p)
    none = dict.fromkeys(base["procedures"][0])
    for c in base["conditions"]:
        treated += [{**p, **c} for p in by_condition.get(c["condition_id"]) or [none]]
    treated = join(treated, "subject_reference", inner=True)
    tod = CFG.profile("tod")
    is_death = lambda r: bool(r["meta_profile"]) and r["meta_profile"].startswith(tod)
    dead = [r for r in base["observations"] if is_death(r)]
    known_dead = collections.Counter((r["subject_reference"], r["meta_profile"]) for r in observations if is_death(r))
    performance = []
    ecog = CFG.code_system("allgemeiner-leistungszustand-ecog")
    refs = {ref for ref, _ in known_dead}
    used = set()
    for r in observations:
        if r["value_codeable_concept_coding_system"] == ecog:
            used.add(r["subject_reference"])
            matches = [(p, n) for (ref, p), n in known_dead.items() if ref == r["subject_reference"] and ref is not None]
            performance += [(r["value_codeable_concept_coding_code"], p) for p, n in matches or [(None, 1)] for _ in range(n)]
    performance += [(None, p) for (ref, p), n in known_dead.items() if ref not in used for _ in range(n)]
    assert refs
    results = {}

    def rule(suite, name, rows, evaluated, good):
        looked = [r for r in rows if evaluated(r)]
        results[suite, name] = (len(looked), sum(not good(r) for r in looked))

    def given(suite, name, rows, column, where=lambda r: True):
        rule(suite, name, rows, where, lambda r: r[column] is not None)

    def between(suite, rows, column):
        rule(suite, f"{column} between 1900 and now", rows, lambda r: r[column] is not None,
             lambda r: Q.FIRST_DAY <= r[column] <= f"{AS_OF[:4]}-12-31")

    def pair(suite, name, rows, later, earlier, where=lambda r: True):
        rule(suite, name, rows, lambda r: where(r) and r[later] is not None and r[earlier] is not None,
             lambda r: r[later] >= r[earlier])

    def once(suite, name, rows, columns, where=lambda r: True):
        found = collections.Counter(tuple(r[c] for c in columns) for r in rows if where(r) and all(r[c] is not None for c in columns))
        results[suite, name] = (sum(found.values()), sum(n for n in found.values() if n > 1))

    s, rows = "conditions", conditions
    for column in ("date_of_birth", "deceased_date_time", "asserted_date"):
        between(s, rows, column)
    pair(s, "death not before birth", rows, "deceased_date_time", "date_of_birth")
    pair(s, "diagnosis not before birth", rows, "asserted_date", "date_of_birth")
    pair(s, "recorded not before birth", rows, "recorded_date", "date_of_birth")
    rule(s, "prostate cancer only in men", rows, lambda r: r["icd_code"] == "C61" and r["gender"] is not None, lambda r: r["gender"] == "male")
    for name, column in (("diagnosis date given", "asserted_date"), ("patient known", "patient_id"), ("condition id given", "condition_id"),
                         ("catalogue year given", "icd_version"), ("diagnosis code given", "icd_code"), ("recorded date given", "recorded_date")):
        given(s, name, rows, column)
    s, rows = "observations", observations
    other = CFG.profile("weitere-klassifikationen")
    coded = lambda r: r["meta_profile"] is not None and not r["meta_profile"].startswith(other)
    study = CFG.code_system("studienteilnahme")
    no_study = lambda r: r["value_codeable_concept_coding_system"] == study and r["value_codeable_concept_coding_code"] == "N"
    between(s, rows, "date_of_birth")
    between(s, rows, "effective_date_time")
    given(s, "code system given", rows, "code_system", coded)
    given(s, "code given", rows, "code_code", coded)
    given(s, "patient known", rows, "patient_id")
    given(s, "observation id given", rows, "observation_id")
    pair(s, "observed not before birth", rows, "effective_date_time", "date_of_birth")
    pair(s, "observed not after death", rows, "deceased_date_time", "effective_date_time")
    given(s, "observation date given", rows, "effective_date_time", lambda r: not no_study(r))
    once(s, "one death observation per patient", rows, ["patient_id"], is_death)
    given(s, "deceased flag given with a death date", rows, "deceased", lambda r: r["deceased_date_time"] is not None)
    given(s, "death date of a reported death", rows, "deceased_date_time", is_death)
    given(s, "patient of a reported death is deceased", rows, "deceased_date_time", is_death)
    s, rows = "procedures", procedures
    given(s, "patient known", rows, "patient_id")
    given(s, "procedure id given", rows, "procedure_id")
    pair(s, "performed not before birth", rows, "performed_date_time", "date_of_birth")
    pair(s, "performed not after death", rows, "deceased_date_time", "performed_date_time")
    for name, pattern, sex in (("no female organ surgery in men", r"^5-6[5-9]|^5-7[0-1]", "male"), ("no male organ surgery in women", r"^5-6[0-4]", "female")):
        rule(s, name, rows, lambda r, sex=sex: r["gender"] == sex and r["ops_code"] is not None, lambda r, p=pattern: not re.search(p, r["ops_code"]))
    between(s, rows, "performed_date_time")
    rule(s, "no date beside a period", rows, lambda r: r["performed_period_start"] is not None, lambda r: r["performed_date_time"] is None)
    rule(s, "no period beside a date", rows, lambda r: r["performed_date_time"] is not None, lambda r: r["performed_period_start"] is None)
    s, rows = "medication_statements", statements
    pair(s, "end not before start", rows, "effective_period_end", "effective_period_start")
    between(s, rows, "effective_period_start")
    pair(s, "start not before birth", rows, "effective_period_start", "date_of_birth")
    s, rows = "condition_procedure", treated
    rule(s, "no breast surgery in men without breast cancer", rows,
         lambda r: r["gender"] == "male" and r["icd_code"] is not None and r["icd_code"] != "C50.9" and r["ops_code"] is not None,
         lambda r: not re.search(r"^5-8[7-8]", r["ops_code"]))
    pair(s, "procedure not before diagnosis", rows, "performed_date_time", "asserted_date")
    pair(s, "surgery not before primary diagnosis", rows, "performed_date_time", "asserted_date",
         lambda r: r["meta_profile_con"] == CFG.profile("diagnose-primaertumor") and r["meta_profile_procedure"] == CFG.profile("operation"))
    spread = [r for r in observations if r["meta_profile"] and r["meta_profile"].startswith(CFG.profile("fernmetastasen"))]
    once("metastases", "metastasis reported once", spread, ["patient_id", "effective_date_time", "value_codeable_concept_coding_code"])
    five = [p for grade, p in performance if grade == "5"]
    results["performance_death", "death reported for grade five"] = (len(five), sum(p is None for p in five))
    given("death_completeness", "cause of death given", dead, "value_codeable_concept_coding_code")
    given("death_completeness", "relation to tumour given", dead, "interpretation_tod_tumorbedingt_code")
    rule("death_completeness", "relation to tumour not unknown", dead, lambda r: r["interpretation_tod_tumorbedingt_code"] is not None,
         lambda r: r["interpretation_tod_tumorbedingt_code"] != "U")
    days = collections.defaultdict(set)
    for r in dead:
        days[r["subject_reference"]] |= {r["effective_date_time"]} - {None}
    results["death_dates", "one death date per patient"] = (len(days), sum(len(d) != 1 for d in days.values()))
    return results


def test_suites_of_all_sections_equal_plain_version(spark):
    from oncolake.operators.staging import stage_table

    assert C.ICD10GM and derived.KINDS
    tables = {k: stage_table(t, "resources") for k, t in _tables(spark, SF, *V.BASE_TABLES.values()).items()}
    base = {n: [r.asDict() for r in v.collect()] for n, v in V.views_from_tables(tables, CFG).items()}
    found = {(r.suite, r.expectation): (r.evaluated, r.unexpected) for r in Q.quality_run(tables, AS_OF, CFG).collect()}
    want = plain(base)
    assert set(found) == set(want)
    assert {k: (found[k], want[k]) for k in want if found[k] != want[k]} == {}
    assert sum(n for n, _ in found.values()) > 10_000 and any(bad for _, bad in found.values())
