"""Expected results of the queries as SQL over the same tables.

The mapping rules are written here a second time, in plain SQL from the source columns, so that a
wrong mapping cannot agree with itself.
"""

from __future__ import annotations

from oncolake.config import ONCOLOGY
from oncolake.plans.derived import CONFIG, KINDS, SOURCE, VALUES

BASE = CONFIG.identifier_base_url
ORACLE: dict[str, str] = {}


def sid(system: str, value: str) -> str:
    """Resource id of an identifier value."""
    return f"sha256('{BASE}/{system}|' || {value})"


def slug(text: str) -> str:
    for letter, spelled in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
        text = f"replace({text}, '{letter}', '{spelled}')"
    text = f"regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]+', '', 'g')"
    return f"regexp_replace(regexp_replace({text}, '[^A-Za-z0-9_]+', '-', 'g'), '^-|-$', '', 'g')"


def pdate(value: str, precision: str = "prec") -> str:
    return (
        f"CASE coalesce({precision}, 'E') WHEN 'E' THEN substr({value}, 1, 10) "
        f"WHEN 'T' THEN substr({value}, 1, 7) WHEN 'M' THEN substr({value}, 1, 4) END"
    )


PLAIN = {name: sql for name, sql in VALUES.items() if "{i}" not in sql}
REPEATED = {name: sql.replace("{i}", "i") for name, sql in VALUES.items() if "{i}" in sql}

REP = (
    "src AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in SOURCE.items())
    + " FROM orders JOIN customer ON o_custkey = c_custkey), vals AS (SELECT *, "
    + ", ".join(f"({sql}) AS {name}" for name, sql in PLAIN.items())
    + ", CAST(cust AS VARCHAR) AS patient_id FROM src WHERE cust > 0), "
    "rep AS (SELECT *, "
    + sid("primaerdiagnose-condition-id", "patient_id || '-' || tumor_id")
    + " AS cond_id, 'Patient/' || "
    + sid("patient-id", "patient_id")
    + " AS pref FROM vals)"
)


def kinds(*names: str) -> str:
    return "kind IN (" + ", ".join(str(KINDS.index(n)) for n in names) + ")"


SECTION = "CASE kind " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(KINDS)) + " END"


def elements(count: str, where: str) -> str:
    """CTE ``el``: reports times positions below a count, with the repeated values."""
    repeated = ", ".join(f"({sql}) AS {name}" for name, sql in REPEATED.items())
    return (
        f"el0 AS (SELECT rep.*, t.i FROM rep, (VALUES (0), (1), (2), (3)) t(i) "
        f"WHERE t.i < {count} AND {where}), el AS (SELECT *, {repeated} FROM el0)"
    )


def mapping(select: str, *ctes: str) -> str:
    return "WITH " + ", ".join([REP, *ctes]) + " " + select


# ---- changelog ---------------------------------------------------------------------------------

ORACLE["latest_version"] = """
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
    ORDER BY month(o_orderdate) DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""
ORACLE["latest_by_key_tombstone"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'"""
ORACLE["stream_latest"] = ORACLE["latest_by_key_tombstone"]
ORACLE["prefer_by_reason"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""
ORACLE["group_split"] = """
SELECT l_orderkey, l_suppkey, count(*) AS reports, min(l_linenumber) AS first_line
FROM lineitem GROUP BY 1, 2"""
ORACLE["key_by_patient"] = """
SELECT o_custkey AS patient_id, count(*) AS reports FROM orders GROUP BY 1"""
ORACLE["merge_group_header"] = """
SELECT o_custkey, 0 AS part,
  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
  arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
  count(*) AS orders,
  string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS order_keys
FROM orders GROUP BY 1"""
ORACLE["merge_group_parts"] = """
SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
  count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1"""
ORACLE["latest_master_data"] = """
SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority
FROM orders GROUP BY 1"""
ORACLE["keep_all_events"] = """
SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('signup', 'purchase', 'error')"""
ORACLE["first_report_of_message"] = """
SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 1"""
ORACLE["rank_reports"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY
    CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END,
    l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS report_rank FROM lineitem"""
ORACLE["bundle_key"] = """
SELECT o_orderkey, 'Patient/' || o_custkey || CASE WHEN o_orderstatus <> 'P'
  THEN ' - Condition/' || o_orderkey ELSE '' END AS bundle_key
FROM orders WHERE o_custkey % 10 <> 0"""

_LATEST = (
    "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, report_id "
    "ORDER BY version DESC, export_id DESC) AS rn FROM rep) WHERE rn = 1)"
)
_NEWEST = "day DESC, report_id"


def _reason(change: bool) -> str:
    column = "reason_change" if change else "reason_end"
    first, second = (
        ("statusaenderung", "statusmeldung") if change else ("behandlungsende", "behandlungsbeginn")
    )
    return f"CASE {column} WHEN '{first}' THEN 0 WHEN '{second}' THEN 1 ELSE 2 END"


ORACLE["consolidated_reports"] = mapping(
    f"""SELECT patient_id, tumor_id, report_id, export_id, {SECTION} AS section,
      CASE kind WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 1 THEN 3 WHEN 6 THEN 4 WHEN 5 THEN 5 ELSE 0 END
        AS section_rank
    FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, tumor_id, kind,
        CASE kind WHEN 1 THEN course_id WHEN 2 THEN therapy_id WHEN 3 THEN therapy_id
          WHEN 6 THEN board_id ELSE report_id || '|' || export_id END
      ORDER BY CASE WHEN kind = 1 THEN {_reason(True)} WHEN kind IN (2, 3, 6) THEN {_reason(False)}
        ELSE 0 END, {_NEWEST}) AS pick FROM latest) WHERE pick = 1""",
    _LATEST,
)
for _name, _kind, _id, _change in (
    ("select_systemic", "SYST", "therapy_id", False),
    ("select_radiotherapy", "ST", "therapy_id", False),
    ("select_progress", "Verlauf", "course_id", True),
    ("select_boards", "Tumorkonferenz", "board_id", False),
):
    ORACLE[_name] = mapping(
        f"""SELECT patient_id, tumor_id, {_id} AS therapy_id, export_id FROM (
          SELECT *, row_number() OVER (PARTITION BY patient_id, tumor_id, {_id}
            ORDER BY {_reason(_change)}, {_NEWEST}) AS pick FROM latest WHERE {kinds(_kind)})
        WHERE pick = 1""",
        _LATEST,
    )

# ---- sources -----------------------------------------------------------------------------------

_ALL = REP.replace(" FROM src WHERE cust > 0", " FROM src")
ORACLE["xml_roundtrip"] = (
    f"WITH {_ALL} SELECT export_id, name AS source_patient_id, report_id, tumor_id, "
    "recorded AS report_date, icd, diagnosed, "
    f"{SECTION} AS section, sex, CAST(NULL AS VARCHAR) AS parse_error FROM rep"
)
ORACLE["explode_reports"] = (
    f"WITH {_ALL} SELECT name AS source_patient_id, count(*) AS reports, "
    "min(report_id) AS first_report FROM rep GROUP BY 1"
)
ORACLE["json_envelope"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS export_id, o_orderpriority AS reference_number,
  CAST(o_custkey AS VARCHAR) AS report_number, CAST(month(o_orderdate) AS INTEGER) AS version,
  o_orderstatus AS xml FROM orders"""
ORACLE["version_detect"] = """
WITH t AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '<oBDS Schema_Version="3.0.2">'
    WHEN 1 THEN '<ADT_GEKID Schema_Version="2.1.1">' WHEN 2 THEN '<obds xmlns="x" SCHEMA_VERSION="3.1">'
    ELSE '' END || CASE WHEN page_id % 5 = 3 THEN '   ' ELSE html END AS xml FROM pages)
SELECT page_id, CASE WHEN trim(xml) = '' THEN 'empty'
  WHEN contains(lower(xml), '<obds') AND contains(lower(xml), 'schema_version="3.') THEN 'v3'
  WHEN contains(lower(xml), '<adt') AND contains(lower(xml), 'schema_version="2.') THEN 'v2'
  ELSE 'unknown' END AS report_version FROM t"""
ORACLE["quarantine_split"] = """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative balance'
  WHEN c_mktsegment = 'HOUSEHOLD' THEN 'segment not allowed: HOUSEHOLD' END AS error FROM customer"""
ORACLE["single_patient_messages"] = (
    f"WITH {_ALL} SELECT export_id, CASE WHEN k % 3 = 0 THEN 'message holds more than one patient' END "
    "AS error FROM rep"
)
ORACLE["incremental_scan"] = """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey > 5000 AND o_orderstatus <> 'P'"""
ORACLE["next_cursor"] = "SELECT max(o_orderkey) AS o_orderkey FROM orders"
ORACLE["report_export_rows"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS export_id, o_orderpriority AS reference_number,
  CAST(o_custkey AS VARCHAR) AS report_number, CAST(month(o_orderdate) AS INTEGER) AS version,
  '<oBDS/>' AS xml FROM orders
WHERE o_orderkey > 1000 AND o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"""
ORACLE["status_join3"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS patient_id,
  strftime(l_shipdate, '%Y-%m-%d') AS last_information,
  CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS death_date
FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey AS INTEGER)) > TIMESTAMP '1995-03-01'"""
ORACLE["code_lookup"] = """
SELECT c_custkey, n_name AS display,
  CASE WHEN n_name IS NULL THEN 'not in nation: ' || c_nationkey END AS code_error
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) ON n_nationkey = c_nationkey"""
ORACLE["code_map_override"] = """
SELECT p_name, p_type, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_name
  ORDER BY p_size DESC, p_partkey DESC) AS rn FROM part WHERE p_type <> 'PROMO' AND p_type <> '')
WHERE rn = 1"""

# ---- functions ---------------------------------------------------------------------------------

ORACLE["resource_id"] = f"SELECT c_custkey, {sid('patient-id', 'c_name')} AS id FROM customer"
ORACLE["slug"] = "SELECT doc_id, " + slug("(source || ' / ' || text)") + " AS slug FROM documents"
ORACLE["text_hash"] = "SELECT doc_id, sha256(text) AS hash FROM documents"
ORACLE["first_nonblank"] = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN 'last' ELSE 'b' END AS value
FROM orders"""
ORACLE["partial_date"] = f"""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, {SOURCE['prec']} AS prec FROM orders)
SELECT o_orderkey, {pdate('d')} AS value, CASE coalesce(prec, 'E') WHEN 'E' THEN 'day' WHEN 'T' THEN 'month'
  WHEN 'M' THEN 'year' END AS precision FROM t"""
ORACLE["icd_version_year"] = """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(2000 + p_size AS VARCHAR) END AS year FROM part"""
ORACLE["normalize_id"] = """
SELECT c_name, CASE WHEN c_custkey > 0 THEN CAST(c_custkey AS VARCHAR) END AS patient_id,
  CASE WHEN c_custkey = 0 THEN 'patient id does not match: ' || c_name END AS patient_id_error FROM customer"""
ORACLE["data_absent"] = """
SELECT doc_id, CASE WHEN quality IS NULL THEN 'unknown' END AS reason
FROM documents LEFT JOIN labels USING (doc_id)"""
ORACLE["require_reference"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL
  WHEN o_orderstatus = 'O' THEN 'reference must point to a Patient: Order/' || o_custkey
  WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'reference must point to a Patient: none' END AS error FROM orders"""
ORACLE["distinct_by_code"] = """
WITH t AS (SELECT o_orderkey, i AS pos, 'c' || ((o_orderkey + i) % 2) AS "Code",
    CASE WHEN (o_custkey + i) % 4 <> 0 THEN CAST((o_custkey * 7 + i * 3) % 9 AS VARCHAR) END AS "Version"
  FROM orders, (VALUES (0), (1), (2)) v(i)),
w AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, "Code"
  ORDER BY coalesce("Version", '') DESC, pos) AS rn FROM t)
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY "Code") - 1 AS INTEGER) AS n,
  "Code", "Version", pos FROM w WHERE rn = 1"""
ORACLE["period_of"] = """
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_orderkey % m AS INTEGER) AS d
  FROM orders, (VALUES (0, 5), (1, 7), (2, 11)) v(i, m) WHERE o_orderkey % 3 <> i)
SELECT o_orderkey, CAST(min(d) AS VARCHAR) AS start, CAST(max(d) AS VARCHAR) AS "end" FROM t GROUP BY 1"""
_K = "t AS (SELECT o_orderkey AS k FROM orders)"


def suffixes(value: str) -> dict[str, str]:
    return {
        "value": f"trim(regexp_replace({value}, '\\(?(i-|i\\+|sn)\\)?.*$', ''))",
        "sn": f"contains({value}, 'sn')",
        "itc_positive": f"contains({value}, 'i+')",
        "itc_negative": f"contains({value}, 'i-')",
    }


_N = f"('N' || ({VALUES['tnm_n']}))"
_S = suffixes(_N)
ORACLE["tnm_suffixes"] = (
    f"WITH {_K} SELECT k, {_S['value']} AS value, "
    + ", ".join(f"CAST({_S[n]} AS INTEGER) AS {n}" for n in ("sn", "itc_positive", "itc_negative"))
    + f" FROM t WHERE ({VALUES['tnm_n']}) IS NOT NULL"
)
ORACLE["uicc_stage"] = f"""
WITH {_K} SELECT k, CASE WHEN ({VALUES['stage']}) IN ('IV', 'IIA', 'okk') THEN {VALUES['stage']} END AS stage FROM t"""
_ECOG = "CASE {0} WHEN '0' THEN '0' WHEN '2' THEN '2' WHEN '90%' THEN '0' WHEN '30%' THEN '3' WHEN 'U' THEN 'U' WHEN '70%' THEN '1' END"
ORACLE["ecog_bucket"] = f"WITH {_K} SELECT k, {_ECOG.format('(' + VALUES['performance'] + ')')} AS grade FROM t"
_GRADE_GROUPS = """(VALUES ('3+3', '1279715000'), ('3+4', '1279714001'), ('4+3', '1279716004'),
  ('3+5', '1279718003'), ('4+4', '1279717008'), ('5+3', '1279719006'), ('4+5', '1279720000'),
  ('5+4', '1279721001'), ('5+5', '1279722008'), ('6', '84556003'), ('7', '57403001'), ('8', '33013007'),
  ('9', '58925000')) gg(key, gcode)"""
_SCORE = """CASE WHEN gr IS NOT NULL THEN gr WHEN g1 = '3' AND g2 = '4' THEN '7a'
  WHEN g1 = '4' AND g2 = '3' THEN '7b' ELSE CAST(CAST(g1 AS INTEGER) + CAST(g2 AS INTEGER) AS VARCHAR) END"""
ORACLE["gleason"] = f"""
WITH {_K}, g AS (SELECT k, {VALUES['gleason_primary']} AS g1, {VALUES['gleason_secondary']} AS g2,
  {VALUES['gleason_result']} AS gr FROM t),
s AS (SELECT *, {_SCORE} AS score FROM g),
x AS (SELECT *, CASE WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN g1 || '+' || g2 ELSE score END AS text FROM s)
SELECT k, score, text, gcode AS code, CAST(regexp_replace(score, '[ab]', '') AS DOUBLE) AS ordinal
FROM x LEFT JOIN {_GRADE_GROUPS} ON text = key"""
ORACLE["ops_category"] = """
SELECT o_orderkey, CASE o_orderkey % 10 WHEN 5 THEN '387713003' WHEN 1 THEN '165197003' ELSE '394841004' END
  AS category FROM orders"""
_PID = "replace(c_name, '#', '_')"
for _strategy, _sql in (
    ("sha256", sid("patient-id", _PID)),
    ("md5", f"md5({_PID})"),
    ("dashes", f"replace({_PID}, '_', '-')"),
    ("plain", _PID),
):
    ORACLE[f"patient_ref_{_strategy}"] = (
        f"SELECT {_PID} AS patient_id, 'Patient/' || {_sql} AS patient_ref, "
        f"{_PID} AS patient_identifier FROM customer"
    )
ORACLE["patient_ref_lookup"] = """
SELECT c_custkey, 'Patient/' || n_name AS patient_ref,
  coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS patient_identifier,
  CASE WHEN n_name IS NULL THEN 0 ELSE 1 END AS patient_exists
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey"""
ORACLE["patient_ref_existing"] = """
SELECT c_custkey, CASE WHEN n = 1 THEN 'Patient/' || id END AS patient_ref,
  CASE WHEN n > 1 THEN 'more than one patient matches the identifier' END AS patient_ref_error
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS id, count(DISTINCT o_orderpriority) AS n
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey"""
ORACLE["pseudonymize"] = """
SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN 'PSN-' || s_suppkey END AS patient_id,
  CASE WHEN s_suppkey IS NULL THEN 'no pseudonym for the patient id' END AS pseudonym_error
FROM customer LEFT JOIN supplier ON replace(s_name, 'Supplier', 'Customer') = c_name"""


def hmac(text: str, key: str) -> str:
    secret = key.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in secret).hex()
    outer = bytes(b ^ 0x5C for b in secret).hex()
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"


ORACLE["pseudonymize_keyed"] = f"SELECT c_custkey, {hmac('c_name', 'key')} AS patient_id FROM customer"

# ---- mapping jobs ------------------------------------------------------------------------------

ORACLE["map_patients"] = mapping(
    f"""SELECT {sid('patient-id', 'patient_id')} AS id, patient_id AS identifier_value,
      CASE any_value(sex) WHEN 'W' THEN 'female' WHEN 'M' THEN 'male' WHEN 'U' THEN 'unknown' ELSE 'other' END AS gender,
      any_value({pdate('birth', 'birth_prec')}) AS birth_date,
      CASE WHEN bool_or(kind = 7) THEN 1 END AS deceased,
      max(CASE WHEN kind = 7 THEN start END) AS deceased_date,
      CASE WHEN any_value(cust) % 5 <> 3 THEN 1 ELSE 0 END AS has_address,
      CASE WHEN any_value(cust) % 5 <> 3 THEN any_value(postcode) END AS postal_code,
      CASE WHEN any_value(cust) % 5 <> 3 AND any_value(nation) % 4 = 0 THEN 'DE'
        WHEN any_value(cust) % 5 <> 3 AND any_value(nation) % 4 = 1 THEN 'AUT' END AS country
    FROM rep GROUP BY patient_id"""
)
_EARLIER_VALUE = (
    "patient_id || '-' || tumor_id || '-' || "
    "coalesce(earlier_icd, sha256(earlier_text)) || coalesce('-' || earlier_year, '')"
)
_EARLIER = (
    f"ear AS (SELECT *, {slug('(' + _EARLIER_VALUE + ')')} AS value FROM el "
    "WHERE earlier_icd IS NOT NULL OR earlier_text IS NOT NULL)"
)
_EARLIER_SYSTEM = "fruehere-tumorerkrankung-condition-id"
ORACLE["map_conditions"] = mapping(
    f"""SELECT cond_id AS id, patient_id || '-' || tumor_id AS identifier_value, report_id,
      CASE WHEN kind = 0 THEN 1 ELSE 0 END AS has_diagnosis,
      CASE WHEN kind IN (2, 3, 6) AND reason_end = 'behandlungsende' THEN 2
        WHEN kind = 1 AND reason_change = 'statusaenderung' THEN 2 ELSE 0 END AS priority,
      CASE WHEN kind = 0 THEN 0 ELSE 1 END AS incomplete,
      icd, CASE k % 4 WHEN 0 THEN '2023' WHEN 1 THEN '2019' ELSE '-' END AS icd_version,
      CASE WHEN kind = 0 AND has_histology THEN CASE 1 + k % 4
          WHEN 1 THEN '8140/3|32|Karzinom'
          WHEN 2 THEN '8140/3|32|Karzinom,8500/3|Karzinom'
          WHEN 3 THEN '8140/3|33|Karzinom,8500/3|Karzinom'
          ELSE '8140/3|33|Karzinom,8500/3|31|Karzinom' END
        WHEN morphology IS NOT NULL THEN '8140/3|32' ELSE '' END AS morphology,
      CASE WHEN kind = 0 THEN concat_ws('|', topography, topography_text) ELSE '' END AS topography,
      CASE WHEN kind = 0 AND certainty IS NOT NULL THEN 'confirmed,' || certainty END AS verification,
      CASE side WHEN 'L' THEN 'L,7771000' WHEN 'R' THEN 'R,24028007' WHEN 'B' THEN 'B,51440002'
        WHEN 'M' THEN 'M,260528009' WHEN 'T' THEN 'T,385432009' WHEN 'U' THEN 'U,261665006' END AS laterality,
      {pdate('diagnosed')} AS asserted_date, recorded AS recorded_date,
      CASE WHEN kind = 0 THEN {sid('erstdiagnose-evidenz-list-id', "patient_id || '-' || tumor_id")} END AS evidence_list_id,
      coalesce((SELECT string_agg({sid(_EARLIER_SYSTEM, 'value')}, ',' ORDER BY i) FROM ear WHERE ear.k = rep.k), '') AS follows
    FROM rep""",
    elements("earlier", kinds("Diagnose")),
    _EARLIER,
)
ORACLE["earlier_tumour_links"] = mapping(
    f"""SELECT cond_id AS condition_id, report_id,
      CAST(row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS INTEGER) AS pos,
      {sid(_EARLIER_SYSTEM, 'value')} AS earlier_condition_id FROM ear""",
    elements("earlier", kinds("Diagnose")),
    _EARLIER,
)
ORACLE["map_earlier_tumours"] = mapping(
    f"""SELECT {sid(_EARLIER_SYSTEM, 'value')} AS id, value AS identifier_value, report_id,
      earlier_icd AS icd, coalesce(earlier_text, earlier_icd) AS code_text, earlier_year AS asserted_date FROM ear""",
    elements("earlier", kinds("Diagnose")),
    _EARLIER,
)


def present(*names: str) -> str:
    return " + ".join(f"CASE WHEN {n} IS NOT NULL THEN 1 ELSE 0 END" for n in names)


_TNM_PRESENT = present(
    "tnm_t", "tnm_n", "tnm_m", "tnm_a", "tnm_multi", "tnm_l", "tnm_pn", "tnm_r", "tnm_s", "tnm_v", "tnm_y"
)
_MODULE_PRESENT = present(
    "psa", "cores", "positive_cores", "core_unknown", "clavien", "gleason_primary", "gleason_secondary"
) + " + 1"
ORACLE["map_evidence_lists"] = mapping(
    f"""SELECT {sid('erstdiagnose-evidenz-list-id', "patient_id || '-' || tumor_id")} AS id,
      patient_id || '-' || tumor_id AS identifier_value, report_id, 'current' AS status, 'snapshot' AS mode,
      CAST({present('performance')} + sites + genes + classes
        + CASE WHEN has_study THEN 1 ELSE 0 END
        + CASE WHEN has_histology THEN {present('grading', 'nodes_examined', 'nodes_affected', 'sentinel_examined', 'sentinel_affected')} ELSE 0 END
        + CASE WHEN has_ctnm THEN {_TNM_PRESENT} + 1 ELSE 0 END
        + CASE WHEN has_ptnm THEN {_TNM_PRESENT} + 1 ELSE 0 END
        + CASE WHEN has_prostate THEN {_MODULE_PRESENT} ELSE 0 END AS BIGINT) AS entries
    FROM rep WHERE {kinds('Diagnose')}"""
)


def observed(system: str, value: str, code: str, effective: str, extra: str, source: str = "rep", section: str = SECTION) -> str:
    """Observation rows; ``value`` is an SQL text before the slug."""
    slugged = slug(f"({value})")
    return (
        f"SELECT {sid(system, slugged)} AS id, {slugged} AS identifier_value, report_id, "
        f"{section} AS source_section, {code} AS code, {effective} AS effective, {extra} FROM {source}"
    )


_DAY = "CAST(day AS VARCHAR)"
ORACLE["map_metastases"] = mapping(
    observed(
        "fernmetastasen-observation-id", f"report_id || '-' || {SECTION} || '-' || i", "'385421009'",
        pdate(_DAY, "site_prec"),
        "CASE WHEN site_prec = 'V' THEN 'unknown' END AS effective_absent, site, "
        "CASE WHEN site IS NULL THEN 'unknown' END AS value_absent, 'Condition/' || cond_id AS focus",
        "el",
    ),
    elements("sites", kinds("Diagnose", "Verlauf", "Pathologie")),
)
ORACLE["map_genetic_variants"] = mapping(
    observed(
        "genetische-variante-observation-id",
        f"'GenetischeAusprägung-' || {SECTION} || '-' || report_id || coalesce('-' || gene_expression, '') || '-' || i",
        "'69548-6'", pdate(_DAY),
        "coalesce(gene_expression, CASE WHEN gene_other IS NOT NULL THEN 'S' END) AS interpretation, "
        "CASE WHEN gene_expression IS NULL THEN gene_other END AS interpretation_text, gene AS note",
        "el",
    ),
    elements("genes", kinds("Diagnose", "Verlauf", "OP", "Pathologie")),
)
_ECOG_SQL = _ECOG.format("performance")
ORACLE["map_performance_status"] = mapping(
    observed(
        "allgemeiner-leistungszustand-ecog-id", "'ECOG-' || report_id", "'423740007,89262-0'",
        f"CASE WHEN kind = 0 THEN {pdate('diagnosed')} ELSE {_DAY} END",
        f"({_ECOG_SQL}) || ',' || CASE ({_ECOG_SQL}) WHEN '0' THEN 'LA9622-7' WHEN '1' THEN 'LA9623-5' "
        "WHEN '2' THEN 'LA9624-3' WHEN '3' THEN 'LA9625-0' ELSE '-' END AS value",
        f"rep WHERE performance IS NOT NULL AND {kinds('Diagnose', 'Verlauf')}",
    )
)
ORACLE["map_study_participation"] = mapping(
    observed(
        "studienteilnahme-observation-id", "report_id || '-Studienteilnahme'", "'709491003'", "study_date",
        "CASE WHEN study_date IS NOT NULL THEN 'J' ELSE study_answer END AS answer",
        f"rep WHERE has_study AND {kinds('Diagnose', 'Verlauf', 'SYST', 'ST', 'OP')}",
    )
)
ORACLE["map_classifications"] = mapping(
    observed(
        "weitere-klassifikation-observation-id",
        "report_id || '-' || class_name || coalesce('-' || class_date, '') || '-' || class_stage",
        "CASE WHEN i = 0 THEN (SELECT r_name FROM region WHERE r_regionkey = 0) END", "class_date",
        "class_name AS code_text, CASE WHEN i = 0 THEN 'V0' ELSE class_stage END AS value, "
        "CASE WHEN i = 0 THEN class_stage END AS value_text",
        "el",
    ),
    elements("classes", kinds("Diagnose", "Verlauf", "Pathologie")),
)
_HISTOLOGY = kinds("Diagnose", "Verlauf", "OP", "Pathologie")
_HBASE = "coalesce(histology_id, report_id)"
_SPECIMEN = sid("histologie-specimen-id", slug(f"({_HBASE})"))
_HWHERE = f"has_histology AND {_HISTOLOGY}"
ORACLE["map_specimens"] = mapping(
    f"""SELECT {_SPECIMEN} AS id, {slug('(' + _HBASE + ')')} AS identifier_value, report_id,
      accession AS accession_no, {pdate('histology_date')} AS collected FROM rep WHERE {_HWHERE}"""
)
ORACLE["map_grading"] = mapping(
    observed(
        "grading-observation-id", f"{_HBASE} || '-grading'", "'33732-9,371469007'", pdate("histology_date"),
        f"CASE WHEN prec = 'V' THEN 'unknown' END AS effective_absent, grading AS grade, {_SPECIMEN} AS specimen_id",
        f"rep WHERE {_HWHERE} AND grading IS NOT NULL",
    )
)
_NODES = """nodes AS (SELECT rep.*, sfx, codes, CASE n WHEN 0 THEN nodes_affected WHEN 1 THEN nodes_examined
    WHEN 2 THEN sentinel_affected ELSE sentinel_examined END AS cnt
  FROM rep, (VALUES (0, 'befallen', '21893-3,443527007'), (1, 'untersucht', '21894-1,444025001'),
    (2, 'befallen-sentinel', '92832-5,1264491009'), (3, 'untersucht-sentinel', '85347-3,444411008')) m(n, sfx, codes))"""
ORACLE["map_lymph_nodes"] = mapping(
    observed(
        "lymphknotenuntersuchung-observation-id", f"{_HBASE} || '-' || sfx", "codes", pdate("histology_date"),
        f"CAST(cnt AS DOUBLE) AS nodes, {_SPECIMEN} AS specimen_id",
        f"nodes WHERE cnt IS NOT NULL AND {_HWHERE}",
    ),
    _NODES,
)
_MORPHOLOGY = """morph AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, morphology_code
    ORDER BY coalesce(morphology_version, '') DESC, i) AS rn FROM el) WHERE rn = 1)"""
ORACLE["map_course_histology"] = mapping(
    observed(
        "verlaufshistologie-observation-id", f"{_HBASE} || '-ICDO3-' || morphology_code", "'59847-4'",
        pdate("histology_date"),
        "morphology_code AS morphology, coalesce(morphology_version, '-') AS version, "
        f"'Karzinom' AS value_text, {_SPECIMEN} AS specimen_id",
        "morph",
    ),
    elements("morphologies", f"has_histology AND {kinds('Verlauf', 'OP', 'Pathologie')}"),
    _MORPHOLOGY,
)
ORACLE["map_pathology_reports"] = mapping(
    f"""SELECT {sid('histologiebefund-diagnostic-report-id', slug('(coalesce(finding_id, report_id))'))} AS id,
      {slug('(coalesce(finding_id, report_id))')} AS identifier_value, report_id, finding AS conclusion,
      CASE WHEN finding IS NULL THEN 'unknown' END AS conclusion_absent,
      CASE WHEN has_histology THEN {_SPECIMEN} END AS specimen_id
    FROM rep WHERE {kinds('Pathologie')}"""
)

_TBASE = "coalesce(tnm_id, CASE WHEN has_histology THEN histology_id END, report_id)"
_STAGINGS = f"""stag AS (
  SELECT *, 'c' AS st, {_TBASE} || '-c' AS tbase FROM rep WHERE {kinds('Diagnose', 'Pathologie')} AND has_ctnm
  UNION ALL SELECT *, 'p', {_TBASE} || '-p' FROM rep WHERE {kinds('Diagnose', 'Pathologie')} AND has_ptnm
  UNION ALL SELECT *, 'g', {_TBASE} FROM rep WHERE {kinds('Verlauf', 'OP')} AND has_ctnm)"""
_MEMBERS = f"""mem0 AS (SELECT stag.*, n, sfx, prof, CASE n WHEN 0 THEN 'T' || tnm_t WHEN 1 THEN 'N' || tnm_n
    WHEN 2 THEN 'M' || tnm_m WHEN 3 THEN tnm_a WHEN 4 THEN tnm_multi WHEN 5 THEN tnm_l WHEN 6 THEN tnm_pn
    WHEN 7 THEN tnm_r WHEN 8 THEN tnm_s WHEN 9 THEN tnm_v ELSE tnm_y END AS raw,
    coalesce(CASE n WHEN 0 THEN tnm_t_prefix WHEN 1 THEN tnm_n_prefix WHEN 2 THEN tnm_m_prefix END, 'c') AS pre
  FROM stag, (VALUES (0, 'T', 't-kategorie'), (1, 'N', 'n-kategorie'), (2, 'M', 'm-kategorie'),
    (3, 'a', 'a-symbol'), (4, 'm', 'm-symbol'), (5, 'L', 'l-kategorie'), (6, 'Pn', 'pn-kategorie'),
    (7, 'r', 'r-symbol'), (8, 'S', 's-kategorie'), (9, 'V', 'v-kategorie'), (10, 'y', 'y-symbol')) v(n, sfx, prof)),
mem AS (SELECT *, {slug("(tbase || '-' || sfx)")} AS mvalue FROM mem0 WHERE raw IS NOT NULL),
mid AS (SELECT *, sha256('{BASE}/tnm-' || prof || '-observation-id|' || mvalue) AS mid FROM mem)"""
_SFX = suffixes("raw")
_GROUP_VALUE = slug("(tbase)")
ORACLE["map_tnm"] = mapping(
    f"""SELECT 'tnm' AS kind, mid AS id, mvalue AS identifier_value, report_id, {SECTION} AS source_section,
      CASE n WHEN 0 THEN CASE pre WHEN 'p' THEN '384625004' ELSE '399504009' END
        WHEN 1 THEN CASE pre WHEN 'c' THEN '399534004' WHEN 'p' THEN '371494008' ELSE '277206009' END
        WHEN 2 THEN CASE pre WHEN 'c' THEN '399387003' WHEN 'p' THEN '371497001' ELSE '277208005' END
        WHEN 3 THEN '101660-9' WHEN 4 THEN '42030-7' WHEN 5 THEN '395715009' WHEN 6 THEN '371513001'
        WHEN 7 THEN '101659-1' WHEN 8 THEN '399424006' WHEN 9 THEN '371493002' ELSE '101658-3' END AS code,
      tnm_date AS effective, CASE WHEN n < 3 THEN pre END AS prefix,
      CASE WHEN n IN (1, 2) THEN {_SFX['value']} WHEN n = 3 THEN '421426001' WHEN n = 7 THEN '421188008'
        WHEN n = 10 THEN '421755005' ELSE raw END AS value,
      CASE WHEN n IN (1, 2) THEN nullif(concat_ws(',', CASE WHEN {_SFX['sn']} THEN 'sn' END,
        CASE WHEN {_SFX['itc_positive']} THEN 'i+' END, CASE WHEN {_SFX['itc_negative']} THEN 'i-' END), '') END AS suffixes,
      '8' AS method, '' AS members FROM mid
    UNION ALL
    SELECT 'tnm_grouping', {sid('tnm-grouping-observation-id', _GROUP_VALUE)}, {_GROUP_VALUE}, report_id, {SECTION},
      CASE st WHEN 'c' THEN '399537006' WHEN 'p' THEN '399588009' ELSE '399390009' END, tnm_date, NULL,
      CASE WHEN stage IN ('IV', 'IIA', 'okk') THEN stage END, NULL, '8',
      coalesce((SELECT string_agg(mid, ',' ORDER BY n) FROM mid WHERE mid.k = stag.k AND mid.st = stag.st), '')
    FROM stag""",
    _STAGINGS,
    _MEMBERS,
)
_MWHERE = f"has_prostate AND {_HISTOLOGY}"
_MSUFFIX = "report_id || '-modul-prostata-"
_GSYS = "prostata-gleason-patterns-observation-id"
_MDATE = f"CASE kind WHEN 0 THEN diagnosed WHEN 1 THEN {_DAY} WHEN 4 THEN start END"
_PID1 = sid(_GSYS, slug(f"({_MSUFFIX}primary-gleason-pattern')"))
_PID2 = sid(_GSYS, slug(f"({_MSUFFIX}secondary-gleason-pattern')"))
_METHOD = "CASE gleason_method WHEN 'O' THEN '65801008' WHEN 'S' THEN '86273004' WHEN 'U' THEN '261665006' END"
_PATTERN = "CASE {0} WHEN '3' THEN '369772003' WHEN '4' THEN '369773008' WHEN '5' THEN '369774002' END"
ORACLE["map_gleason"] = mapping(
    "SELECT 'gleason_grade_group' AS kind, t.* FROM ("
    + observed(
        _GSYS, f"{_MSUFFIX}gleason-grade-group'", "'1812491000004107'", _MDATE,
        f"coalesce(gcode, '-') AS value, gtext AS value_text, {_METHOD} AS method, "
        "CAST(regexp_replace(score, '[ab]', '') AS DOUBLE) AS ordinal, "
        f"concat_ws(',', CASE WHEN g1 IS NOT NULL THEN {_PID1} END, CASE WHEN g2 IS NOT NULL THEN {_PID2} END) AS derived_from",
        f"gx LEFT JOIN {_GRADE_GROUPS} ON gtext = key WHERE {_MWHERE}",
    )
    + ") t UNION ALL SELECT 'gleason_pattern', t.* FROM ("
    + observed(
        _GSYS, f"{_MSUFFIX}primary-gleason-pattern'", "'384994009'", _MDATE,
        f"{_PATTERN.format('g1')} AS value, CAST(NULL AS VARCHAR) AS value_text, {_METHOD} AS method, "
        "CAST(g1 AS DOUBLE) AS ordinal, '' AS derived_from",
        f"gx WHERE g1 IS NOT NULL AND {_MWHERE}",
    )
    + ") t UNION ALL SELECT 'gleason_pattern', t.* FROM ("
    + observed(
        _GSYS, f"{_MSUFFIX}secondary-gleason-pattern'", "'384995005'", _MDATE,
        f"{_PATTERN.format('g2')} AS value, CAST(NULL AS VARCHAR) AS value_text, {_METHOD} AS method, "
        "CAST(g2 AS DOUBLE) AS ordinal, '' AS derived_from",
        f"gx WHERE g2 IS NOT NULL AND {_MWHERE}",
    )
    + ") t",
    "g AS (SELECT *, gleason_primary AS g1, gleason_secondary AS g2, gleason_result AS gr FROM rep)",
    f"gs AS (SELECT *, {_SCORE} AS score FROM g)",
    "gx AS (SELECT *, CASE WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN g1 || '+' || g2 ELSE score END AS gtext FROM gs)",
)
_FOCUS = "'Condition/' || cond_id"


def _measured(suffix, system, code, value, kind, unit, where, number, absent="CAST(NULL AS VARCHAR)"):
    return (
        f"SELECT 'prostate' AS kind, t.* FROM ("
        + observed(
            system, f"{_MSUFFIX}{suffix}'", f"'{code}'", _DAY,
            f"'{kind}' AS value_kind, CAST(NULL AS VARCHAR) AS value, CAST({number} AS DOUBLE) AS number, "
            f"CASE WHEN '{unit}' <> '' THEN '{unit}' END AS value_unit_code, {absent} AS value_absent, {_FOCUS} AS focus",
            f"rep WHERE {where} AND {_MWHERE}",
        )
        + ") t"
    )


_SURGERY_ID = sid("operation-procedure-id", slug("(therapy_id || '-' || k)"))
ORACLE["map_prostate_module"] = mapping(
    " UNION ALL ".join(
        [
            _measured("psa", "prostata-psa-observation-id", "2857-1", "psa", "quantity", "ng/mL", "psa IS NOT NULL", "psa"),
            _measured("anzahl-stanzen", "prostata-anzahl-stanzen-observation-id", "44652-6", "cores", "integer", "", "cores IS NOT NULL", "cores"),
            _measured("anzahl-positive-stanzen", "prostata-anzahl-positive-stanzen-observation-id", "44651-8", "positive_cores", "integer", "", "positive_cores IS NOT NULL", "positive_cores"),
            _measured("ca-befall-stanze", "prostata-ca-befall-stanze-observation-id", "44654-2", "core_percent", "quantity", "%", "core_unknown IS NOT NULL", "core_percent",
                      "CASE WHEN core_percent IS NULL THEN 'unknown' END"),
            "SELECT 'clavien_dindo', t.* FROM ("
            + observed(
                "prostata-clavien-dindo-observation-id", f"{_MSUFFIX}clavien-dindo'", "'789279006'", _MDATE,
                "'concept' AS value_kind, clavien AS value, CAST(NULL AS DOUBLE) AS number, "
                "CAST(NULL AS VARCHAR) AS value_unit_code, CAST(NULL AS VARCHAR) AS value_absent, "
                f"{_FOCUS} || CASE WHEN kind = 4 THEN ',Procedure/' || {_SURGERY_ID} ELSE '' END AS focus",
                f"rep WHERE clavien IS NOT NULL AND {_MWHERE}",
            )
            + ") t",
        ]
    )
)

_SURGERY = "(therapy_id || '-' || k)"
_PSYS = "operation-procedure-id"
_OPS = """opsd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, procedure_code
    ORDER BY coalesce(procedure_version, '') DESC, i) AS rn FROM el) WHERE rn = 1)"""
_OPV = f"{_SURGERY} || '-' || procedure_code"
ORACLE["map_surgeries"] = mapping(
    f"""SELECT 'surgery' AS kind, {sid(_PSYS, slug(_SURGERY))} AS id, {slug(_SURGERY)} AS identifier_value, report_id,
      'completed' AS status, CAST(NULL AS VARCHAR) AS category, '387713003' AS code, intention, residual_local AS outcome,
      CAST(NULL AS VARCHAR) AS part_of_id, cond_id AS reason_condition_id,
      'http://snomed.info/sct/900000000000207008/version/20250701' AS version, start AS performed,
      CASE WHEN start IS NULL THEN 'unknown' END AS performed_absent FROM rep WHERE {kinds('OP')}
    UNION ALL SELECT 'surgery_part', {sid(_PSYS, slug('(' + _OPV + ')'))}, {slug('(' + _OPV + ')')}, report_id,
      'completed', CASE substr(procedure_code, 1, 1) WHEN '5' THEN '387713003' WHEN '1' THEN '165197003' ELSE '394841004' END,
      procedure_code, intention, residual_local, {sid(_PSYS, slug(_SURGERY))}, cond_id, coalesce(procedure_version, '-'),
      start, CASE WHEN start IS NULL THEN 'unknown' END FROM opsd""",
    elements("procedures", kinds("OP")),
    _OPS,
)
ORACLE["map_residual_status"] = mapping(
    observed(
        "residualstatus-observation-id", _SURGERY, "'84892-9'", "start", "residual_total AS value",
        f"rep WHERE {kinds('OP')} AND residual_total IS NOT NULL",
    )
)
_ST = "strahlentherapie-procedure-id"
_STI = "strahlentherapie-bestrahlung-procedure-id"
_STATUS = "CASE WHEN reason_end = 'behandlungsende' THEN 'completed' ELSE 'in-progress' END"
_NUCLEAR = "coalesce(dose_kind = 2, false)"
ORACLE["map_radiotherapy"] = mapping(
    f"""SELECT 'radiotherapy' AS kind, {sid(_ST, slug('therapy_id'))} AS id, {slug('therapy_id')} AS identifier_value, report_id,
      {_STATUS} AS status, CASE WHEN nuc THEN '399315003' ELSE '1287742003' END AS category,
      CASE WHEN nuc THEN '8-53' ELSE '8-52' END AS code, intention, end_reason AS outcome,
      CAST(NULL AS VARCHAR) AS part_of_id, cond_id AS reason_condition_id,
      '{ONCOLOGY}/StructureDefinition/mii-pr-onko-strahlentherapie' AS profile, first_start AS period_start,
      CASE WHEN first_start IS NULL THEN 'unknown' END AS period_start_absent, last_finish AS period_end, position,
      CAST(NULL AS VARCHAR) AS used_code, CAST(NULL AS VARCHAR) AS method, CAST(NULL AS VARCHAR) AS body_site,
      CAST(NULL AS VARCHAR) AS side, CAST(NULL AS DOUBLE) AS single_dose, CAST(NULL AS DOUBLE) AS total_dose,
      CAST(NULL AS VARCHAR) AS boost
    FROM rep LEFT JOIN (SELECT k AS kk, min(dose_start) AS first_start, max(dose_finish) AS last_finish,
        coalesce(bool_and(dose_kind = 2) FILTER (WHERE dose_kind < 4), false) AS nuc FROM el GROUP BY k) ON kk = k
    WHERE {kinds('ST')}
    UNION ALL SELECT 'irradiation', {sid(_STI, slug("(therapy_id || '-' || i)"))}, {slug("(therapy_id || '-' || i)")}, report_id,
      CASE WHEN dose_finish IS NOT NULL THEN 'completed' ELSE 'in-progress' END,
      CASE WHEN {_NUCLEAR} THEN '399315003' ELSE '1287742003' END, CASE WHEN {_NUCLEAR} THEN '8-53' ELSE '8-52' END,
      NULL, NULL, {sid(_ST, slug('therapy_id'))}, NULL,
      '{ONCOLOGY}/StructureDefinition/mii-pr-onko-strahlentherapie-bestrahlung-' || CASE WHEN {_NUCLEAR} THEN 'nuklearmedizin' ELSE 'strahlentherapie' END,
      dose_start, CASE WHEN dose_start IS NULL THEN 'unknown' END, dose_finish, NULL,
      CASE dose_kind WHEN 0 THEN 'UH' WHEN 1 THEN 'Co-60' WHEN 2 THEN 'Y-90' END,
      CASE dose_kind WHEN 0 THEN 'PRCN-ST' WHEN 1 THEN 'IHDR' WHEN 2 THEN 'MSIRT' ELSE 'S' END,
      coalesce(dose_target_old, dose_target_new), dose_side, CAST(dose_single AS DOUBLE), CAST(dose_total AS DOUBLE),
      CASE WHEN dose_kind = 0 THEN 'SIB' END
    FROM el WHERE dose_kind < 4""",
    elements("doses", kinds("ST")),
)
_SYS = "systemische-therapie-procedure-id"
ORACLE["map_systemic_procedures"] = mapping(
    f"""SELECT 'systemic' AS kind, {sid(_SYS, slug('therapy_id'))} AS id, {slug('therapy_id')} AS identifier_value, report_id,
      {_STATUS} AS status,
      CASE WHEN therapy IS NULL THEN '-' WHEN therapy = 'SO' THEN '394841004' WHEN therapy IN ('WW', 'AS', 'WS') THEN NULL ELSE '18629005' END AS category,
      CASE WHEN therapy IS NULL THEN '-' ELSE CASE therapy WHEN 'SZ' THEN '8-86' WHEN 'HO' THEN '6-00' WHEN 'WW' THEN '373818007'
        WHEN 'AS' THEN '424313000' WHEN 'SO' THEN '74964007' ELSE '8-54' END || ',' || therapy END AS code,
      intention, end_reason AS outcome, CAST(NULL AS VARCHAR) AS part_of_id, cond_id AS reason_condition_id,
      {pdate('start')} AS period_start, CASE WHEN start IS NULL AND finish IS NULL THEN 'unknown' END AS period_start_absent,
      finish AS period_end, position, protocol FROM rep WHERE {kinds('SYST')}"""
)
_SUBSTANCES = """sub AS (SELECT *, coalesce(substance_code, substance_name) AS skey,
    coalesce(substance_code, CASE WHEN substance_name = 'Bicalutamid' THEN 'L02BB03' END) AS acode
  FROM (SELECT *, row_number() OVER (PARTITION BY k, coalesce(substance_code, substance_name)
    ORDER BY coalesce(substance_version, '') DESC, i) AS rn FROM el) WHERE rn = 1)"""
_MSV = slug("(cond_id || '-' || therapy_id || '-' || skey)")
_MSYS = "systemische-therapie-medication-id"
ORACLE["map_medication_statements"] = mapping(
    f"""SELECT {sid('systemische-therapie-medication-statement-id', _MSV)} AS id, {_MSV} AS identifier_value, report_id,
      CASE WHEN reason_end = 'behandlungsende' THEN 'completed' ELSE 'active' END AS status,
      {sid(_MSYS, 'acode')} AS medication_id, substance_name AS medication_text,
      CASE WHEN acode IS NULL THEN 'as-text' END AS code_absent, {pdate('start')} AS period_start, finish AS period_end,
      {sid(_SYS, slug('therapy_id'))} AS part_of_id FROM sub""",
    elements("substances", kinds("SYST")),
    _SUBSTANCES,
)
ORACLE["map_medications"] = mapping(
    f"""SELECT {sid(_MSYS, 'acode')} AS id, acode AS identifier_value, report_id,
      CASE WHEN substance_code IS NOT NULL THEN substance_version ELSE '2025' END AS version,
      CASE WHEN substance_code IS NOT NULL THEN 1 ELSE 0 END AS user_selected, substance_name AS text
    FROM sub WHERE acode IS NOT NULL""",
    elements("substances", kinds("SYST")),
    _SUBSTANCES,
)
_AE = "nebenwirkung-adverse-event-id"
_AEP = f"CASE WHEN kind = 2 THEN {sid(_SYS, slug('therapy_id'))} ELSE {sid(_ST, slug('therapy_id'))} END"
_AE1 = slug("('mii-pr-onko-nebenwirkung-' || therapy_id || '-' || i)")
_AE2 = slug("('mii-pr-onko-nebenwirkung-' || therapy_id || '-Grad-maximal-2-unbekannt')")
ORACLE["map_adverse_events"] = mapping(
    f"""SELECT {sid(_AE, _AE1)} AS id, {_AE1} AS identifier_value, report_id, effect_code AS event,
      CASE WHEN effect_code IS NULL THEN effect_name END AS event_text,
      CASE WHEN effect_code IS NULL THEN 'unknown' END AS event_absent, effect_grade AS grade, {_AEP} AS suspect_procedure_id FROM el
    UNION ALL SELECT {sid(_AE, _AE2)}, {_AE2}, report_id, NULL, NULL, 'not-applicable', effect_limit, {_AEP}
    FROM rep WHERE effect_limit IS NOT NULL AND {kinds('SYST', 'ST')}""",
    elements("effects", kinds("SYST", "ST")),
)
_DEATHS = f"""dea AS (SELECT *, patient_id || '-' || tumor_id || coalesce('-' || dcause, '') AS dvalue FROM (
  SELECT rep.*, CASE t.i WHEN 0 THEN 'C61' WHEN 1 THEN 'I21.9' END AS dcause, CASE t.i WHEN 0 THEN '2022' ELSE '-' END AS dyear
    FROM rep, (VALUES (0), (1)) t(i) WHERE {kinds('Tod')} AND has_causes AND t.i < causes
  UNION ALL SELECT rep.*, NULL, NULL FROM rep WHERE {kinds('Tod')} AND NOT has_causes))"""
ORACLE["map_deaths"] = mapping(
    observed(
        "tod-observation-id", "dvalue", "'184305005'", "start",
        "death_related AS related, dcause AS cause, dyear AS version", "dea",
    ),
    _DEATHS,
)
_BOARD = "('Tumorkonferenz-' || board_id)"
_BSTATUS = "CASE WHEN reason_end = 'behandlungsende' THEN 'completed' ELSE 'active' END"
_ACT = (
    "CASE deviation WHEN 'J' THEN 'cancelled' WHEN 'U' THEN 'unknown' "
    "ELSE CASE WHEN reason_end = 'behandlungsende' THEN 'completed' ELSE 'in-progress' END END"
)
ORACLE["map_tumour_boards"] = mapping(
    f"""SELECT {sid('tumorkonferenz-care-plan-id', slug(_BOARD))} AS id, {slug(_BOARD)} AS identifier_value, report_id,
      {_BSTATUS} AS status, board_type AS category, CASE WHEN board_type IS NULL THEN 'unknown' END AS category_absent,
      {pdate('histology_date')} AS created,
      concat_ws(',', CASE WHEN advice > 0 THEN 'OP|' || {_ACT} || '|' || deviation END,
        CASE WHEN advice > 1 THEN 'ST|' || {_ACT} || '|' || deviation END,
        CASE WHEN advice > 2 THEN 'CH|' || {_ACT} || '|' || deviation END) AS activities
    FROM rep WHERE {kinds('Tumorkonferenz')}"""
)
ORACLE["map_progress"] = mapping(
    observed(
        "verlauf-observation-id", "course_id", "'396432002'", _DAY,
        """upper(overall) AS overall, concat_ws(',',
          '277062004|' || upper(local_status) || '|' || CASE upper(local_status) WHEN 'K' THEN 'kein Tumor nachweisbar' WHEN 'R' THEN 'Lokalrezidiv' ELSE 'fehlende Angabe' END,
          '399656008|' || node_status || '|' || CASE node_status WHEN 'N' THEN 'bekannter Lymphknotenbefall No Change' ELSE 'fraglicher Befund' END,
          '399608002|' || upper(distant_status) || '|' || CASE upper(distant_status) WHEN 'U' THEN 'unbekannt' WHEN 'P' THEN 'Fernmetastasen Progress' ELSE 'Fernmetastasen Residuen' END) AS components""",
        f"rep WHERE {kinds('Verlauf')}",
    )
)
_STATUS_ROWS = """st AS (SELECT CAST(o_custkey AS VARCHAR) AS pid,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS last_information,
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 30 END AS death_date
  FROM orders WHERE o_orderkey % 11 <> 0)"""
_VS = "pid || '-vs-' || CASE WHEN death_date IS NOT NULL THEN 'T' ELSE 'L' END"
_VSYS = "onkostar-patient-table-vital-status-id"
_TSYS = "onkostar-patient-table-tod-observation-id"
ORACLE["map_vital_status"] = f"""
WITH {_STATUS_ROWS} SELECT {sid(_VSYS, _VS)} AS id, {_VS} AS identifier_value,
  'Patient/' || {sid('patient-id', 'pid')} AS patient_ref,
  CAST(coalesce(death_date, last_information) AS VARCHAR) AS effective,
  CASE WHEN death_date IS NOT NULL THEN 'T' ELSE 'L' END AS value
FROM st WHERE death_date IS NOT NULL OR last_information IS NOT NULL"""
_SD = "pid || '-fromAdditionalOnkoPatientInfo'"
ORACLE["map_status_deaths"] = f"""
WITH {_STATUS_ROWS} SELECT {sid(_TSYS, _SD)} AS id, {_SD} AS identifier_value,
  CAST(death_date AS VARCHAR) AS effective FROM st WHERE death_date IS NOT NULL"""
ORACLE["stream_vital_status"] = f"""
WITH {_STATUS_ROWS} SELECT 'Patient/' || {sid('patient-id', 'pid')} AS key, 'Observation/' || {sid(_VSYS, _VS)} AS full_url,
  CAST(coalesce(death_date, last_information) AS VARCHAR) AS effective,
  CASE WHEN death_date IS NOT NULL THEN 'T' ELSE 'L' END AS value
FROM st WHERE death_date IS NOT NULL OR last_information IS NOT NULL
UNION ALL SELECT 'Patient/' || {sid('patient-id', 'pid')}, 'Observation/' || {sid(_TSYS, _SD)},
  CAST(death_date AS VARCHAR), NULL FROM st WHERE death_date IS NOT NULL"""

# ---- bundles -----------------------------------------------------------------------------------

ORACLE["patient_policy"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS patient_id, 1 AS write_patient,
  coalesce(s_name, {sid('patient-id', 'CAST(c_custkey AS VARCHAR)')}) AS bundle_id
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
ORACLE["upsert_entries"] = """
SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value,
  min(event_id) AS first_pos FROM events GROUP BY 1, 2"""
ORACLE["duplicate_conflicts"] = """
SELECT user_id, event_type, count(*) AS copies, count(DISTINCT value) AS versions FROM events
WHERE event_type <> 'error' GROUP BY 1, 2 HAVING count(DISTINCT value) > 1"""
ORACLE["bundle_json"] = """
SELECT CAST(o_custkey AS VARCHAR) AS patient_id, 0 AS part, count(*) AS entries,
  '{"resourceType":"Bundle","id":"' || o_custkey || '","type":"transaction","entry":[' ||
  string_agg('{"fullUrl":"Order/' || o_orderkey || '","resource":{"status":"' || o_orderstatus ||
    '"},"request":{"method":"PUT","url":"Order/' || o_orderkey || '"}}', ',' ORDER BY o_orderdate, o_orderkey)
  || ']}' AS bundle_json FROM orders GROUP BY o_custkey"""
ORACLE["bundle_parts"] = """
SELECT patient_id, part, string_agg('Order/' || o_orderkey, ',' ORDER BY o_orderdate, o_orderkey) AS urls,
  1 AS own_id, CASE WHEN part = 0 THEN 1 ELSE 0 END AS plain_id
FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS patient_id, CAST((row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey) - 1) // 4 AS INTEGER) AS part FROM orders) GROUP BY 1, 2"""
ORACLE["stamp_source"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P'
  THEN '{"meta":{"source":"urn:registry"},"id":"' || o_orderkey || '"}'
  ELSE '{"id":"' || o_orderkey || '","meta":{"source":"urn:registry"' ||
    CASE WHEN o_orderstatus = 'O' THEN '}}' ELSE ',"profile":["' || o_orderstatus || '"]}}' END END AS resource_json
FROM orders"""
_DEVICE = f"{CONFIG.device_name}-{CONFIG.device_version}"
_PROV = slug(f"('{_DEVICE}-' || report_id)")
ORACLE["provenance_targets"] = mapping(
    f"""SELECT {sid('provenance-id', _PROV)} AS id, {_PROV} AS identifier_value, report_id,
      'Condition/' || cond_id || ',CarePlan/' || {sid('tumorkonferenz-care-plan-id', slug(_BOARD))} AS targets,
      '{_DEVICE}' AS agent_device FROM (SELECT DISTINCT report_id, cond_id, board_id FROM rep WHERE {kinds('Tumorkonferenz')})"""
)
_KEY = "secret key"
_CP = sid("tumorkonferenz-care-plan-id", slug(_BOARD))
ORACLE["deidentify"] = mapping(
    f"""SELECT {hmac(_CP, _KEY)} AS id, 'CarePlan/' || {hmac(_CP, _KEY)} AS full_url,
      {hmac(slug(_BOARD), _KEY)} AS identifier_value, 'Patient/' || {hmac("substr(pref, 9)", _KEY)} AS subject_ref,
      {hmac(_CP, _KEY)} AS body_id, {hmac(slug(_BOARD), _KEY)} AS body_identifier,
      'Patient/' || {hmac("substr(pref, 9)", _KEY)} AS body_subject, 'Condition/' || {hmac('cond_id', _KEY)} AS body_condition,
      {_BSTATUS} AS status FROM rep WHERE {kinds('Tumorkonferenz')}"""
)
ORACLE["changelog_diff"] = """
SELECT o_orderkey, o_custkey, 1 AS retract FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_custkey + 1, 0 FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'P'"""
ORACLE["stream_report_set"] = """
SELECT CAST(o_custkey AS VARCHAR) AS patient_id, o_orderpriority AS report_id,
  CAST(month(o_orderdate) AS INTEGER) AS version, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS export_id,
  o_orderstatus AS payload FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
    ORDER BY month(o_orderdate) DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""

# ---- quality -----------------------------------------------------------------------------------

ORACLE["outer_join_view"] = """
SELECT o_orderkey, subject_reference, patient_id, c_mktsegment FROM
  (SELECT o_orderkey, 'Patient/' || CASE WHEN o_custkey % 7 = 0 THEN -o_custkey ELSE o_custkey END
    AS subject_reference FROM orders)
  FULL OUTER JOIN (SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_mktsegment FROM customer)
  ON subject_reference = 'Patient/' || patient_id"""
ORACLE["left_inner_view"] = """
SELECT p_partkey, p_brand, count(l_orderkey) AS lines, sum(l_quantity) AS quantity
FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R')
  ON l_partkey = p_partkey GROUP BY 1, 2"""
ORACLE["inner_view"] = """
SELECT s_name, count(*) AS lines FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1"""
ORACLE["distinct_rows"] = "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem"
ORACLE["duplicate_ids"] = """
SELECT l_orderkey, count(*) AS "count" FROM lineitem GROUP BY 1 HAVING count(*) > 1"""
ORACLE["null_by_group"] = """
SELECT source, count(*) AS "count" FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NULL GROUP BY 1"""
ORACLE["distinct_dates"] = """
SELECT o_custkey AS subject_reference, count(DISTINCT year(o_orderdate)) AS distinct_dates_count
FROM orders GROUP BY 1"""
ORACLE["several_death_dates"] = """
SELECT o_custkey AS subject_reference, count(DISTINCT o_orderdate) AS distinct_dates_count FROM orders
GROUP BY 1 HAVING count(DISTINCT o_orderdate) > 1 """
ORACLE["column_summary"] = """
SELECT 'c_name' AS "column", count(c_name) AS "count", NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev,
  min(c_name) AS "min", max(c_name) AS "max" FROM customer
UNION ALL
SELECT 'c_custkey', count(c_custkey), round(avg(c_custkey), 4), round(stddev_samp(c_custkey), 4),
  CAST(min(c_custkey) AS VARCHAR), CAST(max(c_custkey) AS VARCHAR) FROM customer"""
_CHECKED = """c AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  CAST(o_orderkey AS VARCHAR) AS key_text FROM orders)"""


def _row(name: str, where: str, bad: str) -> str:
    return (
        f"SELECT '{name}' AS expectation, count(*) FILTER (WHERE {where}) AS evaluated, "
        f"count(*) FILTER (WHERE ({where}) AND ({bad})) AS unexpected FROM c"
    )


_UNIQUE1 = """SELECT 'customer once', CAST(coalesce(sum(n), 0) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM c WHERE o_orderstatus = 'O' GROUP BY o_custkey)"""
_UNIQUE2 = """SELECT 'customer and priority once', CAST(coalesce(sum(n), 0) AS BIGINT), CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
  FROM (SELECT count(*) AS n FROM c WHERE status IS NOT NULL GROUP BY o_custkey, status)"""
_EXPECTED = " UNION ALL ".join(
    [
        _row("total between", "true", "o_totalprice < 1000 OR o_totalprice > 400000"),
        _row("key above customer", "true", "o_orderkey < o_custkey"),
        _row("status given", "true", "status IS NULL"),
        _row("no status when pending", "o_orderstatus = 'P'", "status IS NOT NULL"),
        _row("priority listed", "true", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')"),
        _row("not low", "o_orderstatus = 'F'", "o_orderpriority = '5-LOW'"),
        _row("no digit four", "true", "key_text LIKE '%4%4%'"),
        _UNIQUE1,
        _UNIQUE2,
    ]
)
ORACLE["expectations_orders"] = f"""
WITH {_CHECKED}, r AS ({_EXPECTED})
SELECT 'orders' AS suite, expectation, evaluated, unexpected,
  round(CASE WHEN evaluated > 0 THEN 100.0 * unexpected / evaluated ELSE 0 END, 4) AS unexpected_pct,
  CASE WHEN unexpected = 0 THEN 1 ELSE 0 END AS success FROM r"""
ORACLE["failing_between"] = "SELECT o_orderkey FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000"
ORACLE["failing_regex"] = "SELECT o_orderkey FROM orders WHERE CAST(o_orderkey AS VARCHAR) LIKE '%4%4%'"
ORACLE["failing_unique"] = """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING count(*) > 1)"""

# Patients, conditions and deaths as the quality views see them.
_PAT = f"""pat AS (SELECT {sid('patient-id', 'patient_id')} AS pat_id,
    CASE any_value(sex) WHEN 'W' THEN 'female' WHEN 'M' THEN 'male' WHEN 'U' THEN 'unknown' ELSE 'other' END AS gender,
    any_value({pdate('birth', 'birth_prec')}) AS birth, max(CASE WHEN kind = 7 THEN start END) AS died,
    CASE WHEN bool_or(kind = 7) AND max(CASE WHEN kind = 7 THEN start END) IS NULL THEN true END AS deceased
  FROM rep WHERE {{0}} GROUP BY patient_id)"""


def suite(name: str, view: str, rules: list[tuple[str, str, str]], where: str, *ctes: str, unique: list[str] = ()) -> str:
    rows = [
        f"SELECT '{name}' AS suite, '{rule}' AS expectation, count(*) FILTER (WHERE {looked}) AS evaluated, "
        f"count(*) FILTER (WHERE ({looked}) AND ({bad})) AS unexpected FROM v"
        for rule, looked, bad in rules
    ]
    rows += [
        f"SELECT '{name}' AS suite, '{rule}' AS expectation, CAST(coalesce(sum(n), 0) AS BIGINT) AS evaluated, "
        f"CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS unexpected FROM (SELECT count(*) AS n FROM v WHERE {looked} GROUP BY {columns})"
        for rule, looked, columns in unique
    ]
    return mapping(" UNION ALL ".join(rows), _PAT.format(where), *ctes, f"v AS ({view})")


def _range(column: str, label: str) -> tuple[str, str, str]:
    return (
        f"{label} between 1900 and now",
        f"{column} IS NOT NULL",
        f"{column} < '1900-01-01' OR {column} > '2001-12-31'",
    )


def _pair(rule: str, a: str, b: str, where: str = "true") -> tuple[str, str, str]:
    return (rule, f"{where} AND {a} IS NOT NULL AND {b} IS NOT NULL", f"{a} < {b}")


def _given(rule: str, column: str, where: str = "true") -> tuple[str, str, str]:
    return (rule, where, f"{column} IS NULL")


_CONDITION_ROWS = f"""con AS (SELECT DISTINCT cond_id, icd, CASE k % 4 WHEN 0 THEN '2023' WHEN 1 THEN '2019' END AS year,
    substr(pref, 9) AS p, {pdate('diagnosed')} AS asserted, recorded AS rec FROM rep WHERE {{0}})"""
_W = kinds("SYST", "Tod")
ORACLE["suite_conditions"] = suite(
    "conditions",
    "SELECT * FROM con FULL OUTER JOIN pat ON p = pat_id",
    [
        _range("birth", "date_of_birth"),
        _pair("death not before birth", "died", "birth"),
        _range("died", "deceased_date_time"),
        _range("asserted", "asserted_date"),
        _pair("diagnosis not before birth", "asserted", "birth"),
        _given("diagnosis date given", "asserted"),
        ("prostate cancer only in men", "icd = 'C61' AND gender IS NOT NULL", "gender <> 'male'"),
        _given("patient known", "pat_id"),
        _given("condition id given", "cond_id"),
        _given("catalogue year given", "year"),
        _given("diagnosis code given", "icd"),
        _pair("recorded not before birth", "rec", "birth"),
        _given("recorded date given", "rec"),
    ],
    _W,
    _CONDITION_ROWS.format(_W),
)
_W = kinds("OP", "Tod")
_PROC = f"""pro AS (
  SELECT DISTINCT {sid(_PSYS, slug(_SURGERY))} AS pid, CAST(NULL AS VARCHAR) AS ops, substr(pref, 9) AS p, start AS per, cond_id AS rc FROM rep WHERE {kinds('OP')}
  UNION SELECT DISTINCT {sid(_PSYS, slug('(' + _OPV + ')'))}, procedure_code, substr(pref, 9), start, cond_id FROM opsd)"""
_PCTES = (elements("procedures", kinds("OP")), _OPS, _PROC)
ORACLE["suite_procedures"] = suite(
    "procedures",
    "SELECT * FROM pro JOIN pat ON p = pat_id",
    [
        _given("patient known", "pat_id"),
        _given("procedure id given", "pid"),
        _pair("performed not before birth", "per", "birth"),
        _pair("performed not after death", "died", "per"),
        ("no female organ surgery in men", "gender = 'male' AND ops IS NOT NULL", "regexp_matches(ops, '^5-6[5-9]|^5-7[0-1]')"),
        ("no male organ surgery in women", "gender = 'female' AND ops IS NOT NULL", "regexp_matches(ops, '^5-6[0-4]')"),
        _range("per", "performed_date_time"),
        ("no date beside a period", "false", "true"),
        ("no period beside a date", "per IS NOT NULL", "false"),
    ],
    _W,
    *_PCTES,
)
_W = kinds("OP")
ORACLE["suite_condition_procedure"] = suite(
    "condition_procedure",
    "SELECT con.*, pid, ops, per, pat.* FROM con LEFT JOIN pro ON cond_id = rc JOIN pat ON con.p = pat_id",
    [
        ("no breast surgery in men without breast cancer", "gender = 'male' AND icd <> 'C50.9' AND ops IS NOT NULL", "regexp_matches(ops, '^5-8[7-8]')"),
        _pair("procedure not before diagnosis", "per", "asserted"),
        _pair("surgery not before primary diagnosis", "per", "asserted"),
    ],
    _W,
    *_PCTES,
    _CONDITION_ROWS.format(_W),
)
_W = kinds("SYST")
_STM = f"""stm AS (SELECT DISTINCT {sid('systemische-therapie-medication-statement-id', _MSV)} AS sid, substr(pref, 9) AS p,
    {pdate('start')} AS s0, finish AS s1 FROM sub)"""
ORACLE["suite_medication_statements"] = suite(
    "medication_statements",
    "SELECT * FROM stm JOIN pat ON p = pat_id",
    [
        _pair("end not before start", "s1", "s0"),
        _range("s0", "effective_period_start"),
        _pair("start not before birth", "s0", "birth"),
    ],
    _W,
    elements("substances", kinds("SYST")),
    _SUBSTANCES,
    _STM,
)
_W = kinds("Tod", "SYST")
_OBS = f"""obs AS (SELECT DISTINCT {sid('tod-observation-id', slug('dvalue'))} AS oid, substr(pref, 9) AS p, dcause AS vc,
    start AS eff, true AS is_death, death_related AS rel, false AS no_study FROM dea
  UNION SELECT DISTINCT {sid('studienteilnahme-observation-id', slug("(report_id || '-Studienteilnahme')"))}, substr(pref, 9),
    CASE WHEN study_date IS NOT NULL THEN 'J' ELSE study_answer END, study_date, false, NULL, study_date IS NULL AND study_answer = 'N'
  FROM rep WHERE has_study AND {kinds('SYST')})"""
ORACLE["suite_observations"] = suite(
    "observations",
    "SELECT * FROM obs FULL OUTER JOIN pat ON p = pat_id",
    [
        _range("birth", "date_of_birth"),
        _given("code system given", "NULL", "false"),
        _given("code given", "NULL", "false"),
        _given("patient known", "pat_id"),
        _given("observation id given", "oid"),
        _pair("observed not before birth", "eff", "birth"),
        _pair("observed not after death", "died", "eff"),
        _given("observation date given", "eff", "NOT coalesce(no_study, false)"),
        _range("eff", "effective_date_time"),
        _given("deceased flag given with a death date", "deceased", "died IS NOT NULL"),
        _given("death date of a reported death", "died", "coalesce(is_death, false)"),
        _given("patient of a reported death is deceased", "died", "coalesce(is_death, false)"),
    ],
    _W,
    _DEATHS,
    _OBS,
    unique=[("one death observation per patient", "coalesce(is_death, false) AND pat_id IS NOT NULL", "pat_id")],
).replace(
    "'code system given' AS expectation, count(*) FILTER (WHERE false)",
    "'code system given' AS expectation, count(*) FILTER (WHERE oid IS NOT NULL)",
).replace(
    "'code given' AS expectation, count(*) FILTER (WHERE false)",
    "'code given' AS expectation, count(*) FILTER (WHERE oid IS NOT NULL)",
)
_W = kinds("Pathologie")
_MET = f"""met AS (SELECT DISTINCT {sid('fernmetastasen-observation-id', slug("(report_id || '-Pathologie-' || i)"))} AS oid,
    substr(pref, 9) AS p, site, {pdate(_DAY, 'site_prec')} AS eff FROM el)"""
ORACLE["suite_metastases"] = suite(
    "metastases", "SELECT * FROM met JOIN pat ON p = pat_id", [], _W,
    elements("sites", kinds("Pathologie")), _MET,
    unique=[("metastasis reported once", "eff IS NOT NULL AND site IS NOT NULL", "pat_id, eff, site")],
)
_W = kinds("Verlauf", "Tod")
_PERF = f"""perf AS (SELECT DISTINCT {sid('allgemeiner-leistungszustand-ecog-id', slug("('ECOG-' || report_id)"))} AS oid,
    substr(pref, 9) AS p, {_ECOG_SQL} AS grade, {_DAY} AS eff FROM rep WHERE {kinds('Verlauf')} AND performance IS NOT NULL)"""
ORACLE["suite_performance_death"] = suite(
    "performance_death", "SELECT * FROM perf LEFT JOIN pat ON p = pat_id",
    [_given("death reported for grade five", "died", "grade = '5'")], _W, _PERF,
)
_W = kinds("Tod")
_DOBS = f"""dob AS (SELECT DISTINCT {sid('tod-observation-id', slug('dvalue'))} AS oid, substr(pref, 9) AS p, dcause AS vc,
    start AS eff, death_related AS rel FROM dea)"""
ORACLE["suite_death_completeness"] = suite(
    "death_completeness", "SELECT * FROM dob",
    [
        _given("cause of death given", "vc"),
        ("relation to tumour not unknown", "rel IS NOT NULL", "rel = 'U'"),
        _given("relation to tumour given", "rel"),
    ],
    _W, _DEATHS, _DOBS,
)
ORACLE["suite_death_dates"] = suite(
    "death_dates", "SELECT p, count(DISTINCT eff) AS n FROM dob GROUP BY p",
    [("one death date per patient", "true", "n <> 1")], _W, _DEATHS, _DOBS,
)
ORACLE["diagnoses_per_year"] = mapping(
    """SELECT icd, CAST(year(day) AS VARCHAR) AS year, count(*) AS diagnoses, count(DISTINCT patient_id) AS patients,
      count(*) FILTER (WHERE icd = 'C61' AND sex <> 'M') AS not_male FROM latest GROUP BY 1, 2""",
    _LATEST,
)


# ---- sections and whole bundles, from the job results above ----------------------------------------


def _urls(section: str, jobs: dict[str, str]) -> str:
    """Type and id of everything a section gives rise to."""
    parts = []
    number = KINDS.index(section)
    for job, kind in jobs.items():
        parts.append(
            f"SELECT '{kind}' AS resource_type, id FROM ({ORACLE['map_' + job]}) "
            f"WHERE contains(report_id, '_{number}/')"
        )
    return " UNION ALL ".join(parts)


def _section(section: str, jobs: dict[str, str]) -> str:
    return (
        "SELECT resource_type, count(*) AS resources, count(DISTINCT id) AS urls "
        f"FROM ({_urls(section, jobs)}) GROUP BY 1"
    )


def _typed(names: str, kind: str = "Observation") -> dict[str, str]:
    return dict.fromkeys(names.split(), kind)


_CLINICAL = "metastases grading lymph_nodes genetic_variants tnm prostate_module gleason classifications"
SECTION_JOBS = {
    "Diagnose": _typed(f"performance_status study_participation {_CLINICAL}")
    | {"specimens": "Specimen", "evidence_lists": "List", "earlier_tumours": "Condition"},
    "Verlauf": _typed(f"progress performance_status course_histology study_participation {_CLINICAL}")
    | {"specimens": "Specimen"},
    "SYST": {
        "systemic_procedures": "Procedure",
        "medication_statements": "MedicationStatement",
        "medications": "Medication",
        "study_participation": "Observation",
        "adverse_events": "AdverseEvent",
    },
    "ST": {
        "radiotherapy": "Procedure",
        "study_participation": "Observation",
        "adverse_events": "AdverseEvent",
    },
    "OP": _typed(
        "residual_status course_histology grading lymph_nodes study_participation genetic_variants "
        "tnm prostate_module gleason"
    )
    | {"surgeries": "Procedure", "specimens": "Specimen"},
    "Pathologie": _typed(f"course_histology {_CLINICAL}")
    | {"specimens": "Specimen", "pathology_reports": "DiagnosticReport"},
    "Tod": _typed("deaths"),
    "Tumorkonferenz": {"tumour_boards": "CarePlan"},
}
for _name, _kind in (
    ("diagnosis", "Diagnose"),
    ("progress", "Verlauf"),
    ("systemic", "SYST"),
    ("radiotherapy", "ST"),
    ("surgery", "OP"),
    ("pathology", "Pathologie"),
    ("death", "Tod"),
    ("board", "Tumorkonferenz"),
):
    ORACLE[f"section_{_name}"] = _section(_kind, SECTION_JOBS[_kind])

_PICKED = ORACLE["consolidated_reports"]


def _of_picked(job: str) -> str:
    """A job's result over the reports that survive consolidation."""
    return ORACLE[f"map_{job}"].replace(
        " FROM vals)", f" FROM vals WHERE export_id IN (SELECT export_id FROM ({_PICKED})))", 1
    )


_TYPES = {job: kind for jobs in SECTION_JOBS.values() for job, kind in jobs.items()}
_ENTRIES = " UNION ALL ".join(
    f"SELECT report_id, '{kind}/' || id AS url FROM ({_of_picked(job)})" for job, kind in _TYPES.items()
)
ORACLE["bundles_pipeline"] = (
    f"WITH picked AS ({_PICKED}), urls AS ({_ENTRIES}) "
    "SELECT patient_id, tumor_id, 0 AS part, CAST(2 + count(DISTINCT url) AS INTEGER) AS entries, "
    "'Patient/' || " + sid("patient-id", "patient_id") + " || ' - Condition/' || "
    + sid("primaerdiagnose-condition-id", "patient_id || '-' || tumor_id")
    + " AS bundle_key FROM picked LEFT JOIN urls USING (report_id) GROUP BY 1, 2"
)
ORACLE["bundles_to_views"] = mapping(
    f"""SELECT id, pref AS subject, start AS effective, coalesce(dcause, '') AS cause FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY report_id DESC) AS pick FROM (
        SELECT *, {sid('tod-observation-id', slug('dvalue'))} AS id FROM dea)) WHERE pick = 1""",
    _LATEST,
    _DEATHS.replace("FROM rep,", "FROM latest rep,").replace("FROM rep WHERE", "FROM latest rep WHERE"),
)


# ---- views of all sections ------------------------------------------------------------------------


def _of_latest(job: str) -> str:
    """A job's result over the newest version of every report."""
    newest = mapping("SELECT export_id FROM latest", _LATEST)
    return ORACLE[f"map_{job}"].replace(" FROM vals)", f" FROM vals WHERE export_id IN (SELECT export_id FROM ({newest})))", 1)


_VIEW_JOBS = {
    "patients": ["patients"],
    "conditions": ["conditions", "earlier_tumours"],
    "observations": [job for job, kind in _TYPES.items() if kind == "Observation"],
    "procedures": [job for job, kind in _TYPES.items() if kind == "Procedure"],
    "medication_statements": ["medication_statements"],
}
ORACLE["views_by_path"] = " UNION ALL ".join(
    f"SELECT '{view}' AS view, count(DISTINCT id) AS resources, CAST(0 AS BIGINT) AS differing FROM ("
    + " UNION ALL ".join(f"SELECT id FROM ({_of_latest(job)})" for job in jobs) + ")"
    for view, jobs in _VIEW_JOBS.items()
)
ORACLE["consolidated_in_steps"] = ORACLE["consolidated_reports"]
_KEY = "secret key"
_HIDDEN_PATIENT = hmac(sid("patient-id", "patient_id"), _KEY)
ORACLE["deidentified_bundles"] = (
    f"SELECT {hmac('patient_id', _KEY)} AS patient_id, {hmac('tumor_id', _KEY)} AS tumor_id, entries, "
    f"'Patient/' || {_HIDDEN_PATIENT} || ' - Condition/' || "
    + hmac(sid("primaerdiagnose-condition-id", "patient_id || '-' || tumor_id"), _KEY)
    + f" AS bundle_key, {_HIDDEN_PATIENT} AS bundle_id, 1 AS same_id, 0 AS leaks "
    f"FROM ({ORACLE['bundles_pipeline']})"
)
ORACLE["bundle_files"] = """
SELECT CAST(o_custkey AS VARCHAR) AS bundle_id, count(DISTINCT o_orderpriority) AS files, count(*) AS entries,
  CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders GROUP BY 1"""
ORACLE["row_counts"] = """
SELECT 'Line' AS resource_type, 'read' AS stage, count(*) AS rows FROM lineitem
UNION ALL SELECT 'Line', 'extracted', count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
UNION ALL SELECT 'Order', 'read', count(*) FROM orders
UNION ALL SELECT 'Order', 'extracted', count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)"""
ORACLE["schema_check"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'document is not well-formed'
  WHEN o_orderstatus = 'P' THEN 'document does not conform to the schema' END AS parse_error FROM orders"""
ORACLE["sorted_table_upsert"] = """
WITH returned AS (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'),
changed AS (
  SELECT 'Order' AS resource_type, CAST(l_orderkey AS VARCHAR) AS id, count(*) AS value FROM returned GROUP BY l_orderkey
  UNION ALL SELECT 'Supplier', CAST(l_suppkey AS VARCHAR), count(*) FROM returned GROUP BY l_suppkey
), old AS (SELECT 'Order' AS resource_type, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS BIGINT) AS value FROM orders)
SELECT * FROM changed
UNION ALL SELECT * FROM old WHERE NOT EXISTS (
  SELECT 1 FROM changed WHERE changed.resource_type = old.resource_type AND changed.id = old.id)"""
# Over all sections these are compared with a plain version of the suites in the tests.
for _suite in ("conditions", "procedures", "condition_procedure", "observations", "metastases", "performance_death"):
    del ORACLE[f"suite_{_suite}"]
