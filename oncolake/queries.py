"""Every operator as a query over the driver tables, results flat.

Mapping jobs run on registry reports derived from orders and customers (one report per order), the
other operators on the tables as they are, by calling the library function with column parameters.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake import resources as R
from oncolake.functions import clinical, codes, dates, ids
from oncolake.operators import bundles as B
from oncolake.operators import consolidate as K
from oncolake.operators import deidentify as D
from oncolake.operators import deidentify_rules as DR
from oncolake.operators import patient_reference as PR
from oncolake.operators import reports as RP
from oncolake.operators.staging import checkpoint_dir, drop_staged, few_rows_at_once, stage_table
from oncolake.plans import derived
from oncolake.plans import pipeline as P
from oncolake.quality import expectations as E
from oncolake.quality import paths as X
from oncolake.quality import suites as Q
from oncolake.quality import views as V
from oncolake.resources.envelope import to_envelope
from oncolake.sources import code_maps, grouped_files, patient_status, resources, sorted_tables
from oncolake.sources import reports as SR
from oncolake.streaming import report_set, vital_status

CFG = derived.CONFIG
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = "2001-12-31"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Mapping-ready derived reports with a valid patient id."""
    documents = derived.derived_documents(spark, sf_dir, kinds or derived.KINDS)
    prepared = RP.prepare_reports(documents.withColumn("parse_error", F.lit(None).cast("string")), CFG)
    return prepared.filter(F.col("patient_id").isNotNull())


def code_text(items: str | Column) -> Column:
    """Codes of a list of codings as text."""
    items = F.col(items) if isinstance(items, str) else items
    return F.nullif(
        F.concat_ws(",", F.transform(items, lambda c: F.coalesce(c["code"], F.lit("-")))), F.lit("")
    )


def version_text(items: str) -> Column:
    return F.nullif(
        F.concat_ws(",", F.transform(F.col(items), lambda c: F.coalesce(c["version"], F.lit("-")))),
        F.lit(""),
    )


def number(column: Column) -> Column:
    return column.cast("double")


def order_keys() -> list[Column]:
    return [F.col("o_orderdate"), F.col("o_orderkey")]


# ---- changelog, grouping and consolidation -----------------------------------------------------


@query
def latest_version(spark, sf):
    """Per customer and priority the order with the highest version."""
    orders = table(spark, sf, "orders")
    latest = K.retain_latest_version(
        orders, ("o_custkey", "o_orderpriority"), (F.month("o_orderdate"), "o_orderkey")
    )
    return latest.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query
def latest_by_key_tombstone(spark, sf):
    """Newest event per user; users whose newest event is an error are gone."""
    events = table(spark, sf, "events")
    latest = K.latest_by_key(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return latest.select("user_id", "event_id", "event_type", "value")


@query
def prefer_by_reason(spark, sf):
    """Per order one line: a returned one, else an accepted one, else any."""
    lines = table(spark, sf, "lineitem")
    tie = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    chosen = K.prefer_by_reason(lines, ["l_orderkey"], F.col("l_returnflag"), "a", "r", tie)
    return chosen.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query
def group_split(spark, sf):
    lines = table(spark, sf, "lineitem")
    return K.group_by_tumor(
        lines, ("l_orderkey", "l_suppkey"), F.min("l_linenumber").alias("first_line")
    )


@query
def key_by_patient(spark, sf):
    """Orders spread by customer and order; the shuffle keeps every row."""
    orders = table(spark, sf, "orders").withColumnsRenamed(
        {"o_custkey": "patient_id", "o_orderkey": "report_id"}
    )
    keyed = K.key_by_patient(orders, 16)
    return keyed.groupBy("patient_id").agg(F.count(F.lit(1)).alias("reports"))


@query
def merge_group_header(spark, sf):
    """Orders of a customer merged: header of the newest order, all order keys in date order."""
    merged = K.merge_report_group(
        table(spark, sf, "orders"),
        ["o_custkey"],
        F.col("o_orderkey"),
        order_keys(),
        {"priority": F.col("o_orderpriority"), "status": F.col("o_orderstatus")},
        order_keys(),
    )
    return merged.select(
        "o_custkey", "part", "priority", "status",
        F.size("items").cast("bigint").alias("orders"),
        F.concat_ws(",", F.col("items").cast("array<string>")).alias("order_keys"),
    )


@query
def merge_group_parts(spark, sf):
    """The same merge in parts of five orders, asked for; the parts add up to the whole group."""
    merged = K.merge_report_group(
        table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderkey"), order_keys(),
        {"priority": F.col("o_orderpriority")}, order_keys(), max_rows=5,
    )
    return merged.groupBy("o_custkey", "priority").agg(
        F.sum(F.size("items")).cast("bigint").alias("orders"),
        F.sum(F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("key_sum"),
    )


@query
def latest_master_data(spark, sf):
    orders = table(spark, sf, "orders")
    return K.latest_master_data(orders, ("o_custkey",), "o_orderpriority", order_keys())


@query
def keep_all_events(spark, sf):
    events = table(spark, sf, "events")
    kept = K.keep_all_events(events, F.col("event_type").isin("signup", "purchase", "error"))
    return kept.select("event_id", "user_id", "event_type")


@query
def first_report_of_message(spark, sf):
    """The first line number of an order as the first report of a message."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.lit(0).alias("patient_pos"), (F.col("l_linenumber") - 1).alias("report_pos"),
    )
    return K.first_report_of_message(lines).select("l_orderkey", "l_partkey", "l_suppkey")


@query
def rank_reports(spark, sf):
    """Lines numbered within their order by flag priority, line number and part."""
    lines = table(spark, sf, "lineitem")
    priority = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    ranked = RP.rank_reports(
        lines,
        ("l_orderkey",),
        (priority, "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
    )
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "report_rank")


@query
def bundle_key(spark, sf):
    orders = table(spark, sf, "orders")
    condition = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string"))
    patient = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).otherwise(" ")
    return orders.select(
        "o_orderkey", K.bundle_key(patient, condition).alias("bundle_key")
    ).filter(F.col("bundle_key").isNotNull())


_RULED = ["patient_id", "tumor_id", "report_id", "export_id", "version", "report_date"]
_CURRENT = ["patient_id", "tumor_id", "report_id", "export_id", "section", "section_rank"]


def with_row_id(rows: DataFrame) -> DataFrame:
    """Derived reports are one per export, so the place in the export identifies a row."""
    return rows.withColumn("row_id", F.concat_ws("/", "export_id", "patient_pos", "report_pos"))


@query
def consolidated_reports(spark, sf):
    """Reports that survive version and reason rules, per patient and tumour."""
    return K.winning_reports(with_row_id(reports(spark, sf))).select(*_CURRENT)


@query
def consolidated_in_steps(spark, sf):
    """The same rules one after the other, on whole rows of what the rules read."""
    rows = reports(spark, sf).select(*_RULED, K.rule_members())
    return K.consolidate_reports(K.retain_latest_version(rows)).select(*_CURRENT)


def _section_selection(select, section, id_field):
    def run(spark, sf):
        rows = reports(spark, sf, section).select(*_RULED, K.rule_members())
        latest = K.retain_latest_version(rows)
        return select(latest).select(
            "patient_id", "tumor_id", F.col("report")[section][id_field].alias("therapy_id"), "export_id"
        )

    return run


QUERIES["select_systemic"] = _section_selection(K.systemic_reports, "SYST", "_SYST_ID")
QUERIES["select_radiotherapy"] = _section_selection(K.radiotherapy_reports, "ST", "_ST_ID")
QUERIES["select_progress"] = _section_selection(K.progress_reports, "Verlauf", "_Verlauf_ID")
QUERIES["select_boards"] = _section_selection(
    K.board_reports, "Tumorkonferenz", "_Tumorkonferenz_ID"
)


# ---- sources -----------------------------------------------------------------------------------


@query
def xml_roundtrip(spark, sf):
    """Derived reports written as XML text, decoded again and exploded."""
    xml = derived.derived_xml(spark, sf)
    exploded = RP.explode_reports(SR.parse_reports(xml))
    report = F.col("report")
    return exploded.select(
        "export_id",
        "source_patient_id",
        "report_id",
        "tumor_id",
        F.col("report_date").cast("string").alias("report_date"),
        report["Tumorzuordnung"]["Primaertumor_ICD"]["Code"].alias("icd"),
        report["Tumorzuordnung"]["Diagnosedatum"]["_VALUE"].alias("diagnosed"),
        RP.section_set(report).alias("section"),
        F.col("master.Geschlecht").alias("sex"),
        F.col("parse_error"),
    )


@query
def explode_reports(spark, sf):
    """Reports per patient after exploding nested documents."""
    documents = derived.derived_documents(spark, sf)
    exploded = RP.explode_reports(documents)
    return exploded.groupBy("source_patient_id").agg(
        F.count("report_id").alias("reports"), F.min("report_id").alias("first_report")
    )


@query
def json_envelope(spark, sf):
    """Orders as JSON messages whose keys come in mixed case and with quoted numbers."""
    orders = table(spark, sf, "orders")
    upper = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("ID"),
            F.col("o_orderpriority").alias("REFERENZ_NUMMER"),
            F.col("o_custkey").alias("LKR_MELDUNG"),
            F.month("o_orderdate").alias("VERSIONSNUMMER"),
            F.col("o_orderstatus").alias("XML_DATEN"),
        )
    )
    mixed = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("o_orderpriority").alias("Referenz_Nummer"),
            F.col("o_custkey").alias("lkr_meldung"),
            F.month("o_orderdate").cast("string").alias("versionsnummer"),
            F.col("o_orderstatus").alias("xml_daten"),
        )
    )
    messages = orders.select(F.when(F.col("o_orderkey") % 2 == 0, upper).otherwise(mixed).alias("value"))
    return SR.read_report_messages(messages)


@query
def version_detect(spark, sf):
    """Page texts behind different report headers, classified by root tag and schema version."""
    pages = table(spark, sf, "pages")
    header = (
        F.when(F.col("page_id") % 5 == 0, '<oBDS Schema_Version="3.0.2">')
        .when(F.col("page_id") % 5 == 1, '<ADT_GEKID Schema_Version="2.1.1">')
        .when(F.col("page_id") % 5 == 2, '<obds xmlns="x" SCHEMA_VERSION="3.1">')
        .otherwise("")
    )
    body = F.when(F.col("page_id") % 5 == 3, "  \n ").otherwise(F.col("html"))
    texts = pages.select("page_id", F.concat(header, body).alias("xml"))
    return SR.detect_report_version(texts).select("page_id", "report_version")


@query
def quarantine_split(spark, sf):
    customers = table(spark, sf, "customer")
    good, bad = SR.split_quarantine(
        customers,
        {
            "negative balance": F.col("c_acctbal") < 0,
            "no segment": F.when(
                F.col("c_mktsegment") == "HOUSEHOLD",
                F.concat(F.lit("segment not allowed: "), F.col("c_mktsegment")),
            ),
        },
    )
    kept = good.select("c_custkey", F.lit(None).cast("string").alias("error"))
    return kept.unionByName(bad.select("c_custkey", "error"))


@query
def single_patient_messages(spark, sf):
    """Messages with one or two patients, built from order pairs; those with two are rejected."""
    documents = derived.derived_documents(spark, sf)
    patients = F.col("document")["Menge_Patient"]["Patient"]
    doubled = documents.select(
        "export_id",
        F.struct(
            F.struct(
                F.when(
                    F.col("export_id").cast("bigint") % 3 == 0, F.concat(patients, patients)
                ).otherwise(patients).alias("Patient")
            ).alias("Menge_Patient")
        ).alias("document"),
    )
    good, bad = SR.require_single_patient(doubled)
    return good.select("export_id", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("export_id", "error")
    )


@query
def incremental_scan(spark, sf):
    orders = table(spark, sf, "orders")
    newer = SR.incremental_scan(orders, 5000, "o_orderkey", F.col("o_orderstatus") != "P")
    return newer.select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def next_cursor(spark, sf):
    return SR.next_cursor(table(spark, sf, "orders"), "o_orderkey")


@query
def report_export_rows(spark, sf):
    """Export rows of the report table: not deleted, with a version, past a cursor."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ID"),
        F.when(F.col("o_orderstatus") == "P", -1).otherwise(1).alias("TYP"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.month("o_orderdate")).alias("VERSIONSNUMMER"),
        F.col("o_orderpriority").alias("REFERENZ_NUMMER"),
        F.col("o_custkey").alias("LKR_MELDUNG"),
        F.lit("<oBDS/>").alias("XML_DATEN"),
    )
    return SR.report_export_rows(rows, 1000)


@query
def status_join3(spark, sf):
    """Customers, orders and lines joined as patient, procedure and status tables."""
    patients = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("PATIENTEN_ID"),
        F.expr("timestamp'1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey as int))").alias(
            "BEARBEITET_AM"
        ),
    )
    links = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("PATIENT_ID")
    )
    status = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ID"),
        F.col("l_shipdate").alias("LETZTEINFORMATION"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("STERBEDATUM"),
    )
    joined = patient_status.join_patient_status(
        patients, links, status, F.lit("1995-03-01").cast("timestamp")
    )
    return joined.select(
        "id", "patient_id",
        F.col("last_information").cast("string").alias("last_information"),
        F.col("death_date").cast("string").alias("death_date"),
    )


@query
def code_lookup(spark, sf):
    """Customers with the name of their nation as display; nations of one region are unlisted."""
    nations = table(spark, sf, "nation")
    listed = nations.filter(F.col("n_regionkey") != 3).select(
        F.lit("nation").alias("system"),
        F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("display"),
    )
    customers = table(spark, sf, "customer")
    found = code_maps.code_lookup(customers, F.col("c_nationkey").cast("string"), listed, "nation")
    return found.select("c_custkey", "display", "code_error")


@query
def code_map_override(spark, sf):
    """Part names to the type of the last part with the name; one type does not count."""
    parts = table(spark, sf, "part")
    chosen = code_maps.override_code_map(parts, ["p_name"], "p_type", ["p_size", "p_partkey"], ["PROMO"])
    return chosen.select("p_name", "p_type", "p_partkey")


# ---- functions ---------------------------------------------------------------------------------


@query
def resource_id(spark, sf):
    customers = table(spark, sf, "customer")
    system = CFG.identifier_system("patient-id")
    return customers.select("c_custkey", ids.resource_id(system, F.col("c_name")).alias("id"))


@query
def slug(spark, sf):
    """Slugs of texts with blanks, umlauts, accents and punctuation."""
    documents = table(spark, sf, "documents")
    return documents.select("doc_id", ids.slugify(F.concat("source", F.lit(" / "), "text")).alias("slug"))


@query
def text_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ids.text_hash(F.col("text")).alias("hash"))


@query
def first_nonblank(spark, sf):
    orders = table(spark, sf, "orders")
    a = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    b = F.when(F.col("o_orderstatus") == "O", F.lit("  ")).otherwise("b")
    return orders.select("o_orderkey", ids.first_nonblank(a, b, F.lit("last")).alias("value"))


@query
def partial_date(spark, sf):
    orders = table(spark, sf, "orders")
    precision = F.expr(derived.SOURCE["prec"])
    date = dates.partial_date(F.to_date("o_orderdate").cast("string"), precision)
    return orders.select("o_orderkey", date["value"].alias("value"), date["precision"].alias("precision"))


@query
def icd_version_year(spark, sf):
    parts = table(spark, sf, "part")
    text = F.when(
        F.col("p_size") % 3 == 0, F.concat(F.lit("10 20"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit(" GM"))
    ).when(F.col("p_size") % 3 == 1, "Sonstige")
    return parts.select("p_partkey", dates.icd_version_year(text).alias("year"))


@query
def normalize_id(spark, sf):
    customers = table(spark, sf, "customer")
    normal = RP.normalize_patient_id(customers, CFG.patient_id_regex, "c_name")
    return normal.select("c_name", "patient_id", "patient_id_error")


@query
def data_absent(spark, sf):
    labels = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    reason = F.when(F.col("quality").isNull(), "unknown")
    marked = codes.data_absent(reason)
    return labels.select("doc_id", F.try_element_at(marked, F.lit(1))["valueCode"].alias("reason"))


@query
def require_reference(spark, sf):
    orders = table(spark, sf, "orders")
    ref = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Patient/"), "o_custkey")).when(
        F.col("o_orderstatus") == "O", F.concat(F.lit("Order/"), "o_custkey")
    )
    identifier = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string"))
    return orders.select("o_orderkey", codes.require_reference(ref, "Patient", identifier).alias("error"))


@query
def distinct_by_code(spark, sf):
    """Per order three derived codes, duplicates reduced to the greatest version."""
    orders = table(spark, sf, "orders")
    items = F.array(
        *[
            F.struct(
                F.concat(F.lit("c"), ((F.col("o_orderkey") + i) % 2).cast("string")).alias("Code"),
                F.when((F.col("o_custkey") + i) % 4 != 0, ((F.col("o_custkey") * 7 + i * 3) % 9).cast("string")).alias(
                    "Version"
                ),
                F.lit(i).alias("pos"),
            )
            for i in range(3)
        ]
    )
    distinct = orders.select("o_orderkey", F.posexplode(clinical.distinct_by_code(items)).alias("n", "item"))
    return distinct.select("o_orderkey", "n", "item.Code", "item.Version", "item.pos")


@query
def period_of(spark, sf):
    """Earliest and latest of three dates derived per order, nulls ignored."""
    orders = table(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    shifted = [F.date_add(day, (F.col("o_orderkey") % n).cast("int")) for n in (5, 7, 11)]
    begins = F.array(*[F.when(F.col("o_orderkey") % 3 != i, d) for i, d in enumerate(shifted)])
    period = dates.period_of(begins, begins)
    return orders.select(
        "o_orderkey",
        period["start"].cast("string").alias("start"),
        period["end"].cast("string").alias("end"),
    )


@query
def tnm_suffixes(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    value = F.concat(F.lit("N"), F.expr(derived.VALUES["tnm_n"]))
    parts = clinical.tnm_suffixes(value)
    return orders.filter(F.expr(derived.VALUES["tnm_n"]).isNotNull()).select(
        "k", parts["value"].alias("value"),
        parts["sn"].cast("int").alias("sn"),
        parts["itc_positive"].cast("int").alias("itc_positive"),
        parts["itc_negative"].cast("int").alias("itc_negative"),
    )


@query
def uicc_stage(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    return orders.select("k", clinical.uicc_stage(F.expr(derived.VALUES["stage"])).alias("stage"))


@query
def ecog_bucket(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    return orders.select("k", clinical.ecog_bucket(F.expr(derived.VALUES["performance"])).alias("grade"))


@query
def gleason(spark, sf):
    """Score and grade group from two patterns and a result."""
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    first, second, result = (
        F.expr(derived.VALUES[n]) for n in ("gleason_primary", "gleason_secondary", "gleason_result")
    )
    score = clinical.gleason_score(first, second, result)
    group = clinical.gleason_grade_group(first, second, score)
    return orders.select(
        "k", score.alias("score"), group["text"].alias("text"), group["code"].alias("code"),
        number(group["ordinal"]).alias("ordinal"),
    )


@query
def ops_category(spark, sf):
    orders = table(spark, sf, "orders")
    code = F.concat((F.col("o_orderkey") % 10).cast("string"), F.lit("-604"))
    return orders.select("o_orderkey", clinical.ops_category(code)["code"].alias("category"))


def _reference_query(strategy):
    def run(spark, sf):
        patients = table(spark, sf, "customer").select(
            F.regexp_replace("c_name", "#", "_").alias("patient_id")
        )
        referred = PR.patient_reference(patients, CFG, strategy)
        return referred.select("patient_id", "patient_ref", "patient_identifier")

    return run


for _strategy in ("sha256", "md5", "dashes", "plain"):
    QUERIES[f"patient_ref_{_strategy}"] = _reference_query(_strategy)


@query
def patient_ref_lookup(spark, sf):
    """Record ids of suppliers' nations as lookup; customers elsewhere keep an identifier."""
    patients = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("patient_id")
    )
    lookup = table(spark, sf, "nation").filter(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").cast("string").alias("patient_id"), F.col("n_name").alias("record_id")
    )
    found = PR.patient_reference(patients, CFG, "record_id", lookup)
    return found.select(
        "c_custkey", "patient_ref", "patient_identifier",
        F.col("patient_exists").cast("int").alias("patient_exists"),
    )


@query
def patient_ref_existing(spark, sf):
    """Known patients by identifier; several matches are an error."""
    patients = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("patient_id")
    )
    known = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").cast("string").alias("identifier_value"),
        F.col("o_orderpriority").alias("id"),
    )
    found = PR.patient_reference(patients, CFG, "existing", known)
    return found.select("c_custkey", "patient_ref", "patient_ref_error")


@query
def pseudonymize(spark, sf):
    patients = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("patient_id"))
    table_ = table(spark, sf, "supplier").select(
        F.regexp_replace("s_name", "Supplier", "Customer").alias("original"),
        F.concat(F.lit("PSN-"), "s_suppkey").alias("pseudonym"),
    )
    return PR.pseudonymize(patients, table_)


@query
def pseudonymize_keyed(spark, sf):
    patients = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("patient_id"))
    return PR.pseudonymize(patients, key="key")


# ---- mapping jobs ------------------------------------------------------------------------------


@query
def map_patients(spark, sf):
    rows = R.map_patients(reports(spark, sf), CFG)
    return rows.select(
        "id", "identifier_value", "gender",
        F.col("birth_date.value").alias("birth_date"),
        F.col("deceased").cast("int").alias("deceased"),
        F.col("deceased_date.value").alias("deceased_date"),
        F.col("has_address").cast("int").alias("has_address"), "postal_code", "country",
    )


@query
def map_conditions(spark, sf):
    rows = R.map_conditions(reports(spark, sf), CFG)
    return rows.select(
        "id", "identifier_value", "report_id",
        F.col("rank_key.has_diagnosis").alias("has_diagnosis"),
        F.col("rank_key.priority").alias("priority"),
        F.col("incomplete").cast("int").alias("incomplete"),
        code_text("icd").alias("icd"), version_text("icd").alias("icd_version"),
        F.concat_ws(",", F.transform("morphology", lambda m: F.concat_ws("|", m["code"], m["version"], m["text"]))).alias("morphology"),
        F.concat_ws("|", F.col("topography.code"), F.col("topography.text")).alias("topography"),
        code_text("verification").alias("verification"),
        code_text("laterality").alias("laterality"),
        F.col("asserted_date.value").alias("asserted_date"),
        F.col("recorded_date.value").alias("recorded_date"),
        "evidence_list_id",
        F.concat_ws(",", "follows_condition_ids").alias("follows"),
    )


@query
def earlier_tumour_links(spark, sf):
    from oncolake.resources.conditions import earlier_tumour_links as links

    return links(R.map_conditions(reports(spark, sf, "Diagnose"), CFG))


@query
def map_earlier_tumours(spark, sf):
    rows = R.map_earlier_tumours(reports(spark, sf, "Diagnose"), CFG)
    return rows.select(
        "id", "identifier_value", "report_id", code_text("icd").alias("icd"), "code_text",
        F.col("asserted_date.value").alias("asserted_date"),
    )


@query
def map_evidence_lists(spark, sf):
    rows = R.map_evidence_lists(reports(spark, sf, "Diagnose"), CFG)
    return rows.select(
        "id", "identifier_value", "report_id", "status", "mode",
        F.size("entry_refs").cast("bigint").alias("entries"),
    )


def _observation_columns(*extra):
    return [
        "id", "identifier_value", "report_id", "source_section",
        code_text("code").alias("code"),
        F.col("effective.value").alias("effective"),
        *extra,
    ]


@query
def map_metastases(spark, sf):
    rows = R.map_metastases(reports(spark, sf, "Diagnose", "Verlauf", "Pathologie"), CFG)
    return rows.select(
        *_observation_columns("effective_absent", code_text("value_codings").alias("site"), "value_absent",
                              F.concat_ws(",", "focus_refs").alias("focus"))
    )


@query
def map_genetic_variants(spark, sf):
    rows = R.map_genetic_variants(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select(
        *_observation_columns(code_text("interpretation").alias("interpretation"), "interpretation_text", "note")
    )


@query
def map_performance_status(spark, sf):
    rows = R.map_performance_status(reports(spark, sf, "Diagnose", "Verlauf"), CFG)
    return rows.select(*_observation_columns(code_text("value_codings").alias("value")))


@query
def map_study_participation(spark, sf):
    rows = R.map_study_participation(reports(spark, sf, "Diagnose", "Verlauf", "SYST", "ST", "OP"), CFG)
    return rows.select(*_observation_columns(code_text("value_codings").alias("answer")))


def classification_map(spark, sf) -> DataFrame:
    """A code map with the regions as codes, for two classification names."""
    regions = table(spark, sf, "region")
    value = F.when(F.col("r_regionkey") == 0, F.lit("V0")).otherwise("")
    return regions.filter(F.col("r_regionkey") < 2).select(
        F.when(F.col("r_regionkey") == 0, "FIGO").otherwise("Ann Arbor").alias("name"),
        F.when(F.col("r_regionkey") == 0, "IIIB").otherwise("III").alias("stadium"),
        F.lit("urn:region").alias("code_system"), F.lit("1").alias("code_version"),
        F.col("r_name").alias("code_code"), F.lower("r_name").alias("code_display"),
        F.lit("urn:value").alias("value_system"), F.lit("1").alias("value_version"),
        value.alias("value_code"), F.lit("").alias("value_display"),
    )


@query
def map_classifications(spark, sf):
    rows = R.map_classifications(
        reports(spark, sf, "Diagnose", "Verlauf", "Pathologie"), CFG, classification_map(spark, sf)
    )
    return rows.select(
        *_observation_columns("code_text", code_text("value_codings").alias("value"), "value_text")
    )


@query
def map_specimens(spark, sf):
    rows = R.map_specimens(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select("id", "identifier_value", "report_id", "accession_no",
                       F.col("collected.value").alias("collected"))


@query
def map_grading(spark, sf):
    rows = R.map_grading(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select(
        *_observation_columns("effective_absent", code_text("value_codings").alias("grade"), "specimen_id")
    )


@query
def map_lymph_nodes(spark, sf):
    rows = R.map_lymph_nodes(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select(*_observation_columns(number(F.col("value_num")).alias("nodes"), "specimen_id"))


@query
def map_course_histology(spark, sf):
    rows = R.map_course_histology(reports(spark, sf, "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select(
        *_observation_columns(
            code_text("value_codings").alias("morphology"), version_text("value_codings").alias("version"),
            "value_text", "specimen_id",
        )
    )


@query
def map_pathology_reports(spark, sf):
    rows = R.map_pathology_reports(reports(spark, sf, "Pathologie"), CFG)
    return rows.select("id", "identifier_value", "report_id", "conclusion", "conclusion_absent", "specimen_id")


@query
def map_tnm(spark, sf):
    rows = R.map_tnm(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select(
        "kind",
        *_observation_columns(
            code_text("code_extension").alias("prefix"), code_text("value_codings").alias("value"),
            code_text("value_suffixes").alias("suffixes"), code_text("method").alias("method"),
            F.concat_ws(",", "member_ids").alias("members"),
        ),
    )


@query
def map_gleason(spark, sf):
    rows = R.map_gleason(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.select(
        "kind",
        *_observation_columns(
            code_text("value_codings").alias("value"), "value_text", code_text("method").alias("method"),
            number(F.try_element_at("value_codings", F.lit(1))["ordinal"]).alias("ordinal"),
            F.concat_ws(",", "derived_from_ids").alias("derived_from"),
        ),
    )


@query
def map_prostate_module(spark, sf):
    rows = R.map_prostate_module(reports(spark, sf, "Diagnose", "Verlauf", "OP", "Pathologie"), CFG)
    return rows.filter(~F.col("kind").startswith("gleason")).select(
        "kind",
        *_observation_columns(
            "value_kind", code_text("value_codings").alias("value"), number(F.col("value_num")).alias("number"),
            "value_unit_code", "value_absent", F.concat_ws(",", "focus_refs").alias("focus"),
        ),
    )


def _procedure_columns(*extra):
    return [
        "kind", "id", "identifier_value", "report_id", "status",
        code_text("category").alias("category"), code_text("code").alias("code"),
        code_text("intention").alias("intention"), code_text("outcome").alias("outcome"),
        "part_of_id", "reason_condition_id", *extra,
    ]


@query
def map_surgeries(spark, sf):
    rows = R.map_surgeries(reports(spark, sf, "OP"), CFG)
    return rows.select(
        *_procedure_columns(version_text("code").alias("version"), F.col("performed.value").alias("performed"),
                            "performed_absent")
    )


@query
def map_residual_status(spark, sf):
    rows = R.map_residual_status(reports(spark, sf, "OP"), CFG)
    return rows.select(*_observation_columns(code_text("value_codings").alias("value")))


@query
def map_radiotherapy(spark, sf):
    rows = R.map_radiotherapy(reports(spark, sf, "ST"), CFG)
    return rows.select(
        *_procedure_columns(
            "profile",
            F.col("period_start.value").alias("period_start"), "period_start_absent",
            F.col("period_end.value").alias("period_end"),
            code_text("position_to_surgery").alias("position"),
            code_text("used_code").alias("used_code"), code_text("method").alias("method"),
            code_text("body_site").alias("body_site"), code_text("body_site_side").alias("side"),
            number(F.col("single_dose.value")).alias("single_dose"),
            number(F.col("total_dose.value")).alias("total_dose"), code_text("boost").alias("boost"),
        )
    )


@query
def map_systemic_procedures(spark, sf):
    rows = R.map_systemic_procedures(reports(spark, sf, "SYST"), CFG)
    return rows.select(
        *_procedure_columns(
            F.col("period_start.value").alias("period_start"), "period_start_absent",
            F.col("period_end.value").alias("period_end"),
            code_text("position_to_surgery").alias("position"), "protocol",
        )
    )


def drug_map(spark, sf) -> DataFrame:
    """A drug map of two names, one of which the derived reports use."""
    regions = table(spark, sf, "region").filter(F.col("r_regionkey") < 2)
    first = F.col("r_regionkey") == 0
    return regions.select(
        F.when(first, "Bicalutamid").otherwise(F.col("r_name")).alias("name"),
        F.when(first, "L02BB03").otherwise("X").alias("atc_code"),
    )


@query
def map_medication_statements(spark, sf):
    rows = R.map_medication_statements(reports(spark, sf, "SYST"), CFG, drug_map(spark, sf))
    return rows.select(
        "id", "identifier_value", "report_id", "status", "medication_id", "medication_text", "code_absent",
        F.col("period_start.value").alias("period_start"), F.col("period_end.value").alias("period_end"),
        "part_of_id",
    )


@query
def map_medications(spark, sf):
    rows = R.map_medications(reports(spark, sf, "SYST"), CFG, drug_map(spark, sf))
    first = F.try_element_at("code", F.lit(1))
    return rows.select(
        "id", "identifier_value", "report_id", version_text("code").alias("version"),
        first["user_selected"].cast("int").alias("user_selected"), "text",
    )


@query
def map_adverse_events(spark, sf):
    rows = R.map_adverse_events(reports(spark, sf, "SYST", "ST"), CFG)
    return rows.select(
        "id", "identifier_value", "report_id", code_text("event").alias("event"), "event_text",
        "event_absent", code_text("grade").alias("grade"), "suspect_procedure_id",
    )


@query
def map_deaths(spark, sf):
    rows = R.map_deaths(reports(spark, sf, "Tod"), CFG)
    return rows.select(
        *_observation_columns(code_text("interpretation").alias("related"),
                              code_text("value_codings").alias("cause"), version_text("value_codings").alias("version"))
    )


@query
def map_tumour_boards(spark, sf):
    rows = R.map_tumour_boards(reports(spark, sf, "Tumorkonferenz"), CFG)
    return rows.select(
        "id", "identifier_value", "report_id", "status", code_text("category").alias("category"),
        "category_absent", F.col("created.value").alias("created"),
        F.concat_ws(",", F.transform("activities", lambda a: F.concat_ws("|", a["code"]["code"], a["status"], a["status_reason"]["code"]))).alias("activities"),
    )


@query
def map_progress(spark, sf):
    rows = R.map_progress(reports(spark, sf, "Verlauf"), CFG)
    return rows.select(
        *_observation_columns(
            code_text("value_codings").alias("overall"),
            F.concat_ws(",", F.transform("components", lambda c: F.concat_ws("|", c["code"]["code"], c["value"]["code"], c["value"]["display"]))).alias("components"),
        )
    )


def status_rows(spark, sf) -> DataFrame:
    """Patient status rows derived from orders: last information, death dates, blank rows."""
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        key.cast("string").alias("id"),
        F.when(key % 11 != 0, F.col("o_custkey").cast("string")).alias("patient_id"),
        F.when(key % 3 != 0, day).alias("last_information"),
        F.when(key % 4 == 0, F.date_add(day, 30)).alias("death_date"),
    )


@query
def map_vital_status(spark, sf):
    rows = R.map_vital_status(PR.patient_reference(status_rows(spark, sf), CFG), CFG)
    return rows.select(
        "id", "identifier_value", "patient_ref", F.col("effective.value").alias("effective"),
        code_text("value_codings").alias("value"),
    )


@query
def map_status_deaths(spark, sf):
    rows = R.map_status_deaths(PR.patient_reference(status_rows(spark, sf), CFG), CFG)
    return rows.select("id", "identifier_value", F.col("effective.value").alias("effective"))


# ---- sections, bundles, provenance -------------------------------------------------------------


@query
def patient_policy(spark, sf):
    """Known patients are not written again and lend their id to the bundle."""
    from dataclasses import replace

    patients = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("patient_id"))
    lookup = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("patient_id"), F.col("s_name").alias("record_id")
    )
    cfg = replace(CFG, create_patient_if_exists=True)
    decided = RP.patient_policy(PR.patient_reference(patients, cfg, "record_id", lookup), cfg)
    return decided.select("patient_id", F.col("write_patient").cast("int").alias("write_patient"), "bundle_id")


def _section_counts(mapper, *kinds):
    def run(spark, sf):
        maps = {"drug_map": drug_map(spark, sf), "classification_map": classification_map(spark, sf)}
        staged = stage_table(reports(spark, sf, *kinds), "reports")
        rows = mapper(staged, CFG, **maps)
        return rows.groupBy("resource_type").agg(
            F.count(F.lit(1)).alias("resources"), F.count_distinct("full_url").alias("urls")
        )

    return run


QUERIES["section_diagnosis"] = _section_counts(P.map_diagnosis_section, "Diagnose")
QUERIES["section_pathology"] = _section_counts(P.map_pathology_section, "Pathologie")
QUERIES["section_progress"] = _section_counts(P.map_progress_section, "Verlauf")
QUERIES["section_systemic"] = _section_counts(P.map_systemic_section, "SYST")
QUERIES["section_radiotherapy"] = _section_counts(P.map_radiotherapy_section, "ST")
QUERIES["section_surgery"] = _section_counts(P.map_surgery_section, "OP")
QUERIES["section_death"] = _section_counts(P.map_death_section, "Tod")
QUERIES["section_board"] = _section_counts(P.map_board_section, "Tumorkonferenz")


@query
def upsert_entries(spark, sf):
    """Per user and event type the last value at the position of the first event."""
    events = table(spark, sf, "events")
    merged = B.upsert_entries(events, ["user_id", "event_type"], ["event_id"])
    return merged.select("user_id", "event_type", "event_id", "value", F.col("entry_pos.event_id").alias("first_pos"))


@query
def duplicate_conflicts(spark, sf):
    """Users and event types with differing values."""
    events = table(spark, sf, "events")
    return B.duplicate_conflicts(
        events, ["user_id", "event_type"], F.col("value").cast("string"), F.col("event_type") == "error"
    )


@query
def bundle_json(spark, sf):
    """Per customer a transaction bundle of its orders, text as is."""
    orders = table(spark, sf, "orders")
    entries = orders.select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.struct("o_orderdate", "o_orderkey").alias("entry_pos"),
        F.concat(F.lit("Order/"), "o_orderkey").alias("full_url"),
        F.to_json(F.struct(F.col("o_orderstatus").alias("status"))).alias("resource_json"),
    )
    built = B.build_bundles(entries)
    return built.select("patient_id", "part", F.col("entries").cast("bigint").alias("entries"), "bundle_json")


@query
def bundle_parts(spark, sf):
    """The same orders in parts of at most four, which a caller may ask for; order runs on across parts."""
    orders = table(spark, sf, "orders")
    entries = orders.select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.struct("o_orderdate", "o_orderkey").alias("entry_pos"),
        F.concat(F.lit("Order/"), "o_orderkey").alias("full_url"),
        F.lit("{}").alias("resource_json"),
    )
    built = B.build_bundles(entries, max_entries=4)
    urls = F.regexp_extract_all("bundle_json", F.lit('"fullUrl":"([^"]*)"'), F.lit(1))
    return built.select(
        "patient_id", "part", F.concat_ws(",", urls).alias("urls"),
        (F.get_json_object("bundle_json", "$.id") == F.col("bundle_id")).cast("int").alias("own_id"),
        (F.col("bundle_id") == F.col("patient_id")).cast("int").alias("plain_id"),
    )


@query
def stamp_source(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_json(
            F.struct(
                F.col("o_orderkey").cast("string").alias("id"),
                F.when(
                    F.col("o_orderstatus") != "P",
                    F.struct(F.when(F.col("o_orderstatus") != "O", F.array("o_orderstatus")).alias("profile")),
                ).alias("meta"),
            )
        ).alias("resource_json"),
    )
    return B.stamp_source(orders, "urn:registry")


@query
def provenance_targets(spark, sf):
    """Provenance of board reports: the condition and the care plan of each, in order."""
    rows = reports(spark, sf, "Tumorkonferenz")
    envelopes = to_envelope(R.map_conditions(rows, CFG), "Condition", CFG).unionByName(
        to_envelope(R.map_tumour_boards(rows, CFG), "CarePlan", CFG)
    )
    single = K.pick_by_key(
        envelopes, ["patient_id", "tumor_id", "report_id", "full_url"], ["emit_seq", "rank_key"]
    )
    made = B.add_provenance(single, CFG, F.lit("2000-01-01").cast("timestamp"))
    return made.select(
        "id", "identifier_value", "report_id", F.concat_ws(",", "target_refs").alias("targets"), "agent_device"
    )


@query
def deidentify(spark, sf):
    """Board care plans with hashed ids, references and identifiers."""
    rows = R.map_tumour_boards(reports(spark, sf, "Tumorkonferenz"), CFG)
    hidden = D.deidentify(to_envelope(rows, "CarePlan", CFG), "secret key")
    body = F.col("resource_json")
    return hidden.select(
        "id", "full_url", "identifier_value", "subject_ref",
        F.get_json_object(body, "$.id").alias("body_id"),
        F.get_json_object(body, "$.identifier[0].value").alias("body_identifier"),
        F.get_json_object(body, "$.subject.reference").alias("body_subject"),
        F.get_json_object(body, "$.addresses[0].reference").alias("body_condition"),
        F.get_json_object(body, "$.status").alias("status"),
    )


@query
def bundles_pipeline(spark, sf):
    """XML texts to bundles: entries and parts per patient and tumour."""
    bundles, _ = P.reports_to_bundles(
        derived.derived_xml(spark, sf), CFG, drug_map=drug_map(spark, sf),
        classification_map=classification_map(spark, sf),
    )
    return bundles.select("patient_id", "tumor_id", "part", "entries", "bundle_key")


@query
def bundle_files(spark, sf):
    """Orders as a bundle file per priority and customer, written to a folder and read back from it."""
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("orders/"), "o_orderpriority", F.lit(".xml")).alias("source"),
        F.col("o_custkey").cast("string").alias("bundle"), F.col("o_orderkey").alias("entry_pos"),
        F.concat(F.lit("Order/"), "o_orderkey").alias("full_url"),
        F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus")).alias("resource_json"),
    )
    folder = _work_folder(spark, "files")
    grouped_files.write_bundle_files(orders, folder, F.col("bundle"), F.col("source"))
    # Written once more, as a table: to count files and entries, each file would be opened twice.
    back = stage_table(grouped_files.read_grouped_files(spark, folder), "files")
    entry = resources.bundle_resources(back)
    sizes = entry.groupBy("bundle_id").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(F.get_json_object("resource_json", "$.id").cast("long")).alias("ids"),
    )
    files = back.groupBy(F.get_json_object("value", "$.id").alias("bundle_id")).agg(F.count(F.lit(1)).alias("files"))
    return files.join(sizes, "bundle_id").select("bundle_id", "files", "entries", "ids")


HIDDEN = DR.Deidentifier("secret key", DR.STRICT)


@query
def deidentified_bundles(spark, sf):
    """XML texts of all sections to bundles without identifiers of the source."""
    bundles, _ = P.reports_to_bundles(
        derived.derived_xml(spark, sf), CFG, drug_map=drug_map(spark, sf),
        classification_map=classification_map(spark, sf), hide=HIDDEN,
    )
    body = F.col("bundle_json")
    return bundles.select(
        "patient_id", "tumor_id", "entries", "bundle_key", "bundle_id",
        (F.get_json_object(body, "$.id") == F.col("bundle_id")).cast("int").alias("same_id"),
        # Texts of the source: report ids, reports' texts, patients' addresses.
        F.regexp_like(body, F.lit(r"conclusion|\"address\"|_[0-7]/|Customer#")).cast("int").alias("leaks"),
    )


# ---- quality -----------------------------------------------------------------------------------


@query
def outer_join_view(spark, sf):
    """All orders and customers, full outer; a seventh of the customers is named by none, and their orders name nobody."""
    key = F.col("o_custkey")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("Patient/"), F.when(key % 7 == 0, -key).otherwise(key)).alias("subject_reference"),
    )
    patients = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"), "c_mktsegment"
    )
    return V.with_patients(orders, patients, "subject_reference")


@query
def left_inner_view(spark, sf):
    """Parts with their lines if any, then their supplier."""
    from oncolake.operators.staging import left_join_hot_right

    parts = table(spark, sf, "part").select("p_partkey", "p_size")
    lines = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_partkey", "l_quantity"
    )
    joined = left_join_hot_right(
        parts, lines, parts["p_partkey"] == lines["l_partkey"], parts["p_partkey"], lines["l_partkey"]
    )
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), "p_brand")
    return joined.join(brands, F.col("p_partkey") == F.col("key"), "inner").groupBy("p_partkey", "p_brand").agg(
        F.count("l_orderkey").alias("lines"), F.sum("l_quantity").alias("quantity")
    )


@query
def inner_view(spark, sf):
    """Lines with their suppliers, by the join of the views."""
    lines = table(spark, sf, "lineitem").select(F.concat(F.lit("Patient/"), "l_suppkey").alias("subject_reference"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("patient_id"), "s_name")
    joined = V.with_patients(lines, suppliers, "subject_reference", how="inner")
    return joined.groupBy("s_name").agg(F.count(F.lit(1)).alias("lines"))


@query
def distinct_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    names = ("l_returnflag", "l_linestatus", "l_linenumber")
    return V.extract_view(lines, {name: F.col(name) for name in names})


@query
def duplicate_ids(spark, sf):
    return V.duplicate_ids(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey")


@query
def null_by_group(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return V.null_counts(joined, "quality", "source")


@query
def distinct_dates(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("subject_reference"), F.year("o_orderdate").alias("effective_date_time")
    )
    return V.death_dates(orders)


@query
def several_death_dates(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("subject_reference"), F.col("o_orderdate").alias("effective_date_time")
    )
    return V.several_death_dates(V.death_dates(orders))


@query
def column_summary(spark, sf):
    """A text column and a number column."""
    customers = table(spark, sf, "customer")
    text = V.column_summary(customers, "c_name").select(F.lit("c_name").alias("column"), "*")
    key = V.column_summary(customers, "c_custkey").select(
        F.lit("c_custkey").alias("column"), "count",
        F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
        F.col("min").cast("string").alias("min"), F.col("max").cast("string").alias("max"),
    )
    return text.unionAll(key)


def _checks():
    col = F.col
    return [
        E.expect_between("total between", "o_totalprice", 1000.0, 400000.0),
        E.expect_pair("key above customer", "o_orderkey", "o_custkey"),
        E.expect_not_null("status given", "status"),
        E.expect_null("no status when pending", "status", col("o_orderstatus") == "P"),
        E.expect_in_set("priority listed", "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"]),
        E.expect_not_in_set("not low", "o_orderpriority", ["5-LOW"], col("o_orderstatus") == "F"),
        E.expect_not_regex("no digit four", "key_text", r"4.*4"),
        E.expect_unique("customer once", "o_custkey", where=col("o_orderstatus") == "O"),
        E.expect_unique("customer and priority once", "o_custkey", "status"),
    ]


def _checked_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "*",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderkey").cast("string").alias("key_text"),
    )


@query
def expectations_orders(spark, sf):
    """One row per kind of expectation, all row rules in one pass."""
    result = E.run_suite(_checked_orders(spark, sf), "orders", _checks())
    return result.select("suite", "expectation", "evaluated", "unexpected", "unexpected_pct",
                         F.col("success").cast("int").alias("success"))


def _failing(index):
    def run(spark, sf):
        return E.failing_rows(_checked_orders(spark, sf), _checks()[index]).select("o_orderkey")

    return run


QUERIES["failing_between"] = _failing(0)
QUERIES["failing_regex"] = _failing(6)
QUERIES["failing_unique"] = _failing(7)


def _tables(spark, sf, *types, jobs=None):
    """Typed tables of the resources that all sections of all reports give rise to."""
    needed = P.needed_reports(reports(spark, sf), types, jobs)
    rows = P.stage_reports(needed, CFG)
    return P.map_all(rows, CFG, drug_map(spark, sf), classification_map(spark, sf), types=types, observation_jobs=jobs)


_RESULT = ["suite", "expectation", "evaluated", "unexpected"]


def _suite_query(suite, jobs=None):
    """One suite. ``jobs`` are all that yield rows its view does not filter out by their profile."""

    def run(spark, sf):
        types = [V.BASE_TABLES[name] for name in V.NEEDS[suite]]
        return Q.quality_run(_tables(spark, sf, *types, jobs=jobs), AS_OF, CFG, [suite]).select(*_RESULT)

    return run


QUERIES["suite_conditions"] = _suite_query("conditions")
QUERIES["suite_procedures"] = _suite_query("procedures")
QUERIES["suite_medication_statements"] = _suite_query("medication_statements")
QUERIES["suite_condition_procedure"] = _suite_query("condition_procedure")
QUERIES["suite_observations"] = _suite_query("observations")
QUERIES["suite_metastases"] = _suite_query("metastases", ("metastases",))
QUERIES["suite_performance_death"] = _suite_query("performance_death", ("performance_status", "deaths"))
QUERIES["suite_death_completeness"] = _suite_query("death_completeness", ("deaths",))
QUERIES["suite_death_dates"] = _suite_query("death_dates", ("deaths",))


@query
def quality_run(spark, sf):
    """All nine suites over the resources of all sections, each base view and the shared join staged once."""
    return Q.quality_run(_tables(spark, sf, *V.BASE_TABLES.values()), AS_OF, CFG).select(*_RESULT)


@query
def row_counts(spark, sf):
    """Rows read and rows extracted: lines by order and supplier, orders by customer and status."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    views = {
        "lines": V.extract_view(lines, {c: F.col(c) for c in ("l_orderkey", "l_suppkey")}),
        "orders": V.extract_view(orders, {c: F.col(c) for c in ("o_custkey", "o_orderstatus")}),
    }
    return V.row_counts({"Line": lines, "Order": orders}, views, {"Line": "lines", "Order": "orders"})


@query
def bundles_to_views(spark, sf):
    """Bundles of death reports as JSON text, read back into observation rows."""
    rows = stage_table(K.retain_latest_version(reports(spark, sf, "Tod")), "reports")
    envelopes = P.to_envelopes(
        {"Patient": R.map_patients(rows, CFG), "Condition": R.map_conditions(rows, CFG),
         "Observation": R.map_deaths(rows, CFG)}, CFG,
    )
    built = B.build_bundles(stage_table(B.upsert_entries(envelopes), "entries"))
    back = resources.bundle_resources(built.withColumnRenamed("bundle_json", "value"))
    deaths = resources.resource_table(back, "Observation")
    value = F.col("valueCodeableConcept.coding")
    return deaths.select(
        "id", F.col("subject.reference").alias("subject"), F.col("effectiveDateTime").alias("effective"),
        F.concat_ws(",", F.transform(value, lambda c: c["code"])).alias("cause"),
    )


@query
def views_by_path(spark, sf):
    """Bundles of all sections as JSON text, read back through path tables over an inferred schema.

    Per view its number of resources, and the rows in which it differs from the view of the typed tables.
    """
    rows = stage_table(K.retain_latest_version(reports(spark, sf)), "reports", ["sections"])
    tables = P.map_all(rows, CFG, drug_map(spark, sf), classification_map(spark, sf), types=tuple(V.BASE_TABLES.values()))
    tables = {kind: stage_table(rows_, "resources") for kind, rows_ in tables.items()}
    drop_staged(rows)
    # Hashed ids are only compared, so they stay packed. What a step has read is deleted before the next one.
    typed = {name: stage_table(view, name) for name, view in V.views_from_tables(tables, CFG, keep_packed=True).items()}
    envelopes = P.to_envelopes(tables, CFG).withColumn("entry_pos", F.struct("rank_key", "emit_seq", "report_id"))
    built = stage_table(B.build_bundles(envelopes).select(F.col("bundle_json").alias("value")), "bundles")
    drop_staged(*tables.values())
    with few_rows_at_once(spark):
        decoded = stage_table(resources.bundle_resources(built), "decoded", ["resource_type"])
    drop_staged(built)
    results = []
    for name, columns in V.base_paths(CFG).items():
        found = X.view_of_resources(decoded, V.BASE_TABLES[name], columns, change=V.pack_ids)
        both = found.withColumn("side", F.lit(1)).unionByName(typed[name].withColumn("side", F.lit(-1)))
        compared = both.groupBy(*columns).agg(F.sum("side").alias("side"))
        result = compared.agg(
            F.count_distinct(next(iter(columns))).alias("resources"), F.count_if(F.col("side") != 0).alias("differing")
        ).select(F.lit(name).alias("view"), "resources", "differing")
        results.append(stage_table(result, "compared"))
        drop_staged(typed[name])
    drop_staged(decoded)
    return reduce(DataFrame.unionAll, results)


# ---- streaming ---------------------------------------------------------------------------------


def _stream(spark, sf, name, schema=None) -> DataFrame:
    """One driver table as a stream of files."""
    schema = schema or table(spark, sf, name).schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(sf)
    )


def _work_folder(spark, name) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _run(writer, checkpoint):
    query_ = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query_.awaitTermination()


@query
def stream_latest(spark, sf):
    """Newest event per user as a stream in update mode; final state read back."""
    folder = _work_folder(spark, "latest")
    events = _stream(spark, sf, "events")
    newest = report_set.latest_by_key_stream(
        events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error"
    )

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    _run(newest.writeStream.outputMode("update").foreachBatch(write), f"{folder}/checkpoint")
    out = spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out")
    last = K.latest_by_key(out, ["user_id"], ["batch"], F.col("deleted"))
    return last.select("user_id", "event_id", "event_type", "value")


@query
def stream_report_set(spark, sf):
    """Orders as report versions through the stateful report set, touched customers published."""
    folder = _work_folder(spark, "reports")
    orders = _stream(spark, sf, "orders")
    changes = orders.select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("o_orderpriority").alias("report_id"),
        F.month("o_orderdate").alias("version"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("export_id"),
        F.col("o_orderstatus").alias("payload"),
        F.lit(False).alias("retract"),
    )

    def publish(current, batch_id):
        current.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    writer = report_set.emit_updates(
        report_set.maintain_report_set(changes), f"{folder}/changelog", publish, buckets=4
    )
    _run(writer, f"{folder}/checkpoint")
    out = spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out")
    last = K.latest_by_key(out, ["patient_id", "report_id"], ["batch"])
    return last.select("patient_id", "report_id", "version", "export_id", "payload")


@query
def stream_vital_status(spark, sf):
    """Patient status rows as a stream, appended as envelopes and read back."""
    folder = _work_folder(spark, "vital")
    orders = _stream(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    status = orders.select(
        key.cast("string").alias("id"),
        F.when(key % 11 != 0, F.col("o_custkey").cast("string")).alias("patient_id"),
        F.when(key % 3 != 0, day).alias("last_information"),
        F.when(key % 4 == 0, F.date_add(day, 30)).alias("death_date"),
    )
    envelopes = vital_status.vital_status_stream(status, CFG)
    writer = vital_status.write_vital_status(envelopes, f"{folder}/out", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out.select(
        "key", "full_url",
        F.get_json_object("resource_json", "$.effectiveDateTime").alias("effective"),
        F.get_json_object("resource_json", "$.valueCodeableConcept.coding[0].code").alias("value"),
    )


@query
def changelog_diff(spark, sf):
    """Orders changed by their newer halves: old rows out, new rows in."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    previous = orders.filter(F.col("o_orderkey") % 3 != 0)
    batch = orders.filter(F.col("o_orderkey") % 2 == 0).select(
        "o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), "o_orderstatus",
        (F.col("o_orderstatus") == "P").alias("deleted"),
    )
    diff = report_set.changelog_diff(previous, batch, "o_orderkey")
    return diff.select("o_orderkey", "o_custkey", F.col("retract").cast("int").alias("retract"))


@query
def schema_check(spark, sf):
    """Orders as report texts checked against a schema: pending ones have no date, urgent ones are cut off."""
    folder = _work_folder(spark, "schema")
    schema = (
        '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="oBDS"><xs:complexType><xs:sequence>'
        '<xs:element name="Meldedatum" type="xs:date"/><xs:element name="Menge_Patient"/></xs:sequence>'
        '<xs:attribute name="Schema_Version" use="required"/></xs:complexType></xs:element></xs:schema>'
    )
    spark.range(1).select(F.lit(schema)).coalesce(1).write.text(folder)
    day = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    text = F.concat(F.lit('<oBDS Schema_Version="3.0.2"><Meldedatum>'), day, F.lit("</Meldedatum><Menge_Patient/></oBDS>"))
    cut = F.when(F.col("o_orderpriority") == "1-URGENT", F.substring(text, 1, 60)).otherwise(text)
    orders = table(spark, sf, "orders").select("o_orderkey", cut.alias("xml"))
    parsed = SR.parse_reports(orders, schema_path=spark.read.text(folder).inputFiles()[0])
    return parsed.select("o_orderkey", "parse_error")


@query
def sorted_table_upsert(spark, sf):
    """Orders as a sorted table, then orders with returned lines replaced and their suppliers added."""
    folder = _work_folder(spark, "sorted")
    orders = table(spark, sf, "orders").select(
        F.lit("Order").alias("resource_type"), F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("long").alias("value"),
    )
    sorted_tables.write_sorted_table(orders, folder, files=8)
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    changes = [
        returned.groupBy(F.lit(kind).alias("resource_type"), F.col(key).cast("string").alias("id")).agg(
            F.count(F.lit(1)).alias("value")
        )
        for kind, key in (("Order", "l_orderkey"), ("Supplier", "l_suppkey"))
    ]
    sorted_tables.upsert_sorted_table(changes[0].unionByName(changes[1]), folder, files=8)
    return sorted_tables.read_sorted_table(spark, folder)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnoses per code and year with their patients, from XML texts to joined tables.

    Male-only check of prostate cancer included, as the quality job does it.
    """
    good, _ = P.prepare_documents(derived.derived_xml(spark, sf_dir), CFG)
    latest = K.retain_latest_version(P.needed_reports(good, ("Patient", "Condition")), row="row_id")
    conditions = R.map_conditions(latest, CFG)
    patients = R.map_patients(latest, CFG).select(F.col("id").alias("patient"), "gender")
    joined = conditions.join(
        patients, F.substring_index("patient_ref", "/", -1) == F.col("patient"), "inner"
    )
    icd = F.try_element_at("icd", F.lit(1))["code"]
    year = F.substring(F.col("recorded_date.value"), 1, 4)
    return joined.groupBy(icd.alias("icd"), year.alias("year")).agg(
        F.count(F.lit(1)).alias("diagnoses"),
        F.count_distinct("patient").alias("patients"),
        F.count(F.when((icd == "C61") & (F.col("gender") != "male"), 1)).alias("not_male"),
    )


QUERIES["diagnoses_per_year"] = flagship
__all__ = ["QUERIES", "flagship"]
