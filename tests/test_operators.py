import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oncolake.operators import bundles, consolidate, deidentify, patient_reference, staging
from oncolake.operators.bundles import stamp_source
from oncolake.operators.consolidate import retain_latest_version
from oncolake.operators.reports import normalize_patient_id
from oncolake.queries import _CURRENT, _RULED, reports


def hot_rows(spark, n=600):
    """One key holds a third of all rows."""
    rng = random.Random(7)
    rows = [(0 if i % 3 == 0 else rng.randrange(1, 40), rng.randrange(50), i) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, v int, i int").repartition(5), rows


def test_rank_in_groups_matches_brute_force(spark):
    df, rows = hot_rows(spark)
    got = {r["i"]: r["rank"] for r in staging.rank_in_groups(df, ["k"], ["v", "i"]).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        for n, row in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]), 1):
            want[row[2]] = n
    assert got == want


def test_parts_are_consecutive_and_only_made_when_asked_for(spark):
    df, rows = hot_rows(spark)
    assert {r["part"] for r in staging.number_parts(df, ["k"], ["i"], None).collect()} == {0}
    got = {r["i"]: r["part"] for r in staging.number_parts(df, ["k"], ["i"], 30).collect()}
    for key in {r[0] for r in rows}:
        for n, i in enumerate(sorted(r[2] for r in rows if r[0] == key)):
            assert got[i] == n // 30


def test_bundle_parts_keep_order_and_have_ids_of_their_own(spark):
    import json

    df, rows = hot_rows(spark)
    entries = df.select(
        F.col("k").cast("string").alias("patient_id"), F.col("i").alias("entry_pos"),
        F.concat(F.lit("A/"), "i").alias("full_url"), F.lit("{}").alias("resource_json"),
    )
    whole = {r["patient_id"]: r for r in bundles.build_bundles(entries).collect()}
    cut = bundles.build_bundles(entries, max_entries=50).collect()
    assert len({r["bundle_id"] for r in cut}) == len(cut) > len(whole)
    urls = lambda r: [e["fullUrl"] for e in json.loads(r["bundle_json"])["entry"]]
    for key, row in whole.items():
        parts = sorted((r for r in cut if r["patient_id"] == key), key=lambda r: r["part"])
        assert [u for part in parts for u in urls(part)] == urls(row)
        assert parts[0]["bundle_id"] == row["bundle_id"] == key
        assert all(json.loads(p["bundle_json"])["id"] == p["bundle_id"] for p in parts)


def test_merged_parts_hold_every_item(spark):
    df, rows = hot_rows(spark)
    merged = consolidate.merge_report_group(
        df, ["k"], F.col("i"), ["v", "i"], {"last": F.col("i")}, ["v", "i"], max_rows=50
    ).collect()
    for key in {r[0] for r in rows}:
        parts = sorted((r for r in merged if r["k"] == key), key=lambda r: r["part"])
        want = [r[2] for r in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:])]
        assert [i for part in parts for i in part["items"]] == want
    newest = max((r[1:] for r in rows if r[0] == 0))[1]
    assert {r["last"] for r in merged if r["k"] == 0} == {newest}


def test_outer_joins_equal_plain_ones(spark):
    many, _ = hot_rows(spark)
    one = spark.createDataFrame([(k, f"n{k}") for k in range(0, 60, 2)], "key int, name string")
    got = staging.full_join_hot_left(many, one, many["k"] == one["key"], many["k"], one["key"])
    want = many.join(one, many["k"] == one["key"], "full_outer")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    got = staging.left_join_hot_right(one, many, one["key"] == many["k"], one["key"], many["k"])
    want = one.join(many, one["key"] == many["k"], "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.booleans()), min_size=1, max_size=20))
def test_latest_by_key_ignores_arrival_order(spark, changes):
    rows = [(k, v, i, dead) for i, (k, v, dead) in enumerate(changes)]
    want = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        want[row[0]] = row
    want = sorted(r for r in want.values() if not r[3])
    shuffled = random.Random(1).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "k int, v int, i int, dead boolean")
    got = consolidate.latest_by_key(df, ["k"], ["v", "i"], F.col("dead")).collect()
    assert sorted(map(tuple, got)) == want


def test_prefer_by_reason(spark):
    rows = [(1, "behandlungsbeginn", "a"), (1, "behandlungsende", "b"), (2, "other", "d"), (2, None, "c")]
    df = spark.createDataFrame(rows, "id int, reason string, report string")
    got = consolidate.prefer_by_reason(
        df, ["id"], F.col("reason"), "behandlungsende", "behandlungsbeginn", ["report"]
    ).collect()
    assert {r["id"]: r["report"] for r in got} == {1: "b", 2: "c"}


def test_upsert_keeps_first_position_and_last_content(spark):
    rows = [("p", "A/1", 1, "x"), ("p", "B/1", 2, "y"), ("p", "A/1", 3, "z")]
    df = spark.createDataFrame(rows, "patient_id string, full_url string, n int, resource_json string")
    got = {r["full_url"]: r for r in bundles.upsert_entries(df, order=["n"]).collect()}
    assert (got["A/1"]["resource_json"], got["A/1"]["entry_pos"]["n"]) == ("z", 1)
    conflicts = bundles.duplicate_conflicts(df).collect()
    assert [(r["full_url"], r["copies"], r["versions"]) for r in conflicts] == [("A/1", 2, 2)]


def test_patient_ids(spark):
    df = spark.createDataFrame([(" 0012 ",), ("x",), (None,)], "source_patient_id string")
    rows = normalize_patient_id(df, r"0*([1-9]\d*)").collect()
    assert [r["patient_id"] for r in rows] == ["12", None, None]
    assert [r["patient_id_error"] is None for r in rows] == [True, False, False]


def test_existing_patient_lookup(spark):
    patients = spark.createDataFrame([("1",), ("2",), ("3",)], "patient_id string")
    known = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c")], "identifier_value string, id string")
    rows = patient_reference.patient_reference(patients, strategy="existing", lookup=known).collect()
    got = {r["patient_id"]: (r["patient_ref"], r["patient_ref_error"] is None) for r in rows}
    assert got == {"1": ("Patient/a", True), "2": (None, False), "3": (None, True)}


def test_deidentify_hashes_every_identifier_and_drops_conclusions(spark):
    import json

    body = {
        "resourceType": "DiagnosticReport",
        "id": "a",
        "identifier": [{"system": "urn:any", "value": "secret \"1\""}],
        "accessionIdentifier": {"value": "E-1"},
        "subject": {"reference": "Patient/p", "identifier": {"system": "urn:p", "value": "77"}},
        "conclusion": "text with \"quotes\" and 77",
        "status": "final",
    }
    row = ("77", "T", "r", "DiagnosticReport", "a", "DiagnosticReport/a", "x", "Patient/p", json.dumps(body, separators=(",", ":")))
    schema = (
        "patient_id string, tumor_id string, report_id string, resource_type string, id string, "
        "full_url string, identifier_value string, subject_ref string, resource_json string"
    )
    (hidden,) = deidentify.deidentify(spark.createDataFrame([row], schema), "key").collect()
    made = json.loads(hidden["resource_json"])
    assert "conclusion" not in made and made["status"] == "final" and made["id"] == hidden["id"]
    assert made["subject"]["reference"] == hidden["subject_ref"] != "Patient/p"
    assert made["subject"]["identifier"]["value"] == hidden["patient_id"]
    hashed = [made["identifier"][0]["value"], made["accessionIdentifier"]["value"]]
    assert all(len(v) == 64 for v in hashed) and made["identifier"][0]["system"] == "urn:any"


def test_every_resource_is_stamped_as_valid_json(spark):
    import json

    bodies = ['{}', '{"id":"1"}', '{"id":"1","meta":{}}', '{"id":"1","meta":{"profile":["p"]},"x":2}']
    df = spark.createDataFrame([(b,) for b in bodies], "resource_json string")
    for row in stamp_source(df, 'urn:"x').collect():
        assert json.loads(row[0])["meta"]["source"] == 'urn:"x'


def test_rows_without_id_stay(spark):
    rows = [("p", None, 1, "a"), ("p", None, 2, "b"), ("p", "r", 1, "c"), ("p", "r", 2, "d")]
    df = spark.createDataFrame(rows, "patient_id string, report_id string, version int, export_id string")
    assert {r["export_id"] for r in retain_latest_version(df).collect()} == {"a", "b", "d"}


def test_late_fetch_equals_whole_rows(spark):
    """Winners on narrow rows give what aggregates over whole rows give, without sorting a body."""
    from oncolake.operators.staging import stage_table
    from oncolake.plans import derived
    from oncolake.queries import reports

    rows = reports(spark, "/root/testdata/sf0.001")
    odd = rows.limit(30).withColumn("report_id", F.lit(None).cast("string")).withColumn("export_id", F.concat(F.lit("x"), "export_id"))
    staged = stage_table(rows.unionByName(odd).withColumn("row_id", F.monotonically_increasing_id()), "reports")
    K = consolidate  # noqa: N806
    whole = consolidate.consolidate_reports(consolidate.retain_latest_version(staged))
    for late in (
        K.current_reports(staged),
        consolidate.consolidate_reports(consolidate.retain_latest_version(staged, row="row_id"), row="row_id"),
    ):
        names = ["row_id", "section", "section_rank"]
        assert sorted(map(tuple, late.select(names).collect())) == sorted(map(tuple, whole.select(names).collect()))
        assert set(late.columns) == set(whole.columns)
    plan = K.current_reports(staged).select("row_id", "report")._jdf.queryExecution().executedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate(" in line]
    assert aggregates and not any("report#" in line for line in aggregates)
    assert derived._spread(spark.range(1000).withColumnRenamed("id", "o_orderkey"), 6).withColumn(
        "p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).first()[0] < 2 * 1000 / 6


def test_rules_need_no_more_of_a_report_than_their_members(spark):
    rows = reports(spark, "/root/testdata/sf0.001").select(*_RULED, "report")
    slim = rows.withColumn("report", consolidate.rule_members())
    sections = slim.schema["report"].dataType
    assert sections["Diagnose"].dataType.names == ["given"] and sections["SYST"].dataType.names == ["_SYST_ID", "Meldeanlass"]
    steps = [consolidate.consolidate_reports(consolidate.retain_latest_version(x)).select(*_CURRENT).collect() for x in (rows, slim)]
    assert sorted(map(str, steps[0])) == sorted(map(str, steps[1])) and steps[0]


def test_few_wide_rows_are_read_at_once_and_the_setting_comes_back(spark):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    try:
        with staging.few_rows_at_once(spark, 7):
            assert spark.conf.get(name) == "7"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(name) == before
