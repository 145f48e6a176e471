from dataclasses import replace

from pyspark.sql import functions as F

from oncolake import resources as R
from oncolake.functions import ids
from oncolake.operators.staging import small_scans
from oncolake.plans import derived
from oncolake.plans import pipeline as P
from oncolake.quality import expectations as E
from oncolake.quality import suites as Q
from oncolake.quality import views as V
from oncolake.queries import CFG, reports
from oncolake.schemas import SECTIONS


def test_suite_counts_nulls_and_conditions(spark):
    df = spark.createDataFrame(
        [("1899-01-01", "a", 1), ("2000", None, 1), (None, "b", 2)], "d string, s string, k int"
    )
    rules = [
        E.expect_between("range", "d", "1900-01-01", "2024-12-31"),
        E.expect_not_null("given", "s", F.col("k") == 1),
        E.expect_unique("once", "k"),
        E.expect_in_set("listed", "s", ["a"]),
    ]
    got = {r["expectation"]: (r["evaluated"], r["unexpected"], r["success"]) for r in E.run_suite(df, "s", rules).collect()}
    assert got == {"range": (2, 1, False), "given": (2, 1, False), "once": (3, 2, False), "listed": (2, 1, False)}
    assert E.failing_rows(df, rules[2]).count() == 2


def test_empty_input_is_a_success(spark):
    df = spark.createDataFrame([], "k int")
    row = E.run_suite(df, "s", [E.expect_not_null("given", "k"), E.expect_unique("once", "k")]).collect()
    assert all(r["success"] and r["evaluated"] == 0 for r in row)


def test_weighted_pairs_equal_the_plain_join(spark):
    rows = [("Patient/1", "5", "ecog", "x")] * 3 + [("Patient/1", None, None, "P/mii-pr-onko-tod")] * 2
    rows += [("Patient/2", "5", "ecog", "x"), ("Patient/3", None, None, "P/mii-pr-onko-tod")]
    schema = "subject_reference string, value_codeable_concept_coding_code string, value_codeable_concept_coding_system string, meta_profile string"
    df = spark.createDataFrame(rows, schema)

    class Config:
        @staticmethod
        def profile(name):
            return f"P/mii-pr-onko-{name}"

        @staticmethod
        def code_system(name):
            return "ecog"

    joined = V.performance_and_death(df, Config)
    rule = E.expect_not_null("death", "meta_profile_death", F.col("value_codeable_concept_coding_code") == "5")
    (row,) = E.run_suite(joined, "s", [rule], "row_weight").collect()
    # Three observations times two deaths, and one observation without a death.
    assert (row["evaluated"], row["unexpected"]) == (7, 1)


def test_packed_ids_come_back_and_stay_apart(spark):
    hashed = "0123456789abcdef" * 4
    texts = [hashed, f"Patient/{hashed}", f"Condition/{hashed}", hashed[:-1], hashed.upper(), "Patient/7", "", "ä/ö", None]
    rows = spark.createDataFrame([(x,) for x in texts], "id string")
    both = rows.select("id", ids.packed(F.col("id")).alias("data")).select("id", "data", ids.unpacked(F.col("data")).alias("back"))
    found = both.collect()
    assert [r["back"] for r in found] == texts
    assert len({r["data"] and bytes(r["data"]) for r in found}) == len(texts)
    assert len(found[0]["data"]) == 33 and len(found[1]["data"]) == 41


def test_suites_stage_only_sections_their_jobs_read(spark):
    rows = reports(spark, "/root/testdata/sf0.001")
    deaths = P.needed_reports(rows, ("Observation",), ("deaths",))
    assert set(deaths.schema["report"].dataType.names) & set(SECTIONS) == {"Tod"}
    assert {r["sections"] for r in deaths.select("sections").distinct().collect()} == {"Tod"}
    # Patients come from reports of all sections.
    both = P.needed_reports(rows, ("MedicationStatement", "Patient"))
    assert set(both.schema["report"].dataType.names) & set(SECTIONS) == {"SYST", "Tod"}
    assert both.count() == rows.count()
    assert P.needed_reports(rows).schema == rows.schema


def test_more_orders_are_dealt_to_more_tasks(spark, monkeypatch):
    def tasks():
        return derived.derived_documents(spark, "/root/testdata/sf0.001").rdd.getNumPartitions()

    # The adaptive planner may not merge them after a join that is no broadcast either.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert tasks() == 4
        monkeypatch.setattr(derived, "ORDERS_PER_TASK", 100)
        assert tasks() == 16
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_reports_hold_no_hashes_and_come_back(spark):
    rows = reports(spark, "/root/testdata/sf0.001")
    staged = P.stage_reports(rows, CFG)
    assert staged.columns == rows.columns
    written = spark.read.parquet(staged.inputFiles()[0].rsplit("/", 2)[0])
    assert not {"patient_ref", "condition_id", "bundle_id"} & set(written.columns)
    names = ["export_id", "sections", *P.REFERENCES, "condition_value"]
    found = [sorted(map(tuple, df.select(*names).collect())) for df in (rows, staged)]
    assert found[0] == found[1] and len(found[0]) > 1000


def test_staged_references_of_a_lookup_are_written(spark):
    cfg = replace(CFG, patient_reference_strategy="record_id")
    rows = reports(spark, "/root/testdata/sf0.001").limit(5).withColumn("patient_ref", F.lit("Patient/known"))
    assert {r["patient_ref"] for r in P.stage_reports(rows, cfg).collect()} == {"Patient/known"}


def test_largest_id_is_that_of_the_texts(spark):
    low, high = "0123456789abcdef" * 4, "fe" * 32
    groups = [
        [f"Patient/{low}", f"Patient/{high}", None], [f"Patient/{high}", "Patient/z"], [f"Patient/{high}", "Patient/0"],
        [high, low], [high.upper(), low], [f"Patient/{high}\n", f"Patient/{high}"], ["", None], [None], ["Patient/7"],
    ]
    rows = spark.createDataFrame([(i, x) for i, g in enumerate(groups) for x in g], "i int, id string")
    found = rows.groupBy("i").agg(
        F.max("id").alias("text"), ids.max_id(F.col("id"), "Patient/").alias("a"), ids.max_id(F.col("id")).alias("b")
    ).collect()
    assert len(found) == len(groups) and all(r["text"] == r["a"] == r["b"] for r in found)


def test_patients_move_hashes_as_bytes(spark):
    rows = P.stage_reports(reports(spark, "/root/testdata/sf0.001"), CFG)
    plan = R.map_patients(rows, CFG).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "max(bundle_id" not in plan and "unhex(" in plan


def test_quality_run_stages_what_is_read_twice_in_small_scans(spark, monkeypatch):
    tables = {"Observation": R.map_deaths(reports(spark, "/root/testdata/sf0.001", "Tod"), CFG)}
    size, staged = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(size)

    def stage(df, name, *more):
        staged.append((name, spark.conf.get(size)))
        return df

    monkeypatch.setattr(Q, "stage_table", stage)
    one = Q.quality_run(tables, "2001-12-31", CFG, ["death_dates"]).collect()
    assert staged == []
    both = Q.quality_run(tables, "2001-12-31", CFG, ["death_dates", "death_completeness"]).collect()
    assert staged == [("observations", str(32 << 20))] and spark.conf.get(size) == before
    assert set(one) < set(both) and len(both) == 4
    with small_scans(spark, 1 << 20):
        assert spark.conf.get(size) == str(128 << 20)
