import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from oncolake.functions import clinical, codes, dates, ids
from oncolake.operators.deidentify import keyed_hash


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0]["x"]


@pytest.mark.parametrize(
    "text,slug",
    [
        ("C50.9", "C50-9"),
        ("Ausprägung_ß", "Auspraegung_ss"),
        (" café / 1 ", "cafe-1"),
        ("a–b", "ab"),
        ("GenetischeAusprägung-OP-1", "GenetischeAuspraegung-OP-1"),
    ],
)
def test_slug(spark, text, slug):
    assert one(spark, ids.slugify(F.lit(text))) == slug


def test_resource_id(spark):
    want = hashlib.sha256(b"urn:x|1").hexdigest()
    assert one(spark, ids.resource_id("urn:x", F.lit("1"))) == want


@pytest.mark.parametrize(
    "precision,want",
    [("E", "2020-03-15"), (None, "2020-03-15"), ("T", "2020-03"), ("M", "2020"), ("V", None)],
)
def test_partial_date(spark, precision, want):
    date = one(spark, dates.partial_date(F.lit("2020-03-15+01:00"), F.lit(precision).cast("string")))
    assert (date and date["value"]) == want


@pytest.mark.parametrize(
    "text,year", [("10 2023 GM", "2023"), ("10 2019 WHO", "2019"), ("Sonstige", None), ("10 1999 GM", None)]
)
def test_catalogue_year(spark, text, year):
    assert one(spark, dates.icd_version_year(F.lit(text))) == year


@pytest.mark.parametrize(
    "text,want", [("01.02.2024", "2024-02-01"), ("55.55.2026", None), ("31.02.2025", "2025-02-28"), ("x", None)]
)
def test_german_date(spark, text, want):
    assert one(spark, dates.german_date(F.lit(text)).cast("string")) == want


@pytest.mark.parametrize(
    "text,want",
    [
        ("N1", ("N1", False, False, False)),
        ("N0 (i-)(sn)", ("N0", True, False, True)),
        ("M0i+", ("M0", False, True, False)),
    ],
)
def test_tnm_suffixes(spark, text, want):
    assert tuple(one(spark, clinical.tnm_suffixes(F.lit(text)))) == want


@pytest.mark.parametrize("text,grade", [("0", "0"), ("70%", "1"), ("U", "U"), ("KARNOFSKY_20", "4"), ("ECOG_3", "3")])
def test_ecog(spark, text, grade):
    assert one(spark, clinical.ecog_bucket(F.lit(text))) == grade


def test_gleason(spark):
    null = F.lit(None).cast("string")
    assert one(spark, clinical.gleason_score(F.lit("3"), F.lit("4"), null)) == "7a"
    assert one(spark, clinical.gleason_score(F.lit("4"), F.lit("4"), null)) == "8"
    group = one(spark, clinical.gleason_grade_group(F.lit("4"), F.lit("3"), F.lit("7b")))
    assert (group["text"], group["code"], int(group["ordinal"])) == ("4+3", "1279716004", 7)
    assert one(spark, clinical.gleason_grade_group(null, null, F.lit("9")))["code"] == "58925000"


def test_stage_and_category(spark):
    assert one(spark, clinical.uicc_stage(F.lit("IIIC1"))) == "IIIC1"
    assert one(spark, clinical.uicc_stage(F.lit("V"))) is None
    assert one(spark, clinical.ops_category(F.lit("1-100")))["code"] == "165197003"


def test_distinct_by_code_keeps_greatest_version(spark):
    items = F.from_json(
        F.lit('[{"Code":"b"},{"Code":"a","Version":"2"},{"Code":"a"},{"Code":"a","Version":"10"},{"Code":"b","Version":"1"}]'),
        "array<struct<Code:string,Version:string>>",
    )
    assert [tuple(r) for r in one(spark, clinical.distinct_by_code(items))] == [("a", "2"), ("b", "1")]


@pytest.mark.parametrize("key", ["k", "x" * 100])
def test_keyed_hash_is_hmac(spark, key):
    want = hmac.new(key.encode(), "Größe".encode(), hashlib.sha256).hexdigest()
    assert one(spark, keyed_hash(F.lit("Größe"), key)) == want


def test_require_reference(spark):
    ok = codes.require_reference(F.lit("Patient/1"), "Patient", F.lit(None).cast("string"))
    assert one(spark, ok) is None
    assert one(spark, codes.require_reference(F.lit("Device/1"), "Patient", F.lit("1"))) is not None
    assert one(spark, codes.require_reference(F.lit(None).cast("string"), "Patient", F.lit("1"))) is None
