"""Headline timings on one data folder, as one JSON line.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oncolake.operators.staging import stage_table  # noqa: E402
from oncolake.plans import derived, pipeline  # noqa: E402
from oncolake.queries import QUERIES  # noqa: E402

HEADLINE = (
    "latest_version prefer_by_reason merge_group_header rank_reports consolidated_reports "
    "xml_roundtrip json_envelope slug map_conditions map_tnm map_radiotherapy "
    "map_medication_statements upsert_entries duplicate_conflicts bundle_json outer_join_view "
    "left_inner_view expectations_orders suite_conditions diagnoses_per_year"
).split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Wide generated methods are not compiled by the JVM; smaller ones per operator are.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df) -> None:
    """Run a query to the end without a driver-side result."""
    df.write.mode("overwrite").format("noop").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.time()
        consume(QUERIES[name](spark, folder))
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    extra = {}
    if not only or "reports_to_bundles" in only:
        # The workload the published figure is about: XML reports to bundles. Making the XML from
        # the tables is not part of it.
        xml = stage_table(derived.derived_xml(spark, folder), "xml")
        reports = xml.count()
        start = time.time()
        bundles, _ = pipeline.reports_to_bundles(xml, derived.CONFIG)
        consume(bundles)
        times["reports_to_bundles"] = round(time.time() - start, 3)
        extra = {
            "reports": reports,
            "reports_per_second": round(reports / times["reports_to_bundles"], 1),
        }
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
