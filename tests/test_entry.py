"""The registered queries: every one has expected results, and some are compared here."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, plain

FOLDER = "/root/testdata/sf0.001"


# Over the rows of all sections SQL would be too slow; test_quality_run.py compares these with a plain version.
PLAIN = {"quality_run"} | {
    f"suite_{name}"
    for name in ("conditions", "procedures", "condition_procedure", "observations", "metastases", "performance_death")
}


def test_every_query_has_expected_results():
    assert set(entry.oracle_sql()) - set(entry.LLM_ORACLE) == set(entry.queries()) - set(entry.LLM_QUERIES) - PLAIN


@pytest.mark.parametrize(
    "name",
    "latest_version rank_reports merge_group_parts map_conditions map_surgeries map_deaths "
    "expectations_orders outer_join_view bundle_json stream_latest".split(),
)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(repr(tuple(plain(row[c]) for c in columns)) for row in df.collect())
    result = con.sql(entry.oracle_sql()[name])
    order = [result.columns.index(c) for c in columns]
    want = Counter(repr(tuple(plain(row[i]) for i in order)) for row in result.fetchall())
    assert got == want
