"""Every engine query against its SQL on the smallest tables."""

import pytest
from helpers import DATA, duck, rows_of, rows_of_sql

from loomspan.plans.registry import ORACLES, QUERIES, flagship


@pytest.fixture(scope="module")
def con():
    return duck()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert rows_of(QUERIES[name](spark, DATA)) == rows_of_sql(con, ORACLES[name])


def test_validator_report_covers_all_gates(spark):
    found = {(r["gate"], r["finding"]) for r in QUERIES["validator_report"](spark, DATA).collect()}
    assert {("version", "mixed_versions"), ("version", "unsupported_version"), ("contract", "resolved_at_missing")} <= found


def test_flagship_has_all_members(spark):
    assert flagship(spark, DATA).count() == 17


@pytest.mark.parametrize("name", ["slot_pool_assignment", "score_summary_upper_median", "duplicate_flags"])
def test_partitioning_does_not_matter(spark, name):
    before = rows_of(QUERIES[name](spark, DATA))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows_of(QUERIES[name](spark, DATA)) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
