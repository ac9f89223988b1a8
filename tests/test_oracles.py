"""Every query against its SQL at the smallest scale, with usual settings and with all keys treated as heavy."""

import duckdb
import pytest

import __spark_entry__ as entry
from acreage.plans.oracles import ORACLES
from acreage.plans.queries import REGISTRY as QUERIES
from acreage.sources.stand_ins import BASE_TABLES
from tools.check import rows_of

# the ways for heavy keys and large tables are slower on tiny data; these queries cover all of them
CROWDED = [
    "related_table",
    "permits_repeated",
    "permits_extra_rows",
    "multi_pid_no_occupancy",
    "locate_permits",
    "locate_apps_polygon",
    "locate_apps_point",
    "parcel_point",
    "parcel_label_point",
    "geocode_addresses",
    "civic_join",
    "street_segment_points",
    "domain_decode",
    "subtype_domain_check",
    "domain_blocks",
    "spec_to_schema",
    "form_metadata",
    "domain_order",
]


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def check(spark, folder, db, name):
    got = QUERIES[name](spark, folder)
    want = db.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, folder, db, name):
    check(spark, folder, db, name)


@pytest.mark.parametrize("name", CROWDED)
def test_query_equals_sql_with_heavy_keys(crowded, folder, db, name):
    check(crowded, folder, db, name)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
