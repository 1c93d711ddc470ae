"""Every registered query against its SQL twin on the smallest data."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import check  # noqa: E402
from parcelgrid.plans import registry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"size_audit"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) - set(registry.ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, con, name):
    status, rows, _, note = check(spark, con, name, SF_DIR)
    assert status == ("rows-only" if name in ROWS_ONLY else "ok"), note


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["query_id", "nearest_poly_id", "min_distance_m", "nearest_crop", "nearby_covered_area_m2"]
    assert df.count() == 1000


@pytest.mark.parametrize("name", ["buffer_area", "point_buffer", "within_polygon", "polygon_intersects_polygon", "shape_in_window"])
def test_small_files_of_heavy_rows_are_dealt_over_tasks(spark, name):
    found = contract.queries()[name](spark, contract.ENTRY_DATA)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
