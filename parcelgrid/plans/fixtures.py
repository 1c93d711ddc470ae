"""Geometry tables derived from the given tables.

``FIXTURE_SQL`` holds each table once, in SQL both Spark and the check engine
evaluate to the same doubles (integer arithmetic first, one division last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIELDS_M = """
SELECT p_partkey AS field_id,
       CASE p_partkey % 4 WHEN 0 THEN 'corn' WHEN 1 THEN 'wheat' WHEN 2 THEN 'soy' ELSE 'cotton' END AS crop_type,
       CAST(1 + (p_partkey * 37) % 199 AS DOUBLE) AS area_ha,
       CAST(1000 + (p_partkey * 53) % 19000 AS DOUBLE) / 1000 AS yield_tha,
       minx, miny, minx + w AS maxx, miny + h AS maxy
FROM (SELECT p_partkey,
             CAST((b * 7919 + 13) % 99800 AS DOUBLE) AS minx,
             CAST((b * 104729 + 37) % 99800 AS DOUBLE) AS miny,
             CAST(CASE WHEN b % 100 = 7 THEN 30000 WHEN b % 250 = 199 THEN 0 ELSE 50 + (b * 31) % 351 END AS DOUBLE) AS w,
             CAST(CASE WHEN b % 100 = 7 THEN 20000 ELSE 50 + (b * 17) % 251 END AS DOUBLE) AS h
      FROM (SELECT p_partkey, CASE WHEN p_partkey % 50 = 1 THEN p_partkey - 1 ELSE p_partkey END AS b FROM part) t0) t1
"""

SENSORS_M = """
SELECT event_id AS query_id, ts, value,
       CAST((event_id * 15485863 + 101) % 1000000 AS DOUBLE) / 10 AS x,
       CAST((event_id * 32452843 + 307) % 1000000 AS DOUBLE) / 10 AS y
FROM events
"""

FIELDS_LL = """
SELECT p_partkey AS field_id,
       CASE p_partkey % 5 WHEN 0 THEN 'corn' WHEN 1 THEN 'wheat' WHEN 2 THEN 'soybean' WHEN 3 THEN 'cotton' ELSE 'alfalfa' END AS crop_type,
       CASE p_partkey % 4 WHEN 0 THEN 'Imperial' WHEN 1 THEN 'Riverside' WHEN 2 THEN 'San Diego' ELSE 'Coachella' END AS county,
       CAST(2023 + p_partkey % 3 AS INT) AS year,
       lon AS minx, lat AS miny, lon + sz AS maxx, lat + sz * 7 / 10 AS maxy,
       sz * sz * 7 / 10 * 111320 * 111320 / 10000 AS area_ha
FROM (SELECT p_partkey,
             CAST(-116500000 + (p_partkey * 7919 + 13) % 2000000 AS DOUBLE) / 1000000 AS lon,
             CAST(32500000 + (p_partkey * 104729 + 37) % 1500000 AS DOUBLE) / 1000000 AS lat,
             CAST(300 + (p_partkey * 31) % 4701 AS DOUBLE) / 1000000 AS sz FROM part) t
"""

POINTS_LL = """
SELECT c_custkey AS point_id,
       CAST(-116500000 + (c_custkey * 7919 + 13) % 2000000 AS DOUBLE) / 1000000 AS lon,
       CAST(32500000 + (c_custkey * 104729 + 37) % 1500000 AS DOUBLE) / 1000000 AS lat
FROM customer
"""

#: Outlines that are no rectangles, of whole coordinates: 0 an L, 1 a square with a hole, 2 a triangle.
#: ``s`` is a third of the extent's side.
SHAPES_M = """
SELECT p_partkey AS field_id, p_partkey % 3 AS kind,
       CAST((p_partkey * 7919 + 13) % 998000 AS DOUBLE) AS x0,
       CAST((p_partkey * 104729 + 37) % 998000 AS DOUBLE) AS y0,
       CAST(2000 + (p_partkey * 31) % 6007 AS DOUBLE) AS s
FROM part
"""

#: Combs: a base of height ``b`` with 2,500 teeth up to ``h``, each ``u`` wide and as far from the next.
COMBS_M = """
SELECT p_partkey AS field_id,
       CAST((p_partkey * 7919 + 13) % 900000 AS DOUBLE) AS x0,
       CAST((p_partkey * 104729 + 37) % 800000 AS DOUBLE) AS y0,
       CAST(20 AS DOUBLE) AS u, CAST(1000 + p_partkey % 977 AS DOUBLE) AS b, CAST(200000 AS DOUBLE) AS h
FROM part WHERE p_partkey % 100 = 3
"""

SPOTS_M = """
SELECT event_id AS query_id,
       CAST((event_id * 15485863 + 101) % 1000000 AS DOUBLE) AS x,
       CAST((event_id * 32452843 + 307) % 1000000 AS DOUBLE) AS y
FROM events
"""

FIXTURE_SQL = {
    "fields_m": (FIELDS_M, "part"),
    "sensors_m": (SENSORS_M, "events"),
    "fields_ll": (FIELDS_LL, "part"),
    "points_ll": (POINTS_LL, "customer"),
    "shapes_m": (SHAPES_M, "part"),
    "combs_m": (COMBS_M, "part"),
    "spots_m": (SPOTS_M, "events"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived geometry table, lazily, over the whole source table."""
    sql, source = FIXTURE_SQL[name]
    return spark.sql(
        sql.replace(f"FROM {source}", "FROM {src}"), src=table(spark, sf_dir, source)
    )


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """As :func:`fixture`, dealt over tasks by its id: a small file is one task, however much work its rows are.

    The number is given, so that adaptive execution does not merge the pieces for being small.
    """
    rows = fixture(spark, sf_dir, name)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.columns[0])


def oracle_with(*names: str) -> str:
    """The ``WITH`` clause defining the named tables for the SQL check."""
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURE_SQL[n][0].strip()})" for n in names)
