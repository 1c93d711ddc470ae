"""Shipping the package, and intermediates that go when their batch ends."""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from parcelgrid import session
from parcelgrid.streaming.zones import stream_zone_lookup

ROOT = Path(__file__).resolve().parents[1]


def folders(spark):
    root = session.shared_root(spark).removeprefix("file:")
    return set(os.listdir(root))


def test_intermediates_go_with_their_block(spark):
    before = folders(spark)
    with session.intermediates(spark):
        kept = session.materialise(spark.range(5), "five")
        assert kept.count() == 5 and len(folders(spark)) == len(before) + 1
    assert folders(spark) == before


def test_batches_leave_no_folders(spark, tmp_path):
    source = tmp_path / "in"
    fields = spark.createDataFrame(
        [(1, "corn", 0.0, 0.0, 5.0, 5.0), (2, "soy", 90.0, 90.0, 99.0, 99.0)],
        "field_id bigint, crop_type string, minx double, miny double, maxx double, maxy double",
    )
    schema = "query_id bigint, x double, y double"
    for i in range(4):
        spark.createDataFrame([(i, float(i), 9.0)], schema).coalesce(1).write.mode("append").parquet(str(source))
    readings = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    before = folders(spark)
    run = stream_zone_lookup(readings, fields, str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == 4 and len(run.recentProgress) >= 4
    # the standing pyramid and list stay; nothing more per batch
    assert not [f for f in folders(spark) - before if f.startswith("groups-")]
    assert found.select(F.max("batch")).first()[0] == 3


def test_package_reaches_workers_that_lack_it(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as entry
from parcelgrid.session import local_session
spark = local_session(2, **{{"spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
print("rows", entry.queries()["geoparquet_roundtrip"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
