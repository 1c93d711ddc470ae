import json

import pyarrow.parquet as pq
import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from parcelgrid.functions import box as B
from parcelgrid.functions import ring as R
from parcelgrid.functions.ring import GEOMETRY_TYPE
from parcelgrid.functions.wkt import tagged
from parcelgrid.operators import verify
from parcelgrid.plans import etl
from parcelgrid.sources import geojson, geoparquet, lake, synthetic
from parcelgrid.streaming.ingest import ingest_geojson

PROPERTIES = "name string, crop_type string, area_ha double, note string"


def feature(i):
    """A right triangle, turned by i; some without a note, one without a geometry."""
    x, y = -116 + (i * 37 % 200) / 100, 32.5 + (i * 53 % 150) / 100
    legs = [(3, 0), (0, 2), (-3, 0), (0, -2)]
    (ax, ay), (bx, by) = legs[i % 4], legs[(i + 1) % 4]
    corners = [[x, y], [x + ax / 1000, y + ay / 1000], [x + bx / 1000, y + by / 1000], [x, y]]
    notes = {"note": None} if i == 5 else {"note": 'a "quoted" {"type": "Feature", '} if i % 2 else {"note": "plain"}
    return {
        "type": "Feature",
        "id": str(i),
        "properties": {"name": f"triangle {i}", "crop_type": "corn", "area_ha": i / 100, **notes},
        "geometry": None if i == 7 else {"type": "Polygon", "coordinates": [corners]},
    }


def collection(path, numbers):
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature(i) for i in numbers]}))


@pytest.fixture(scope="module")
def one_line(tmp_path_factory):
    folder = tmp_path_factory.mktemp("geojson")
    collection(folder / "a.json", range(400))
    return str(folder / "a.json")


def test_collection_reads_like_document(spark, one_line):
    split = geojson.read_geojson(spark, one_line, PROPERTIES)
    whole = geojson.read_geojson(spark, one_line, PROPERTIES, layout="document")
    assert split.count() == 400 and verify.differences(split, whole).count() == 0
    row = split.where("feature_id = '3'").first()
    assert row["geom"]["srid"] == 4326 and len(row["geom"]["rings"][0]) == 4
    assert row["bbox"]["maxx"] == max(v["x"] for v in row["geom"]["rings"][0])
    assert split.where("geom.rings is null").count() == 1 and split.where("note is null").count() == 1


def test_every_document_of_a_file_is_read(spark, tmp_path):
    path = tmp_path / "several.geojson"
    texts = [json.dumps({"features": [feature(i) for i in part], "type": "FeatureCollection"}) for part in ([0, 1], [2], [3, 4])]
    path.write_text(f"{texts[0]}\n{texts[1]}{texts[2]}\n")
    found = geojson.read_geojson(spark, str(path), PROPERTIES, layout="document")
    assert sorted(r.feature_id for r in found.collect()) == ["0", "1", "2", "3", "4"]


def test_text_after_a_document_raises(spark, tmp_path):
    path = tmp_path / "cut.geojson"
    path.write_text(json.dumps({"features": [feature(0)]}) + ' {"features": [')
    with pytest.raises(Exception, match="not a feature or the frame of a collection"):
        geojson.read_geojson(spark, str(path), PROPERTIES, layout="document").collect()


def test_one_file_is_split_over_tasks(spark, one_line):
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        parts = geojson.read_geojson(spark, one_line, PROPERTIES).groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 3 and sum(r["count"] for r in parts) == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_lines_of_other_writers(spark, tmp_path):
    body = ",\n".join('{ "type": "Feature", ' + json.dumps(feature(i))[20:] for i in range(4))
    (tmp_path / "g.json").write_text('{\n"type": "FeatureCollection",\n"features": [\n' + body + "\n]\n}\n")
    rows = geojson.read_geojson(spark, str(tmp_path / "g.json"), PROPERTIES, layout="lines")
    assert [r["name"] for r in rows.orderBy("name").collect()] == [f"triangle {i}" for i in range(4)]
    with pytest.raises(ValueError):
        geojson.read_geojson(spark, str(tmp_path), PROPERTIES, layout="other")


def test_broken_features_raise(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"type":"Feature","id":"1","properties":{"name":"a"},"geometry":{"type":"Polygon","coordinates":[[[1,2],[3,"x')
    with pytest.raises(Exception, match="(?i)malformed"):
        geojson.read_geojson(spark, str(tmp_path / "b.json"), PROPERTIES, layout="lines").collect()


def test_points(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"type":"Feature","id":"1","properties":{"name":"a"},"geometry":{"type":"Point","coordinates":[1.5,2.5]}}')
    row = geojson.read_geojson(spark, str(tmp_path / "p.json"), "name string", layout="lines", geometry="point").first()
    assert (row["x"], row["y"], row["srid"]) == (1.5, 2.5, 4326)


def test_geojson_round_trip(spark, one_line, tmp_path):
    first = geojson.read_geojson(spark, one_line, PROPERTIES)
    geojson.write_geojson(first, str(tmp_path / "out"), "feature_id", PROPERTIES.replace(" string", "").replace(" double", "").split(", "))
    for layout, prefix in ((None, None), ("lines", None), ("collection", '{"type":"Feature",')):
        again = geojson.read_geojson(spark, str(tmp_path / "out"), PROPERTIES, layout=layout, prefix=prefix)
        assert verify.differences(first, again).count() == 0


def id_first(i):
    own = feature(i)
    return {"id": own["id"], "type": own["type"], "geometry": own["geometry"], "properties": own["properties"]}


def written(features, layout):
    whole = {"type": "FeatureCollection", "name": "x", "features": features}
    if layout == "compact":
        return json.dumps(whole, separators=(",", ":"))
    if layout == "indented":
        return json.dumps(whole, indent=2)
    if layout == "lines":
        return "\n".join(json.dumps(f) for f in features)
    return json.dumps(whole)


@pytest.mark.parametrize("layout", ["plain", "compact", "indented", "lines"])
@pytest.mark.parametrize("make", [feature, id_first])
def test_any_writer_s_layout_is_read_whole(spark, tmp_path, layout, make):
    (tmp_path / "a.json").write_text(written([make(i) for i in range(5)], layout))
    (tmp_path / "b.json").write_text(written([make(i) for i in range(5, 9)], layout))
    rows = geojson.read_geojson(spark, str(tmp_path), PROPERTIES)
    assert sorted(r["name"] for r in rows.collect()) == [f"triangle {i}" for i in range(9)]


def test_foreign_files_raise(spark, tmp_path):
    """Nothing beside the sniffed layout is skipped in silence."""
    one = written([feature(i) for i in range(3)], "plain")
    for number, other in enumerate((written([feature(3)], "compact"), written([id_first(3)], "plain"), one[:-2] + ',{"id": 9, "type" :"Feature"}]}')):
        folder = tmp_path / str(number)
        folder.mkdir()
        (folder / "a.json").write_text(one)
        (folder / "b.json").write_text(other)
        with pytest.raises(Exception, match="(?i)not a feature|malformed"):
            geojson.read_geojson(spark, str(folder), PROPERTIES, "collection", prefix='{"type": "Feature", ').collect()
    (tmp_path / "l.json").write_text(json.dumps(feature(1)) + '\n{"some": "thing"}\n')
    with pytest.raises(Exception, match="not a feature"):
        geojson.read_geojson(spark, str(tmp_path / "l.json"), PROPERTIES).collect()
    (tmp_path / "d.json").write_text('{"rows": [1]}')
    with pytest.raises(Exception, match="not a feature"):
        geojson.read_geojson(spark, str(tmp_path / "d.json"), PROPERTIES).collect()


def framed(spark, n=300):
    b = B.box()
    rows = synthetic.boxes(spark, n).withColumns({"geom": tagged(R.polygon_of_box(b), 32611), "bbox": B.as_struct(b)})
    county = F.when(F.col("field_id") % 3 == 0, "a").otherwise("b b/c")
    return rows.select("field_id", "crop_type", county.alias("county"), "yield_tha", "geom", "bbox")


def test_geoparquet_footer_and_round_trip(spark, tmp_path):
    df, path = framed(spark), str(tmp_path / "gp")
    geoparquet.write_geoparquet(df, path, 32611)
    files = list((tmp_path / "gp").glob("*.parquet"))
    assert files and not list((tmp_path / "gp").glob("_attempt*"))
    for file in files:
        meta = json.loads(pq.read_metadata(file).metadata[b"geo"])
        column = meta["columns"][meta["primary_column"]]
        assert meta["version"] == "1.0.0" and column["encoding"] == "WKB" and column["geometry_types"] == ["Polygon"]
        assert column["crs"]["id"]["code"] == 32611 and len(column["bbox"]) == 4
        assert pq.read_metadata(file).row_group(0).column(0).compression == "SNAPPY"
    back = geoparquet.read_geoparquet(spark, path)
    assert verify.differences(df.select("field_id", "geom", "bbox"), back.select("field_id", "geom", "bbox")).count() == 0
    stats = geoparquet.footers(spark, path).agg(F.sum("n_rows"), F.min("minx"), F.max("maxy")).first()
    true = df.agg(F.count("*"), F.min("bbox.minx"), F.max("bbox.maxy")).first()
    assert tuple(stats) == tuple(true)


def test_attribute_scan_skips_geometry(spark, tmp_path):
    path = str(tmp_path / "gp")
    geoparquet.write_geoparquet(framed(spark), path, 32611)
    plan = plan_of(geoparquet.read_geoparquet(spark, path, 32611).select("field_id", "crop_type", "yield_tha"))
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "geometry" not in schema and "bbox" not in schema and "Python" not in plan


def test_geoparquet_modes_and_partitions(spark, tmp_path):
    df, path = framed(spark), str(tmp_path / "gp")
    geoparquet.write_geoparquet(df, path, 32611, partition_by=["crop_type"], compression="zstd")
    geoparquet.write_geoparquet(df, path, 32611, partition_by=["crop_type"])
    assert geoparquet.read_geoparquet(spark, path).count() == 600
    geoparquet.write_geoparquet(df, path, 32611, partition_by=["crop_type"], mode="overwrite")
    back = geoparquet.read_geoparquet(spark, path)
    assert back.count() == 300
    counts = lambda d: {r[0]: r[1] for r in d.groupBy("crop_type").count().collect()}
    assert counts(back) == counts(df)
    with pytest.raises(ValueError):
        geoparquet.write_geoparquet(df, path, 32611, compression="lzo")


def test_awkward_partition_values(spark, tmp_path):
    year = F.when(F.col("field_id") % 5 > 0, (2023 + F.col("field_id") % 2).cast("int"))
    df, path = framed(spark).withColumn("year", year), str(tmp_path / "gp")
    geoparquet.write_geoparquet(df, path, 32611, partition_by=["county", "year"])
    back = geoparquet.read_geoparquet(spark, path)
    assert {"a", "b b/c"} == {r[0] for r in back.select("county").distinct().collect()}
    columns = ["field_id", "county", "year"]
    assert verify.differences(df.select(columns), back.select(columns)).count() == 0


def test_failed_write_shows_nothing(spark, tmp_path):
    bad = framed(spark).withColumn("yield_tha", F.when(F.col("field_id") == 299, F.raise_error(F.lit("stop")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="stop"):
        geoparquet.write_geoparquet(bad, str(tmp_path / "gp"), 32611)
    # tasks still running at the abort may leave hidden files; readers never see those
    visible = [f for f in (tmp_path / "gp").rglob("*.parquet") if "_attempt-" not in str(f)]
    assert not visible


def test_lake_pruning(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(framed(spark), path, ["county"], 25_000.0)
    rows = lake.read_window(spark.read.parquet(path).where("county = 'b b/c'"), (0.0, 0.0, 40_000.0, 40_000.0))
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(county" in plan and "LessThanOrEqual(bbox.minx,40000.0)" in plan
    expected = framed(spark).where("county = 'b b/c' and bbox.minx <= 40000 and bbox.miny <= 40000")
    assert rows.count() == expected.count()


def test_small_storage_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "field_id int, elevation_m double")
    assert lake.short_names(df).columns == ["field_id", "elevation_"]
    with pytest.raises(ValueError, match="collide"):
        lake.short_names(spark.createDataFrame([(1, 2)], "elevation_m int, elevation_ft int"))
    path = str(tmp_path / "once")
    lake.write_once(df, path)
    assert lake.write_once(df.withColumn("field_id", F.lit(9)), path).first()["field_id"] == 1
    lake.write_once(framed(spark), str(tmp_path / "plain"))
    sizes = {r["format"]: r for r in lake.size_audit(spark, {"a": path, "b": str(tmp_path / "plain")}, "a").collect()}
    assert sizes["a"]["ratio_to_baseline"] == 1 and sizes["b"]["ratio_to_baseline"] > 1


def test_files_hold_one_srid_each(spark, tmp_path):
    ring = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]
    rows = [(i, f"a b%{i % 2}", ([4326, 32611][i % 2], ring)) for i in range(8)] + [(9, "x", (4326, None))]
    df = spark.createDataFrame(rows, f"i int, part string, geom {GEOMETRY_TYPE}").repartition(2)
    want = {(r["i"], r["geom"]["srid"]) for r in df.collect() if r["geom"]["rings"]}
    for number, partition_by in enumerate((None, ["part"])):
        path = str(tmp_path / str(number))
        geoparquet.write_geoparquet(df, path, partition_by=partition_by)
        back = geoparquet.read_geoparquet(spark, path)
        assert {(r["i"], r["geom"]["srid"]) for r in back.collect() if r["geom"]["rings"]} == want
        assert back.count() == 9
    with pytest.raises(Exception, match="expected SRID 4326"):
        geoparquet.write_geoparquet(df, str(tmp_path / "one"), 4326)


def test_geoparquet_points_and_types(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, -4.5, 6.25)], "i int, lon double, lat double")
    geoparquet.write_geoparquet_points(df, str(tmp_path / "p"), 4326, "lon", "lat")
    back = geoparquet.read_geoparquet_points(spark, str(tmp_path / "p")).orderBy("i").collect()
    assert [(r["i"], r["x"], r["y"], r["srid"]) for r in back] == [(1, 2.0, 3.0, 4326), (2, -4.5, 6.25, 4326)]
    kinds = {json.loads(r["geo"])["columns"]["geometry"]["geometry_types"][0] for r in geoparquet.footers(spark, str(tmp_path / "p")).collect()}
    assert kinds == {"Point"}


def test_overwrite_replaces_and_row_groups_are_large(spark, tmp_path):
    path = str(tmp_path / "gp")
    geoparquet.write_geoparquet(framed(spark, 50), path, 32611)
    geoparquet.write_geoparquet(framed(spark, 30_000).coalesce(1), path, 32611, mode="overwrite")
    (file,) = (tmp_path / "gp").glob("*.parquet")
    assert pq.read_metadata(file).num_rows == 30_000 and pq.read_metadata(file).num_row_groups == 1


def test_evolved_schema(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "old"))
    spark.range(2, 4).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "new"))
    rows = lake.read_evolved(spark, str(tmp_path / "old"), str(tmp_path / "new")).orderBy("id").collect()
    assert [r["extra"] for r in rows] == [None, None, "x", "x"]


@pytest.mark.parametrize("make", [feature, id_first])
def test_stream_ingest_equals_batch(spark, tmp_path, make):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(written([make(i) for i in range(100)], "plain"))
    (source / "b.json").write_text(written([make(i) for i in range(100, 200)], "plain"))
    run = ingest_geojson(spark, str(source), str(tmp_path / "out"), str(tmp_path / "cp"), PROPERTIES, 32611)
    run.awaitTermination()
    assert len([p for p in run.recentProgress if p["numInputRows"] > 0]) == 2
    batch = etl.keep_large_fields(geojson.read_geojson(spark, str(source), PROPERTIES), 32611)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < got.count() < 200
    report = verify.reconcile(batch, got, ["feature_id"], ["crop_type"], ["area_m2"]).first()
    assert report["verdict"] == "MATCH"


def test_lake_load_rejects_and_enriches(spark, tmp_path):
    square = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]
    bow = [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]
    lonlat = [[(-117.0, 33.0), (-116.99, 33.0), (-116.99, 33.01), (-117.0, 33.0)]]
    schema = f"field_id int, crop string, geom {GEOMETRY_TYPE}"
    a = spark.createDataFrame([(1, "x", (32611, square)), (2, "x", (32611, bow)), (3, "x", (32611, None))], schema)
    b = spark.createDataFrame([(4, "y", (4326, lonlat))], schema)
    zones = spark.createDataFrame([(7, 0.0, 0.0, 6.0, 6.0), (5, 4.0, 4.0, 9.0, 9.0)], "zone_id int, minx double, miny double, maxx double, maxy double")
    etl.lake_load([a, b], 32611, zones, str(tmp_path / "lake"), ["crop"], 1000.0, str(tmp_path / "bad"))
    rows = {r["field_id"]: r for r in spark.read.parquet(str(tmp_path / "lake")).collect()}
    assert set(rows) == {1, 4} and rows[1]["area_m2"] == 100 and rows[1]["zone_id"] == 5
    assert rows[4]["zone_id"] is None and rows[4]["area_m2"] > 400_000
    assert {r["field_id"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {2, 3}
