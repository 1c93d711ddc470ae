import math

import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from parcelgrid.operators import summaries, tiles, verify
from parcelgrid.sources import synthetic

@pytest.fixture(scope="module")
def fields(spark):
    even = synthetic.boxes(spark, 900, extent=200_000.0).drop("label")
    crowded = synthetic.boxes(spark, 600, extent=500.0, seed=3).drop("label").withColumn("field_id", F.col("field_id") + 10_000)
    return even.unionByName(crowded).cache()


@pytest.fixture(scope="module")
def tiled(fields):
    return tiles.assign_tiles(fields, 4, 4)


def test_assignment_follows_the_rule(fields, tiled):
    rows = fields.collect()
    x0, y0 = min(r["minx"] for r in rows), min(r["miny"] for r in rows)
    x1, y1 = max(r["maxx"] for r in rows), max(r["maxy"] for r in rows)

    def tile(r):
        col = int(((r["minx"] + r["maxx"]) / 2 - x0) / ((x1 - x0) / 4))
        row = int(((r["miny"] + r["maxy"]) / 2 - y0) / ((y1 - y0) / 4))
        return min(max(row, 0), 3) * 4 + min(max(col, 0), 3)

    expected = {r["field_id"]: tile(r) for r in rows}
    assert {r["field_id"]: r["tile_id"] for r in tiled.collect()} == expected


def test_one_place_is_one_tile(spark):
    one = spark.createDataFrame([(1, 5.0, 5.0, 5.0, 5.0)], "field_id int, minx double, miny double, maxx double, maxy double")
    assert tiles.assign_tiles(one, 4, 4).first()["tile_id"] == 0
    with pytest.raises(ValueError):
        tiles.assign_tiles(one, 0, 4)


def test_features_by_hand(tiled):
    rows, native = tiled.collect(), {r["field_id"]: r for r in tiles.tile_features(tiled).collect()}
    tile_of = {}
    for r in rows:
        tile_of.setdefault(r["tile_id"], []).append(((r["minx"] + r["maxx"]) / 2, (r["miny"] + r["maxy"]) / 2))
    for r in rows:
        own, got = tile_of[r["tile_id"]], native[r["field_id"]]
        mean = [sum(c[i] for c in own) / len(own) for i in (0, 1)]
        centre = ((r["minx"] + r["maxx"]) / 2, (r["miny"] + r["maxy"]) / 2)
        assert got["computed_area_m2"] == pytest.approx((r["maxx"] - r["minx"]) * (r["maxy"] - r["miny"]))
        assert got["dist_to_tile_center_m"] == pytest.approx(math.dist(centre, mean), abs=0.006)
        assert got["n_in_partition"] == len(own) and got["partition_id"] == r["tile_id"]


def test_features_use_no_window(tiled):
    plan = plan_of(tiles.tile_features(tiled))
    assert "Window" not in plan and "BatchEvalPython" not in plan


def test_user_function_gets_whole_tiles(tiled):
    def one_size(frame):
        return frame.assign(n=len(frame))[["tile_id", "n"]].head(1)

    sizes = {r["tile_id"]: r["n_in_tile"] for r in tiles.tile_sizes(tiled).collect()}
    got = tiles.apply_per_tile(tiled, one_size, "tile_id int, n bigint").collect()
    assert {r["tile_id"]: r["n"] for r in got} == sizes and len(got) == len(sizes)
    pieces = tiles.apply_per_tile(tiled, one_size, "tile_id int, n bigint", rows_per_call=100).collect()
    assert max(r["n"] for r in pieces) < 200 and sum(r["n"] for r in pieces) == 1500


def test_fold_does_not_depend_on_the_pieces(tiled):
    def partial(frame):
        return frame.groupby("tile_id", as_index=False).agg(n=("field_id", "size"), total=("field_id", "sum"))

    def finish(frame):
        return partial_sum(frame)

    def partial_sum(frame):
        return frame.groupby("tile_id", as_index=False).agg(n=("n", "sum"), total=("total", "sum"))

    schema = "tile_id int, n bigint, total bigint"
    one, many = (sorted(map(tuple, tiles.fold_per_tile(tiled, partial, schema, finish, schema, pieces=k).collect())) for k in (1, 50))
    assert one == many and sum(n for _, n, _ in one) == 1500


@pytest.mark.parametrize("partitions", [1, 7])
def test_chunks_follow_the_order(fields, partitions):
    def span(frame):
        return frame.groupby("chunk", as_index=False).agg(n=("field_id", "size"), low=("field_id", "min"), high=("field_id", "max"))

    got = tiles.apply_per_chunk(fields.repartition(partitions), span, "chunk bigint, n bigint, low bigint, high bigint", 400, ["field_id"])
    ids = sorted(r["field_id"] for r in fields.select("field_id").collect())
    want = [(k, len(p), p[0], p[-1]) for k in range(4) if (p := ids[400 * k : 400 * (k + 1)])]
    assert sorted(map(tuple, got.collect())) == want


def test_sample(tiled):
    one = tiles.sample_per_tile(tiled, 50, "field_id")
    again = tiles.sample_per_tile(tiled.repartition(5), 50, "field_id")
    assert one.exceptAll(again).count() == 0
    sizes = {r["tile_id"]: r["n_in_tile"] for r in tiles.tile_sizes(tiled).collect()}
    kept = {r["tile_id"]: r["count"] for r in one.groupBy("tile_id").count().collect()}
    assert kept == {t: min(50, n) for t, n in sizes.items()}
    assert tiles.sample_per_tile(tiled, 50, "field_id", seed=1).exceptAll(one).count() > 0
    assert "WindowGroupLimit" in plan_of(one)


def test_occupancy(tiled):
    row = tiles.tile_occupancy(tiled).first()
    sizes = [r["n_in_tile"] for r in tiles.tile_sizes(tiled).collect()]
    assert (row["min_features"], row["max_features"]) == (min(sizes), max(sizes))
    assert row["mean_features"] == pytest.approx(1500 / len(sizes))
    assert [r[0] for r in tiles.tile_ids(tiled).collect()] == sorted(range(len(sizes)))


def test_numbering_is_dense(spark, tmp_path):
    spark.range(0, 1003, 1, 7).write.parquet(str(tmp_path / "n"))
    numbered = summaries.numbered(spark.read.parquet(str(tmp_path / "n"))).collect()
    assert sorted(r["row_number"] for r in numbered) == list(range(1003))
    stats = summaries.chunk_statistics(spark.range(1003), summaries.chunk_of(F.col("id")), F.col("id") % 2 == 0)
    assert {r["chunk"]: r["n_features"] for r in stats.collect()} == {0: 250, 1: 250, 2: 250, 3: 250, 4: 3}


def test_partition_statistics_cover_all_rows(spark):
    rows = summaries.partition_statistics(spark.range(0, 100, 1, 4), F.col("id") < 10).collect()
    assert sum(r["n_features"] for r in rows) == 100 and sum(r["n_kept"] for r in rows) == 10


def test_reconcile_verdicts(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", math.inf), (3, None, None)], "k int, s string, v double")
    same = verify.reconcile(a, a, ["k"], ["s"], ["v"]).first()
    assert same["verdict"] == "MATCH" and same["n_match_v"] == 3 and same["match_pct_s"] == 100
    b = spark.createDataFrame([(1, "x", 1.000001), (2, "z", 5.0), (4, "q", 1.0)], "k int, s string, v double")
    row = verify.reconcile(a, b, ["k"], ["s"], ["v"]).first()
    assert (row["n_left"], row["n_right"], row["n_common"], row["n_match_s"], row["n_match_v"]) == (3, 3, 2, 1, 1)
    assert row["verdict"] == "MISMATCH"
    extra = verify.reconcile(a, a.where("k < 3"), ["k"], ["s"], ["v"]).first()
    assert extra["verdict"] == "MISMATCH" and extra["match_pct_s"] == 100
    assert {tuple(r) for r in verify.differences(a.select("k"), b.select("k")).collect()} == {(3, "left"), (4, "right")}


def test_report_is_written(spark, tmp_path):
    verify.comparison_report(spark.createDataFrame([(1, 2.5)], "n int, ratio double"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first()["ratio"] == 2.5
