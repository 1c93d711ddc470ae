"""GeoParquet: WKB geometry in Parquet with a ``geo`` entry in each file footer.

Every file holds geometries of one SRID, taken from the rows; a reader takes it
from each file's own footer.
"""

from __future__ import annotations

import json
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from parcelgrid.functions.crs import projjson
from parcelgrid.functions.ring import bounds_struct
from parcelgrid.functions.wkb import point_of_wkb, polygon_of_wkb, wkb_of_point, wkb_of_polygon
from parcelgrid.functions.wkt import tagged

SHORT_NAME = "parcelgrid_geoparquet"

# Footer key and format version.
FOOTER_KEY, FORMAT_VERSION = "geo", "1.0.0"
CODECS = ("snappy", "none", "zstd")

# Type codes of the binary form, and schemes that Arrow knows by another name.
TYPE_NAMES = {1: "Point", 3: "Polygon"}
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}

#: Uncompressed bytes of a row group.
ROW_GROUP_BYTES = 128 << 20

#: Carries each row's SRID to the writer; not stored.
SRID_COLUMN = "__srid"

# How partition folders name missing values, and what they escape.
MISSING_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\{}[]^\x7f"


def footer(bounds: list[float] | None, srid: int, types: list[str], column: str = "geometry") -> str:
    entry = {"encoding": "WKB", "geometry_types": types}
    if projjson(srid) is not None:
        entry["crs"] = projjson(srid)
    if bounds is not None:
        entry["bbox"] = bounds
    return json.dumps(
        {"version": FORMAT_VERSION, "primary_column": column, "columns": {column: entry}}
    )


def _folder_value(value) -> str:
    """A partition value as folder name, escaped as Spark reads it back."""
    if value is None or value == "":
        return MISSING_PARTITION
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in str(value))


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's filesystem for a path as Spark names it, and the path inside it."""
    scheme, colon, rest = path.partition("://")
    if colon and scheme != "file":
        return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    return pafs.LocalFileSystem(), re.sub("^file:/*", "/", path)


class _Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str]]):
        self.files = files


class _OpenFile:
    """One Parquet file being written; bounds and types go to its footer at the end."""

    def __init__(self, fs, path: str, schema: pa.Schema, codec: str, srid: int):
        self.stream = fs.open_output_stream(path)
        self.writer = pq.ParquetWriter(self.stream, schema, compression=codec)
        self.low, self.high = np.full(2, np.inf), np.full(2, -np.inf)
        self.srid, self.types = srid, set()
        self.held, self.held_bytes = [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        box = batch.column(batch.schema.get_field_index("bbox"))
        known = box.filter(box.is_valid())
        if len(known):
            corner = lambda name: known.field(name).to_numpy(zero_copy_only=False)
            self.low = np.minimum(self.low, [np.nanmin(corner("minx")), np.nanmin(corner("miny"))])
            self.high = np.maximum(self.high, [np.nanmax(corner("maxx")), np.nanmax(corner("maxy"))])
        # little-endian WKB: the type's lowest byte comes second
        codes = pc.unique(pc.binary_slice(batch.column(batch.schema.get_field_index("geometry")), 1, 2)).drop_null()
        self.types |= {TYPE_NAMES[code.as_py()[0]] for code in codes}
        self.held.append(batch)
        self.held_bytes += batch.nbytes
        if self.held_bytes >= ROW_GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        """One row group of what is held."""
        if self.held:
            whole = pa.Table.from_batches(self.held)
            self.writer.write_table(whole, row_group_size=max(1, whole.num_rows))
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.flush()
        bounds = [*self.low.tolist(), *self.high.tolist()] if np.isfinite(self.low).all() else None
        self.writer.add_key_value_metadata({FOOTER_KEY: footer(bounds, self.srid, sorted(self.types))})
        self.writer.close()
        self.stream.close()


class GeoParquetWriter(DataSourceArrowWriter):
    """Each task writes its own files; only those of committed tasks become visible.

    Files are written under a hidden attempt folder with unique names and moved
    on commit, so retried and speculative tasks never clash. A task that outlives
    an aborted job can leave hidden files behind; readers skip such folders.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.target = options["path"]
        self.codec = options.get("compression", "snappy")
        self.partition_by = [c for c in options.get("partitioncolumns", "").split(",") if c]
        self.overwrite = overwrite
        self.attempt = f"_attempt-{uuid.uuid4().hex}"

    def _fs(self):
        return _filesystem(self.target)

    def _folder(self, values: list) -> str:
        return "/".join(f"{c}={_folder_value(v)}" for c, v in zip(self.partition_by, values))

    def write(self, iterator) -> _Written:
        fs, root = self._fs()
        files, current, open_file = [], None, None
        for batch in iterator:
            for (srid, *values), piece in self._pieces(batch):
                if open_file is None or [srid, *values] != current:
                    if open_file:
                        open_file.close()
                    current, folder = [srid, *values], self._folder(values)
                    name = f"part-{uuid.uuid4().hex}.parquet"
                    hidden = f"{root}/{self.attempt}/{folder}"
                    fs.create_dir(hidden, recursive=True)
                    open_file = _OpenFile(fs, f"{hidden}/{name}", piece.schema, self.codec, srid)
                    files.append((f"{hidden}/{name}", f"{folder}/{name}".lstrip("/")))
                open_file.add(piece)
        if open_file:
            open_file.close()
        return _Written(files)

    def _pieces(self, batch: pa.RecordBatch):
        """Runs of equal SRID and partition values, without those columns."""
        split_by = [SRID_COLUMN, *self.partition_by]
        rest = batch.drop_columns(split_by)
        columns = [batch.column(batch.schema.get_field_index(c)) for c in split_by]
        change = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
        for column in columns:
            codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            change |= codes[1:] != codes[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield tuple(c[start].as_py() for c in columns), rest.slice(start, end - start)

    def commit(self, messages) -> None:
        fs, root = self._fs()
        # what an overwrite replaces goes only when the new files stand
        old = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True)) if self.overwrite else []
        for message in messages:
            for hidden, final in message.files if message else []:
                fs.create_dir(f"{root}/{final}".rsplit("/", 1)[0], recursive=True)
                fs.move(hidden, f"{root}/{final}")
        for info in old:
            if info.type == pafs.FileType.File and f"/{self.attempt}/" not in info.path:
                fs.delete_file(info.path)
        self._drop_attempt(fs, root)

    def abort(self, messages) -> None:
        self._drop_attempt(*self._fs())

    def _drop_attempt(self, fs, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.attempt}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.attempt}")


class GeoParquetSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return SHORT_NAME

    def writer(self, schema, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(dict(self.options), overwrite)


def encoded(df: DataFrame, geom: str = "geom", srid: int | None = None) -> DataFrame:
    """Polygons as WKB ``geometry`` next to their ``bbox`` and SRID; another SRID than ``srid`` raises."""
    rings, own = F.col(f"{geom}.rings"), F.col(f"{geom}.srid")
    others = [c for c in df.columns if c not in (geom, "bbox", "geometry")]
    extent = F.col("bbox") if "bbox" in df.columns else bounds_struct(rings)
    return df.select(*others, extent.alias("bbox"), wkb_of_polygon(rings).alias("geometry"), _checked(own, srid))


def encoded_points(df: DataFrame, x: str, y: str, srid: int) -> DataFrame:
    """Points as WKB ``geometry`` next to their ``bbox`` and SRID."""
    others = [c for c in df.columns if c not in ("bbox", "geometry")]
    corners = F.struct(*(F.col(c).cast("double").alias(n) for c, n in ((x, "minx"), (y, "miny"), (x, "maxx"), (y, "maxy"))))
    return df.select(*others, corners.alias("bbox"), wkb_of_point(x, y).alias("geometry"), F.lit(srid).alias(SRID_COLUMN))


def _checked(own: Column, srid: int | None) -> Column:
    if srid is None:
        unknown = F.raise_error(F.lit("a geometry without an SRID: pass srid")).cast("int")
        return F.coalesce(own, unknown).alias(SRID_COLUMN)
    other = F.raise_error(F.concat(F.lit(f"expected SRID {srid}, found "), own.cast("string"))).cast("int")
    return F.when(own.isNull() | (own == srid), F.lit(srid)).otherwise(other).alias(SRID_COLUMN)


def write_geoparquet(
    df: DataFrame,
    path: str,
    srid: int | None = None,
    compression: str = "snappy",
    partition_by: list[str] | None = None,
    mode: str = "append",
    geom: str = "geom",
) -> None:
    """Write polygons with footers; each file gets rows of one SRID.

    With ``srid``, rows of another one raise. With ``partition_by``, rows are
    ordered by those columns first (ranges, so a crowded value is shared by
    several tasks).
    """
    _save(encoded(df, geom, srid), path, compression, partition_by, mode)


def write_geoparquet_points(
    df: DataFrame,
    path: str,
    srid: int,
    x: str = "x",
    y: str = "y",
    compression: str = "snappy",
    partition_by: list[str] | None = None,
    mode: str = "append",
) -> None:
    """The same for points in two columns."""
    _save(encoded_points(df, x, y, srid), path, compression, partition_by, mode)


def _save(rows: DataFrame, path: str, compression: str, partition_by: list[str] | None, mode: str) -> None:
    if compression not in CODECS:
        raise ValueError(f"compression is one of {CODECS}")
    if mode not in ("append", "overwrite"):
        raise ValueError("mode is append or overwrite")
    rows.sparkSession.dataSource.register(GeoParquetSink)
    if partition_by:
        spread = [*partition_by, F.col("bbox.minx"), F.col("bbox.miny")]
        rows = rows.repartitionByRange(*spread).sortWithinPartitions(*partition_by, SRID_COLUMN, *spread[-2:])
    else:
        rows = rows.sortWithinPartitions(SRID_COLUMN)
    (
        rows.write.format(SHORT_NAME)
        .mode(mode)
        .option("compression", compression)
        .option("partitioncolumns", ",".join(partition_by or []))
        .save(path)
    )


def _plain_path(path: Column) -> Column:
    """Local paths come with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "/")


def _decoded(path: Column) -> Column:
    """The path in ``_metadata``, which is escaped as a URL; a plus sign is not."""
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


def _with_srid(spark: SparkSession, path: str, srid: int | None) -> tuple[DataFrame, Column]:
    """The rows below a path, and each row's SRID: given, or from its file's footer."""
    raw = spark.read.parquet(path)
    if srid is not None:
        return raw, F.lit(srid)
    known = footers(spark, path).select(_plain_path(F.col("path")).alias("__path"), F.col("srid").alias(SRID_COLUMN))
    codes = [row[0] for row in known.select(SRID_COLUMN).distinct().limit(2).collect()]
    if None in codes or not codes:
        raise ValueError(f"a file without {FOOTER_KEY} footer below {path}; pass srid")
    if len(codes) == 1:
        return raw, F.lit(codes[0])
    # one row per file
    located = raw.withColumn("__path", _plain_path(_decoded(F.col("_metadata.file_path"))))
    lost = F.raise_error(F.concat(F.lit("no footer found for "), F.col("__path"))).cast("int")
    met = located.join(known, "__path", "left").withColumn(SRID_COLUMN, F.coalesce(SRID_COLUMN, lost))
    return met.drop("__path"), F.col(SRID_COLUMN)


def read_geoparquet(spark: SparkSession, path: str, srid: int | None = None) -> DataFrame:
    """All columns with ``geom`` in place of the WKB; only decoded when selected.

    The SRID is that of each row's file, unless it is given.
    """
    raw, code = _with_srid(spark, path, srid)
    geom = tagged(polygon_of_wkb("geometry"), code)
    return raw.withColumn("geom", geom).drop("geometry", SRID_COLUMN)


def read_geoparquet_points(spark: SparkSession, path: str, srid: int | None = None) -> DataFrame:
    """All columns with ``x``, ``y`` and ``srid`` in place of the WKB of points."""
    raw, code = _with_srid(spark, path, srid)
    placed = raw.withColumn("srid", code).withColumn("__point", point_of_wkb("geometry"))
    return placed.withColumns({"x": F.col("__point.x"), "y": F.col("__point.y")}).drop("geometry", "__point", SRID_COLUMN)


def _read_footers(frames):
    import pandas as pd

    for frame in frames:
        rows = []
        for path in frame["path"]:
            fs, inner = _filesystem(path)
            with fs.open_input_file(inner) as stream:
                meta = pq.ParquetFile(stream).metadata
            text = (meta.metadata or {}).get(FOOTER_KEY.encode())
            geo = json.loads(text) if text else None
            column = geo["columns"][geo["primary_column"]] if geo else {}
            crs = column.get("crs")
            code = None if geo is None else 4326 if crs is None else crs.get("id", {}).get("code")
            box = column.get("bbox") or [None] * 4
            rows.append((path, meta.num_rows, code, *box, text.decode() if text else None))
        yield pd.DataFrame(rows, columns=["path", "n_rows", "srid", "minx", "miny", "maxx", "maxy", "geo"])


def footers(spark: SparkSession, path: str) -> DataFrame:
    """Row count, SRID and extent of each file from its footer, without a data scan."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    schema = (
        "path string, n_rows bigint, srid int, minx double, miny double, maxx double, maxy double, geo string"
    )
    return files.mapInPandas(_read_footers, schema)
