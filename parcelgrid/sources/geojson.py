"""GeoJSON as splittable text.

One big FeatureCollection is usually a single line. Splitting the text at the
literal that starts each feature lets many tasks read one file, each handling
only its own split, so memory does not grow with the file. The literal is taken
from the start of the text. Nothing is skipped unseen: text that is neither a
feature nor the frame of a collection ends the read with an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions.crs import WGS84
from parcelgrid.functions.ring import bounds_struct
from parcelgrid.functions.wkt import coordinates_of_polygon, polygon_of_coordinates, tagged

# The geometry types' coordinates, and patterns of the format's own text.
_COORDINATES = {"polygon": "array<array<array<double>>>", "point": "array<double>"}
TYPE_FIRST = r'"features"\s*:\s*\[\s*(\{\s*"type"\s*:\s*"Feature"\s*,\s*)'
IS_FEATURE = r'"type"\s*:\s*"Feature"\s*[,}]'
HEADER = r'(?s)^\s*\{.*"features"\s*:\s*\[\s*$'
FRAME = r'^\s*([{}\[\],\s]*|.*"features"\s*:\s*\[|"[^"]+"\s*:.*)\s*$'
NAMES_FEATURE = r'"type"\s*:\s*"Feature"'

#: Pieces of a file's start that are looked at to tell its layout.
SNIFFED_PIECES = 32


def feature_schema(properties: T.StructType | str, geometry: str = "polygon") -> T.StructType:
    if isinstance(properties, str):
        properties = T.StructType.fromDDL(properties)
    shape = T.StructType.fromDDL(f"type string, coordinates {_COORDINATES[geometry]}")
    return (
        T.StructType()
        .add("type", T.StringType())
        .add("id", T.StringType())
        .add("properties", properties)
        .add("geometry", shape)
    )


def decoded(features: DataFrame, srid: int, geometry: str) -> DataFrame:
    """Attributes and geometry columns of parsed features in column ``f``."""
    attributes = features.schema["f"].dataType["properties"].dataType.names
    kept = [F.col(f"f.properties.{name}").alias(name) for name in attributes]
    coordinates = F.col("f.geometry.coordinates")
    if geometry == "point":
        shape = [
            F.get(coordinates, F.lit(0)).alias("x"),
            F.get(coordinates, F.lit(1)).alias("y"),
            F.lit(srid).alias("srid"),
        ]
        return features.select(F.col("f.id").alias("feature_id"), *kept, *shape)
    rings = F.when(coordinates.isNotNull(), polygon_of_coordinates(coordinates))
    return features.select(
        F.col("f.id").alias("feature_id"), *kept, tagged(rings, srid).alias("geom")
    ).withColumn("bbox", bounds_struct(F.col("geom.rings")))


def _parsed(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, schema, {"mode": "FAILFAST"}).alias("f")


def _foreign(text: Column) -> Column:
    """An error that shows the text that could not be placed."""
    return F.raise_error(F.concat(F.lit("not a feature or the frame of a collection: "), F.substring(text, 1, 200)))


def json_values(text: str) -> Iterator[str]:
    """The JSON values that follow each other in a text; anything else raises."""
    decoder, blanks, at = json.JSONDecoder(), re.compile(r"\s*"), 0
    while (at := blanks.match(text, at).end()) < len(text):
        try:
            _, end = decoder.raw_decode(text, at)
        except json.JSONDecodeError as error:
            raise ValueError(f"not a feature or the frame of a collection: {text[at : at + 200]}") from error
        yield text[at:end]
        at = end


@F.arrow_udf(T.ArrayType(T.StringType()))
def documents(texts: pa.Array) -> pa.Array:
    """A file's documents: several may follow each other, where ``from_json`` would read the first."""
    return pa.array([list(json_values(text.as_py())) for text in texts], pa.list_(pa.string()))


def layout_of_start(start: str) -> tuple[str, str | None]:
    """(layout, prefix) of a text that starts like this."""
    found = re.search(TYPE_FIRST, start)
    if found:
        return "collection", found.group(1)
    first_line = next((line for line in start.split("\n") if line.strip()), "")
    if re.search(IS_FEATURE, first_line) and '"features"' not in first_line:
        return "lines", None
    return "document", None


def sniff(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """(layout, prefix) from the first characters of one file below ``path``.

    A feature that does not start with its type has no literal to split at, so
    such a collection is a document. Files of another layout beside that one
    are not read as something else: they raise.
    """
    pieces = (
        spark.read.option("lineSep", "{").text(path)
        .select(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"), "value")
        .where("start = 0")
        .limit(SNIFFED_PIECES)
        .collect()
    )
    own = [piece.value for piece in pieces if piece.file == pieces[0].file]
    return layout_of_start("{".join(own) + "{") if own else ("lines", None)


def text_options(layout: str, prefix: str | None) -> dict[str, str]:
    """How Spark's text source cuts files of a layout."""
    if layout == "collection":
        return {"lineSep": prefix}
    return {"wholetext": "true"} if layout == "document" else {}


def features_of(texts: DataFrame, schema: T.StructType, layout: str) -> DataFrame:
    """Parsed features ``f`` of text cut for the layout, in batches or streams."""
    value = F.col("value")
    if layout == "collection":
        # what precedes the first feature of a file must be a header and nothing else
        header = value.rlike(HEADER) & ~value.rlike(NAMES_FEATURE)
        framed = ~header & (F.trim(value) != "")
        whole = F.when(value.rlike(NAMES_FEATURE), _foreign(value).cast("string")).otherwise(
            F.concat(F.lit('{"type":"Feature",'), value)
        )
        return texts.where(framed).select(_parsed(whole, schema))
    if layout == "lines":
        is_feature = value.rlike(IS_FEATURE) & value.rlike(r"^\s*\{")
        framing = value.rlike(FRAME) & ~value.rlike(NAMES_FEATURE)
        kept = F.when(is_feature, F.lit(True)).when(framing, F.lit(False)).otherwise(_foreign(value).cast("boolean"))
        parsed = texts.where(kept).select("value", _parsed(value, schema))
        own = F.col("f.type") == "Feature"
        return parsed.where(F.when(own, F.lit(True)).otherwise(_foreign(value).cast("boolean"))).select("f")
    if layout == "document":
        whole = T.StructType().add("features", T.ArrayType(schema))
        each = texts.where(F.trim(value) != "").select(F.explode(documents(value)).alias("value"))
        parsed = each.select("value", _parsed(value, whole).alias("whole"))
        listed = F.when(F.col("whole.features").isNull(), _foreign(value).cast(T.ArrayType(schema))).otherwise(
            F.col("whole.features")
        )
        return parsed.select(F.explode(listed).alias("f"))
    raise ValueError(f"unknown layout {layout}")


def read_geojson(
    spark: SparkSession,
    path: str,
    properties: T.StructType | str,
    layout: str | None = None,
    srid: int = WGS84,
    geometry: str = "polygon",
    prefix: str | None = None,
) -> DataFrame:
    """Features as rows: ``feature_id``, the properties, geometry (and ``bbox``).

    ``layout`` says how features lie in the text; None takes it from the start:

    - ``collection``: anywhere, each starting with the literal ``prefix``; splittable
    - ``lines``: one per line, with or without enclosing collection; splittable
    - ``document``: any other JSON, also several documents in a file; one task per file
    """
    if layout is None or layout == "collection" and prefix is None:
        found, literal = sniff(spark, path)
        layout, prefix = (found, literal) if layout is None or found != "lines" else (layout, literal)
        if layout == "collection" and prefix is None:
            raise ValueError(f"no feature collection below {path}")
    schema = feature_schema(properties, geometry)
    texts = spark.read.format("text").options(**text_options(layout, prefix)).load(path)
    return decoded(features_of(texts, schema, layout), srid, geometry)


def feature_text(feature_id: Column, properties: list[str], coordinates: Column, kind: str = "Polygon") -> Column:
    """One GeoJSON feature."""
    geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            feature_id.cast("string").alias("id"),
            F.struct(*properties).alias("properties"),
            F.when(coordinates.isNotNull(), geometry).alias("geometry"),
        ),
        {"ignoreNullFields": "false"},
    )


def write_geojson(
    df: DataFrame,
    path: str,
    feature_id: str,
    properties: list[str],
    rings: str = "geom.rings",
    mode: str = "error",
    compression: str = "none",
) -> None:
    """One feature per line (a feature sequence), so it splits on re-reading."""
    text = feature_text(F.col(feature_id), properties, coordinates_of_polygon(F.col(rings)))
    df.select(text.alias("value")).write.mode(mode).option("compression", compression).text(path)
