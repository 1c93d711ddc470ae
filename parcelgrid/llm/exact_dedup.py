"""Exact dedup as a stateful stream, in DataFrame operations throughout.

Two streams run over the content, one after the other, until all of it is read.
The first turns each row into its digest, its identifier and its content
locator (file and row number) and appends them to a narrow table. The second
keeps state keyed by digest, on disk in RocksDB and without expiry: the place
of the row that stays so far (its length, identifier and locator) and the size
of the group. Copies fold into one row per task before they are shuffled, so a
text that makes up a third of all rows is no hot key. Both streams remember
what they have read; given the same ``folder`` again, only new files are read
and meet the state of the earlier ones.

A hit is a digest seen twice. The texts of all hits are fetched by locator and
compared with the text of the row that stays, byte for byte. Equal texts of a
group are folded in the task that reads them. If texts differ under one digest,
their rows are grouped anew by digest and text, so no result rests on the digest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.llm.scratch import Kept
from parcelgrid.session import register, shared_path

#: The characters deleted before texts are compared.
BLANKS = "[ \t\n\u000b\f\r]"
#: Bytes of files in one micro-batch.
BATCH_BYTES = 64 << 30
#: Locators and retained rows, of some 200 bytes, are broadcast up to so many; beyond, they are joined by shuffle.
BROADCAST_ROWS = 100_000
#: A group with more than one in so many of all rows is met by broadcast: there are never more such groups than this.
HOT_SHARE = 1000
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # no disk is set aside for logs: a store may be small, and there is one per partition
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without blanks, null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def locator() -> list[Column]:
    """``file, row``: where a row's content is. Streams and tables spell the path's scheme differently."""
    return [
        F.regexp_replace("_metadata.file_path", "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ]


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """A block in which streams keep their state in RocksDB."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stream(spark: SparkSession, path: str, schema: T.StructType, batch_bytes: int) -> DataFrame:
    """A stream over the Parquet files at ``path``, a folder or one file."""
    path = path.rstrip("/")
    # a pattern for the path itself: streams take a plain path for a folder
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(f"{path[:-1]}[{path[-1]}]")


def located(content: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, file, row``."""
    return content.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *locator())


def digested(content: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """``id, length, file, row, digest`` of ``id, text, file, row``."""
    length = F.coalesce(F.char_length("text"), F.lit(0)).alias("length")
    return content.select("id", length, "file", "row", digest(normalised(F.col("text"))).alias("digest"))


def place() -> Column:
    """Least for the row that stays: the longest original, then the smallest id, nulls last, then the first place."""
    return F.struct((-F.col("length")).alias("shortness"), F.col("id").isNull().alias("unnamed"), "id", "file", "row")


def absorb(
    content: DataFrame, folder: str, digest: Callable[[Column], Column], batch_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """Run both streams to the end of ``content``, a stream: the digests of all rows, and the state."""
    spark = content.sparkSession
    rows_at, state_at = f"{folder}/digests", f"{folder}/state"
    rows = digested(content, digest)
    first = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/digesting")
    first.trigger(availableNow=True).start(rows_at).awaitTermination()
    with disk_state(spark):
        # by its plain path the table is read as the first stream's log of it says
        seen = spark.readStream.schema(rows.schema).option("maxBytesPerTrigger", batch_bytes).parquet(rows_at)
        groups = seen.groupBy("digest").agg(F.min(place()).alias("best"), F.count("*").alias("n"))
        second = groups.writeStream.outputMode("update").format("noop").option("checkpointLocation", state_at)
        second.trigger(availableNow=True).start().awaitTermination()
        state = spark.read.format("statestore").load(state_at)
        best = [F.col(f"value.min.{c}").alias(f"keep_{c}") for c in ("id", "file", "row")]
        retained = Kept(state.select("key.digest", *best, F.col("value.count").alias("n")), "retained").df
    return spark.read.schema(rows.schema).parquet(rows_at), retained


def joined(rows: DataFrame, side: DataFrame, on: list[str], hot: Column | None = None) -> DataFrame:
    """The rows with those of ``side``, which has each key once; the hot keys, a bounded few, are broadcast."""
    if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(side), on)
    if hot is None:
        return rows.join(side, on)
    crowded = F.broadcast(side.filter(hot))
    others = rows.join(crowded.select(*on), on, "left_anti").join(side.filter(~hot), on)
    return rows.join(crowded, on).unionByName(others)


def differing(content: DataFrame, rows: DataFrame, retained: DataFrame, hot: Column) -> DataFrame:
    """``digest``: those under which some text is not that of the row that stays, from the texts of all hits."""
    own = ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("own")
    hits = joined(rows.select("digest", "file", "row"), retained.filter("n > 1"), ["digest"], hot)
    hits = Kept(hits.select("file", "row", "digest", own), "hits").df
    texts = joined(content.select("text", "file", "row"), hits, ["file", "row"])
    distinct = texts.groupBy("digest", normalised(F.col("text")).alias("content")).agg(F.max("own").alias("own"))
    return distinct.filter("NOT own").select("digest").distinct()


def regrouped(content: DataFrame, rows: DataFrame, digests: DataFrame) -> DataFrame:
    """``id, digest, file, row, keep_id, keep_file, keep_row, n`` of the rows under the digests, grouped by text."""
    places = joined(rows, digests, ["digest"])
    whole = places.join(content.select("text", "file", "row"), ["file", "row"])
    whole = Kept(whole.withColumn("content", normalised(F.col("text"))).drop("text"), "collided").df
    groups = whole.groupBy(F.col("digest").alias("of"), F.col("content").alias("its")).agg(
        F.min(place()).alias("best"), F.count("*").alias("n")
    )
    best = [F.col(f"best.{c}").alias(f"keep_{c}") for c in ("id", "file", "row")]
    return whole.join(groups.select("of", "its", *best, "n"), (F.col("digest") == F.col("of")) & (F.col("content") == F.col("its")))


def exact_dedup_files(
    spark: SparkSession,
    path: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``, one row per row of the Parquet table at ``path``.

    Texts are equal if they are after all blanks are deleted; null counts as
    empty. Of each group the row with the most code points stays, then the one
    with the smallest id, null ids last, then the first by file and row: of
    repeated rows one is kept. An empty table gives no rows, other columns are
    not read. ``folder``, in shared storage, holds the state and is new if not
    given; with the same one again, files added to ``path`` meet what is there.
    Files once read must stay as they are.
    """
    folder = folder or register(shared_path(spark, "exact-dedup"))
    types = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(c, types[c].dataType) for c in (id_col, text_col)])
    rows, retained = absorb(located(stream(spark, path, schema, batch_bytes), id_col, text_col), folder, digest, batch_bytes)
    content = located(spark.read.schema(schema).parquet(path), id_col, text_col)
    hot = F.col("n") > rows.count() / HOT_SHARE
    found = ["id", "digest", "file", "row", "keep_id", "keep_file", "keep_row", "n"]
    collided = Kept(differing(content, rows, retained, hot), "collided-digests").df
    if collided.isEmpty():
        met = joined(rows, retained, ["digest"], hot).select(found)
    else:
        alone = retained.join(collided, "digest", "left_anti")
        met = joined(rows, alone, ["digest"], hot).select(found).unionByName(regrouped(content, rows, collided).select(found))
    return met.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: object) -> DataFrame:
    """The same for any ``docs``, whose ids and texts are first written to the shared folder."""
    staged = Kept(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), "content")
    return exact_dedup_files(docs.sparkSession, staged.path, id_col="id", text_col="text", **how).withColumnRenamed("id", id_col)
