"""Token counts through a digest cache.

A text's key is the MD5 of its normalised content together with the digest of
the tokenizer file, so another version of the tokenizer never reads old counts.
Texts are reduced to their keys, keys are joined to the stored counts, and only
the texts of keys found nowhere are read, encoded once each, and appended.

The misses travel by key. Before that shuffle each task lets a key pass once
only, so a text that makes up a third of all rows is sent once per task; the
counts of such keys come back to their rows by broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import sentencepiece
from public_tokenizers import path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelgrid.llm.hot import joined, small
from parcelgrid.llm.scratch import Kept
from parcelgrid.llm.texts import slices
from parcelgrid.session import register, shared_path

COUNTS = "digest string, n_tokens long, version string"


@cache
def version(file: str) -> str:
    """The digest of a tokenizer's file."""
    with open(path(file), "rb") as stream:
        return hashlib.sha256(stream.read()).hexdigest()


@cache
def counter(file: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole texts by the file's library; one per Python worker."""
    if file.endswith(".model"):
        pieces = sentencepiece.SentencePieceProcessor(model_file=path(file))
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    tokenizer = Tokenizer.from_file(path(file))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def normalised(text: Column) -> Column:
    """Null as the empty text. No more is safe: tokenizers tell apart what other rules would fold."""
    return F.coalesce(text.cast("string"), F.lit(""))


def digest(text: Column) -> Column:
    return F.md5(normalised(text).cast("binary"))


def once_per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each digest in a task."""
    seen: set[str] = set()
    for batch in batches:
        rows = []
        for row, key in enumerate(batch.column("digest").to_pylist()):
            if key not in seen:
                seen.add(key)
                rows.append(row)
        if rows:
            yield batch.take(pa.array(rows))


def encode_misses(texts: DataFrame, missing: DataFrame, file: str) -> DataFrame:
    """``digest, n_tokens`` of each missing digest, its text taken from ``digest, text``."""
    alone = texts.mapInArrow(once_per_task, texts.schema)
    if small(missing):
        by_key = alone.join(F.broadcast(missing), "digest", "left_semi").repartition("digest")
    else:  # the join deals the texts out by digest itself
        by_key = alone.join(missing, "digest", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in once_per_task(batches):
            for part in slices([batch], "text"):
                counts = counter(file)(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return by_key.mapInArrow(count, "digest string, n_tokens long")


def stored_counts(spark: SparkSession, folder: str, file: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer: its own part of the cache."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    every = spark.read.schema(COUNTS).parquet(folder)
    return every.filter(F.col("version") == version(file)).select("digest", "n_tokens")


def token_counts(
    docs: DataFrame,
    cache_path: str | None = None,
    tokenizer: str = "piece_bpe_32k.model",
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit``, one row per row of ``docs``.

    Counts are read from the Parquet table at ``cache_path``, a folder per
    tokenizer version, and those missing are appended to it; without a path the
    cache starts out empty. Only digests meet the cache: texts are read again for
    the missing ones, and if none is missing no text is shuffled. A null text
    is the empty one, whose count the library gives as well. Equal texts share
    one count, an empty table appends and gives nothing, other columns are not
    looked at. Writers at the same time may append a key twice, with one count.
    """
    spark = docs.sparkSession
    folder = cache_path or register(shared_path(spark, "token-cache"))
    text = docs[text_col]
    length = F.octet_length(normalised(text)).cast("long")
    keys = Kept(docs.select(docs[id_col].alias("id"), length.alias("n_bytes"), digest(text).alias("digest")), "keys").df
    groups = Kept(keys.groupBy("digest").agg(F.count("*").alias("n")), "digests").df
    missing = Kept(groups.select("digest").join(stored_counts(spark, folder, tokenizer), "digest", "left_anti"), "missing")
    if not missing.df.isEmpty():
        texts = docs.select(digest(text).alias("digest"), normalised(text).alias("text"))
        found = Kept(encode_misses(texts, missing.df, tokenizer), "misses")
        found.df.withColumn("version", F.lit(version(tokenizer))).write.partitionBy("version").mode("append").parquet(folder)
        found.drop()
    missing.drop()
    counts = stored_counts(spark, folder, tokenizer).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    counts = Kept(counts.join(groups, "digest"), "counts").df
    return joined(keys, counts, ["digest"], F.col("n"), keys.count()).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
