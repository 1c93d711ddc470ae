"""The registered queries of the operators in this folder, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.llm.exact_dedup import exact_dedup_files
from parcelgrid.llm.licences import scan
from parcelgrid.llm.line_dedup import line_classes
from parcelgrid.llm.manifest import tamper_check
from parcelgrid.llm.mixing import mix
from parcelgrid.llm.oracles import ORACLES as ORACLES
from parcelgrid.llm.packing import pack
from parcelgrid.llm.repetition import repetition
from parcelgrid.llm.simhash import near_duplicates
from parcelgrid.llm.token_cache import token_counts
from parcelgrid.llm.topk import top_k
from parcelgrid.llm.toxicity import toxicity
from parcelgrid.llm.url_filter import judge
from parcelgrid.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed along a Hilbert curve; the pieces without their ids."""
    return pack(table(spark, sf_dir, "documents")).drop("ids")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with its fuzzy class."""
    return line_classes(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return judge(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document, by the targets of the sources."""
    return mix(table(spark, sf_dir, "documents"))


def op8_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, through a cache that starts out empty."""
    return token_counts(table(spark, sf_dir, "documents"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notice in every document."""
    return scan(table(spark, sf_dir, "documents"))


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    return repetition(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the first four whitened components."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and whether the tampered table still gives the root."""
    return tamper_check(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text, by keyed streaming state."""
    return exact_dedup_files(spark, f"{sf_dir}/documents.parquet")


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_topk,
        op3_line_dedup,
        op4_toxicity,
        op5_simhash,
        op6_url_filter,
        op7_mixing,
        op8_token_cache,
        op9_licences,
        op10_repetition,
        op11_whitening,
        op12_manifest,
        op13_exact_dedup,
    )
}
