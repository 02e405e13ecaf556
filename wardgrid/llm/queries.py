"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, mixing, quality, spelling
from .arrow_ids import arrow_ids
from .decontaminate import contaminated_documents
from .html_extract import extract
from .hyperminhash import near_duplicates
from .language import identify
from .packing import pack
from .oracles import CENTROID_SQL, MIXING_SQL, SPELLING_SQL
from .simhash import edited_fingerprints
from .suffix_dedup import suffix_dedup
from .window_dedup import window_dedup
from .workers import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(importable(spark), sf_dir)
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


@_query
def op2_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op3_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = quality.score(docs.select("doc_id", "text"), labels, learn=quality.LEARN)
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted")


@_query
def op4_recurrent_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


@_query
def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup(_table(spark, sf_dir, "documents"))


@_query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def _remainder(of: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % of


@_query
def op8_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(_table(spark, sf_dir, "documents"), learn="crc32(cast(doc_id as string)) % 4 <> 2")
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@_query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@_query
def op10_arrow_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_ids(_table(spark, sf_dir, "documents"))


@_query
def op11_gram_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(_table(spark, sf_dir, "documents")))


@_query
def op12_capped_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


@_query
def op13_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    found = found.select("cluster", "cluster_inertia", "inertia", centroids.digest("components").alias("centroid_sha256"))
    return assigned.withColumnRenamed("id", "vec_id").join(F.broadcast(found), "cluster")  # as many rows as centroids


ORACLES |= {"op11_gram_spelling": SPELLING_SQL, "op12_capped_mixing": MIXING_SQL, "op13_orchard_clusters": CENTROID_SQL}
