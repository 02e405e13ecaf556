"""From raw documents to packed sequences: filter, near-duplicates, substrings, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a DataFrame; ``run`` writes
every stage as Parquet in the shared folder and reads it again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgrid.llm import decontaminate, hyperminhash, packing, quality, repeats, window_dedup
from wardgrid.llm.repeats import staged
from wardgrid.llm.workers import importable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle in the near-duplicate stage.
SHINGLE = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; unlabelled ones are judged alike.

    Null and empty texts get the score of the intercept, equal texts the same decision; without any label all stay; other
    columns than those of documents go."""
    labels = _table(importable(spark), sf_dir, "labels")
    return quality.score(docs.select(COLUMNS), labels, learn=quality.LEARN).where("predicted = 1").select(COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the least doc_id, one without doc_id only if all lack it; of rows equal in
    doc_id and text the first by the other columns. Texts without words all stay."""
    importable(spark)
    kept = staged(hyperminhash.representatives(docs, shingle=SHINGLE), "kept").toDF("_doc", "_mark")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    docs = docs.select(COLUMNS)
    own = docs.where(has_words).withColumns(dict(zip(("_doc", "_mark"), repeats._identity()[:2], strict=True)))
    # the rank is cut in every map task before the shuffle, so many equal rows do not meet
    equal = Window.partitionBy("_doc", "_mark").orderBy("lang", "source", "n_chars")
    first = own.withColumn("_rank", F.row_number().over(equal)).where("_rank = 1")
    return first.join(kept, ["_doc", "_mark"], "left_semi").select(COLUMNS).unionByName(docs.where(~has_words))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated windows; a changed text has its words joined by one space."""
    importable(spark)
    found = window_dedup.window_dedup(docs.select(COLUMNS), with_text=True)
    changed = F.col("n_removed") > 0
    return found.withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    ).select(COLUMNS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Null and empty texts, and all documents where there is no item, stay; equal rows share their fate."""
    return decontaminate.clean(docs.select(COLUMNS), _table(importable(spark), sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences. A null or empty text is one closing id; each of equal rows has its own place; an
    empty table gives no rows."""
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("benchmark_decontamination", remove_benchmark),
    ("best_fit_packing", pack_sequences),
]

#: Stages that learn a model and tokenise cannot be put as SQL; a test compares ``run`` with plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again. Extra columns of documents are left behind by the first stage."""
    docs = _table(importable(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
