"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Every stage works on all that its predecessor kept. Null and empty texts pass the filtering stages
(nothing is wrong with them) and fill no place in a sequence; repeated rows are copies, of which one row
stays; columns besides doc_id and text are carried along; an empty table gives an empty plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import load, stored
from pairloom.llm.decontaminate import decontaminated
from pairloom.llm.jaccard import jaccard_components
from pairloom.llm.line_templates import without_recurring_lines
from pairloom.llm.packing import packed_plan, with_word_counts
from pairloom.llm.toxicity import THRESHOLD, fit_toxicity, labelled_sample, toxicity_scores
from pairloom.session import broadcast_if, fits_broadcast

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the network learns from all labels."""
    model = fit_toxicity(labelled_sample(docs, load(spark, sf_dir, "labels")))
    return toxicity_scores(docs, model).where(F.col("_score") < THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones have; those of which nothing is left go."""
    cleaned = without_recurring_lines(docs)
    kept = cleaned.where("kept_words > 0 OR words = 0 OR words IS NULL").select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents, that of the smallest id; five-word shingles link at 0.8.

    A repeated row of an id stays once; other texts of the same id stay, and so do rows without an id.
    """
    placed = jaccard_components(docs, width=5, percent=80)
    leads = F.max(F.col("doc_id") == F.col("component_id")).alias("leads")
    gone = few(placed.groupBy("doc_id").agg(leads).where("NOT leads").select("doc_id"), "gone")
    kept = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti").unionByName(docs.where("doc_id IS NULL"))
    repeats = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    repeats = few(repeats, "repeats")
    if repeats.isEmpty():
        return kept.select(*docs.columns)
    single = kept.join(repeats, "doc_id", "left_anti")
    double = kept.join(repeats, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(double).select(*docs.columns)


def few(ids: DataFrame, label: str) -> DataFrame:
    """Ids of what is the smaller part of a table: sent to its rows while they fit a broadcast, as its texts need not move then."""
    ids = stored(ids, label)
    return broadcast_if(ids, fits_broadcast(ids.count(), 0))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no item of the benchmark, whatever their id."""
    return decontaminated(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept word in a training sequence of a permitted length."""
    return packed_plan(with_word_counts(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: Trained models, similarity links and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
