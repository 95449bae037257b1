"""The corpus pipeline: quality rules, quality classifier, near-duplicates, benchmark decontamination, packing.

Defined cases. Stages read `doc_id` and `text` alone and carry every other column along, whatever its name, up to packing, which returns
pieces. NULL, empty and very short texts fail the base rule of the quality rules and go there. Very long texts are used whole.
Rows with the same id and text are one document after the near-duplicates; of a group the smallest id stays, so ties do not
depend on order. Rows without an id are linked with nothing and kept until packing. Without labels the models keep what
the base rules keep, and the classifier's score is 0.5; without benchmark items nothing is contaminated; without documents the result is
empty, with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import decontaminate, minhash, nb_svm, packing, quality_trees
from fleetlens.llm.common import stored, table
from fleetlens.llm.queries import tokenizer_path

# Five words and a similarity of 0.8; at that similarity a link meets in none of 68 bands of 7 with a chance of 1e-7.
NEAR = minhash.Rule(words=5, percent=80, bands=68, rows=7)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the trees are fitted on labelled rows of the whole table."""
    return quality_trees.keep_good(docs, quality_trees.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good.

    It is fitted on labelled rows of the whole table: few bad ones are left among those that the rules kept.
    """
    return nb_svm.keep_good(docs, nb_svm.fit_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.one_of_each(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

# SQL cannot express the fitted models and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
