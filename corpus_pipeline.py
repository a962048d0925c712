"""A training corpus from raw documents: five stages, each written before the next reads it.

1. Documents that the quality classifier rejects go.
2. Passages of several lines that were seen before are cut; documents of which
   nothing is left go.
3. Of near duplicates (five-word shingles, similarity 0.8) one stays.
4. The rest is put in the order of the mixture of sources.
5. Each document becomes piece ids, with its place in that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm import line_dedup, mixing, pieces, quality, set_join
from offhours.llm.shared import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand elsewhere before; emptied ones go."""
    cut = line_dedup.dedup_lines(docs, grow=True)
    emptied = (F.col("cut.n_removed") > 0) & ~F.col("text").rlike(r"\S")
    return cut.where(~F.coalesce(emptied, F.lit(False))).drop("cut")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return set_join.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; the files, one after the other, are in the order of the mixture."""
    return mixing.interleaved(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids``, ``n_ids``, ``lossless``, and ``slot`` and ``start``, which sort to the mixture.

    Both are read off the files of the stage before: ``slot`` is a document's number in
    them, ``start`` its first byte among those of its source.
    """
    placed = mixing.in_file_order(docs)
    return pieces.encode(placed.select("doc_id", "text", "mix.slot", "mix.start"), kept=("slot", "start"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", cut_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("source mixing", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

# Training, scheduling and encoding are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
