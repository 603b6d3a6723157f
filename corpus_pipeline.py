"""From raw documents to training tokens, in four stages.

Every stage works on all that its predecessor kept. Between stages the documents are
written as Parquet to the shared scratch folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import anti, bounded_batches, kept, row_key, small, table
from tillstream.llm.decontamination import judged
from tillstream.llm.language_id import UNKNOWN, identify, learn
from tillstream.llm.minhash_dedup import near_duplicates
from tillstream.llm.pieces import encode, load_vocabulary

# A document stays if its best language is at least so probable.
LEAST_SCORE = 0.35


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told from their text; others, and texts without letters, go.

    The network learns from the labelled documents of the corpus itself.
    """
    bounded_batches(spark)
    guessed = identify(docs.select(F.struct(*docs.columns).alias("row"), "text"), learn(docs))
    sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return guessed.filter(sure).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Where ids repeat, every text of an id is judged as a document of its own, and one row of
    each group stays. Rows without an id are nobody's copy and stay.
    """
    counts = docs.filter("doc_id is not null").groupBy("doc_id").count()
    if counts.filter("count > 1").isEmpty():
        groups = near_duplicates(docs)
        gone = kept(groups.filter("doc_id is not null and not kept").select("doc_id"), "copies")
        return anti(docs, gone, ["doc_id"])
    # Texts get numbers, which are sound ids.
    texts = docs.filter("doc_id is not null").select(*row_key(), "text").dropDuplicates(["id", "h"])
    texts = kept(texts.withColumn("number", F.monotonically_increasing_id()), "numbered-texts")
    groups = near_duplicates(texts, "number").select(F.col("doc_id").alias("number"), "component_id")
    first = texts.select("number", "id", "h").join(groups, "number").groupBy("component_id")
    first = kept(first.agg(F.min(F.struct("id", "h")).alias("first")).select("first.*"), "first-texts")
    row = F.struct(*docs.columns).alias("row")
    few = F.broadcast(first) if small(first) else first
    stay = docs.filter("doc_id is not null").select(row, *row_key()).join(few, ["id", "h"], "left_semi")
    one = stay.groupBy("id", "h").agg(F.min("row").alias("row")).select("row.*")
    return docs.filter("doc_id is null").unionByName(one)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands.

    Rows are judged by their text, so rows that repeat an id are told apart by it.
    """
    found = judged(docs, table(spark, sf_dir, "benchmark"))
    dirty = kept(found.filter("contaminated").select("id", "h").distinct(), "contaminated")
    row = F.struct(*docs.columns).alias("row")
    named = docs.select(row, *row_key())
    return anti(named, dirty, ["id", "h"]).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``n_tokens`` of every document."""
    coded = encode(docs, load_vocabulary())
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language ID", known_language),
    ("near-duplicates", one_of_each_group),
    ("decontamination", uncontaminated),
    ("SentencePiece", tokens),
]

# The first stage is a trained network, the last a lattice: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; a row for each document that stays."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
