"""From raw documents to packed training sequences: five stages, each a table that the next one reads.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of documents; the last returns the packed pieces.

In every stage null texts and empty ones stay what they are, very long texts are worked on
whole, equal rows are judged alike, extra columns are dropped by no stage but the last, and an
empty table gives an empty one. What else differs from stage to stage is said there.

Scratch tables of a stage are deleted when the next stage begins: a stage's
result must have been written by then, as run() does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import decontamination, jaccard, packing, substrings, toxicity
from cellspark.llm.common import read, release, scope, scratch_path, table
from cellspark.llm.encoding import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    def work(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "pipeline")
        with scope("pipeline"):
            return f(spark, docs, sf_dir)

    return work


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score toxicity.BAR or more go; the model learns from the labels of the documents outside the held-out fold.

    Null and empty texts have the score of a text without features. Without labels all documents stay. Rows with a null doc_id
    are scored, never learned from.
    """
    model = toxicity.train(docs.filter(~toxicity.held_out(F.col("doc_id"))), read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more, directly or not, the one with the smallest doc_id stays.

    Null and empty texts are one group. Of repeated rows one stays; rows with one doc_id and several texts are
    told apart. Rows with a null doc_id stay: they are compared with nothing.
    """
    return jaccard.keep_one(docs).select(docs.columns)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that an earlier document has, too, are cut out; n_chars follows.

    A document of which nothing is left stays, with an empty text. Null texts stay null, texts shorter than a window as they are;
    documents with one doc_id are not each other's predecessors. Rows with a null doc_id stay whole.
    """
    return substrings.dedup_substrings(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


@stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which an item of the benchmark occurs go.

    Null and empty texts, and null or blank items, match nothing. Each row is judged by its own text, whatever its doc_id.
    """
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null or empty text is one piece, the end token. Repeated rows and rows with a null doc_id are packed like any
    other, ties in the order of their rows.
    """
    return packing.pack(table(packing.cut(docs, tokenizer_path("byte_bpe_50k.json")), "pieces"))


STAGES: list[tuple[str, Stage]] = [("toxicity", drop_toxic), ("near duplicates", one_of_each_group), ("substring dedup", cut_repeats), ("decontamination", drop_contaminated), ("packing", pack)]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left of documents; a stage's table is deleted when the next one's is written."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, f) in enumerate(STAGES):
        with scope(f"pipeline result {k}"):
            path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        f(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, f"pipeline result {k - 1}")
    release(spark, "pipeline")
    return docs
