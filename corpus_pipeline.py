"""Corpus pipeline: toxic documents go, then those of no clear language, near copies, contaminated ones; the rest is mixed.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all that its
predecessor kept.  ``run`` applies them to ``documents``, writing each stage's rows as Parquet in the shared
folder and reading them again as the next stage's ``docs``; a stage's table goes when the next one's is written.

In every stage null ids, texts, languages and sources are values like others, an empty or null text is a text
without words, whole texts of any length are read, no rows give no rows, and columns beyond those of documents
pass through, whatever they are called.  Each stage says what it does with ties and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canvass.llm import decontaminate, language, mixing, neardup, toxicity
from canvass.storage import discard, saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score 0.5 or more go.

    Repeated rows score alike and share one fate; a text without words scores like one without matches.
    """
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unclear_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents whose language is rejected go.

    That is where the two best languages are nearly tied, and where a text has no letter; repeated rows share one fate.
    """
    return language.accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group stays.

    The one with the smallest id, rows without an id last, ties by a hash of the row; of repeated rows one
    stays.  Documents without words are linked with nothing and stay, but for repeated rows of one.
    """
    return neardup.kept(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark window go.

    Repeated rows share one fate; items without words hit nothing, items without an id hit like others.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each document as often as the mix takes it, with the copy's number.

    Repeated rows are taken equally often; a null source is one source; ties are drawn from a fixed seed.
    """
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unclear_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix),
]

#: Learned scores and the cube method's draws are not SQL; tests hold the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = saved(stage(spark, docs, sf_dir), name)
        discard(docs)  # the table of the stage before; never the input
        docs = done
    return docs
