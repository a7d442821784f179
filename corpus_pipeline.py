"""Corpus pipeline: five stages over ``documents``, each written as Parquet and
reread as the next one's input.

Toxic documents go; lines that many documents share are dropped; one document
of each group of near copies stays; sources are mixed to their target weights
(a document then stands there once per copy); the mix is packed into token
windows. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm import lines, minhash, mixing, packing, toxicity
from spendstar.llm.common import shared_folder
from spendstar.llm.queries import tokenizer_path

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of TOXIC_FROM or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(toxicity.fold(F.col("doc_id"), 4) != 2)
    scored = toxicity.score(docs, toxicity.train(docs, labels), out_col="__toxicity")
    return scored.filter(F.col("__toxicity") < TOXIC_FROM).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share are dropped; a document keeps its other lines."""
    return lines.drop_shared_lines(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays. Rows without an id stay."""
    dropped = minhash.near_duplicates(docs.select("doc_id", "text")).filter(~F.col("kept")).select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, packed as op2 does."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL = None  # SQL cannot express the classifier, the sketches and the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage={k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


query = run
