"""From raw documents to packed training windows: quality, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on whatever its predecessor kept. All but the last return the
columns of documents. Stages are written as Parquet and read again, so that a lost executor costs at most a part of one stage.

Rows with null texts count as empty texts throughout; the quality stage rejects most of them. Ties and repeated rows are settled as the
operators' docstrings say. Other columns pass through every stage but the last untouched, also those named like a column that an
operator makes. Rows without an id take part like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import clear_shared, table, vocabulary, written
from folioforge.llm.minhash import drop_near_duplicates
from folioforge.llm.packing import pack_documents
from folioforge.llm.quality import keep_quality, train_quality
from folioforge.llm.toxicity import drop_toxic, train_toxicity


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return keep_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    return drop_toxic(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2,048 ids, with the ids."""
    packed = pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1)
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("packing", packing)]

#: Classifiers and signatures are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each but the last is written to the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        made: list[str] = []
        docs = written(stage(spark, docs, sf_dir), name, made)
        clear_shared(spark, before)  # no later stage reads what this one has read
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
