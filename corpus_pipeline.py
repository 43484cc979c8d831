"""From raw documents to packed windows: toxicity, near duplicates, personal data, packing.

Every stage is (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept. All
but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.llm import dart_minhash, packing, pii_skipchain, toxic_crf
from rosterlens.llm.store import discard, materialise, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field doesn't call toxic; null and empty texts stay, extra columns and repeated rows pass by."""
    return toxic_crf.keep_clean(docs, toxic_crf.fit(docs, table(spark, sf_dir, "labels")))


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest doc_id, then hash of the text.

    A document is a doc_id with a text, so a doc_id whose one text goes keeps its others;
    rows that repeat both stay once, with the other columns of any of them. Null doc_ids
    come last; null and empty texts are nobody's duplicates. Texts move once: dealt by id
    and text, they meet both their own repeats and the documents that go.
    """
    none, key, text = (f"{name}_{uuid.uuid4().hex}" for name in ("none", "id", "text"))  # names that no column of docs has
    own = {none: F.col("doc_id").isNull(), key: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), text: F.xxhash64(F.col("text").cast("string"))}
    found = dart_minhash.near_duplicates(docs.select("doc_id", "text"))
    gone = found.filter("not kept").select(F.col("doc_id").isNull().alias(none), F.coalesce("doc_id", F.lit(0)).alias(key), F.col("text_key").alias(text)).distinct()
    once = docs.withColumns(own).repartition(*own).dropDuplicates([*own])
    return once.join(gone, [*own], "left_anti").select(docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; null and empty texts stay as they are, extra columns and repeated rows pass by."""
    return pii_skipchain.redact(docs, pii_skipchain.fit(pii_skipchain.candidates(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token windows; a null or empty text is its end id alone, each repeated row is packed, extra columns are left out."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity), ("minhash", minhash), ("pii", pii), ("packing", pack)]

#: No stage can be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents; every stage's output is a table in the shared folder, deleted once the next is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        discard(before)
    return docs
