"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.common import id_and_text, load, row_key, ship_package, stored
from barograph.llm.decontaminate import clean_documents
from barograph.llm.jaccard_join import near_duplicates
from barograph.llm.packing import pack_documents
from barograph.llm.secret_scan import mask_secrets
from barograph.llm.token_ids import default_vocabulary
from barograph.llm.toxicity import reject_toxic

#: Stages depend on fitted models and token ids, which SQL cannot express.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts, repeated rows and null ids are scored like any other row; an empty table stays empty.
    """
    ship_package(spark)
    return reject_toxic(docs, load(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, Jaccard 0.8) the smallest id stays.

    Null ids come last. Rows with equal ids and different texts are documents of
    their own; of rows with equal ids and texts one stays.
    """
    ship_package(spark)
    found = near_duplicates(docs.select(row_key(docs).alias("doc_id"), "text"))
    kept = stored(found.where("doc_id = component_id").select(F.col("doc_id").alias("_row_key")).distinct(), "kept-rows")
    return (docs.withColumn("_row_key", row_key(docs)).join(kept, "_row_key", "left_semi")
            .dropDuplicates(["_row_key"]).select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go.

    Null and empty texts have none and stay; repeated rows and null ids are decided by their texts; an empty table stays empty.
    """
    return clean_documents(docs, load(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed secrets are masked; every document stays, with its new length.

    Null texts stay null, repeated rows stay repeated, and an empty table stays empty.
    """
    masked = mask_secrets(docs)
    if "n_chars" in masked.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(masked.schema["n_chars"].dataType))
    return masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in sequences of 2048 tokens.

    Null and empty texts are the end id alone, repeated rows are packed each, and an empty table gives no piece.
    """
    ship_package(spark)
    # Workers of earlier stages are still there, so this one remembers less than packing alone.
    return pack_documents(id_and_text(docs), default_vocabulary(), remember=250_000)


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read by the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
