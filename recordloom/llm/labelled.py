"""The bounded sample of labelled documents that classifiers are trained on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One id in so many is held out of training.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by ``FOLDS``; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, columns: list[str], limit: int, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(text, *columns) of at most ``limit`` labelled documents that are not held out, chosen by a hash of their ids.

    Labels that are null in any of ``columns``, or of an id without a document, are passed over; of several labels of an id
    the largest counts. Rows equal in id and text are one document; of an id with several texts those with the smaller
    hashes come first. What is chosen is a list of ids and hashes of known size, so it is broadcast to the documents.
    """
    known = labels.where(~held_out(F.col(id_column)))
    for c in columns:
        known = known.where(F.col(c).isNotNull())
    known = known.groupBy(F.col(id_column).alias("__id")).agg(*[F.max(c).cast("int").alias(c) for c in columns])
    texts = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text_column}`").cast("string").alias("text")).withColumn("__hash", F.xxhash64("text"))
    pairs = texts.select("__id", "__hash").join(known, "__id").distinct()
    chosen = pairs.orderBy(F.xxhash64("__id", F.lit(5)), "__id", "__hash").limit(limit)
    return texts.join(F.broadcast(chosen), ["__id", "__hash"]).dropDuplicates(["__id", "__hash"]).select("text", *columns)
