"""Splits and bounded training samples shared by the three classifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickloom.session import cut_lineage


def in_fold(doc_id: Column, parts: int, fold: int) -> Column:
    """True where crc32 of the id's text leaves `fold` on division; a null id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts)) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int):
    """(text, label) of at most `per_class` documents of each label value, as a local frame.

    The documents with the smallest hashes of their ids are taken. Only texts of 1 to
    `max_chars` characters are learned from, so the sample is bounded in rows and in
    bytes; the texts taken are whole. `labels` holds (doc_id, label), of few values;
    of several labels of an id the largest counts, of several texts the smallest.

    The number of documents of a class tells below which hash its sample lies, so
    only about twice as many rows as wanted are ranked, however large the table.
    Their ids are broadcast, and texts are met by them where they are read.
    """
    fits = docs.where(F.length("text").between(1, max_chars)).select("doc_id", "text")
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).alias(label))
    known = cut_lineage(known.join(fits.select("doc_id"), "doc_id", "left_semi"))
    sizes = {r[0]: r[1] for r in known.groupBy(label).agg(F.count(F.lit(1))).collect()}
    wanted = 2 * per_class + 10 * math.isqrt(per_class) + 100
    below = F.lit(False)
    for value, size in sizes.items():
        last = (1 << 64) * wanted // size - (1 << 63) if size > wanted else (1 << 63) - 1
        below |= (F.col(label) == value) & (F.xxhash64("doc_id") <= last)
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = known.where(below).withColumn("__rank", F.row_number().over(order))
    ranked = cut_lineage(ranked.where(F.col("__rank") <= per_class).drop("__rank"))
    met = fits.join(F.broadcast(ranked), "doc_id")
    taken = met.groupBy("doc_id", label).agg(F.min("text").alias("text"))
    return taken.orderBy(F.xxhash64("doc_id"), "doc_id").select("text", label).toPandas()
