"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.shared import keep

_PARTS = 1 << 30


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def thinned(rows: DataFrame, bound: int, salt: int) -> DataFrame:
    """About ``bound`` of ``rows``, chosen by a hash of ``doc_id``; all of them when there are no more."""
    total = rows.count()
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(salt)), F.lit(_PARTS))
    return rows if total <= bound else rows.where(part < int(bound / total * _PARTS))


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, bound: int,
             longest: int | None = None) -> DataFrame:
    """(doc_id, text, y) of about ``bound`` documents labelled 0 or 1 whose id is not held out.

    A document whose labels contradict each other is left out, and with ``longest`` a text of more bytes. The
    sample of labels has about ``bound`` rows, which is why it may be broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"), modulus, remainder))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").drop("other")
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    if longest is not None:
        texts = texts.where(F.octet_length("text") <= longest)
    return texts.join(F.broadcast(keep(thinned(known, bound, 1), "labels")), "doc_id").select("doc_id", "text", "y")
