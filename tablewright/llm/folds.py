"""What is learned from which rows: folds by a checksum of the document's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm import crf_quality, langid

ACCEPT = 0.3  # quality scores from here on are good
CONFIDENT = 0.5  # a language is recognised from here on


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def quality_model(docs: DataFrame, labels: DataFrame) -> crf_quality.Model:
    """Learned from labelled rows outside the held-out fold."""
    return crf_quality.train(docs, labels, fold(5) != 0)


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from rows outside the held-out fold."""
    return langid.train(docs.filter(fold(4) != 2))
