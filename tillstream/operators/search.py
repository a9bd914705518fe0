"""Full-text match and sorted paging over a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def match(docs: DataFrame, field: str, text: str) -> DataFrame:
    """Documents whose field holds one of the words of ``text`` (letters and digits, any case)."""
    words = F.split(F.lower(field), "[^\\p{L}\\p{N}]+")
    asked = F.filter(F.split(F.lower(F.lit(text)), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return docs.where(F.arrays_overlap(words, asked))


def top(docs: DataFrame, sort: str, tie: str, offset: int = 0, size: int = 20,
        descending: bool = False) -> DataFrame:
    """A page of the documents by sort field, ties by ``tie``. Every task keeps only the rows
    that can still be on the page; nothing is sorted as a whole."""
    by = F.desc(sort) if descending else F.asc(sort)
    page = docs.orderBy(by, F.asc(tie))
    return (page.offset(offset) if offset else page).limit(size)
