"""Streams: first-wins deduplication under a watermark, and cleaning as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusforge.functions.text import clean_documents


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def cleaned(stream: DataFrame, text: str = "text") -> DataFrame:
    return clean_documents(stream, text)
