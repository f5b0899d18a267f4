"""Filters that leave a table's columns as they are, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``gone``; rows without an identifier stay."""
    return docs.join(gone.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
