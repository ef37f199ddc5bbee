"""Tables whose other columns may have any name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def apart(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with every column that is not one of ``own`` under a name that no operator uses, in the same places.

    Columns that differ from one of ``own`` only in case are others. ``made.toDF(*docs.columns)`` gives the names back.
    """
    return docs.toDF(*(c if c in own else f"__given_{i}" for i, c in enumerate(docs.columns)))
