"""Rows in key order over many files, whatever the keys' sizes.

Ranges are taken over (key, ties), so that the rows of one frequent key spread over as many ranges as their number
asks for: Spark samples the composite order, and the ties (row ids) make every row its own place in it. Each range is
sorted by one task and written as one file; the files in order of their names are the rows in order. Null keys come first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def key_ordered(df: DataFrame, keys: list[str], ties: list[str], files: int) -> DataFrame:
    """``df`` in ``files`` partitions, in order of (keys, ties) within and across them. (keys, ties) should name a row:
    rows equal in all of them stay in one partition."""
    order = [*keys, *ties]
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)
