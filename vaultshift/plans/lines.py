"""Dense 1-based line numbers by narrow passes over a file scan (A4, for the postal audit).

A row's number is the rows of the splits before its own plus its place in the split. The first pass counts
rows per split and notes the split's least row tag (one small row a split, partially aggregated); the
second adds the offset. Rows are neither shuffled nor sorted nor written. Splits are named by file and
start, so the order is that of file names and bytes however splits are packed into tasks; both passes read
the same splits because the plan of a file scan does not depend on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_line_numbers(df: DataFrame, file_col: str, start_col: str, name: str = "line") -> DataFrame:
    """``df``: narrow transformations of a file scan, with the file and start of each row's split. The two
    columns are dropped and ``name`` is added."""
    tagged = df.withColumn("_tag", F.monotonically_increasing_id())
    splits = tagged.groupBy(file_col, start_col).agg(F.count(F.lit(1)).alias("_n"), F.min("_tag").alias("_first"))
    before = Window.orderBy(file_col, start_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(file_col, start_col, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row a split: at the default split size 128 MB, 8 000 rows a TB
    return (tagged.join(F.broadcast(offsets), [file_col, start_col])
            .withColumn(name, (F.col("_off") + F.col("_tag") - F.col("_first") + 1).cast("long"))
            .drop(file_col, start_col, "_tag", "_first", "_off"))
