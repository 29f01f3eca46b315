"""The first n rows of each group where groups may be large: cells of the order are
counted first, and only rows of cells that can be among the first are sorted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_rows(rows: DataFrame, keys: list[str], cell: list[Column], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each of ``keys`` (null is a key) by (cell, order), with
    their number ``nth``. cell: columns that sort in front of the order, ascending, with
    far fewer values than rows; a group's rows are sorted only in cells that begin
    before row n."""
    of = [f"__k{i}" for i in range(len(keys))]
    cells = [f"__c{i}" for i in range(len(cell))]
    rows = rows.withColumns(dict(zip(cells, cell, strict=True)))
    counts = rows.groupBy(*keys, *cells).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("__begin", F.coalesce(F.sum("__n").over(before), F.lit(0))).where(F.col("__begin") < n)
    renamed = begins.select(*[F.col(a).alias(b) for a, b in zip([*keys, *cells], [*of, *[f"{c}_" for c in cells]], strict=True)], "__begin")
    same = F.lit(True)
    for a, b in zip([*keys, *cells], [*of, *[f"{c}_" for c in cells]], strict=True):
        same = same & F.col(a).eqNullSafe(F.col(b))
    held = rows.join(renamed, same)
    nth = F.row_number().over(Window.partitionBy(*keys, *cells).orderBy(*order)) + F.col("__begin")
    return held.withColumn("nth", nth).where(F.col("nth") <= n).drop(*of, *cells, *[f"{c}_" for c in cells], "__begin")
