"""Ordered operations per key that no single task has to do for a whole key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docmill.session import written


def previous_row(rows: DataFrame, *, key: str, order: str, columns: list[str]) -> DataFrame:
    """Adds ``previous``, a struct of ``columns`` of the row before in the order of its key; null for a key's first.

    ``order`` is unique within a key. Rows are range-partitioned by (key, order), so a key that holds a third of all
    rows is spread over many tasks; within a partition it is a lag, and the first row of each partition looks at the
    last one of the nearest partition before that has rows (one row for each partition). Null keys form one key.
    """
    ranged = rows.repartitionByRange(key, order).withColumn("_part", F.spark_partition_id())
    kept = written(ranged, "ordered")
    value = F.struct(*columns)
    ends = kept.groupBy("_part").agg(F.max_by(F.struct(F.col(key).alias("key"), value.alias("value")), F.struct(F.col(key), F.col(order))).alias("end"))
    before = Window.orderBy("_part")  # as many rows as partitions
    ends = ends.select("_part", F.lag("end").over(before).alias("_end"))
    inside = F.lag(value).over(Window.partitionBy("_part", key).orderBy(order))
    first = F.row_number().over(Window.partitionBy("_part", key).orderBy(order)) == 1
    marked = kept.withColumn("_inside", inside).withColumn("_first", first).join(F.broadcast(ends), "_part", "left")
    carried = F.when(F.col("_first") & F.col("_end.key").eqNullSafe(F.col(key)), F.col("_end.value"))
    return marked.select(*rows.columns, F.coalesce("_inside", carried).alias("previous"))
