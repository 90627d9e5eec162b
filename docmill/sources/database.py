"""The store's tables into an external database and back, over JDBC.

Vectors travel in the text form that vector columns accept (``[1.0,2.0]``), other arrays as JSON, so that any database
with text columns can hold them. The driver's jar must be on Spark's class path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill import schemas
from docmill.store import Store


def as_text(df: DataFrame) -> DataFrame:
    """Arrays as text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.to_json(c).alias(c) if isinstance(k, T.ArrayType) else F.col(c) for c, k in kinds.items()])


def from_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a table's schema, arrays read from their text."""
    columns = []
    for f in schema.fields:
        c = F.col(f.name)
        columns.append((F.from_json(c.cast("string"), f.dataType) if isinstance(f.dataType, T.ArrayType) else c.cast(f.dataType)).alias(f.name))
    return df.select(*columns)


def write_database(store: Store, options: Mapping[str, str], *, partitions: int = 16, batch: int = 5000) -> None:
    """Every table of the store, replacing what the database holds; at most ``partitions`` connections at once."""
    for name in schemas.TABLES:
        rows = as_text(store.table(name))
        rows = rows.coalesce(partitions)
        rows.write.format("jdbc").options(**options, dbtable=name, batchsize=str(batch), truncate="true", stringtype="unspecified").mode("overwrite").save()


def read_database(spark: SparkSession, options: Mapping[str, str], *, partitions: int = 16) -> dict[str, DataFrame]:
    """The tables of a database as the store has them; large ones are read by ranges of their ids."""
    out = {}
    for name, schema in schemas.TABLES.items():
        ends = spark.read.format("jdbc").options(**options, query=f'SELECT MIN("id") AS lo, MAX("id") AS hi FROM {name}').load().first()
        reader = spark.read.format("jdbc").options(**options, dbtable=name)
        if ends[0] is not None and ends[1] > ends[0]:
            reader = reader.options(partitionColumn="id", lowerBound=str(ends[0]), upperBound=str(ends[1] + 1), numPartitions=str(partitions))
        out[name] = from_text(reader.load(), schema)
    return out
