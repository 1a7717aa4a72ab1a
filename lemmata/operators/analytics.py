"""Joins that Spark has no operator for, composed of those it has."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def range_join(points: DataFrame, ranges: DataFrame, at: str, lo: str, hi: str, width: float) -> DataFrame:
    """Points in [lo, hi): both sides meet on cells of ``width``, so the join has an equi key."""
    cell = lambda c: F.floor(c / width)
    r = ranges.withColumn("__cell", F.explode(F.sequence(cell(F.col(lo)), F.greatest(F.ceil(F.col(hi) / width) - 1, cell(F.col(lo))))))
    p = points.withColumn("__cell", cell(F.col(at)))
    return p.join(r, "__cell").where((F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi))).drop("__cell")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """Each left row with ``values`` of the last right row of its keys at or before it: one shuffle, no pairs."""
    names = [c for c in left.columns if c not in (*keys, at)]
    value_type = T.StructType([T.StructField(v, right.schema[v].dataType) for v in values])
    l = left.select(*keys, at, F.lit(1).alias("__side"), F.struct(*names).alias("__row"), F.lit(None).cast(value_type).alias("__value"))
    r = right.select(*keys, at, F.lit(0).alias("__side"), F.lit(None).cast(l.schema["__row"].dataType).alias("__row"), F.struct(*values).alias("__value"))
    w = Window.partitionBy(*keys).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r).withColumn("__last", F.last("__value", ignorenulls=True).over(w))
    return both.where("__side = 1").select(*keys, at, "__row.*", *[F.col(f"__last.{v}").alias(v) for v in values])
