"""Filtering on expensive computed columns.

A Filter on a column computed by a projection is pushed below that projection
with the expression substituted, so an expensive expression (a chain of regex
replacements, a Python UDF result) would be evaluated twice: once to filter,
once to project. Filtering through a generator (explode of a 0- or 1-element
array) keeps the computed column as an input attribute, evaluated once."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_if(df: DataFrame, cond: Column) -> DataFrame:
    """Rows of ``df`` where ``cond`` (over already computed columns) is true."""
    keep = F.array_repeat(F.lit(True), F.coalesce(cond, F.lit(False)).cast("int"))
    return df.withColumn("_keep", F.explode(keep)).drop("_keep")
