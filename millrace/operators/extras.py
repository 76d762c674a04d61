"""Fields that only some sources have, as Variant columns: any JSON, without a schema of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(items: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the column as a Variant, and apart from them rows whose text is no JSON document (or repeats a key), as they were.

    A null text is no fault: its Variant is null.
    """
    v = F.try_parse_json(column)
    bad = F.col(column).isNotNull() & v.isNull()
    return items.filter(~bad).withColumn(column, v), items.filter(bad)


def kind(value: Column) -> Column:
    """The type of a Variant without what it holds: BIGINT, STRING, ARRAY, OBJECT, VOID for a JSON null."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def as_text(value: Column) -> Column:
    """A string as it is, other values as JSON, a JSON null as null."""
    k = kind(value)
    return F.when(k == "VOID", F.lit(None).cast("string")).when(k == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))


def entries(items: DataFrame, id_col: str, column: str) -> DataFrame:
    """id, name, kind, value: the fields of each row's object. Rows whose Variant is null or no object have none."""
    spark = items.sparkSession
    objects = items.select(id_col, column).filter(F.is_variant_null(column).isNotNull() & (kind(F.col(column)) == "OBJECT"))
    out = objects.lateralJoin(spark.tvf.variant_explode(F.col(column).outer()))
    return out.select(id_col, F.col("key").alias("name"), kind(F.col("value")).alias("kind"), as_text(F.col("value")).alias("value"))
