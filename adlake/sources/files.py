"""File readers for landed data (SC2-SC4, RS7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adlake.sources.sinks import split_quarantine


def read_csv_renamed(spark: SparkSession, path: str, schema: StructType,
                     titles: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """SC2: CSV whose first line is junk and second line the original header;
    columns take ``schema``'s names.  Returns (rows, rejected).

    Spark has no skip-lines option: the junk line is consumed as the header,
    and the row equal to the header line in every column is dropped.  The
    header is ``titles``, or else the first row read.  A row with a value that
    its column's type does not parse is not lost: it is in ``rejected``, as
    text, with the names of those columns."""
    text = StructType([StructField(f.name, StringType(), True) for f in schema.fields])
    raw = spark.read.option("header", True).schema(text).csv(path)
    if titles is None:
        first = raw.first()
        titles = list(first) if first else []
    is_title = F.lit(bool(titles))
    for f, title in zip(text.fields, titles):
        is_title = is_title & F.col(f.name).eqNullSafe(F.lit(title))
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    rules = {name: c.isNotNull() | F.col(name).isNull() for name, c in cast.items()}
    good, rejected = split_quarantine(raw.where(~is_title), rules)
    return good.select(*[c.alias(name) for name, c in cast.items()]), rejected


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SC3: header CSV with an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SC4: landed JSON records with an explicit schema."""
    return spark.read.schema(schema).json(path)


def rows_from_json_grid(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    """RS7: a JSON text holding an array of row arrays -> typed-as-text
    rectangular rows with their position (``posexplode``)."""
    arr = F.from_json(F.col(col), "array<array<string>>")
    e = df.select(F.posexplode(arr).alias("row_pos", "cells"))
    return e.select("row_pos", *[F.get("cells", i).alias(n) for i, n in enumerate(names)])
