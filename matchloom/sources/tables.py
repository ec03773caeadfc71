"""Table sources and sinks: typed scans, views, materialised tables, JSON rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.schemas import RAW_TABLES


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet scan with a declared schema, so no footer is read for inference."""
    return spark.read.schema(schema).parquet(path)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", RAW_TABLES[name])


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make lazy models readable by name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def missing_tables(spark: SparkSession, required: Iterable[str]) -> list[str]:
    """Sorted names of required tables or views the session cannot see."""
    return sorted(name for name in required if not spark.catalog.tableExists(name))


def materialise(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write a full rebuild to a path of its own and read it back."""
    writer = df.write.mode("errorifexists")
    columns = list(partition_by)
    (writer.partitionBy(*columns) if columns else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
