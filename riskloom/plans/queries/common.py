"""Helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from riskloom.session import table_path

Query = Callable[[SparkSession, str], DataFrame]

ROWS_PER_FILE = 100_000  # request files of the streams
FILES_PER_TRIGGER = 4  # a backlog is worked off in micro-batches of so many files

PAIRS_SCHEMA = StructType([StructField("prediction", IntegerType()), StructField("label", IntegerType())])


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)
