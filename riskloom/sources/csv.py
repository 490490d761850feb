"""CSV sources.

* ``read_csv_typed``: header + explicit schema. Columns bind by position (the
  header text is skipped), PERMISSIVE by default so a bad cell becomes NULL.
  Optionally exposes Spark's corrupt-record column or switches to
  DROPMALFORMED / FAILFAST.
* ``read_csv_inferred``: header + ``inferSchema`` (costs an extra full pass;
  prefer an explicit schema for large inputs).
* ``read_text_csv``: raw lines parsed with ``from_csv`` (no RDD, no Python).

``path`` may be a file, a directory or a glob; Spark splits large files into
``spark.sql.files.maxPartitionBytes`` pieces, so a scan scales with the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = True,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    enforce_header: bool = False,
    **options: str,
) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    read_schema = schema
    reader = spark.read.format("csv").option("header", str(header).lower()).option("mode", mode)
    if corrupt_column:
        read_schema = StructType(
            list(schema.fields) + [StructField(corrupt_column, StringType(), True)]
        )
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if enforce_header:
        # Fail when the header names disagree with the schema instead of
        # silently binding by position.
        reader = reader.option("enforceSchema", "false")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.schema(read_schema).load(path)


def read_csv_inferred(
    spark: SparkSession, path: str, header: bool = True, **options: str
) -> DataFrame:
    reader = spark.read.option("header", str(header).lower()).option("inferSchema", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_csv_named(spark: SparkSession, path: str, columns: list[str], **options: str) -> DataFrame:
    """The named text columns of CSV files with a header, whatever their order.

    Further columns are ignored; a missing one raises, and so does a file
    whose header differs from the first one's.
    """
    schema = header_schema(spark, path, columns)
    df = read_csv_typed(spark, path, schema, enforce_header=True, **options)
    return df.select(*columns)


def header_schema(spark: SparkSession, path: str, columns: list[str]) -> StructType:
    """Text columns in the order of the files' header, which must hold ``columns``."""
    names = spark.read.option("header", "true").csv(path).columns
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {names}")
    return StructType([StructField(n, StringType(), True) for n in names])


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Project and cast to ``schema`` by column name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_text_csv(
    spark: SparkSession, path: str, schema: StructType, **options: str
) -> DataFrame:
    """Lines of text (no header) parsed into typed columns with ``from_csv``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    lines = spark.read.text(path)
    parsed = lines.select(F.from_csv(F.col("value"), ddl, options or None).alias("r"))
    return parsed.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields])
