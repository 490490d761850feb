"""A store of documents without a schema: any frame is appended, types are given when it is read.

Each row is one VARIANT value, so appends may differ in their fields and in a
field's type, and the store's files still have one schema. Only the fields
that a read asks for are taken from the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.sinks import append_table
from riskloom.sources.table import read_table

DOC = "doc"


def append_documents(df: DataFrame, path: str | None = None, fmt: str = "parquet", **options: str) -> None:
    """Append each row as a document, creating the store when absent. Never deduplicates."""
    doc = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    append_table(df.select(doc.alias(DOC)), path, fmt, **options)


def _path(field: str) -> str:
    if "'" in field:
        raise ValueError(f"a field's name may not hold a quote: {field}")
    return f"$['{field}']"


def read_documents(
    spark: SparkSession,
    path: str | None,
    schema: StructType,
    fmt: str = "parquet",
    tolerant: bool = False,
    rejected: str | None = None,
    **options: str,
) -> DataFrame:
    """The whole store under ``schema``, which names fields and their types.

    A field that a document lacks, or holds as null, is NULL; fields outside
    the schema are left behind. A value that cannot be cast aborts the job;
    with ``tolerant`` it becomes NULL, and the column ``rejected``, where
    named, is true for a row with such a value.
    """
    docs = read_table(spark, path, fmt, **options)
    get = F.try_variant_get if tolerant else F.variant_get
    fields = [get(DOC, _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    if not rejected:
        return docs.select(*fields)
    bad: Column = F.lit(False)
    for f in schema.fields:
        held = F.try_variant_get(DOC, _path(f.name), "string").isNotNull()
        bad = bad | (held & F.try_variant_get(DOC, _path(f.name), f.dataType.simpleString()).isNull())
    return docs.select(*fields, bad.alias(rejected))


def stored_schema(spark: SparkSession, path: str | None, fmt: str = "parquet", **options: str) -> str:
    """The fields the store's documents hold and their types, VARIANT where documents differ (one pass, merged per task)."""
    docs = read_table(spark, path, fmt, **options)
    return docs.select(F.schema_of_variant_agg(DOC)).first()[0]
