"""Store tables and request frames.

The store is a named, append-only table behind a ``format`` / options pair
(Parquet by default). Any installed connector can be used by passing its
format name; none beyond Spark's built-ins is assumed here.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

from riskloom.specs import DatasetSpec


def read_table(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", table: str | None = None, **options: str
) -> DataFrame:
    """Full scan of a store (every earlier append is visible)."""
    if table is not None:
        return spark.table(table)
    reader = spark.read.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path is not None else reader.load()


def request_frame(
    spark: SparkSession,
    spec: DatasetSpec,
    records: Iterable[Sequence],
    label_value: int = 0,
    id_col: str | None = None,
) -> DataFrame:
    """Typed frame of scoring requests with a placeholder label.

    ``records`` hold the feature values in spec order, already typed (with
    ``id_col``, each record starts with an integer id). This is the
    single-request path; tables of requests go through
    ``operators.score.parse_requests`` instead.
    """
    rows = [tuple(r) + (label_value,) for r in records]
    schema = spec.schema
    if id_col:
        schema = StructType([StructField(id_col, IntegerType(), False)] + list(spec.schema.fields))
    return spark.createDataFrame(rows, schema)


def parse_form(spec: DatasetSpec, values: Sequence[str]) -> tuple:
    """One form's text to typed feature values, as the single-user form
    handler does (Python ``int`` / ``float``: a bad value raises)."""
    if len(values) != len(spec.features):
        raise ValueError(f"expected {len(spec.features)} values, got {len(values)}")
    out = []
    for f, v in zip(spec.feature_schema.fields, values):
        out.append(int(v) if isinstance(f.dataType, IntegerType) else float(v))
    return tuple(out)
