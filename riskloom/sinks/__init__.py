"""Sinks: append store, predictions CSV / JSON, display table.

Full results always leave through a distributed writer; nothing is collected
to the driver except bounded previews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import require_shared_warehouse

CRLF = "\r\n"


def append_table(
    df: DataFrame, path: str | None = None, fmt: str = "parquet", table: str | None = None, **options: str
) -> None:
    """Append to a store, creating it when absent. Never deduplicates.

    The store is a path (``path``), a catalog table (``table``, kept under the
    session's warehouse) or, with neither, whatever the format's options
    name (e.g. a connector's collection URI).
    """
    writer = df.write.format(fmt).mode("append")
    for k, v in options.items():
        writer = writer.option(k, v)
    if table is not None:
        require_shared_warehouse(df.sparkSession)
        writer.saveAsTable(table)
    elif path is None:
        writer.save()
    else:
        writer.save(path)


def write_predictions_csv(
    df: DataFrame,
    path: str,
    columns: tuple[str, ...] = ("prediction", "label"),
    line_sep: str = CRLF,
    single_file: bool = False,
) -> None:
    """Header ``prediction,label``, comma, minimal quoting, CRLF, overwrite.

    Written in parallel (one part file per task). ``single_file`` funnels
    everything through one task and is meant for small, bounded outputs only.
    """
    out = df.select(*columns)
    if single_file:
        out = out.coalesce(1)
    (
        out.write.mode("overwrite")
        .option("header", "true")
        .option("lineSep", line_sep)
        .option("quote", '"')
        .csv(path)
    )


def predictions_json(df: DataFrame, columns: tuple[str, ...] = ("prediction", "label"), name: str = "json") -> DataFrame:
    """One JSON object per row, e.g. ``{"prediction":1,"label":0}``."""
    return df.select(*df.columns, F.to_json(F.struct(*[F.col(c) for c in columns])).alias(name))


def write_predictions_json(df: DataFrame, path: str, columns: tuple[str, ...] = ("prediction", "label")) -> None:
    df.select(*columns).write.mode("overwrite").json(path)


def display_table(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Every row as string cells ``c0``, ``c1``, ... below a header row.

    The ``keys`` are carried and order the display; the header row has
    ``is_header`` and NULL keys. No row is numbered, so nothing passes
    through one task.
    """
    cells = [f"c{i}" for i in range(len(columns))]
    types = [df.schema[k].dataType for k in keys]
    header = df.sparkSession.range(1).select(
        F.lit(True).alias("is_header"),
        *[F.lit(None).cast(t).alias(k) for k, t in zip(keys, types)],
        *[F.lit(c).alias(n) for c, n in zip(columns, cells)],
    )
    body = df.select(
        F.lit(False).alias("is_header"), *keys, *[F.col(c).cast("string").alias(n) for c, n in zip(columns, cells)]
    )
    return header.unionByName(body)


def show(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)
