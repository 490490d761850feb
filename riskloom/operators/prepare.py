"""Feature preparation: cast projection, view filters, assembling, splitting.

Design rule: filter and prune *before* assembling. A predicate placed above a
``VectorAssembler`` is not pushed into the Parquet scan, one placed below it is.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HANDLE_INVALID = ("error", "skip", "keep")


def cast_project(df: DataFrame, schema: StructType, tolerant: bool = False) -> DataFrame:
    """Select exactly the schema's columns, cast to its types; drops the rest.

    Strict casts follow ANSI mode (a bad value aborts the job); ``tolerant``
    turns bad values into NULL with ``try_cast``.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        c = c.try_cast(f.dataType) if tolerant else c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def view_filter(spark: SparkSession, df: DataFrame, view: str, where: str) -> DataFrame:
    """Register ``df`` as a temp view and run ``SELECT * ... WHERE`` on it.

    Same plan as ``df.where(where)``; the predicate reaches the scan.
    """
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM `{view}` WHERE {where}")


def assembler(features: list[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    if handle_invalid not in HANDLE_INVALID:
        raise ValueError(f"handle_invalid must be one of {HANDLE_INVALID}")
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)


def assemble(
    df: DataFrame,
    features: list[str],
    output: str = "features",
    handle_invalid: str = "error",
    keep: list[str] | None = None,
) -> DataFrame:
    """Assemble ordered numeric columns into one vector column.

    ``error`` fails on NULL/NaN, ``skip`` drops such rows, ``keep`` puts NaN
    in the vector. With ``keep`` given, the output holds those columns plus
    the vector only.
    """
    out = assembler(features, output, handle_invalid).transform(df)
    if keep is not None:
        out = out.select(*keep, output)
    return out


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Seeded random split. Stable only for the same input partitioning."""
    return df.randomSplit(weights, seed)


def _split_key(key: str | list[str]) -> Column:
    # never NULL, so that a row with a NULL key lands on one side too
    keys = [key] if isinstance(key, str) else list(key)
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def hash_threshold(train_fraction: float) -> str:
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("train_fraction must be in (0, 1)")
    return f"{int(train_fraction * 65536):04x}"


HASHES = ("md5", "xxhash64")


def hash_split_flag(key: str | list[str], train_fraction: float = 0.8, method: str = "md5") -> Column:
    """True for the training side of a reproducible split.

    ``md5``: first 4 hex digits of md5(key text) below the cut; the same
    split can be recomputed by any engine with md5. ``xxhash64``: Spark's
    64-bit hash of the key columns, about an order of magnitude cheaper per
    row, for very large inputs where only Spark needs to agree. Either way
    the split is deterministic across runs and partitionings, copies of the
    same key always land on the same side, and NULL keys are on one side too.
    """
    if method == "md5":
        return F.substring(F.md5(_split_key(key)), 1, 4) < F.lit(hash_threshold(train_fraction))
    if method == "xxhash64":
        keys = [key] if isinstance(key, str) else list(key)
        cut = int(hash_threshold(train_fraction), 16)
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(65536)) < F.lit(cut)
    raise ValueError(f"method must be one of {HASHES}")


def hash_split(
    df: DataFrame, key: str | list[str], train_fraction: float = 0.8, method: str = "md5"
) -> tuple[DataFrame, DataFrame]:
    flag = hash_split_flag(key, train_fraction, method)
    return df.where(flag), df.where(~flag)
