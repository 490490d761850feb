"""A training-corpus pipeline: each stage works on all that the one before kept.

language   texts whose language the models reject go
near_dups  one document of each near-duplicate component stays
secrets    secrets in the texts are replaced by a placeholder
mix        documents are repeated or left out to meet their source's target
tokens     texts become token ids

Each stage takes and, but for the last, returns the columns of ``documents``;
further columns pass through. Null or empty texts go in the first stage (no
letter); an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import language_id, mixing, near_dedup, secrets, tokens
from riskloom.llm.common import staged
from riskloom.session import table_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models accept, learned from the rows that aren't held out."""
    found = language_id.identify(docs, language_id.trained(docs))
    return found.where(~F.col("rejected")).select(*docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component: the smallest doc_id's, null last; rows without words are no copies.

    Rows are told apart by a key of their own, as ids can repeat or be null;
    it is written with them, so that it stays the same when a task runs again.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    keyed = staged(docs.withColumn(key, F.monotonically_increasing_id()), "near-keyed")
    found = near_dedup.near_duplicates(keyed, id_col=key).select(F.col("doc_id").alias("member"), "component_id")
    ids = keyed.select(F.col(key).alias("member"), F.col("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "member"))
    kept = staged(found.join(ids, "member").groupBy("component_id").agg(first["member"].alias("member")), "near-kept")
    return keyed.join(kept, F.col(key) == F.col("member"), "left_semi").select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced and n_chars counted anew."""
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return secrets.redact(docs).withColumn("n_chars", size)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids and counts with their checks; texts are left behind."""
    return tokens.encode(docs, keep_text=False)


STAGES: list[tuple[str, Stage]] = [("language", language), ("near_dups", near_dups), ("secrets", redact), ("mix", mix), ("tokens", tokenize)]

#: None: the stages' language models, sketches, tokenizer and hash orders have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
