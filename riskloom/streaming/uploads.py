"""Uploads as a stream: every file that arrives is appended to a store exactly once.

A micro-batch is written to a folder named by its stream and number, then a row
in the store's ledger commits it. Reads take committed batches only. A batch
that runs again after a failure finds its row and is skipped, or, without one,
replaces what was left in its folder; so files are neither lost nor doubled.
As in batch ingest, copies of a file under other names are appended again.

The ledger's row also holds what was counted while the batch was written: rows,
malformed rows and rows without a label. No pass over the data is added.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskloom.specs import DatasetSpec

LEDGER = "stream string, batch long, n_rows long, n_malformed long, n_null_label long"
_PLACE = [StructField("stream", StringType()), StructField("batch", LongType())]
_MALFORMED = "_malformed"


def ledger(spark: SparkSession, store_path: str) -> DataFrame:
    """One row for each committed batch; none before the first."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{store_path.rstrip('/')}/ledger")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def read_uploads(spark: SparkSession, store_path: str, schema: StructType) -> DataFrame:
    """The rows of all committed batches, chosen by their folders' names (the ledger has one row a batch)."""
    placed = StructType([*schema.fields, *_PLACE])
    committed = ledger(spark, store_path).select("stream", "batch").distinct()
    try:
        data = spark.read.schema(placed).parquet(f"{store_path.rstrip('/')}/data")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return data.join(committed, ["stream", "batch"], "left_semi").select(*schema.names)


def commit_batch(rows: DataFrame, stream: str, batch: int, store_path: str, label: str | None = None) -> bool:
    """Write one micro-batch and commit it; False where it was committed before."""
    spark, store = rows.sparkSession, store_path.rstrip("/")
    if not ledger(spark, store).where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty():
        return False
    bad = F.col(_MALFORMED).isNotNull() if _MALFORMED in rows.columns else F.lit(False)
    unlabelled = F.col(label).isNull() if label else F.lit(False)
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(bad, 1)).alias("n_malformed"),
        F.count(F.when(unlabelled, 1)).alias("n_null_label"),
    )
    counted.drop(_MALFORMED).write.mode("overwrite").parquet(f"{store}/data/stream={stream}/batch={batch}")
    found = seen.get
    row = [(stream, batch, found["n_rows"], found["n_malformed"], found["n_null_label"])]
    spark.createDataFrame(row, LEDGER).coalesce(1).write.mode("append").parquet(f"{store}/ledger")
    return True


def start_upload_stream(
    spark: SparkSession,
    spec: DatasetSpec,
    source_path: str,
    store_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append the CSV files of a folder as they arrive (header, bound by position, bad cells NULL).

    Without ``processing_time`` all files present are worked off, then the
    stream ends. The stream is known by its checkpoint: started over the same
    one it goes on, a fresh one takes every file again.
    """
    schema = StructType([*spec.schema.fields, StructField(_MALFORMED, StringType())])
    reader = spark.readStream.format("csv").schema(schema).option("header", "true").option("columnNameOfCorruptRecord", _MALFORMED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    uploads = reader.options(**options).load(source_path)

    def commit(rows: DataFrame, batch: int) -> None:
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        commit_batch(rows, stream, batch, store_path, spec.label)

    writer = uploads.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(commit)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def ingest_uploads(
    spark: SparkSession,
    spec: DatasetSpec,
    source_path: str,
    store_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Work off all files present, then return the whole store, typed."""
    query = start_upload_stream(spark, spec, source_path, store_path, checkpoint_path, max_files_per_trigger)
    query.awaitTermination()
    return read_uploads(spark, store_path, spec.schema)
