"""Source and sink queries: CSV scans, store round trip, predictions export."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.operators.evaluate import confusion
from riskloom.operators.prepare import cast_project
from riskloom.plans import clinical
from riskloom.plans.queries.common import FILES_PER_TRIGGER, PAIRS_SCHEMA, ROWS_PER_FILE, read_driver_table, write_csv
from riskloom.plans.queries.trees import stump_pairs
from riskloom.session import shared_path
from riskloom.sinks import append_table, display_table, predictions_json, write_predictions_csv, write_predictions_json
from riskloom.sources.csv import cast_to, read_csv_inferred, read_csv_typed, read_text_csv
from riskloom.sources.documents import append_documents, read_documents
from riskloom.sources.table import read_table
from riskloom.specs import DIABETES
from riskloom.streaming.uploads import commit_batch, ingest_uploads, ledger, read_uploads


def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1/S-2: orders written as CSV, read back under an explicit schema."""
    orders = read_driver_table(spark, sf_dir, "orders")
    path = shared_path(spark, "orders-csv")
    write_csv(orders, path)
    return read_csv_typed(spark, path, orders.schema)


def scan_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1 PERMISSIVE: text in a double column becomes NULL and is flagged."""
    cust = read_driver_table(spark, sf_dir, "customer")
    bad = (F.col("c_custkey") % 10) == 0
    dirty = cust.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(bad, F.lit("x")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
    )
    path = shared_path(spark, "customer-dirty-csv")
    write_csv(dirty, path)
    df = read_csv_typed(spark, path, cust.schema, corrupt_column="_corrupt")
    return df.select(*cust.columns, F.col("_corrupt").isNotNull().alias("is_malformed"))


def scan_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-7: inferred CSV types, then cast to the table's schema."""
    cust = read_driver_table(spark, sf_dir, "customer")
    path = shared_path(spark, "customer-csv")
    write_csv(cust, path)
    return cast_to(read_csv_inferred(spark, path), cust.schema)


def scan_text_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-8: header-less CSV lines read as text and parsed with from_csv."""
    cust = read_driver_table(spark, sf_dir, "customer")
    path = shared_path(spark, "customer-lines")
    write_csv(cust, path, header=False)
    return read_text_csv(spark, path, cust.schema)


def store_schema_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3/K-1/P-1 on a store without a schema: two appends whose fields and
    types differ, typed on read; values that are no number are rejected."""
    cust = read_driver_table(spark, sf_dir, "customer")
    key, path = F.col("c_custkey"), shared_path(spark, "store-documents")
    append_documents(cust, path)
    other = cust.select(
        key.cast("string").alias("c_custkey"),
        F.col("c_nationkey").cast("double").alias("c_nationkey"),
        F.when(key % 10 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(key % 3 == 0, F.col("c_name")).alias("c_name"),
        F.struct(key.alias("id"), F.array("c_mktsegment").alias("tags")).alias("extra"),
    )
    append_documents(other, path)
    return read_documents(spark, path, cust.schema, tolerant=True, rejected="rejected")


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-5 as a stream: order files arrive in two lots, the last batch is
    replayed, and the store holds each file's rows once."""
    orders = clinical.diabetes_rows(read_driver_table(spark, sf_dir, "orders"))
    spec = replace(DIABETES, schema=StructType([orders.schema[clinical.KEY], *DIABETES.schema.fields]))
    orders = orders.select(*spec.schema.names)
    source, store, checkpoint = (shared_path(spark, f"uploads-{x}") for x in ("source", "store", "checkpoint"))
    early = F.col(clinical.KEY) % 2 == 0
    for lot in (early, ~early):
        orders.where(lot).write.mode("append").option("header", "true").option("maxRecordsPerFile", ROWS_PER_FILE).csv(source)
        ingest_uploads(spark, spec, source, store, checkpoint, FILES_PER_TRIGGER)
    last = ledger(spark, store).orderBy(F.desc("batch")).first()
    commit_batch(orders, last["stream"], last["batch"], store, spec.label)
    return read_uploads(spark, store, spec.schema)


def table_append_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-1/S-3/M-5: append twice to an empty store; the read sees both."""
    cust = read_driver_table(spark, sf_dir, "customer")
    store = shared_path(spark, "store-customer")
    append_table(cust, store)
    append_table(cust, store)
    return cast_project(read_table(spark, store), cust.schema)


def predictions_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-2: pairs written as CSV (header, CRLF), read back typed."""
    path = shared_path(spark, "predictions-csv")
    write_predictions_csv(stump_pairs(spark, sf_dir), path)
    return read_csv_typed(spark, path, PAIRS_SCHEMA, lineSep="\r\n")


def predictions_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-7: each pair as a JSON object, parsed back."""
    js = predictions_json(stump_pairs(spark, sf_dir)).select("json")
    parsed = js.select("json", F.from_json("json", PAIRS_SCHEMA).alias("r"))
    return parsed.select(F.col("r.prediction").alias("prediction"), F.col("r.label").alias("label"), "json")


def predictions_json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-7 as a file: JSON lines written in parallel, read back typed."""
    path = shared_path(spark, "predictions-json")
    write_predictions_json(stump_pairs(spark, sf_dir), path)
    return spark.read.schema(PAIRS_SCHEMA).json(path)


def display_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-5: header row + string cells of every test pair, ordered by the carried keys."""
    keys = ["l_orderkey", "l_linenumber"]
    return display_table(stump_pairs(spark, sf_dir, keep=keys), ["prediction", "label"], keys)


def display_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-5 on a report: header row + string cells of the test confusion counts."""
    counts = confusion(stump_pairs(spark, sf_dir), "label")
    return display_table(counts, ["prediction", "label", "n"], ["prediction", "label"])
