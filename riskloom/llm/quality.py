"""Quality rules as a bitmask ledger.

``ledger`` measures every whole text once and sets one bit for each rule that
it fails. A policy is a versioned set of rules: applying one, or comparing
several, is integer arithmetic on the stored bits and never reads a text
again. Adding a rule adds a bit; a policy's mask names the rules it rejects on.

Defined results: null text counts as empty (no words: rule ``few_words``);
repeated rows get equal ledgers; an empty table gives an empty ledger; other
columns pass through, and ones named like a measurement are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskloom.llm.common import U64, Rolling, buffers, byte_hashes, mix64, python_stage, slices, word_bounds
from riskloom.session import table_path

REPEAT_WORDS = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
_WINDOW = Rolling(0xA0761D6478BD642F)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Rules in bit order.
RULE_BITS = {
    name: 1 << i
    for i, name in enumerate(["few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words", "some_symbols"])
}


def conditions() -> dict[str, Column]:
    """A row fails a rule when its condition holds."""
    c = F.col
    return {
        "few_words": c("n_words") < 20,
        "repeated_words": 100 * c("n_repeat_words") > 30 * c("n_words"),
        "many_symbols": 2 * c("n_symbols") > c("n_words"),
        "repeated_lines": 100 * c("n_dup_lines") > 50 * c("n_lines"),
        "short_words": c("word_chars") < 2 * c("n_words"),
        "long_words": c("word_chars") > 20 * c("n_words"),
        "some_symbols": 10 * c("n_symbols") > c("n_words"),
    }


POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words", "some_symbols"),
    "lenient": ("few_words", "repeated_words", "many_symbols"),
}


def mask(policy: str) -> int:
    return sum(RULE_BITS[r] for r in POLICIES[policy])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _own(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    with np.errstate(over="ignore"):
        return mix64(hashes + text.astype(U64) * U64(0x9E3779B97F4A7C15))


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The MEASURES of some texts, given their bytes."""
    texts = len(offsets) - 1
    start, end, before = word_bounds(data, offsets)
    n_words = np.diff(before)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[start] += 1
    inside[end] -= 1
    solid = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    word_chars = _per_text(solid & ((data & 0xC0) != 0x80), offsets)
    n_symbols = _per_text(_SYMBOL[data], offsets)

    breaks = np.flatnonzero(data == 10)
    line_end = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    line_start = np.sort(np.concatenate([breaks + 1, offsets[:-1]]), kind="stable")
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    text = np.searchsorted(offsets, line_start, "right") - 1
    _, first = np.unique(_own(byte_hashes(data, line_start, line_end), text), return_index=True)
    n_lines = np.bincount(text, minlength=texts)
    n_dup = n_lines - np.bincount(text[first], minlength=texts)

    words = byte_hashes(data, start, end)
    n_repeat = np.zeros(texts, dtype=np.int64)
    at = np.arange(max(len(words) - REPEAT_WORDS + 1, 0))
    text = np.searchsorted(before, at, "right") - 1
    whole = at + REPEAT_WORDS <= before[1:][text]
    at, text = at[whole], text[whole]
    if len(at):
        _, kind, count = np.unique(_own(_WINDOW.ranges(words, at, at + REPEAT_WORDS), text), return_inverse=True, return_counts=True)
        again = at[count[kind] > 1]
        step = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(step, again, 1)
        np.add.at(step, again + REPEAT_WORDS, -1)
        n_repeat = _per_text(np.cumsum(step[:-1]) > 0, before)
    return [n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat]


def ledger(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` (its text only on request), MEASURES, and ``bits``: the rules that each row fails."""
    python_stage(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in {*MEASURES, "bits"}])
    at = docs.columns.index(text_col)
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for lo, hi in slices(offsets):
                found = measure(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                own = batch.slice(lo, hi - lo)
                columns = [own.column(f.name) for f in fields] + [pa.array(x.astype(np.int64)) for x in found]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields] + MEASURES)

    measured = docs.mapInArrow(scan, StructType([*fields, *[StructField(m, LongType()) for m in MEASURES]]))
    failed = F.lit(0).cast("long")
    for name, condition in conditions().items():
        failed = failed.bitwiseOR(F.when(condition, F.lit(RULE_BITS[name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("bits", failed)


def passes(policy: str) -> Column:
    """Whether a ledger row is kept under a policy."""
    return F.col("bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """policy, rule, n_rows, n_kept, n_failing, n_only: what dropping one rule of a policy would bring back.

    The ledger shrinks to its distinct bit patterns (at most 2 to the number
    of rules) before policies and rules meet it.
    """
    patterns = rows.groupBy("bits").agg(F.count(F.lit(1)).alias("c"))
    entry = lambda p, r: F.struct(F.lit(p).alias("policy"), F.lit(mask(p)).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(RULE_BITS[r]).cast("long").alias("bit"))
    entries = F.array(*[entry(p, r) for p, own in POLICIES.items() for r in own])
    each = patterns.select("bits", "c", F.explode(entries).alias("e")).select("bits", "c", "e.*")
    hit = F.col("bits").bitwiseAND(F.col("mask"))
    zero = F.lit(0).cast("long")
    return each.groupBy("policy", "rule").agg(
        F.sum("c").alias("n_rows"),
        F.sum(F.when(hit == 0, F.col("c")).otherwise(zero)).alias("n_kept"),
        F.sum(F.when(hit.bitwiseAND(F.col("bit")) != 0, F.col("c")).otherwise(zero)).alias("n_failing"),
        F.sum(F.when(hit == F.col("bit"), F.col("c")).otherwise(zero)).alias("n_only"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    return ledger(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        passes("v1").alias("kept"),
        "n_lines",
        "bits",
    )


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM w
), s AS (
  SELECT doc_id, pos, CASE WHEN pos + 7 <= len(words) THEN array_to_string(words[pos:pos + 7], ' ') END AS win FROM p
), f AS (
  SELECT doc_id, pos, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM s
), c AS (
  SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM f
), r AS (
  SELECT doc_id, count(*) FILTER (covered) AS n FROM c GROUP BY doc_id
), l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w
), d AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS one FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(d.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(d.n - d.one, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN d ON d.doc_id = w.doc_id
), b AS (
  SELECT *, CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 64 ELSE 0 END AS BIGINT) AS bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, (bits & 127) = 0 AS kept, n_lines, bits
FROM b
"""
