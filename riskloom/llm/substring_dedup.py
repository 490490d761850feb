"""Substring dedup by relative Lempel-Ziv parsing against an index of reference blocks.

A document's windows of ``window`` words fall into *blocks*: runs of windows
with the same anchor, the smallest hash of the k-word sequences inside the
window. Equal windows have equal anchors, wherever they stand, so the anchor
is a complete index key, and there is about one block in eighteen words.

The reference is every block, owned by the smallest doc_id that holds it.
A document is then factored greedily from the left:

* a block owned by an earlier document is copied whole;
* a block whose anchor also stands in other blocks may share only some of its
  windows with them (the ends of a passage fall inside such blocks). These are
  the factor boundaries: their windows are looked up one by one among the
  windows of all blocks with that anchor;
* adjacent copied windows from one owner make one factor, of at least
  ``window`` words by construction.

Every word of a factor is a duplicate. A window counts if it also starts in a
document with a smaller doc_id; windows are judged on the input.

Blocks are aggregated before each join, so a passage that a third of all
documents share costs one row a task; only the first owner of a block looks
into its windows. Rows of a document are gathered by document only.

Defined results: null text has no words; fewer words than a window stay
whole; rows that repeat a doc_id are never earlier than each other; a row with
a null doc_id is neither reference nor reduced; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import U64, Rolling, buffers, python_stage, slices, staged, word_hashes
from riskloom.session import table_path

WINDOW = 50
GRAM = 16
RUN = 64  # windows a block holds at most (a run of one repeated word is cut)
_GRAM = Rolling(0x2545F4914F6CDD1D)
_BODY = Rolling(0xD1342543DE82EF95)

BLOCKS = "anchor long, body long, doc_id long, tid int, span long"
WINDOWS = "anchor long, win long, doc_id long, tid int, start int"


def _sliding(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values."""
    at = np.arange(len(values) - k + 1)
    return _GRAM.ranges(values, at, at + k)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def _text_ids(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    """31-bit hash of each text's words: tells rows with one doc_id apart."""
    return (_BODY.ranges(words, before[:-1], before[1:]) >> U64(33)).astype(np.int32)


def _anchors(words: np.ndarray, before: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of the window at every word, and where a whole window of one text starts."""
    n = len(words)
    valid = np.zeros(n + 1, dtype=np.int32)
    np.add.at(valid, before[:-1], 1)
    np.add.at(valid, np.maximum(before[:-1], before[1:] - window + 1), -1)
    valid = np.cumsum(valid[:n]) > 0
    anchor = np.zeros(n, dtype=U64)
    if n >= window:
        low = _sliding_min(_sliding(words, gram), window - gram + 1)
        anchor[: len(low)] = low
    return anchor, valid


def _cut(anchor: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length in windows of each block."""
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    runs = np.flatnonzero(new)
    edge = np.flatnonzero(valid & ~np.append(valid[1:] & ~new[1:], False)) + 1  # end of each run
    pieces = (edge - runs + RUN - 1) // RUN
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(runs, pieces) + nth * RUN
    return start, np.minimum(np.repeat(edge, pieces) - start, RUN)


def block_table(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per block of ``docs`` (doc_id, text): anchor, hash of its words, place and length."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = buffers(batch.column(1))
            for lo, hi in slices(offsets):
                words, before = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                start, n = _cut(*(found := _anchors(words, before, window, gram)))
                doc = np.searchsorted(before, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[0][start].view(np.int64)),
                        pa.array(_BODY.ranges(words, start, start + n + window - 1).view(np.int64)),
                        pa.array(ids[lo:hi][doc], pa.int64()),
                        pa.array(_text_ids(words, before)[doc]),
                        pa.array((start - before[doc]) * (2 * RUN) + n),
                    ],
                    names=["anchor", "body", "doc_id", "tid", "span"],
                )

    return docs.mapInArrow(blocks, BLOCKS)


def window_table(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Windows of the listed blocks; ``docs`` has doc_id, text, tid, spans."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            data, offsets = buffers(batch.column(1))
            lists = batch.column(3)
            spans, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
            for lo, hi in slices(offsets):
                words, before = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                span = spans[cuts[lo] : cuts[hi]]
                doc = np.repeat(np.arange(hi - lo), np.diff(cuts[lo : hi + 1]))
                right = _text_ids(words, before)[doc] == tids[lo:hi][doc]  # the row with that text
                span, doc = span[right], doc[right]
                n = span % (2 * RUN)
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc = np.repeat(doc, n)
                local = np.repeat(span // (2 * RUN), n) + within
                start = before[doc] + local
                anchor = _anchors(words, before, window, gram)[0][start]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(_BODY.ranges(words, start, start + window).view(np.int64)),
                        pa.array(ids[lo:hi][doc]),
                        pa.array(tids[lo:hi][doc]),
                        pa.array(local.astype(np.int32)),
                    ],
                    names=["anchor", "win", "doc_id", "tid", "start"],
                )

    return docs.mapInArrow(windows, WINDOWS)


def copied_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Runs of windows that an earlier document holds: doc_id, tid, start, n (windows), owner."""
    python_stage(docs.sparkSession)
    docs = docs.where("doc_id is not null")
    table = staged(block_table(docs, window, gram), "substring-blocks")
    shared = (
        table.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("body").alias("b0"), F.max("body").alias("b1"))
        .where("lo < hi")
        .select("anchor", (F.col("b0") < F.col("b1")).alias("mixed"))
    )
    met = staged(table.join(shared, "anchor"), "substring-shared")
    owners = met.groupBy("anchor", "body").agg(F.min("doc_id").alias("owner"))
    judged = staged(met.join(owners, ["anchor", "body"]), "substring-judged")
    place = F.floor(F.col("span") / (2 * RUN)).cast("int")
    whole = judged.where("doc_id > owner").select("doc_id", "tid", place.alias("start"), (F.col("span") % (2 * RUN)).cast("int").alias("n"), "owner")
    ends = judged.where("doc_id = owner and mixed").groupBy("doc_id", "tid").agg(F.collect_list("span").alias("spans"))
    wins = staged(window_table(docs.join(ends, "doc_id").select("doc_id", "text", "tid", "spans"), window, gram), "substring-windows")
    first = wins.groupBy("anchor", "win").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("hi")).where("owner < hi").drop("hi")
    single = wins.join(first, ["anchor", "win"]).where("doc_id > owner").select("doc_id", "tid", "start", F.lit(1).alias("n"), "owner")
    return whole.unionByName(single)


def factors(copied: DataFrame, window: int = WINDOW) -> DataFrame:
    """Greedy factors of each document: doc_id, tid, start_word, n_words, owner.

    Copied runs that follow each other from one owner join; a document's runs
    stand in one group, whose size its own words bound.
    """
    listed = copied.groupBy("doc_id", "tid").agg(F.array_sort(F.collect_set(F.struct("start", "n", "owner"))).alias("runs"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                last: list | None = None
                for run in row["runs"]:
                    if last and last[1] == run["owner"] and run["start"] <= last[0] + last[2]:
                        last[2] = max(last[2], run["start"] + run["n"] - last[0])
                        continue
                    if last:
                        rows.append((row["doc_id"], row["tid"], last[0], last[2] + window - 1, last[1]))
                    last = [run["start"], run["owner"], run["n"]]
                if last:
                    rows.append((row["doc_id"], row["tid"], last[0], last[2] + window - 1, last[1]))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("doc_id", "tid", "start_word", "n_words", "owner"), r, strict=True)) for r in rows],
                schema=pa.schema([("doc_id", pa.int64()), ("tid", pa.int32()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("owner", pa.int64())]),
            )

    return listed.mapInArrow(parse, "doc_id long, tid int, start_word int, n_words int, owner long")


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) without the words of ``spans`` (doc_id, tid, start_word, n_words).

    Returns doc_id, n_words, n_removed and kept (the rest, joined by one space).
    """
    python_stage(docs.sparkSession)
    listed = spans.groupBy("doc_id").agg(F.collect_list(F.struct("tid", "start_word", "n_words")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, offsets = buffers(batch.column(1))
            for lo, hi in slices(offsets):
                counts, removed, kept = [], [], []
                lists = batch.column(2).slice(lo, hi - lo).to_pylist()
                tids = [0] * (hi - lo)
                if any(lists):
                    tids = _text_ids(*word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                for i, tid, own in zip(range(lo, hi), tids, lists, strict=True):
                    words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    counts.append(len(words))
                    step = np.zeros(len(words) + 1, dtype=np.int32)
                    for s in own or ():
                        if s["tid"] == tid:
                            step[s["start_word"]] += 1
                            step[s["start_word"] + s["n_words"]] -= 1
                    stay = np.cumsum(step[:-1]) == 0
                    removed.append(len(words) - int(stay.sum()))
                    kept.append(b" ".join(compress(words, stay.tolist()) if removed[-1] else words))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    joined = docs.join(listed, "doc_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Documents without the words of duplicate spans: doc_id, n_words, n_removed, kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return remove_spans(docs, factors(copied_windows(docs, window, gram), window))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM w
), s AS (
  SELECT doc_id, pos, words[pos] AS word,
         CASE WHEN pos + 49 <= len(words) THEN sha256(array_to_string(words[pos:pos + 49], ' ')) END AS win
  FROM p
), f AS (
  SELECT doc_id, pos, word, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS copied FROM s
), c AS (
  SELECT doc_id, pos, word,
         bool_or(copied) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM f
), k AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
  FROM c GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""
