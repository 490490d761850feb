"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream of words: its documents in a seeded hash order. The
stream is cut into blocks of equal length (the last may be shorter). An epoch
takes a source's blocks in another seeded order; epochs follow each other
until the source's target is met, the last block being cut to fit.

Slot ``i`` of the mix has the van der Corput point of ``i`` (its binary digits
mirrored). Mapped through the cumulative shares of the sources, the points
deal the slots to sources evenly at every scale; the slots of a source are
ranked and the ``r``-th takes the source's ``r``-th block.

Prefix sums run in two levels (hash bucket, then inside the bucket), so a
source that holds most rows is spread over thousands of groups. Joins of tables
that grow with the input are told to merge: their files are so compressible
that their size on disk says nothing about a broadcast's. Everything is
DataFrame functions; no Python runs on the executors. What several steps read
is written between them: the driver describes a plan anew after each of its
stages, so one long plan costs it more than the short ones.

Defined results: null text or a text without words has size 0 and takes
nothing; a null source is a source of its own (last in order); repeated rows
are separate documents; an empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import staged
from riskloom.session import table_path

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_BITS = 12
CELLS = 4096  # grid over [0, 1) for the join of points with share intervals
POINT_BITS = 48
BLOCK_WORDS = 512
SEED = 17


@dataclass
class Mix:
    """``documents``: one row per input row. ``schedule``: one row per slot taken. ``sources``: targets."""

    documents: DataFrame
    schedule: DataFrame
    sources: DataFrame


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(id_col: str, text_col: str, source_col: str, seed: int = SEED) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col))


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Targets of ``sizes`` (source, source_size): ``share`` of all words by weight, none above ``cap`` times its size.

    What a capped source leaves is shared by weight among the rest until none
    is above. Sorted by cap / weight, the capped sources are a prefix, so one
    pass of prefix sums finds them. One row per source goes through one task.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    total = W.partitionBy(F.lit(0))
    by_ratio = W.orderBy(F.col("most") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    return (
        sizes.withColumn("sid", F.row_number().over(order).cast("int"))
        .withColumn("weight", cycle[(F.col("sid") - 1) % len(weights)].cast("double"))
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("pos", F.row_number().over(by_ratio))
        .withColumn("left", F.sum("source_size").over(total) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("heavy", F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("heavy"))
        .withColumn("open", F.when(F.col("level") * F.col("weight") < F.col("most"), F.struct("pos", "level")))
        .withColumn("open", F.min("open").over(total))
        .withColumn("target", F.when(F.col("pos") < F.coalesce(F.col("open.pos"), F.lit(2**31 - 1)), F.col("most")).otherwise(F.col("open.level") * F.col("weight")))
        .select("sid", "source", "source_size", "weight", "target")
    )


def _prefix(df: DataFrame, keys: list[str], bucket: str, order: list[str], amount: str) -> DataFrame:
    """Adds ``at`` (sum of ``amount`` before the row) and ``rank`` (rows before it) by keys, bucket, order."""
    parts = df.groupBy(*keys, bucket).agg(F.sum(amount).alias("s_"), F.count(F.lit(1)).alias("c_"))
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(
        *keys,
        bucket,
        F.coalesce(F.sum("s_").over(before), F.lit(0)).alias("s0_"),
        F.coalesce(F.sum("c_").over(before), F.lit(0)).alias("c0_"),
    )
    inside = W.partitionBy(*keys, bucket).orderBy(*order)
    return (
        df.withColumn("at", F.sum(amount).over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col(amount))
        .withColumn("rank", F.row_number().over(inside) - 1)
        .join(parts, [*keys, bucket])
        .withColumn("at", F.col("at") + F.col("s0_"))
        .withColumn("rank", F.col("rank") + F.col("c0_"))
        .drop("s0_", "c0_", bucket)
    )


def _points(spark: SparkSession, n: int) -> DataFrame:
    """Slots 0..n-1 with their van der Corput points."""
    mirrored = F.conv(F.reverse(F.lpad(F.bin(F.col("id")), POINT_BITS, "0")), 2, 10).cast("double")
    return spark.range(n).select(F.col("id").alias("slot"), (mirrored / F.lit(float(2**POINT_BITS))).alias("u"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> Mix:
    """Mix ``docs`` to the sources' targets; see the module docstring.

    ``documents`` has doc_id, h (hash of the row), source, size, source_size, target, start (first
    word in the source's stream), taken (words, repeats counted) and
    first_slot (null if nothing is taken). ``schedule`` has slot, source,
    epoch, block, words: the order in which the mix is read.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    sized = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(text).alias("size"),
            row_hash(id_col, text_col, source_col, seed).alias("h"),
        ),
        "mix-sized",
    )
    sources = staged(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "mix-sources")

    # each document's place in its source's stream
    side = F.broadcast(sources) if sources.count() <= CELLS else sources
    named = sized.join(side, sized["source"].eqNullSafe(sources["source"]))
    named = named.select("doc_id", sized["source"], "size", "h", "sid", "source_size", "target").withColumn("bucket", _bucket(F.col("h")))
    placed = staged(_prefix(named, ["sid"], "bucket", ["h", "doc_id", "size"], "size").withColumnRenamed("at", "start"), "mix-placed")

    # every epoch's blocks in shuffled order, up to the target
    n = F.lit(block_words)
    blocks = (
        sources.where("target >= 1")
        .select("sid", "source_size", F.floor("target").alias("quota"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("target") / F.col("source_size")).cast("int") - 1)).alias("epoch"))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("source_size") - 1) / F.lit(block_words * 4096.0)))))
        .withColumn("block", F.explode(F.sequence(F.col("part") * 4096, F.least(F.col("part") * 4096 + 4095, F.floor((F.col("source_size") - 1) / n)))))
        .withColumn("words", F.least(n.cast("long"), F.col("source_size") - F.col("block") * n))
        .withColumn("h", F.xxhash64(F.lit(seed), "sid", "epoch", "block"))
        .withColumn("bucket", F.col("epoch").cast("long") * F.lit(1 << BUCKET_BITS) + _bucket(F.col("h")))
        .drop("part")
    )
    taken = staged(
        _prefix(blocks, ["sid"], "bucket", ["h", "block"], "words")
        .where("at < quota")
        .select("sid", "epoch", "block", "rank", F.least(F.col("words"), F.col("quota") - F.col("at")).alias("words")),
        "mix-blocks",
    )

    # slots by low-discrepancy points through the cumulative shares of blocks
    counts = taken.groupBy("sid").agg(F.count(F.lit(1)).alias("n_blocks"))
    n_slots = taken.count()
    upto = W.orderBy("sid").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranges = (
        counts.withColumn("hi", F.sum("n_blocks").over(upto))
        .withColumn("lo", (F.col("hi") - F.col("n_blocks")) / F.lit(float(max(n_slots, 1))))
        .withColumn("hi", F.col("hi") / F.lit(float(max(n_slots, 1))))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1).cast("long")))))
    )
    slots = _points(spark, n_slots + n_slots // 16 + 64 if n_slots else 0).withColumn("cell", F.floor(F.col("u") * CELLS))
    dealt = slots.join(ranges, "cell").where("u >= lo and u < hi").select("sid", "slot", F.floor(F.col("slot") / 65536).alias("bucket"), F.lit(1).alias("one"))
    dealt = staged(dealt, "mix-dealt")
    ranked = _prefix(dealt, ["sid"], "bucket", ["slot"], "one").select("sid", "rank", "slot")
    # a block whose source got a slot too few stands after the dealt slots
    late = F.lit(n_slots + n_slots // 16 + 64) + F.col("rank")
    schedule = staged(
        taken.join(ranked.hint("merge"), ["sid", "rank"], "left").select("sid", F.coalesce("slot", late).alias("slot"), "epoch", "block", "words"), "mix-schedule"
    )

    # the words of each document that lie in taken blocks
    pieces = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / n), F.floor((F.col("start") + F.col("size") - 1) / n))))
        .join(schedule.hint("merge"), ["sid", "block"], "left")
        .withColumn("lo", F.greatest("start", F.col("block") * n))
        .withColumn("hi", F.least(F.col("start") + F.col("size"), F.col("block") * n + F.coalesce("words", F.lit(0))))
        .withColumn("got", F.greatest(F.col("hi") - F.col("lo"), F.lit(0)))
    )
    columns = ["doc_id", "h", "source", "size", "source_size", "target", "start"]
    full = pieces.groupBy("sid", *columns).agg(F.sum("got").alias("taken"), F.min(F.when(F.col("got") > 0, F.col("slot"))).alias("first_slot"))
    empty = placed.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot"))
    documents = full.select(*columns, "taken", "first_slot").unionByName(empty)
    return Mix(documents, schedule.join(sources.select("sid", "source"), "sid").drop("sid"), sources)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options: int) -> DataFrame:
    """``docs`` as the mix reads them: each row as often as its words are taken, to the nearest whole number.

    Identical rows share what they are taken together.
    """
    key = row_hash(id_col, text_col, source_col)
    mix = mix_sources(docs, id_col, text_col, source_col, **options)
    times = mix.documents.where("size > 0").groupBy(F.col("h").alias("mix_key_")).agg(F.sum(F.floor(F.col("taken") / F.col("size") + 0.5)).alias("mix_times_"))
    times = staged(times, "mix-times")
    keyed = docs.withColumn("mix_row_", key).dropDuplicates(["mix_row_"])
    joined = keyed.join(times.where("mix_times_ > 0").hint("merge"), F.col("mix_row_") == F.col("mix_key_"))
    return joined.withColumn("mix_nth_", F.explode(F.sequence(F.lit(1).cast("long"), "mix_times_"))).select(*[keyed[c] for c in docs.columns])


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    return mix_sources(docs).documents.select("doc_id", "size", "source_size", "target", "taken", "source", "first_slot")
